import collections
import gc
import math
import random
import zlib

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperwarden.llm import bloom_lm, queries

END = None


def tokens(text):
    return [*plain.words(plain.lowered(text)), END]


def counted(rows):
    words, pairs = collections.Counter(), collections.Counter()
    for _, text, trained in rows:
        if trained:
            said = tokens(text)
            words.update(said)
            pairs.update(zip([END, *said], said))
    return words, pairs


def middle(n):
    digits = n.bit_length()
    return (2 ** (digits - 1) + 2 ** digits - 1) / 2 if n else 0.0


def scores(rows):
    """(id, trained, n_tokens, n_known, base, score) from dictionaries of counts."""
    words, pairs = counted(rows)
    total = sum(words.values()) + len(words) + 1
    made = []
    for i, text, trained in rows:
        said = tokens(text)
        base = sum(math.log10((words[w] + 1) / total) for w in said)
        score = 0.0
        for v, w in zip([END, *said], said):
            one = (middle(words[w]) + 1) / total
            seen = middle(words[v])
            both = min(middle(pairs[v, w]), middle(words[w]), seen)
            score += math.log10(min(1.0, (both + bloom_lm.MU * one) / (seen + bloom_lm.MU)))
        made.append((i, trained, len(said), sum(words[w] > 0 for w in said), base, score))
    return made, sum(words.values())


def check(found, rows):
    """Exact columns are equal; scores are but for the few false positives of the filter."""
    expected, n = scores(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], round(r[4], 6))
    got = sorted(((r.doc_id, r.trained, r.n_tokens, r.n_known, r.base_score, r.score, r.train_tokens) for r in found), key=key)
    off = 0.0
    for a, b in zip(got, sorted(expected, key=key), strict=True):
        assert a[:4] == b[:4] and a[6] == n
        assert a[4] == pytest.approx(b[4], abs=1e-6)
        off += abs(a[5] - b[5])
        assert abs(a[5] - b[5]) <= 0.03 * abs(b[5]) + 0.9 and a[5] <= 0
    assert off <= 0.005 * sum(abs(r[5]) for r in expected)


@pytest.mark.parametrize("sizes", [{}, {"ZONE_BYTES": 20_000, "BUCKET_BYTES": 10, "SLICE_BYTES": 200, "MIN_BUCKETS": 2}])
def test_equals_plain_counts(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(bloom_lm, name, value)
    rng = random.Random(5)
    texts = [plain.prose(rng, rng.randint(0, 80)) for _ in range(300)]
    rows = [(i, t if i % 9 else t.upper(), i % 3 > 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, k) for i, t, k in rows], "doc_id long, text string, k boolean").repartition(5)
    check(bloom_lm.score_documents(docs, F.col("k")).collect(), rows)


def test_odd_rows(spark):
    docs = plain.odd_docs(spark)
    given = [(r.doc_id, r.text, r.doc_id is None or r.doc_id % 4 > 0) for r in docs.collect()]
    trained = F.coalesce(docs["doc_id"] % 4 > 0, F.lit(True))
    check(bloom_lm.score_documents(docs, trained).collect(), given)
    assert bloom_lm.score_documents(docs.limit(0), trained).count() == 0
    nothing = bloom_lm.score_documents(docs, F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in nothing} == {(0, 0, 0.0, 0.0)}


def test_query_against_plain_counts(spark):
    given = spark.read.parquet(f"{plain.BENCHMARK_PATH}/documents.parquet").collect()
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in given]
    found = queries.op12_bloom_lm(spark, plain.BENCHMARK_PATH)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(found.withColumn("trained", ~F.col("held_out")).collect(), rows)


def test_filter_never_misses_and_seldom_invents():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 50, 40_000, dtype=np.uint64))
    counts = rng.geometric(0.3, len(keys)) ** 3
    bits = bloom_lm.filter_part(keys, counts)
    zone = bloom_lm.Zone(0, np.array([0]), np.array([len(bits)]), bits, keys[:0], counts[:0])
    found = zone.levels(keys, np.zeros(len(keys), np.int64))
    assert (found >= bloom_lm.levels_of(counts)).all() and (found == bloom_lm.levels_of(counts)).mean() > 0.97
    others = rng.integers(1 << 50, 1 << 51, 40_000, dtype=np.uint64)
    assert (zone.levels(others, np.zeros(len(others), np.int64)) > 0).mean() < 0.03


def test_text_like_the_corpus_scores_higher(spark):
    rng = random.Random(2)
    train = [plain.prose(rng, 60, ["red", "green", "blue", "sky", "sea"]) for _ in range(200)]
    asked = plain.prose(rng, 60, ["red", "green", "blue", "sky", "sea"])
    mixed = asked.split()
    rng.shuffle(mixed)
    rows = [(i, t, True) for i, t in enumerate(train)] + [(1000, asked, False), (1001, "zq " * 60, False)]
    found = bloom_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string, k boolean"), F.col("k"))
    by_id = {r.doc_id: r.score / r.n_tokens for r in found.collect()}
    assert by_id[1000] > by_id[1001] and by_id[1000] > -1.2


def test_keys_keep_their_bucket():
    for bytes_ in (0, 10 ** 9, 10 ** 14):
        layout = bloom_lm.choose_layout(bytes_)
        hashes = np.random.default_rng(3).integers(0, 1 << 63, 1_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for width in (bloom_lm.WORD_BYTES, bloom_lm.PAIR_BYTES):
            keys = layout.keys(hashes, width)
            buckets = layout.buckets(keys, width)
            assert (buckets == (hashes >> np.uint64(64 - layout.bucket_bits))).all()
            assert (layout.unpack(bloom_lm.pack(keys, width), buckets, width) == keys).all()
            assert (layout.zone(buckets) < layout.zones).all()


def test_workers_give_memory_back(monkeypatch):
    """After the n-grams of a slice are sent, none of the arrays they were made of is held."""
    held = []
    monkeypatch.setattr(bloom_lm, "release_memory", lambda: held.append(sum(isinstance(x, bloom_lm.Tokens) for x in gc.get_objects())))
    texts = pa.array(["a b c", "b c d", ""])
    table = pa.table({"slice": pa.array([0] * 3, pa.int64()), "trained": [True, False, True], "text": texts})
    made = bloom_lm._send(bloom_lm.choose_layout(10), range(2))(table)
    assert held == [0] and made.num_rows > 0
