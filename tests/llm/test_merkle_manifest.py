import hashlib
import zlib

import plain
import pytest
from pyspark.sql import functions as F

from paperwarden.llm import merkle_manifest
from paperwarden.operators.ranks import rank_rows, running
from paperwarden.operators import scale


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    told = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return digest(*told)


def proofs(leaves):
    """The root of a list of digests, and for each of them its (left, right) siblings from the run to the root."""
    paths, places, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, place in zip(paths, places):
            start = place - place % 8
            path.append(("".join(level[start:place]), "".join(level[place + 1:start + 8])))
        level = [digest(*level[k:k + 8]) for k in range(0, len(level), 8)]
        places = [p // 8 for p in places]
    return level[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], leaf_of(row)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    told = [sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for g in order]
    trees = [proofs([leaf for _, leaf in t]) for t in told]
    root, above = proofs([subroot for subroot, _ in trees])
    return sorted((i is not None, i or 0, leaf, subroot, root, [*path, *up])
                  for t, (subroot, paths), up in zip(told, trees, above) for (i, leaf), path in zip(t, paths))


FIELDS = "doc_id long, source string, lang string, n_chars long, text string, id string, row string, node string"


@pytest.mark.parametrize("count, langs", [(1, 1), (9, 1), (600, 11), (70, 70)])
def test_manifest_equals_plain_trees(spark, count, langs):
    rows = [(i * 7 % 1000, f"s{i % 3}", None if langs > 1 and i % langs == 0 else f"lÄ{i % langs}", i, f"Text {i} é" * (i % 5))
            for i in range(count)]
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], FIELDS).repartition(7)
    found = merkle_manifest.merkle_manifest(docs).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path])
                  for r in found) == expected(rows)


def test_odd_rows_and_tampering(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, "s", "en", 0, ""), (3, "s", "en", 2, "A"),
            (3, "s", "en", 2, "B"), (3, "s", "en", 2, "B"), (4, "s", "en", 1, "long " * 200_000), (-5, "s", "", 1, "x\n|:-"),
            (6, None, "é", None, "😀"), (7, "1:a", "en", 1, "-")]
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], FIELDS)
    other = merkle_manifest.row_digest([F.col(c) if c != "text" else F.lower("text") for c in merkle_manifest.FIELDS])
    found = merkle_manifest.merkle_manifest(docs, carry={"claimed": other})
    found = found.withColumn("folded", merkle_manifest.fold(F.col("claimed"), F.col("path")))
    found = found.withColumn("own", merkle_manifest.fold(F.col("leaf"), F.col("path"))).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path])
                  for r in found) == expected(rows)
    assert all(r.own == r.root for r in found)
    assert sorted(r.doc_id for r in found if r.folded != r.root) == [3, 3, 3]
    assert merkle_manifest.merkle_manifest(docs.limit(0)).count() == 0


def test_every_third_document_fails_the_query(spark):
    from paperwarden.llm import queries
    rows = queries.op13_merkle_manifest(spark, plain.BENCHMARK_PATH).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{plain.BENCHMARK_PATH}/documents.parquet").collect()}
    for r in rows:
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and texts[r.doc_id] != plain.lowered(texts[r.doc_id])
        assert r.verified == (not changed)


def test_ranks_of_a_group_in_many_partitions(spark):
    rows = spark.range(5_000).select(F.when(F.col("id") % 3 > 0, "hot").alias("g"), (F.col("id") * 7919 % 5_000).alias("v"), "id")
    found = rank_rows(rows, ["g"], ["v", "id"], scale.workspace(spark), "place").collect()
    for g in ("hot", None):
        own = sorted((r.v, r.place) for r in found if r.g == g)
        assert [p for _, p in own] == list(range(len(own)))


@pytest.mark.parametrize("backwards", [False, True])
def test_running_totals_over_chunks(spark, backwards):
    rows = [(k, p, p % 17 + 1) for k, n in ((1, 9_000), (2, 1), (3, 4_097)) for p in range(n)]
    table = spark.createDataFrame(rows, "key long, place long, v long").repartition(5)
    found = {(r.key, r.place): (r.total, r.mixed) for r in running(
        running(table, "key", "place", {"total": F.col("v")}, scale.workspace(spark), backwards),
        "key", "place", {"mixed": F.col("v")}, scale.workspace(spark), backwards, xor=True).collect()}
    for key, n in ((1, 9_000), (2, 1), (3, 4_097)):
        total = mixed = 0
        for place in (reversed(range(n)) if backwards else range(n)):
            total, mixed = total + place % 17 + 1, mixed ^ (place % 17 + 1)
            assert found[key, place] == (total, mixed)
