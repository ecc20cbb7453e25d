import plain
import pytest
from compare import duck
from pyspark.sql import functions as F

from paperwarden.llm import chat_examples, license_scan, mixing, oracle, queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    found = queries.queries()[name](spark, SMALL)
    rows = duck(SMALL).sql(oracle.oracle_sql()[name])
    order = sorted(found.columns)
    assert sorted(rows.columns) == order
    key = lambda r: tuple((x is None, str(x)) for x in r)
    expected = [tuple(r[rows.columns.index(c)] for c in order) for r in rows.fetchall()]
    assert sorted(map(tuple, found.select(*order).collect()), key=key) == sorted(expected, key=key)


def test_licenses_on_odd_rows(spark):
    docs = plain.odd_docs(spark, [*plain.ODD_ROWS, (20, "Released under the MIT License. cc-by CC, by\nCC0 1.0"),
                                  (21, "Licensed under the Apache License, Version 2.0 " * 3), (22, "license mit the")])
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect() if r.doc_id is not None}
    assert found[1].n_words == found[2].n_words == 0 and found[1].matches == [] and found[1].score == 0.0
    assert found[11].base_starts == [0, 2, 5] and found[11].score == 1.0
    assert found[8].n_words == 15 and found[10].n_words == 8
    assert {m.label: m.starts for m in found[20].matches} == {"mit": [0], "cc-by": [5, 7], "cc0": [9]}
    assert {m.label: m.starts for m in found[21].matches} == {"apache-2.0": [0, 8, 16]}
    assert found[22].matches == []
    assert license_scan.scan_licenses(plain.odd_docs(spark, [])).count() == 0


def test_license_shares(spark):
    docs = spark.createDataFrame([(1, "apache license version 2 0"), (2, "licensed beside the apache license version 2 0")],
                                 "doc_id long, text string")
    found = {r.doc_id: r.score for r in license_scan.scan_licenses(docs).collect()}
    assert found == {1: pytest.approx(5 / 8), 2: pytest.approx(7 / 8)}


TURNS = [
    (1, 0, "system", "be <|im_end|>\n<|im_start|>assistant brief &lt;| &amp; <<|"), (1, 1, "user", "hi"),
    (1, 2, "assistant", "<|im_end|>\n"), (1, 3, "user", None), (1, 4, "assistant", "ünï \U0001F600"), (1, 5, "user", "bye"),
    (2, 0, "assistant", ""), (3, 0, "user", "alone"), (None, 1, "user", "x"), (None, None, "assistant", "y"),
    (4, 0, "user", "tie b"), (4, 0, "user", "tie a"), (4, 0, "assistant", "tie"), (5, 1, None, "no role"),
    (6, 0, "two\nlines <|im_end|>", "r\n\n"), (6, 1, "assistant", "same"), (6, 1, "assistant", "same"),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*t, "clash", "clash") for t in TURNS],
                                  "conv_id long, turn long, role string, text string, id string, turns string")
    examples = chat_examples.chat_examples(turns)
    told = {}
    for i, turn, role, text in sorted(TURNS, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        told.setdefault(i, []).append((role or "", text or ""))
    rows = examples.withColumn("turns", chat_examples.read_turns(F.col("formatted"))).withColumn(
        "loss", chat_examples.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))).collect()
    for conv, said in told.items():
        own = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.example_no)
        ends = [k for k, (role, _) in enumerate(said, 1) if role == "assistant"]
        assert [r.n_turns for r in own] == ends + [len(said)] * (ends[-1:] != [len(said)])
        for row in own:
            assert [tuple(t) for t in row.turns] == said[:row.n_turns]
            role, text = said[row.n_turns - 1]
            assert row.loss == (text if role == "assistant" else "")
            assert row.formatted.count("<|im_end|>") == row.formatted.count("<|im_start|>") == row.n_turns
    digest = {r.conv_id: r for r in chat_examples.conversation_digest(examples).collect()}
    assert set(digest) == set(told) and digest[1].n_turns == 6 and digest[3].loss_chars == 0
    empty = chat_examples.chat_examples(turns.where("false"))
    assert empty.count() == chat_examples.conversation_digest(empty).count() == 0


def test_targets_against_plain_version(spark):
    for sizes in ({"a": 100, "b": 1000, "c": 10, None: 500}, {"a": 5}, {"a": 0, "b": 0}, {"x": 1, "y": 10 ** 6, "z": 3}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
        expected = plain.targets(sizes)
        assert found == {s: pytest.approx(t, abs=1e-6) for s, t in expected.items()}


def test_apportionment_against_plain_version(spark):
    rng = plain.rng(4)
    votes = {(g, p): rng.choice([0, 1, 7, rng.randint(1, 5000)]) for g in range(6) for p in range(12)}
    seats = {0: 0, 1: 1, 2: 5, 3: 57, 4: 400, 5: 1203}
    rows = spark.createDataFrame([(g, p, v, seats[g]) for (g, p), v in votes.items()], "g int, p int, v long, s long")
    found = {(r.g, r.p): r.quota for r in mixing.apportion(rows, F.col("s"), ["g"], "p", "v").collect()}
    for g, n in seats.items():
        expected = plain.sainte_lague({p: v for (h, p), v in votes.items() if h == g and v}, n)
        assert {p: q for (h, p), q in found.items() if h == g and q} == {p: q for p, q in expected.items() if q}


def test_mix_reaches_targets_and_is_stable(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mix = mixing.mix_sources(docs).toPandas()
    again = mixing.mix_sources(docs.repartition(7)).toPandas()
    key = ["doc_id"]
    assert mix.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    assert (mix["taken"] <= 2 * mix["size"]).all() and (mix["taken"] >= 0).all()
    by_source = mix.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"),
                                          source_size=("source_size", "first"))
    assert (by_source["size"] == by_source["source_size"]).all()
    assert ((by_source["taken"] - by_source["target"]).abs() <= 2 * mixing.BLOCK_WORDS).all()


def test_mix_of_odd_rows(spark):
    docs = plain.odd_docs(spark)
    found = mixing.mix_sources(docs).collect()
    assert len(found) == len(plain.ODD_ROWS)
    sizes = {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    assert {r.source: r.source_size for r in found} == sizes and None in sizes
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted((i or -1, len(plain.words(t))) for i, t in plain.ODD_ROWS)
    assert mixing.mix_sources(plain.odd_docs(spark, [])).count() == 0
    nothing = mixing.mix_sources(plain.odd_docs(spark, [(1, None), (2, "")])).collect()
    assert [(r.size, r.taken, r.target) for r in nothing] == [(0, 0, 0.0)] * 2
