import collections

import plain

import corpus_pipeline
from paperwarden.llm import decontaminate, mixing, sentence_spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(rng):
    passages = [plain.prose(rng, 60) for _ in range(3)]
    items = [(i, plain.prose(rng, 30)) for i in range(5)]
    texts = [plain.prose(rng, rng.randint(30, 90)) for _ in range(60)]
    texts += plain.near_copies(rng, 12, 80, 2) + [texts[0]] * 5
    texts += [f"{plain.prose(rng, 40)}\n{rng.choice(passages)}\n{plain.prose(rng, 30)}" for _ in range(15)]
    texts += [f"{plain.prose(rng, 40)} {rng.choice(items)[1]} {plain.prose(rng, 30)}" for _ in range(6)]
    texts += ["junk " * 40, "", None, "few words", "\n".join([plain.prose(rng, 15)] * 6)]
    rng.shuffle(texts)
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return rows, items


def plainly(rows, items):
    """What each stage leaves, the slow way."""
    kept = [r for r in rows if plain.rule_verdict(plain.rule_measures(r[1]))[1]]
    yield kept
    first = {i: c for i, _, c in plain.classes([(r[0], r[1]) for r in kept])}
    kept = [r for r in kept if first[r[0]] == r[0]]
    yield kept
    cleaned = plain.without_repeats([(r[0], r[1]) for r in kept], sentence_spans.sentences,
                                    sentence_spans.MIN_SENTENCES, sentence_spans.MIN_WORDS)
    kept = [(r[0], cleaned[r[0]], *r[2:4], len(cleaned[r[0]])) for r in kept]
    yield kept

    def leaks(text):
        plain_text = decontaminate.normal(text)
        return any(plain.edits_in(piece, plain_text) <= int(decontaminate.EDIT_SHARE * len(piece))
                   for piece in (decontaminate.normal(t) for _, t in items))

    kept = [r for r in kept if not leaks(r[1])]
    yield kept


def test_stages_against_plain_versions(spark, tmp_path):
    rows, items = corpus(plain.rng(21))
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, sizes = spark.createDataFrame(rows, SCHEMA), [len(rows)]
    for number, ((_, stage), expected) in enumerate(zip(corpus_pipeline.STAGES, plainly(rows, items))):
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        made.write.parquet(f"{folder}/stage{number}")
        docs = spark.read.parquet(f"{folder}/stage{number}")
        assert sorted(map(tuple, docs.collect())) == sorted(expected)
        sizes.append(len(expected))
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 30
    mix = corpus_pipeline.run(spark, folder).collect()
    by_source = collections.defaultdict(int)
    for r in expected:
        by_source[r[3]] += len(plain.words(r[1]))
    assert {r.doc_id: r.size for r in mix} == {r[0]: len(plain.words(r[1])) for r in expected}
    targets = plain.targets(by_source)
    taken = collections.Counter()
    for r in mix:
        assert r.taken <= 2 * r.size and abs(r.target - targets[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= 2 * mixing.BLOCK_WORDS for s, t in targets.items())


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, "an item of some words that nothing has")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    good = [(i, plain.prose(plain.rng(i), 40)) for i in (60, 61)]
    for rows in ([], [*plain.ODD_ROWS, *good, *good, (None, good[0][1]), (None, plain.prose(plain.rng(7), 40))]):
        docs = plain.odd_docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, folder)
            assert made.columns == docs.columns
            docs = made
        ids = sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is None, i))
        assert ids == ([60, 61, None] if rows else [])
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(ids)
