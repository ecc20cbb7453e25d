import plain
import pytest

from paperwarden.llm import jaccard_join, sentence_spans
from paperwarden.llm.batches import WordHashes
from paperwarden.llm.components import components
from paperwarden.operators.scale import Workspace

BIG = [f"v{i}" for i in range(4000)]


def crowded_rows():
    """Near copies around two like bases, a passage that many texts share, texts of little else, short texts, copies."""
    rng = plain.rng(6)
    passage = plain.prose(rng, 60, BIG)
    texts = [f"{plain.prose(rng, rng.randint(30, 90), BIG)} {passage} {plain.prose(rng, 15, BIG)}" for _ in range(70)]
    texts += [f"{passage} {plain.prose(rng, rng.randint(3, 12), BIG)}" for _ in range(40)]
    texts += plain.near_copies(rng, 90, 110, 5, BIG)
    base = plain.near_copies(rng, 30, 60, 6, BIG)
    texts += [*base, *(" ".join([*b.split()[:45], *plain.prose(rng, 15, BIG).split()]) for b in base[:12])]
    texts += [plain.prose(rng, rng.randint(0, 9)) for _ in range(40)]
    texts += [rng.choice(texts) for _ in range(50)]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("kept_whole, hot_classes", [(jaccard_join.KEPT_WHOLE, jaccard_join.HOT_CLASSES), (0, 3)])
def test_join_against_all_pairs(spark, monkeypatch, kept_whole, hot_classes):
    monkeypatch.setattr(jaccard_join, "KEPT_WHOLE", kept_whole)
    monkeypatch.setattr(jaccard_join, "HOT_CLASSES", hot_classes)
    rows = crowded_rows()
    found = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert sorted(map(tuple, found.collect())) == sorted(plain.classes(rows))


def near_pairs():
    """Pairs of equally long texts just above the least similarity that links them, each pair in words of its own."""
    rng = plain.rng(21)
    texts = []
    for k in range(200):
        n = rng.randint(40, 120)
        new = n // 9  # (n - new) / (n + new) >= 0.8
        words = [f"p{k}w{i}" for i in range(n + 4 + new)]
        texts += [" ".join(words[:n + 4]), " ".join(words[new:])]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_matrix_links_near_pairs_without_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_groups", lambda reps, texts, work: spark.createDataFrame(
        [], "r bigint, id bigint, leader bigint"))
    rows = near_pairs()
    expected = sorted(plain.classes(rows))
    assert sum(i != c for i, _, c in expected) == len(rows) // 2
    found = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert sorted(map(tuple, found.collect())) == expected


def test_unlike_texts_under_one_id(spark):
    """Rows (1, A), (1, B), (2, A'), (3, B'): both texts of row 1 link to their own near copies."""
    rng = plain.rng(31)
    rows = []
    for k in range(0, 60, 10):
        (a, a_), (b, b_) = (plain.near_copies(rng, 2, 120, 2, BIG) for _ in range(2))
        rows += [(k + 1, a), (k + 1, b), (k + 2, a_), (k + 3, b_), (k + 4, plain.prose(rng, 100, BIG))]
    found = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(map(tuple, found.collect())) == sorted(plain.classes(rows))


def test_sets_of_columns_equal_those_of_texts(spark):
    import pyarrow as pa
    texts = [t for _, t in plain.ODD_ROWS] + ["a b c d", "A a\x0bb\tc  d e e e e e e", "x\x1cy z", ""]
    hashes = WordHashes()
    for found, text in zip(jaccard_join.token_sets(pa.array(texts)), texts, strict=True):
        assert (found == jaccard_join.shingles(text, hashes)).all() and len(found) == len(plain.shingle_set(text))


def test_large_crowds_open_in_rounds(spark, monkeypatch):
    """Groups of two of a crowd that blocks alone leave apart come together without opening every pair."""
    monkeypatch.setattr(jaccard_join, "GROUP", 2)
    monkeypatch.setattr(jaccard_join, "ORDERS", 1)
    opened = spark.sparkContext.accumulator(0)
    real = jaccard_join._opened

    def counted(turn, *rest):
        opened.add(turn.count())
        return real(turn, *rest)

    monkeypatch.setattr(jaccard_join, "_opened", counted)
    rng = plain.rng(17)
    rows = list(enumerate(plain.near_copies(rng, 300, 400, 8, BIG)))
    found = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(map(tuple, found.collect())) == sorted(plain.classes(rows))
    assert 0 < opened.value < 10 * len(rows)


def test_a_crowd_below_the_limit_gives_no_candidates(spark, monkeypatch):
    """Texts of one template that share 85 of 100 shingles, which links unlike sizes only, and a few that are linked."""
    rng = plain.rng(17)
    base = plain.prose(rng, 200, BIG).split()
    rows = []
    for i in range(40):
        words = list(base)
        for k, place in enumerate(rng.sample(range(5, 195, 6), 3)):
            words[place] = f"own{i}x{k}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, text.replace(f"own{i}x0", "other")) for i, text in rows[:3]]
    counts, make = [], jaccard_join._candidates

    def counted(*args):
        found = make(*args)
        counts.append(found.count())
        return found

    monkeypatch.setattr(jaccard_join, "_candidates", counted)
    found = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, found.collect())) == sorted(plain.classes(rows))
    assert counts[0] < 150  # of 903 pairs


def test_join_on_odd_rows(spark):
    rows = [*plain.ODD_ROWS, (30, "A b C d e f"), (29, "a B c D E F"), (31, "a b c d e f g"), (32, "Ä b c d e f")]
    docs = plain.odd_docs(spark, rows)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    found = jaccard_join.similar_documents(docs)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(
        ((i, n, i if n == 0 else c) for i, n, c in plain.classes(rows)), key=key)
    kept = jaccard_join.keep_first(docs)
    assert kept.schema == docs.schema
    assert sorted(kept.select("doc_id").collect(), key=key) == sorted(
        [(i,) for i in (1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 29, 31, 32, None, None)], key=key)
    empty = plain.odd_docs(spark, [])
    assert jaccard_join.similar_documents(empty).count() == jaccard_join.keep_first(empty).count() == 0


def test_shingle_sets():
    hashes = WordHashes()
    for text in ("", None, "a", "a b c d", "a b c d e", "A a\x0bb\tc  d e e e e e e", "a b c d e f"):
        assert len(jaccard_join.shingles(text, hashes)) == len(plain.shingle_set(text))
    assert set(jaccard_join.shingles("A b C d e", hashes)) == set(jaccard_join.shingles("a B c D E", hashes))


def test_components(spark):
    rng = plain.rng(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [
        (rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    parent = {x: x for pair in links for x in pair}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    work = Workspace(spark)
    found = components(spark.createDataFrame(links, "a long, b long"), work)
    assert {r.id: r.class_id for r in found.collect()} == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long"), work).count() == 0
    work.close()


def test_spans_against_plain_version(spark):
    rng = plain.rng(8)
    passages = [plain.prose(rng, n) for n in (55, 60, 80, 120)]
    rows = []
    for i in range(60):
        parts = [plain.prose(rng, rng.randint(0, 60))]
        for p in rng.sample(passages, rng.randint(0, 2)) + ([parts[0]] if i % 9 == 0 else []):
            parts += [p, plain.prose(rng, rng.randint(5, 30))]
        rows.append((i, rng.choice(["\n", " "]).join(parts)))
    rows += [(100, None), (101, ""), (102, "?! ... \n\n !"), (103, "a, " * 80), (104, "word " * 200)]
    expected = plain.without_repeats(rows, sentence_spans.sentences, sentence_spans.MIN_SENTENCES,
                                     sentence_spans.MIN_WORDS)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sentence_spans.remove_repeats(docs, counts=("n_sentences", "n_removed")).collect()
    assert {r.doc_id: r.text for r in found} == expected
    assert sum(r.n_removed > 0 for r in found) > 20


def test_repeated_passage_goes_and_the_rest_stays(spark):
    rng = plain.rng(12)
    passage = plain.prose(rng, 70)
    rows = [(i, f"{plain.prose(plain.rng(i), 50)}\n{passage}\n{plain.prose(plain.rng(50 + i), 40)}") for i in range(1, 5)]
    rows.append((9, plain.prose(plain.rng(99), 200)))
    found = {r.doc_id: r.text for r in sentence_spans.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert passage in found[1] and found[1] == rows[0][1] and found[9] == rows[-1][1]
    for i in (2, 3, 4):
        assert found[i] == rows[i - 1][1].replace(passage + "\n", "")


def unmarked(rng, count):
    return " ".join(rng.choices(BIG, k=count))


def unspaced(rng, count):
    return "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(count))


def shared_share(rng, passages, glued):
    """Share of passages that have a common span in two texts which ``glued`` makes around them."""
    common = 0
    for passage in passages:
        one, other = (set(sentence_spans.spans(sentence_spans.sentences(glued(passage)))[2].tolist()) for _ in range(2))
        common += bool(one & other)
    return common / len(passages)


def test_passages_inside_long_sentences_are_found():
    rng = plain.rng(31)
    around = lambda p: f"{unmarked(rng, rng.randint(3, 60))} {p} {unmarked(rng, rng.randint(3, 60))}"
    for count in (60, 200):
        assert shared_share(rng, [unmarked(rng, count) for _ in range(100)], around) == 1


def test_passages_in_scripts_without_spaces_are_found():
    rng = plain.rng(32)
    around = lambda p: f"{unspaced(rng, rng.randint(3, 40))}{p}{unspaced(rng, rng.randint(3, 40))}。"
    assert shared_share(rng, [unspaced(rng, 60) for _ in range(100)], around) == 1
    stops = ["。".join(unspaced(rng, 12) for _ in range(4)) for _ in range(100)]
    assert shared_share(rng, stops, around) == 1
    text = "第一句话。第二句话，还有！Third one. 第四？"
    parts = sentence_spans.sentences(text)
    assert "".join(text[a:b] for a, b, _ in parts) == text and len(parts) == 4


def test_spans_on_odd_rows(spark):
    text = plain.prose(plain.rng(3), 60)
    rows = [*plain.ODD_ROWS, (40, text), (40, text), (41, text), (None, text), (None, f"{text}\n{text}")]
    docs = plain.odd_docs(spark, rows)
    found = sentence_spans.remove_repeats(docs)
    assert found.schema == docs.schema
    texts = [(r.doc_id, r.text) for r in found.collect()]
    assert len(texts) == len(rows) and texts.count((40, text)) == 2 and (41, "") in texts
    assert texts.count((None, text)) == 1 and (None, f"{text}\n") in texts and (1, None) in texts
    assert sentence_spans.remove_repeats(plain.odd_docs(spark, [])).count() == 0


def test_ascii_words_are_read_without_a_pattern(monkeypatch):
    text = "One_2  two's\tTHREE-four, five\x1csix: " + " ".join(f"W{i % 37}-x{i}" for i in range(60)) + "!? ...\n\nEnd"
    expected = [(a, b, sentence_spans._WORD_PLAIN.findall(text[a:b].lower())) for a, b, _ in sentence_spans.sentences(text)]

    class Places:
        finditer = sentence_spans._WORD_PLAIN.finditer

    monkeypatch.setattr(sentence_spans, "_WORD_PLAIN", Places)
    found = sentence_spans.sentences(text)
    assert found == expected and "".join(text[a:b] for a, b, _ in found) == text


def test_sentences_join_to_the_text():
    for _, text in plain.ODD_ROWS:
        if text is not None:
            parts = sentence_spans.sentences(text)
            assert "".join(text[a:b] for a, b, _ in parts) == text
            assert all(len(w) <= sentence_spans.LONG_WORDS for _, _, w in parts)
