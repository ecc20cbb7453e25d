import plain
from paperwarden.llm import decontaminate
from paperwarden.llm.decontaminate import EDIT_SHARE, PIECE_CHARS, Pieces, aligned, normal


def noisy(rng, text, edits):
    made = list(text)
    for _ in range(edits):
        place = rng.randrange(len(made))
        made[place:place + 1] = rng.choice([[], ["q"], ["q", made[place]]])
    return "".join(made)


def test_filter_loses_nothing_that_alignment_finds():
    rng = plain.rng(5)
    items = [(i, plain.prose(rng, n)) for i, n in enumerate((6, 10, 16, 25, 30, 40, 60, 90))]
    pieces = Pieces.of(items)
    hits = 0
    for i, text in items:
        m = len(normal(text))
        for share in (0, 0.3, 0.7, 1.0, 1.3, 2.5):
            doc = f"{plain.prose(rng, 30)} {noisy(rng, normal(text), int(share * EDIT_SHARE * m))} {plain.prose(rng, 30)}"
            plainly = set()
            for name, codes, budget in zip(pieces.items, pieces.codes, pieces.budgets):
                piece = "".join(map(chr, codes))
                if plain.edits_in(piece, normal(doc)) <= budget:
                    plainly.add(name)
            found = {f[0] for f in pieces.find(doc)} - {name for name, _ in pieces.short}
            assert found == plainly
            hits += i in plainly
    assert hits > 20


def test_quotes_of_a_part_of_an_item_are_found():
    rng = plain.rng(7)
    for chars, first, last in ((200, 0, 170), (200, 30, 200), (200, 15, 185), (394, 60, 320), (394, 130, 260)):
        item = normal(plain.prose(rng, 90))[:chars]
        pieces = Pieces.of([(1, item)])
        assert {f[0] for f in pieces.find(f"{plain.prose(rng, 40)} {item[first:last]} {plain.prose(rng, 40)}")} == {1}
        assert pieces.find(plain.prose(rng, 200)) == []


def test_alignment_counts_edits():
    rng = plain.rng(1)
    for _ in range(60):
        piece = plain.prose(rng, 12)
        region = noisy(rng, piece, rng.randint(0, 6)) + plain.prose(rng, 3)
        room = "\0" * 40
        edits, end = aligned(decontaminate._codes(piece), decontaminate._codes(room + region + room))
        assert edits == plain.edits_in(piece, region)
        assert 40 < end <= 40 + len(region)


def test_passages_at_both_ends_of_a_text():
    rng = plain.rng(2)
    item = normal(plain.prose(rng, 40))
    pieces = Pieces.of([(1, item)])
    rest = plain.prose(rng, 30)
    for cut in (item, item[3:], item[:-3], item[2:-2], "q" + item[2:]):
        for text in (cut, f"{cut} {rest}", f"{rest} {cut}"):
            assert {f[0] for f in pieces.find(text)} == {1}


def test_rolling_hash_depends_on_the_gram_only():
    codes = decontaminate._codes("abcabcabcabcabcabcxbcabcabcabcabc")
    for q in (1, 2, 3, 7, 8, 10, 13):
        hashes = decontaminate.rolling(codes, q)
        grams = [tuple(codes[i:i + q]) for i in range(len(codes) - q + 1)]
        assert len(hashes) == len(grams)
        assert len(set(zip(grams, hashes.tolist()))) == len(set(grams)) == len(set(hashes.tolist()))


def test_given_passages_are_found_and_clean_documents_kept(spark):
    small = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    items = {r.item_id: f" {normal(r.text)} " for r in benchmark.collect()}
    found = {r.doc_id: set(r.item_ids) for r in decontaminate.find_contamination(docs, benchmark).collect()}
    texts = {r.doc_id: f" {normal(r.text)} " for r in docs.collect()}
    assert set(found) == set(texts)
    verbatim = {i: {k for k, item in items.items() if item in text} for i, text in texts.items()}
    assert all(verbatim[i] <= found[i] for i in found)
    assert sum(map(bool, verbatim.values())) >= 10
    assert sum(bool(found[i]) and not verbatim[i] for i in found) <= 2
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i, f in found.items() if not f}


def test_places_blocks_and_long_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2_000)
    rng = plain.rng(3)
    items = [(i, plain.prose(rng, 60)) for i in range(40)] + [(99, plain.prose(rng, 600))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(decontaminate.benchmark_blocks(benchmark, "item_id", "text")) > 5
    quote = " ".join(items[-1][1].split()[200:320])
    assert len(quote) > 2 * PIECE_CHARS
    rows = [(1, f"Before it. {items[3][1].upper()} After."), (2, plain.prose(rng, 100)), (3, f"He said: {quote}!"),
            (4, f"{items[5][1]}\n\n{items[7][1]}")]
    found = {r.doc_id: r for r in decontaminate.find_contamination(
        spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()}
    assert found[1].item_ids == [3] and found[3].item_ids == [99] and found[4].item_ids == [5, 7]
    assert not found[2].contaminated and found[2].item_ids == []
    place = found[1].passages[0]
    assert rows[0][1][place.first_char:place.last_char].lower().startswith(items[3][1][:20].lower())


def test_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (None, plain.prose(plain.rng(1), 40)), (4, "?!"),
                                       (3, "one"), (5, "same row")], "item_id long, text string")
    docs = plain.odd_docs(spark, [*plain.ODD_ROWS, (50, plain.prose(plain.rng(1), 40))])
    found = {r.doc_id: r for r in decontaminate.find_contamination(docs, benchmark).collect()}
    assert found[4].item_ids == [3] and found[9].item_ids == [5] and found[50].item_ids == [None]
    assert [i for i, r in found.items() if r.contaminated and i not in (4, 5, 9, 50)] == []
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.schema == docs.schema and kept.count() == len(plain.ODD_ROWS) - 4
    assert decontaminate.drop_contaminated(docs, benchmark.where("false")).count() == docs.count()
    assert decontaminate.find_contamination(plain.odd_docs(spark, []), benchmark).count() == 0
