import plain
import pytest
from pyspark.sql import functions as F

from paperwarden.llm import language_id, quality_rules
from paperwarden.llm.queries import held_out

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def repetitive_texts():
    rng = plain.rng(2)
    made = [plain.prose(rng, rng.randint(1, 200)) for _ in range(30)]
    for share in (1, 2, 4, 8):
        part = plain.prose(rng, 12)
        made.append("\n".join([plain.prose(rng, 40)] + [part] * share))
        made.append(" ".join([plain.prose(rng, 60), *[part] * share, plain.prose(rng, 10)]))
    return [*made, "a " * 100, "ab " * 19, "ab " * 20, "x\r\nx\r\nx\n\n\nx\nx", *(t for _, t in plain.ODD_ROWS[:6])]


def test_measures_against_plain_version(spark):
    rows = list(enumerate(repetitive_texts()))
    found = quality_rules.measure_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    kept = 0
    for row in found:
        expected = plain.rule_measures(rows[row.doc_id][1])
        assert {k: row[k] for k in expected} == expected
        assert (row.base_failed, row.kept) == plain.rule_verdict(expected)
        kept += row.kept
    assert 10 < kept < len(rows) - 10


def test_rules_on_odd_rows(spark):
    docs = plain.odd_docs(spark)
    found = {r.doc_id: r for r in quality_rules.measure_documents(docs).collect()}
    assert found[1].n_words == found[2].n_words == found[3].n_words == 0 and not found[1].kept
    assert found[6].word_chars == 70_000 and found[7].n_repeat_words == 30_000
    kept = quality_rules.keep_good(docs)
    assert kept.schema == docs.schema and kept.count() == 0
    good = plain.odd_docs(spark, [(1, plain.prose(plain.rng(1), 50)), (None, plain.prose(plain.rng(2), 50)), (3, None)])
    assert sorted(map(tuple, quality_rules.keep_good(good).collect()), key=str) == sorted(
        (tuple(r) for r in good.collect() if r.text), key=str)
    empty = plain.odd_docs(spark, [])
    assert quality_rules.measure_documents(empty).count() == quality_rules.keep_good(empty).count() == 0


def test_languages_held_out(spark):
    docs = spark.read.parquet(DOCUMENTS)
    model = language_id.fit_languages(docs.where(~held_out()))
    found = language_id.predict_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out())
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    assert found.where("score < 0 OR score > 1").count() == 0


def test_languages_on_odd_rows(spark):
    docs = plain.odd_docs(spark)
    model = language_id.fit_languages(docs)
    assert model.languages == ["en"]
    found = language_id.predict_languages(docs, model).collect()
    assert len(found) == len(plain.ODD_ROWS)
    assert {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id in (1, 2, 3)} == dict.fromkeys(
        (1, 2, 3), ("und", 0.0))
    assert {r.lang_pred for r in found if r.doc_id in (4, 6, 7, 8)} == {"en"}
    untaught = language_id.fit_languages(docs.where("false"))
    assert {r.lang_pred for r in language_id.predict_languages(docs, untaught).collect()} == {"und"}
    assert language_id.predict_languages(plain.odd_docs(spark, []), model).count() == 0


def test_language_scores_match_plain_sums():
    texts = ["ab cab", "ba", "öäü öä"]
    model = language_id.LanguageModel(["x", "y"], language_id.np.log([0.5, 0.5]), language_id.np.log(
        language_id.np.random.default_rng(1).random((language_id.BUCKETS, 2))))
    for text, (lang, score) in zip(texts, model.predict(texts)):
        sums = model.prior + sum(model.table[b] for b in language_id.ngram_buckets(text))
        best = int(sums.argmax())
        assert lang == model.languages[best]
        assert score == pytest.approx(1 / (1 + language_id.np.exp(sums.min() - sums.max())))


def test_signs_of_number_are_no_letters():
    assert all(len(language_id.ngram_buckets(t)) == 0 for t in ("½ ² ⅷ", "⅓", "12 _ ٣", "①"))
    assert (language_id.ngram_buckets("ab½cd") == language_id.ngram_buckets("ab cd")).all()
