"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, runs of anything but letters become one space, and every run of 2, 3 and 4 characters is
hashed to one of 2**15 buckets. Each task adds up its training texts to one count per language and bucket; the sums
(at most ``MAX_LANGUAGES`` times 2**15) make the matrix of log probabilities, which is broadcast. Scoring gathers the
matrix rows of a batch's n-grams and adds them up document by document.

All rows of the training part are counted. The matrix has a size fixed by the number of languages, which is checked.

Defined cases: a null text or one without a letter is ``und`` with score 0; null ids and repeated rows are rows like
others; rows without a language are not learned from; without training rows everything is ``und`` with score 0; of
equally likely languages the alphabetically first is named; texts are read whole, whatever their length; an empty table
gives an empty result. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperwarden.llm.batches import to_batch

BITS = 15
BUCKETS = 1 << BITS
LENGTHS = (2, 3, 4)
SMOOTHING = 0.5
MAX_LANGUAGES = 1_000
UNKNOWN = "und"
#: N-grams scored at a time.
CHUNK = 500_000

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(text: str | None) -> np.ndarray:
    """Buckets of all character n-grams of the letters of a text; empty if it has none."""
    letters = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if letters and not letters.replace(" ", "").isalpha():  # signs of number such as fractions count as word characters
        letters = " ".join("".join(c if c.isalpha() else " " for c in letters).split())
    if not letters:
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    rolling, found = codes, []
    for n in range(2, max(LENGTHS) + 1):
        if len(codes) < n:
            break
        rolling = (rolling[:-1] * _STEP) + codes[n - 1:]
        if n in LENGTHS:
            mixed = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(found)


def count_ngrams(labelled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Documents (bucket -1) and n-grams per language and bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                buckets = ngram_buckets(text)
                if len(buckets):
                    own[:-1] += np.bincount(buckets, minlength=BUCKETS)
                    own[-1] += 1
        for lang, own in counts.items():
            places = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(places), pa.string()), pa.array(np.where(places == BUCKETS, -1, places), pa.int32()),
                pa.array(own[places], pa.int64())], names=["lang", "bucket", "n"])

    picked = labelled.select(labelled[text_col].alias("text"), labelled[lang_col].alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    return picked.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    languages: list[str]
    prior: np.ndarray
    #: Log probability by bucket and language.
    table: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and posterior probability of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        found: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for place, text in enumerate(texts):
            buckets = ngram_buckets(text)
            if len(buckets):
                held.append((place, buckets))
                size += len(buckets)
            if held and (size >= CHUNK or place == len(texts) - 1):
                self._score(held, found)
                held, size = [], 0
        if held:
            self._score(held, found)
        return found

    def _score(self, held: list[tuple[int, np.ndarray]], found: list[tuple[str, float]]) -> None:
        starts = np.cumsum([0, *(len(b) for _, b in held[:-1])])
        sums = np.add.reduceat(self.table[np.concatenate([b for _, b in held])], starts, axis=0) + self.prior
        odds = np.exp(sums - sums.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        for (place, _), row in zip(held, odds):
            best = int(row.argmax())
            found[place] = (self.languages[best], float(row[best]))


def fit_languages(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row of ``labelled`` that has a text and a language."""
    known = labelled.select(labelled[lang_col]).distinct().limit(MAX_LANGUAGES + 2).count()
    if known > MAX_LANGUAGES:
        raise ValueError(f"more languages than the {MAX_LANGUAGES} that bound the matrix")
    counted = count_ngrams(labelled, text_col, lang_col).toPandas()
    languages = sorted(counted["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    documents = np.zeros(len(languages))
    number = counted["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(dtype=int)
    bucket, n = counted["bucket"].to_numpy(), counted["n"].to_numpy()
    grams = bucket >= 0
    counts[bucket[grams], number[grams]] = n[grams]
    documents[number[~grams]] = n[~grams]
    table = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * BUCKETS)
    prior = np.log((documents + 1) / (documents.sum() + len(languages)))
    return LanguageModel(languages, prior, table)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``lang_pred`` and ``score`` of every row of ``docs``."""
    picked = docs.select(docs[id_col], docs[text_col])
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.table))
    kind = picked.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, schema = LanguageModel(*shared.value), None
        for batch in batches:
            schema = schema or pa.schema([pa.field(id_col, batch.schema.field(0).type), ("lang_pred", pa.string()),
                                          ("score", pa.float64())])
            for start in range(0, batch.num_rows, 1_000):
                part = batch.slice(start, 1_000)
                found = known.predict(part.column(1).to_pylist())
                yield to_batch([(key, *f) for key, f in zip(part.column(0).to_pylist(), found)], schema)

    return picked.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
