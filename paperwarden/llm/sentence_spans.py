"""Substring deduplication by sliding sentence spans.

A text is cut into sentences, those of more than ``CLAUSE_WORDS`` words further at commas and clauses of more than
``LONG_WORDS`` words before the least word hash of every ``WINDOW`` words, so that the same words are cut at the same
places behind whatever words they stand; they are compared by their words in lower case. In scripts written without
spaces every character is a word. From every sentence on, and up to every sentence, the shortest run of at least
``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words is a span. Spans are hashed and joined over all documents: the document with the
smallest id keeps a span, and within a document the first place does; all sentences in any other place are removed.

The corpus-wide part moves one (hash, id) row per distinct span of a document; the counts are combinable, and only
spans of two or more documents come back to their documents. Nothing is gathered but the repeated spans of a
single document.

Defined cases: a null text stays null; a text that is removed whole becomes empty and its row stays; rows without an
id neither give nor take spans of other rows and lose only repeats within themselves; rows with the same id count
as one document; of equal places in a table the first by id, then by place in the text, stays; texts are read whole,
whatever their length; an empty table gives an empty result. All columns are returned, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from paperwarden.llm.batches import SLICE
from paperwarden.operators.scale import Workspace

MIN_SENTENCES = 2
MIN_WORDS = 16
CLAUSE_WORDS = 12
LONG_WORDS = 25
#: A passage of 60 words has two or more whole parts of together ``MIN_WORDS`` words wherever it stands.
WINDOW = 11

#: Commas of clauses; those of other scripts end a clause without white space behind them.
_COMMAS = ",;:，、；：､،؛፣፥"
#: The end of a sentence, or of a clause unless it holds a line break.
_END_PLAIN = re.compile(r"[.!?\n,;:](?:(?<=[.!?])[.!?]*\s+|(?<=\n)\s*|(?<=[,;:])\s+)")  # one set to search for, then which
_STOPS = "。！？｡．।॥؟۔።፧։။។៕"
_END = re.compile(rf"[.!?]+\s+|[{_STOPS}]+\s*|\n\s*|[,;:]\s+|[{_COMMAS[3:]}]\s*")
#: Thai, Lao, Myanmar, Khmer, kana and Chinese characters: scripts without spaces between words.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff" \
            "\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af"
#: Texts without any of these characters are read the same by the plain patterns, which are faster.
_OTHER = re.compile(f"[{_STOPS}{_COMMAS[3:]}{_UNSPACED}]")
_WORD_PLAIN = re.compile(r"\w+")
#: Words of ASCII texts are what ``split`` leaves when all other characters are spaces.
_ASCII = bytes(ord(chr(c).lower()) if c < 128 and (chr(c).isalnum() or c == 95) else 32 for c in range(256))
_WORD = re.compile(rf"(?=\w)[{_UNSPACED}]|[^\W{_UNSPACED}]+")
_BACKWARDS = np.arange(WINDOW)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def _cuts(words: list[str]) -> np.ndarray:
    """The words of a long clause that begin a part: the last least hash of every window of words."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    last = np.arange(WINDOW - 1, len(words))
    least = np.unique(last - hashes[last[:, None] - _BACKWARDS].argmin(axis=1))
    return least[least > 0]


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end and words of every sentence; the parts join to the whole text."""
    found: list[tuple[int, int, list[str]]] = []
    clauses: list[tuple[int, int, list[str]]] = []
    last = n_words = 0
    plain = text.isascii() or not _OTHER.search(text)
    end_of, word_of = (_END_PLAIN, _WORD_PLAIN) if plain else (_END, _WORD)
    ascii_text, lower = text.isascii(), text.lower()
    if ascii_text:
        spaced = text.encode().translate(_ASCII).decode()

        def words_of(a: int, b: int) -> list[str]:
            return spaced[a:b].split()
    elif plain and len(lower) == len(text):
        def words_of(a: int, b: int) -> list[str]:
            return word_of.findall(lower, a, b)
    else:
        def words_of(a: int, b: int) -> list[str]:
            return word_of.findall(text[a:b].lower())

    def close() -> None:
        if len(clauses) == 1 and n_words <= LONG_WORDS:
            parts = clauses
        elif n_words <= CLAUSE_WORDS:
            parts = [(clauses[0][0], clauses[-1][1], [w for _, _, words in clauses for w in words])]
        else:
            parts = []
            for a, b, words in clauses:
                if len(words) <= LONG_WORDS:
                    parts.append((a, b, words))
                elif ascii_text:
                    starts = [m.start() for m in word_of.finditer(text, a, b)]
                    cuts = [0, *_cuts(words).tolist(), len(words)]
                    places = [a, *[starts[i] for i in cuts[1:-1]], b]
                    parts += [(places[i], places[i + 1], words[cuts[i]:cuts[i + 1]]) for i in range(len(cuts) - 1)]
                else:
                    found_at = list(word_of.finditer(text, a, b))
                    cuts = [a, *[found_at[i].start() for i in _cuts([m[0].lower() for m in found_at])], b]
                    parts += [(c, d, words_of(c, d)) for c, d in zip(cuts, cuts[1:])]
        for a, b, words in parts:
            if words or not found:
                found.append((a, b, words))
            else:  # signs without a word belong to the sentence before
                found[-1] = (found[-1][0], b, found[-1][2])

    for end in end_of.finditer(text):
        stop = end.end()
        words = words_of(last, stop)
        clauses.append((last, stop, words))
        n_words += len(words)
        last = stop
        said = end[0]
        if said[0] not in _COMMAS or "\n" in said:
            close()
            clauses, n_words = [], 0
    words = words_of(last, len(text))
    clauses.append((last, len(text), words))
    n_words += len(words)
    close()
    return found


def spans(parts: list[tuple[int, int, list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, sentence behind the last, and hash of every span, by place."""
    n = len(parts)
    counts = np.fromiter((len(words) for _, _, words in parts), np.int64, n)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(" ".join(words)) for _, _, words in parts), np.uint64, n)
    before = np.concatenate(([0], np.cumsum(counts)))
    numbers = np.arange(n)
    # The end of the shortest span from each sentence on, and the start of the shortest one up to each sentence.
    ends = np.maximum(np.searchsorted(before, before[:-1] + MIN_WORDS, "left"), numbers + MIN_SENTENCES)
    starts = np.minimum(np.searchsorted(before, before[1:] - MIN_WORDS, "right") - 1, numbers + 1 - MIN_SENTENCES)
    places = np.unique(np.concatenate([numbers[ends <= n] * (n + 1) + ends[ends <= n],
                                       starts[starts >= 0] * (n + 1) + numbers[starts >= 0] + 1]))
    first, stop = places // (n + 1), places % (n + 1)
    # Sums of hashes times falling powers, raised to the same power wherever the span begins.
    powers = np.cumprod(np.full(n + 1, _STEP, np.uint64))
    falling = np.cumprod(np.full(n, _BACK, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * falling, dtype=np.uint64)))
    key = (sums[stop] - sums[first]) * powers[first] + (stop - first).astype(np.uint64)
    key = (key ^ (key >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return first, stop, (key ^ (key >> np.uint64(29))).view(np.int64)


def remove_spans(text: str, repeated: list[int]) -> tuple[str, int, int]:
    """The text without sentences in ``repeated`` spans or in later places of its own spans, with both counts."""
    parts = sentences(text)
    first, stop, keys = spans(parts)
    again = np.ones(len(keys), bool)
    again[np.unique(keys, return_index=True)[1]] = False
    if len(repeated):
        again |= np.isin(keys, np.array(repeated, np.int64))
    if not again.any():
        return text, len(parts), 0
    steps = np.zeros(len(parts) + 1, np.int64)
    np.add.at(steps, first[again], 1)
    np.add.at(steps, stop[again], -1)
    gone = np.cumsum(steps[:-1]) > 0
    return "".join(text[a:b] for (a, b, _), lost in zip(parts, gone) if not lost), len(parts), int(gone.sum())


def document_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, span) per distinct span of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                keys = [np.unique(spans(sentences(text))[2]) for text in part.column(1).to_pylist()]
                owner = np.repeat(np.arange(part.num_rows), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), pa.array(np.concatenate(keys))],
                                                 names=["id", "span"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where(
        "id IS NOT NULL AND text IS NOT NULL")
    return picked.mapInArrow(run, f"id {picked.schema[0].dataType.simpleString()}, span bigint")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document (id), the spans that a document with a smaller id has."""
    work = Workspace(docs.sparkSession)
    held = work.table(document_spans(docs, id_col, text_col))
    shared = held.groupBy("span").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    # Both sides of the join are read from tables, so they are plain exchanges and a hot span can be split.
    shared = work.table(shared.select("span", "first"))
    later = work.table(held.join(shared, "span").where("id > first").select("id", "span"))
    work.drop(held, shared)
    return later.groupBy("id").agg(F.collect_set("span").alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   counts: tuple[str, str] | None = None) -> DataFrame:
    """All columns of ``docs`` with repeated spans taken out of the text.

    ``counts`` names two more columns: the number of sentences and of those removed.
    """
    held = repeated_spans(docs, id_col, text_col)
    joined = docs.join(held, docs[id_col] == held["id"], "left").select(
        *[docs[c] for c in docs.columns], held["spans"].alias("_repeated_spans"))
    place, width = docs.columns.index(text_col), len(docs.columns)
    schema = T.StructType([*docs.schema, *(T.StructField(c, T.LongType()) for c in counts or ())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                made = [(None, 0, 0) if text is None else remove_spans(text, repeated or ()) for text, repeated
                        in zip(part.column(place).to_pylist(), part.column(width).to_pylist())]
                columns = list(part.columns[:width])
                columns[place] = pa.array([m[0] for m in made], part.schema.field(place).type)
                columns += [pa.array([m[1 + i] for m in made], pa.int64()) for i in range(len(counts or ()))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return joined.mapInArrow(run, schema)
