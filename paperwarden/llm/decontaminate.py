"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are compared by their words in lower case with one space between them. Long items are cut
into overlapping pieces. A piece of m characters may differ from a passage by k = floor(``EDIT_SHARE`` * m) edits.
By the q-gram lemma such a passage shares at least m - q + 1 - k * q q-grams with the piece, on diagonals (place in
the document less place in the piece) at most k apart; any such run of diagonals lies in one of the bands of twice
that width which overlap by half. Bands with enough shared q-grams are kept, and a banded alignment of the piece
against that region tells the exact number of edits.

The benchmark is handed to the tasks in blocks of at most ``BLOCK_CHARS`` characters; every block passes over the
documents in the same scan, so there is no shuffle of texts. Every document is searched whole and by itself.

Defined cases: null and empty texts are clean; null and empty items match nothing; items of fewer than q characters
or too short for the lemma count only as whole words found exactly; repeated items are separate items; without items
all documents are clean; texts are searched whole, whatever their
length; an empty table gives an empty result. Columns beyond the named ones are ignored by
``find_contamination`` and returned untouched by ``drop_contaminated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperwarden.llm.batches import SLICE, release_memory

Q = 10
EDIT_SHARE = 0.07
#: Items longer than this are cut into pieces of this length, one every ``PIECE_STEP`` characters, so that any quote of
#: ``PIECE_CHARS`` + ``PIECE_STEP`` characters holds a whole piece.
PIECE_CHARS = 100
PIECE_STEP = 25
BLOCK_CHARS = 4_000_000
#: Shared q-grams counted at a time.
CHUNK = 400_000

_WORD = re.compile(r"\w+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MAP_BITS = 22


def normal(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def rolling(codes: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of every q-gram."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    value, length = codes.astype(np.uint64), 1
    whole, done = None, 0
    power = _STEP
    while True:  # powers of two put together
        if q & length:
            if whole is None:
                whole, done = value, length
            else:
                n = len(codes) - done - length + 1
                whole, done = whole[:n] * power + value[done:done + n], done + length
        if 2 * length > q:
            break
        value = value[:-length] * power + value[length:]
        power = np.uint64(pow(int(power), 2, 1 << 64))
        length *= 2
    return (whole ^ (whole >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def aligned(piece: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Fewest edits that turn ``piece`` into a part of ``region``, and the end of that part in the region.

    Column d of a row stands for diagonal d of the region, so the row after i characters ends at region place i + d.
    An alignment must keep to the diagonals of the region, which is why callers leave room on both sides.
    """
    width = len(region) - len(piece) + 1
    along = np.arange(width)
    row = np.zeros(width, np.int64)
    for i, char in enumerate(piece):
        step = row + (region[i:i + width] != char)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - along) + along
    best = int(row.argmin())
    return int(row[best]), len(piece) + best


@dataclass
class Pieces:
    """The q-gram index of a block of benchmark items."""

    items: list
    codes: list[np.ndarray]
    budgets: np.ndarray
    least: np.ndarray
    short: list[tuple[int, str]]
    keys: np.ndarray
    starts: np.ndarray
    piece: np.ndarray
    place: np.ndarray
    seen: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[object, str | None]]) -> Pieces:
        names, codes, short = [], [], []
        for name, text in items:
            plain = normal(text or "")
            if not plain:
                continue
            budget = int(EDIT_SHARE * len(plain))
            if len(plain) - Q + 1 - budget * Q < 1:
                short.append((name, f" {plain} "))
                continue
            last = max(0, len(plain) - PIECE_CHARS)
            for start in [*range(0, last, PIECE_STEP), last]:
                names.append(name)
                codes.append(_codes(plain[start:start + PIECE_CHARS]))
        budgets = np.array([int(EDIT_SHARE * len(c)) for c in codes], np.int64)
        least = np.array([len(c) - Q + 1 - k * Q for c, k in zip(codes, budgets)], np.int64)
        grams = [rolling(c, Q) for c in codes]
        hashes = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        piece = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        place = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else np.empty(0, np.int64)
        keys, starts = np.unique(hashes[order], return_index=True)
        seen = np.zeros(1 << _MAP_BITS, bool)
        seen[keys >> np.uint64(64 - _MAP_BITS)] = True
        return cls(names, codes, budgets, least, short, keys, np.append(starts, len(hashes)), piece, place, seen)

    def shared_grams(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces and diagonals of the q-grams that the text shares with them, in chunks."""
        hashes = rolling(text, Q)
        at = np.flatnonzero(self.seen[hashes >> np.uint64(64 - _MAP_BITS)])
        found = np.searchsorted(self.keys, hashes[at])
        found[found == len(self.keys)] = 0
        same = self.keys[found] == hashes[at]
        at, found = at[same], found[same]
        counts = self.starts[found + 1] - self.starts[found]
        chunk = np.cumsum(counts) // CHUNK
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(chunk)) + 1):
            n = counts[part]
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            posting = np.repeat(self.starts[found[part]], n) + offset
            yield self.piece[posting], np.repeat(at[part], n) - self.place[posting]

    def regions(self, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Pieces with the first and last diagonal of bands that share enough q-grams; touching bands are one."""
        bands: dict[int, int] = {}
        for piece, diagonal in self.shared_grams(text):
            band = (diagonal + PIECE_CHARS) // (self.budgets[piece] + 1)
            both = np.concatenate([(piece << 40) + band, (piece << 40) + band + 1])
            for key, n in zip(*(x.tolist() for x in np.unique(both, return_counts=True))):
                bands[key] = bands.get(key, 0) + n
        kept = sorted(key for key, n in bands.items() if n >= self.least[key >> 40])
        start = 0
        for i, key in enumerate(kept):
            if i + 1 < len(kept) and kept[i + 1] == key + 1:
                continue
            piece, width = key >> 40, int(self.budgets[key >> 40]) + 1
            first, last = (kept[start] & ((1 << 40) - 1)) - 1, (key & ((1 << 40) - 1)) + 1
            yield piece, first * width - PIECE_CHARS, last * width - PIECE_CHARS
            start = i + 1

    def find(self, text: str | None) -> list[tuple[object, int, int, int]]:
        """Item, first and last word and edits of every passage that is within the edit budget of a piece."""
        plain = normal(text or "")
        if not plain:
            return []
        found = []
        codes = _codes(plain)
        if self.items:
            for piece, first, last in self.regions(codes):
                budget, m = int(self.budgets[piece]), len(self.codes[piece])
                # Zeros, which no piece has, stand for what lies before and behind the text.
                low, high = first - budget, max(last, first) + m + budget + 1
                region = np.concatenate([np.zeros(max(0, -low), codes.dtype), codes[max(0, low):high],
                                         np.zeros(max(0, high - max(low, len(codes))), codes.dtype)])
                edits, end = aligned(self.codes[piece], region)
                if edits <= budget:
                    end = max(1, min(low + end, len(plain)))
                    begin = max(0, end - m)
                    found.append((self.items[piece], plain.count(" ", 0, begin), plain.count(" ", 0, end - 1), edits))
        framed = f" {plain} "
        for name, words in self.short:
            at = framed.find(words)
            if at >= 0:
                first = framed.count(" ", 0, at + 1) - 1
                found.append((name, first, first + words.count(" ") - 2, 0))
        return found


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[list[tuple[object, str | None]]]:
    """The items in blocks of bounded size; their number follows the measured size of the benchmark."""
    items = benchmark.select(benchmark[id_col].alias("item"), benchmark[text_col].alias("text")).where("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(2 * chars // BLOCK_CHARS) + 1
    held = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    return [[(row["item"], row["text"]) for row in held.where(F.col("block") == b).orderBy("item", "text").collect()]
            for b in range(blocks)]


def _shared(spark, items: list[tuple[object, str | None]]):
    """The index of a block as a broadcast of plain arrays and lists."""
    index = Pieces.of(items)
    return spark.sparkContext.broadcast(tuple(getattr(index, f.name) for f in fields(index)))


def _words_at(text: str) -> list[tuple[int, int]]:
    """Where the words of the normal form stand in the text, as long as lower case doesn't change its length."""
    return [m.span() for m in _WORD.finditer(text.lower())]


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Id, ``contaminated``, ``item_ids`` (distinct, sorted) and ``passages`` (item, start, end, edits) of every row.

    Starts and ends are code points of the lower-cased text, true up to the edits of the passage.
    """
    picked = docs.select(docs[id_col], docs[text_col])
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    passage = f"array<struct<item_id:{item_kind}, first_char:bigint, last_char:bigint, edits:bigint>>"
    found = picked.withColumn("_passages", F.array().cast(passage))
    spark = docs.sparkSession
    for items in benchmark_blocks(benchmark, item_col, item_text_col):
        found = _add_passages(found, _shared(spark, items))
    key, passages = found.columns[0], F.col("_passages")
    ids = F.array_sort(F.array_distinct(F.transform(passages, lambda p: p["item_id"])))
    return found.select(found[key], (F.size(passages) > 0).alias("contaminated"), ids.alias("item_ids"),
                        passages.alias("passages"))


def _add_passages(found: DataFrame, pieces) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Pieces(*pieces.value)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                made = []
                for text, old in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    new = index.find(text)
                    words = _words_at(text) if new else []
                    made.append(old + [{"item_id": item, "first_char": words[a][0], "last_char": words[b][1],
                                        "edits": edits} for item, a, b, edits in new])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(made, part.column(2).type)],
                                                 names=part.schema.names)

    return found.mapInArrow(run, found.schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any passage of the benchmark, with all their columns."""
    place = docs.columns.index(text_col)
    kept = docs
    for items in benchmark_blocks(benchmark, item_col, item_text_col):
        pieces = _shared(docs.sparkSession, items)

        def run(batches: Iterator[pa.RecordBatch], pieces=pieces) -> Iterator[pa.RecordBatch]:
            index = Pieces(*pieces.value)
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE):
                    part = batch.slice(start, SLICE)
                    clean = [not index.find(text) for text in part.column(place).to_pylist()]
                    yield part.filter(pa.array(clean, pa.bool_()))
            release_memory()

        kept = kept.mapInArrow(run, docs.schema)
    return kept
