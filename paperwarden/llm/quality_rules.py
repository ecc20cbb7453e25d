"""Quality rules by repetition coverage: how many characters of a text stand in n-grams or lines that repeat in it.

Rolling 64-bit hashes of the word sequence give, for every n-gram length, the windows that occur more than once in
the text; the characters of the words in those windows, over all characters in words, are the coverage. Every text
is measured whole and by itself, so there is no shuffle and no state across rows.

Defined cases: a null text has no words (all measures 0, not kept); an empty text likewise. Null ids, repeated rows
and an empty table need no special care, since rows are independent; texts are
measured whole, whatever their length; a share that is just its limit is kept. Columns beyond the id and the text are ignored
by ``measure_documents`` and returned untouched by ``keep_good``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paperwarden.llm.batches import SLICE, map_rows, release_memory

#: N-gram length and the largest share, in percent, of word characters inside n-grams that repeat. Tighter published
#: limits (10 to 15 percent) count every text of a hundred words that says one line twice as repetitive.
LIMITS = ((5, 30), (6, 30), (7, 30), (8, 30), (9, 30), (10, 30))
#: The same for lines equal to an earlier line.
LINE_LIMIT = 25
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
WINDOW_LIMIT = 30

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
            *(f"dup_chars_{n}" for n, _ in LIMITS))

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Spread small numbers over 64 bits."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _BASE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def covered_words(ids: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each n-gram length, which words stand in an n-gram that occurs twice or more."""
    n_words, mixed, rolling = len(ids), _mixed(ids), None
    nothing = np.zeros(n_words, bool)
    found = {}
    for n in range(1, max(lengths) + 1):
        if n > n_words:
            break
        rolling = mixed.copy() if n == 1 else rolling[:-1] * _BASE + mixed[n - 1:]
        if n not in lengths:
            continue
        ordered = np.sort(rolling)
        repeated = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(repeated):
            break  # a longer n-gram that repeats would hold a shorter one that does
        starts = np.flatnonzero(np.isin(rolling, repeated))
        steps = np.zeros(n_words + 1, np.int64)
        steps[starts] += 1
        steps[starts + n] -= 1
        found[n] = np.cumsum(steps[:-1]) > 0
    return {n: found.get(n, nothing) for n in lengths}


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if not words:
        return (0, 0, sum((text or "").count(s) for s in SYMBOLS), *[0] * (len(MEASURES) - 3))
    width = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in number), np.int64, len(number))[ids]
    covered = covered_words(ids, sorted({WINDOW, *(n for n, _ in LIMITS)}))
    seen: set[bytes] = set()
    dup_lines = dup_line_chars = 0
    for line in raw.split(b"\n") if b"\n" in raw else ():
        if line in seen:
            dup_lines += 1
            dup_line_chars += sum(len(w.decode("utf-8", "surrogatepass")) for w in line.split())
        elif line.split():
            seen.add(line)
    return (len(words), int(width.sum()), sum(text.count(s) for s in SYMBOLS), dup_lines, int(covered[WINDOW].sum()),
            dup_line_chars, *(int(width[covered[n]].sum()) for n, _ in LIMITS))


def verdict(values: tuple[int, ...]) -> tuple[bool, bool]:
    """Whether the base rules fail, and whether the text is kept."""
    n_words, word_chars, _, _, repeat_words, line_chars, *grams = values
    base_failed = n_words < MIN_WORDS or 100 * repeat_words > WINDOW_LIMIT * n_words
    repetitive = 100 * line_chars > LINE_LIMIT * word_chars or any(
        100 * chars > limit * word_chars for chars, (_, limit) in zip(grams, LIMITS))
    return base_failed, not (base_failed or repetitive)


def measure_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, all measures, ``base_failed`` and ``kept`` of every row of ``docs``."""
    picked = docs.select(docs[id_col], docs[text_col])
    kind = picked.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", base_failed boolean, kept boolean"

    def each():
        def rows(key, text):
            values = measure(text)
            yield (key, *values, *verdict(values))
        return rows

    return map_rows(picked, schema, each)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                kept = [verdict(measure(text))[1] for text in part.column(place).to_pylist()]
                yield part.filter(pa.array(kept, pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
