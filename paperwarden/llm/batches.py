"""Small helpers for operators that work on Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows handled at a time inside a task, so that long texts are not held many times over.
SLICE = 512


def map_rows(df: DataFrame, schema: str | T.StructType, each: Callable[[], Callable]) -> DataFrame:
    """Map every input row to any number of output rows, tuples of ``schema``.

    ``each`` is called once a task and returns the function of one row, so that it can hold caches.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = each()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                made = [made for row in zip(*(column.to_pylist() for column in part.columns)) for made in rows_of(*row)]
                yield to_batch(made, arrow)

    return df.mapInArrow(run, wanted)


def release_memory() -> None:
    """Give freed memory back to the system: worker processes live on, and hold it, after their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def to_batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class WordHashes(dict):
    """64-bit hashes of words, kept for words that come again; emptied before it grows large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value
