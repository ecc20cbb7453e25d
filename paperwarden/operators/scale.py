"""Helpers that keep plans safe at any size: materialising, checked broadcasts, key spreading."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else that of the context.

    Only where neither is set and driver and executors are one process, a temporary folder of this machine is used.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="paperwarden-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of the actions inside are deleted as each action ends, not when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class Workspace:
    """Intermediate tables of one run, as Parquet in a folder of its own below the shared folder.

    A step that reads a table recovers from lost executors by reading it again. ``drop`` frees the space of
    tables that are no longer needed, ``close`` removes the folder; tables behind a result that is still to be
    read must stay. The first table with rows shows whether the folder is shared: all rows written must be found.
    """

    _proven: set[tuple[str, str]] = set()

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._folder = (spark.sparkContext.applicationId, shared_folder(spark))
        self.path = f"{self._folder[1]}/paperwarden-{uuid.uuid4().hex}"
        self._written = 0

    def table(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """Write ``df`` once, in a folder for each value of ``by`` if given, and go on from its files."""
        path = f"{self.path}/{self._written}"
        self._written += 1
        counted = Observation()
        proven = self._folder in self._proven
        rows = df if proven else df.observe(counted, F.count(F.lit(1)).alias("rows"))
        with shuffles_removed(self.spark):
            (rows.write.partitionBy(by) if by else rows.write).parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        if not proven:
            wrote, found = counted.get["rows"], table.count()
            if wrote != found:
                raise OSError(f"{path}: {wrote} rows written, {found} found; is {self._folder[1]} shared?")
            if wrote:
                self._proven.add(self._folder)
        table.written_to = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._delete(table.written_to)

    def close(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


_current: ContextVar[Workspace | None] = ContextVar("workspace", default=None)


@contextlib.contextmanager
def temporary_workspace(spark: SparkSession):
    """All tables that operators write inside are removed at the end; write the results out before."""
    work = Workspace(spark)
    before = _current.set(work)
    try:
        yield work
    finally:
        _current.reset(before)
        work.close()


def workspace(spark: SparkSession) -> Workspace:
    """The workspace of the surrounding ``temporary_workspace``, else a new one that stays."""
    return _current.get() or Workspace(spark)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from its files.

    Lost executors then cost no more than the running step, later readers take only the columns they need, and
    joins know the real size. Inside ``temporary_workspace`` the table is removed with it, else it stays.
    """
    return workspace(df.sparkSession).table(df)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialise`` gave and nothing reads any more, so that they don't stay next to later ones."""
    for table in tables:
        workspace(table.sparkSession).drop(table)


def size_in_bytes(df: DataFrame) -> int:
    """Row widths of ``df`` added up: 16 bytes a value plus the length of its strings."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def shuffled(df: DataFrame) -> DataFrame:
    """Hint that a join with ``df`` sorts and shuffles, unless the other side is hinted to be broadcast.

    Without it Spark takes the size of compressed files for that of their rows, also after an ``explode``, and may
    collect many times as much on the driver for a broadcast.
    """
    return df.hint("merge")


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES, *,
                       otherwise: Callable[[DataFrame], DataFrame | None] = shuffled) -> DataFrame | None:
    """Hint a broadcast if ``df`` (cheap to read) is measured to fit in ``limit`` bytes.

    Beyond it the join shuffles, and because ``df`` is read from written files
    adaptive execution can split the other side's hot keys.
    """
    return F.broadcast(df) if size_in_bytes(df) <= limit else otherwise(df)


def spread_nulls(key: str, row_key: str) -> Column:
    """``key``, with nulls replaced by values that match nothing and differ by row.

    Null keys of an outer join would otherwise all be sent to one task.
    """
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.xxhash64(row_key).cast("string")))


