"""Report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def write_report(reports: DataFrame, path: str, file_format: str = "json", mode: str = "overwrite") -> None:
    """One object per document; nulls are kept in JSON."""
    writer = reports.write.mode(mode).format(file_format)
    if file_format == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.save(path)


def write_batch(reports: DataFrame, path: str, batch: int | str) -> int:
    """Write the report of one batch into its own part of ``path``, split by risk; returns its rows.

    A batch that is written again replaces what it wrote before, all of its risks included. Its number of rows is noted
    last, so that ``read_batches`` can tell a batch that was not written to its end.
    """
    counted = Observation()
    rows = reports.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").partitionBy("risk_level").parquet(f"{path}/batch={batch}")
    written = counted.get["rows"]
    note = reports.sparkSession.range(1).select(F.lit(written).cast("long").alias("rows"))
    note.coalesce(1).write.mode("overwrite").parquet(f"{path}/_rows/batch={batch}")
    return written


def read_batches(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All batches of ``write_batch`` with ``batch`` and ``risk_level``; an incomplete one is an error."""
    reader = spark.read.schema(schema) if schema else spark.read
    reports = reader.option("basePath", path).parquet(f"{path}/batch=*")
    noted = spark.read.option("basePath", f"{path}/_rows").parquet(f"{path}/_rows/batch=*")
    found = reports.groupBy("batch").agg(F.count(F.lit(1)).alias("found"))
    wrong = noted.join(found, "batch", "full").where(~F.coalesce("rows", F.lit(0)).eqNullSafe(F.coalesce("found", F.lit(0))))
    first = wrong.first()
    if first:
        raise OSError(f"{path}: batch {first['batch']} has {first['found']} rows, {first['rows']} were written")
    return reports
