"""Past invoices: CSV with an explicit schema, or any table with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.scale import materialise

HISTORY_SCHEMA = (
    "invoice_number string, vendor_name string, invoice_date date, due_date date, payment_terms string, "
    "po_number string, subtotal double, tax double, total_amount double")
LABEL_SCHEMA = "filename string, ground_truth_note string"


def read_history(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """History rows; invoice numbers stay text even when all are digits, a bad row fails the job."""
    reader = spark.read.schema(HISTORY_SCHEMA)
    if file_format == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST").option("dateFormat", "yyyy-MM-dd")
    return reader.format(file_format).load(path)


def read_history_checked(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Past invoices from CSV files that may hold broken rows: (history, rejects).

    Rejects are (path, line, reason): the reason names the first column whose value is unreadable, or tells that the
    row has too few or too many values. Rows are parsed once, with all their columns, and written.
    """
    return _checked(spark, path, HISTORY_SCHEMA, header)


def read_labels_checked(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Ground-truth notes and rejected rows, as ``read_history_checked``."""
    return _checked(spark, path, LABEL_SCHEMA, header)


def _checked(spark: SparkSession, path: str, schema: str, header: bool) -> tuple[DataFrame, DataFrame]:
    wanted = T.StructType.fromDDL(schema)
    rows = (spark.read.schema(f"{schema}, broken string").option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "broken").option("dateFormat", "yyyy-MM-dd").csv(path))
    rows = materialise(rows.select("*", F.col("_metadata.file_path").alias("path")))
    good = rows.where("broken IS NULL").select(*wanted.names)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    told = rows.where("broken IS NOT NULL").select("path", F.col("broken").alias("line"), F.from_csv(
        "broken", texts.simpleString()[7:-1].replace(":", " ")).alias("told"))
    return good, told.select("path", "line", _reason(wanted).alias("reason"))


def _reason(wanted: T.StructType) -> Column:
    unread = [F.when(F.col(f"told.{f.name}").isNotNull() & F.col(f"told.{f.name}").try_cast(f.dataType).isNull(),
                     F.concat(F.lit(f"{f.name}: "), F.col(f"told.{f.name}"))) for f in wanted]
    return F.coalesce(*unread, F.lit("wrong number of values"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Ground-truth notes by file name."""
    return spark.read.schema(LABEL_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)
