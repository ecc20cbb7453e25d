"""Document text -> labelled fields, as one chain of projections without Python workers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as fv
from ..functions.dates import read_date, tidy_date
from ..functions.text import clean_money, digit_count, first_line, first_match

DATE_FIELDS = ["invoice_date", "due_date"]
MONEY_FIELDS = ["subtotal", "tax", "total_amount"]
PLAIN_FIELDS = ["invoice_number", "po_number", "payment_terms"]
PHRASE_FLAGS = ["mentions_paid_in_full", "mentions_balance_due", "mentions_draft", "mentions_final"]


def extract_raw(docs: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """Adds vendor_name and one ``<field>_raw`` string per label."""
    text = F.col(text_col)
    return docs.select(
        "*",
        first_line(text).alias("vendor_name"),
        *[first_match(text, patterns).alias(f"{name}_raw") for name, patterns in fv.FIELD_PATTERNS.items()],
    )


def phrase_flags(docs: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """Adds the four phrase flags."""
    docs = docs.withColumn("_lower", F.lower(text_col))
    lower = F.col("_lower")
    return docs.select(
        "*",
        F.contains(lower, F.lit(fv.PAID_IN_FULL)).alias("mentions_paid_in_full"),
        lower.rlike("(?U)" + fv.BALANCE_DUE_PATTERN).alias("mentions_balance_due"),
        F.contains(lower, F.lit(fv.DRAFT)).alias("mentions_draft"),
        F.contains(lower, F.lit(fv.FINAL)).alias("mentions_final"),
    ).drop("_lower")


def text_stats(docs: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """Adds text_length (code points) and digit_density, all later steps need of the text."""
    length = F.length(text_col)
    return docs.select(
        "*",
        F.coalesce(length, F.lit(0)).cast("double").alias("text_length"),
        F.coalesce(F.try_divide(digit_count(F.col(text_col)), length), F.lit(0.0)).alias("digit_density"),
    )


def clean_fields(raw: DataFrame) -> DataFrame:
    """Typed values from the ``*_raw`` columns.

    A date has a typed column ``<x>_dt`` (null if unread), a text column ``<x>``
    (ISO if read, else as found) and ``<x>_parse_ok``.
    """
    tidy = raw.select("*", *[tidy_date(F.col(f"{d}_raw")).alias(f"_{d}") for d in DATE_FIELDS])
    typed = tidy.select("*", *[read_date(F.col(f"_{d}")).alias(f"{d}_dt") for d in DATE_FIELDS])
    columns = []
    for d in DATE_FIELDS:
        columns.append(F.coalesce(F.col(f"{d}_dt").cast("string"), F.col(f"{d}_raw")).alias(d))
        columns.append(F.col(f"{d}_dt").isNotNull().alias(f"{d}_parse_ok"))
    columns += [clean_money(F.col(f"{m}_raw")).alias(m) for m in MONEY_FIELDS]
    columns += [F.col(f"{p}_raw").alias(p) for p in PLAIN_FIELDS]
    return typed.select("*", *columns).drop(*[f"_{d}" for d in DATE_FIELDS])


def extract_fields(docs: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """Adds every field, flag and text statistic to ``docs``; null text counts as ''."""
    docs = docs.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    return clean_fields(text_stats(phrase_flags(extract_raw(docs, text_col), text_col), text_col))
