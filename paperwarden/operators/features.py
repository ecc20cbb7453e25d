"""Ten numeric features per document against the vendor's (or the global) baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed_values import FEATURE_NAMES
from ..functions.text import number_text
from .baseline import Baseline
from .extract import text_stats


def _or_zero(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def attach_profile(docs: DataFrame, baseline: Baseline) -> DataFrame:
    """Left lookup of the vendor's profile; vendors without one get the global mean and deviation."""
    vendors = baseline.vendor_lookup().select(
        "vendor_name",
        F.col("amount_mean").alias("_mean"), F.col("amount_std").alias("_std"),
        F.col("typical_net_days").alias("_net_days"), F.lit(True).alias("_known"),
    )
    return docs.join(vendors, "vendor_name", "left").select(
        *docs.columns,
        F.coalesce("_known", F.lit(False)).alias("vendor_known"),
        F.when(F.col("_known"), F.col("_mean")).otherwise(F.lit(baseline.amount_mean)).alias("vendor_amount_mean"),
        F.when(F.col("_known"), F.col("_std")).otherwise(F.lit(baseline.amount_std)).alias("vendor_amount_std"),
        F.col("_net_days").alias("vendor_net_days"),
    )


def add_features(docs: DataFrame, baseline: Baseline) -> DataFrame:
    """Adds the ten features and ``zscore`` (null where the vendor's deviation is unknown).

    ``docs`` needs vendor_name, the three amounts, ``invoice_date_dt``, ``due_date_dt``,
    ``text_length`` and ``digit_density``, not the text itself. A ``subtotal`` feature
    column would clash with the field, so features are one struct column ``features``.
    """
    df = attach_profile(docs, baseline)
    invoiced, due = F.col("invoice_date_dt"), F.col("due_date_dt")
    total, subtotal, tax = (_or_zero(F.col(c)) for c in ("total_amount", "subtotal", "tax"))
    days = F.datediff(due, invoiced)
    df = df.withColumn("zscore", F.try_divide(total - F.col("vendor_amount_mean"), F.col("vendor_amount_std")))
    values = {
        "subtotal": subtotal,
        "tax_ratio": _or_zero(F.try_divide(tax, subtotal)),
        "amount_zscore_vs_vendor": _or_zero(F.col("zscore")),
        "days_invoice_to_due": _or_zero(days),
        "days_terms_deviation": _or_zero(F.abs(days - F.col("vendor_net_days"))),
        "is_weekend_invoice_date": _or_zero((F.weekday(invoiced) >= 5).cast("int")),
        "vendor_seen_before": _or_zero(F.col("vendor_known").cast("int")),
        "text_length": F.col("text_length"),
        "digit_density": F.col("digit_density"),
        "days_since_latest_history": _or_zero(F.datediff(invoiced, F.lit(baseline.latest_date).cast("date"))),
    }
    return df.withColumn("features", F.struct(*[values[name].alias(name) for name in FEATURE_NAMES])).drop(
        "vendor_amount_mean", "vendor_amount_std", "vendor_net_days")


def feature_vector(struct_col: str = "features") -> Column:
    """The features as ``array<double>`` in their fixed order."""
    return F.array(*[F.col(f"{struct_col}.{name}") for name in FEATURE_NAMES])


def history_text() -> Column:
    """The short text that stands for a past invoice: vendor, number and total."""
    return F.concat_ws(" ", "vendor_name", "invoice_number", number_text(F.col("total_amount")))


def history_features(history: DataFrame, baseline: Baseline, text_col: str | None = None) -> DataFrame:
    """The same ten features over history rows, as plain columns next to invoice_number.

    Past invoices usually have no text, so a short one is built from their values;
    ``text_col`` names the real text where the history has it.
    """
    text = F.coalesce(F.col(text_col), F.lit("")) if text_col else history_text()
    rows = history.select(
        "invoice_number", "vendor_name", "subtotal", "tax", "total_amount",
        F.col("invoice_date").alias("invoice_date_dt"), F.col("due_date").alias("due_date_dt"),
        text.alias("_text"))
    rows = text_stats(rows, "_text").drop("_text")
    return add_features(rows, baseline).select("invoice_number", "features.*")
