"""Vendor and global baselines from the table of past invoices.

One scan of the history, by grouping sets, gives the known invoice numbers and one row per vendor and payment terms with
counts, mean and sum of squared deviations. All profiles follow from these rows, and so does the profile of two
histories from the rows of both, so that a new month is added without reading the old ones again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from ..functions.fixed_values import STD_FLOOR
from .scale import workspace

MOMENTS = ["n", "amounts", "mean", "squares", "latest"]


def floored_std(squares: Column, amounts: Column) -> Column:
    """Sample deviation, at least the floor; null (not the floor) for a single row."""
    return F.when(amounts > 1, F.greatest(F.sqrt(squares / (amounts - 1)), F.lit(STD_FLOOR)))


def net_days(terms: Column) -> Column:
    """All digits of the terms read as one number: 'NET30' -> 30."""
    digits = F.regexp_replace(terms, r"[^\p{Nd}]", "")
    return F.nullif(digits, F.lit("")).try_cast("int")


def combined(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of groups of rows of moments; the deviations of their means are added to the squares."""
    whole = moments.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("amounts").alias("amounts"),
        F.try_divide(F.sum(F.col("mean") * F.col("amounts")), F.sum("amounts")).alias("mean"), F.max("latest").alias("latest"))
    centre = whole.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("mean").alias("_mean"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    apart = F.col("amounts") * F.pow(F.col("mean") - F.col("_mean"), F.lit(2.0))
    # Without keys the centre is the one row of the whole.
    placed = moments.join(centre, same) if keys else moments.withColumn("_mean", F.lit(whole.first()["mean"]).cast("double"))
    squares = placed.groupBy(*keys).agg(F.sum(F.col("squares") + F.coalesce(apart, F.lit(0.0))).alias("squares"))
    if not keys:
        return whole.withColumn("squares", F.lit(squares.first()["squares"]).cast("double"))
    squares = squares.select(*[F.col(k).alias(f"_{k}") for k in keys], "squares")
    return whole.join(squares, same).select(*keys, *MOMENTS)


@dataclass
class HistoryProfile:
    """``moments`` (vendor_name, payment_terms, n, amounts, mean, squares, latest) and ``numbers`` (invoice_number)."""

    moments: DataFrame
    numbers: DataFrame

    def merge(self, other: "HistoryProfile") -> "HistoryProfile":
        """The profile of both histories, which should hold different invoices."""
        work = workspace(self.moments.sparkSession)
        both = self.moments.unionByName(other.moments)
        return HistoryProfile(work.table(combined(both, ["vendor_name", "payment_terms"])),
                              work.table(self.numbers.unionByName(other.numbers).distinct()))

    def typical_terms(self) -> DataFrame:
        """Most frequent payment terms per vendor, the smallest on ties."""
        best = self.moments.where("vendor_name is not null and payment_terms is not null").groupBy("vendor_name").agg(
            F.min(F.struct((-F.col("n")).alias("n"), "payment_terms")).alias("best"))
        return best.select("vendor_name", F.col("best.payment_terms").alias("typical_terms"))

    def vendors(self) -> DataFrame:
        """One row per vendor: amount_mean, amount_std, typical_terms, typical_net_days, invoice_count."""
        amounts = combined(self.moments.where("vendor_name is not null"), ["vendor_name"])
        return (amounts.join(self.typical_terms(), "vendor_name", "left").select(
            "vendor_name", F.col("mean").alias("amount_mean"),
            floored_std(F.col("squares"), F.col("amounts")).alias("amount_std"), "typical_terms",
            net_days(F.col("typical_terms")).alias("typical_net_days"), F.col("n").alias("invoice_count")))

    def overall(self) -> Row:
        """amount_mean, amount_std, latest_date and invoice_count of the whole history."""
        return self.overall_table().first()

    def overall_table(self) -> DataFrame:
        whole = combined(self.moments, [])
        return whole.select(
            F.col("mean").alias("amount_mean"), floored_std(F.col("squares"), F.col("amounts")).alias("amount_std"),
            F.col("latest").alias("latest_date"), F.coalesce("n", F.lit(0)).alias("invoice_count"))

    def known_vendors(self) -> DataFrame:
        return self.moments.where("vendor_name is not null").select("vendor_name").distinct()


def history_profile(history: DataFrame) -> HistoryProfile:
    """Count ``history`` once, by vendor and terms and by invoice number."""
    keys = ["vendor_name", "payment_terms", "invoice_number"]
    counted = history.groupingSets([keys[:2], keys[2:]], *keys).agg(
        F.grouping("invoice_number").cast("int").alias("by_vendor"), F.count(F.lit(1)).alias("n"),
        F.count("total_amount").alias("amounts"), F.avg("total_amount").alias("mean"),
        F.coalesce(F.var_pop("total_amount") * F.count("total_amount"), F.lit(0.0)).alias("squares"),
        F.max("invoice_date").alias("latest"))
    counted = workspace(history.sparkSession).table(counted, by="by_vendor")
    return HistoryProfile(
        counted.where("by_vendor = 1").select("vendor_name", "payment_terms", *MOMENTS),
        counted.where("by_vendor = 0 and invoice_number is not null").select("invoice_number"))


def invoice_numbers_by_vendor(history: DataFrame) -> DataFrame:
    """The set of invoice numbers of each vendor, as rows rather than one array per vendor."""
    return (history.where("vendor_name is not null and invoice_number is not null")
            .select("vendor_name", "invoice_number").distinct())


def vendor_profiles(history: DataFrame) -> DataFrame:
    """One row per vendor, see ``HistoryProfile.vendors``."""
    return history_profile(history).vendors()


def global_profile(history: DataFrame) -> DataFrame:
    """One row over the whole history, see ``HistoryProfile.overall``."""
    return history_profile(history).overall_table()
