"""Explainable rule checks: every rule is one conditional struct in a single projection."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv
from ..functions.text import fill, fixed, grouped
from .baseline import Baseline
from .scale import shuffled, spread_nulls

FLAG_TYPE = "struct<category:string,severity:string,message:string,evidence:map<string,string>>"


def _flag(condition: Column, category: str, severity: Column | str, message: Column, **evidence: Column) -> Column:
    pairs = [x for name, value in evidence.items() for x in (F.lit(name), value.cast("string"))]
    details = F.create_map(*pairs) if pairs else F.lit(None)
    return F.when(condition, F.struct(
        F.lit(category).alias("category"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        message.alias("message"),
        details.cast("map<string,string>").alias("evidence"),
    ).cast(FLAG_TYPE))


def missing_fields() -> Column:
    """Names of the required fields that are empty; a total of zero counts as empty."""
    empty = {
        "invoice_number": F.coalesce(F.col("invoice_number"), F.lit("")) == "",
        "invoice_date": F.coalesce(F.col("invoice_date"), F.lit("")) == "",
        "total_amount": F.coalesce(F.col("total_amount"), F.lit(0.0)) == 0,
        "vendor_name": F.coalesce(F.col("vendor_name"), F.lit("")) == "",
    }
    return F.array_compact(F.array(*[F.when(empty[name], F.lit(name)) for name in fv.REQUIRED_FIELDS]))


def missing_rule() -> list[Column]:
    missing = F.col("_missing")
    names = F.array_join(missing, ", ")
    return [_flag(F.size(missing) > 0, "missing_fields",
                  F.when(F.size(missing) > 1, "high").otherwise("medium"),
                  fill(fv.MESSAGES["missing_fields"], missing=names), missing_fields=names)]


def date_rules(reference_date: datetime.date) -> list[Column]:
    invoiced, due, today = F.col("invoice_date_dt"), F.col("due_date_dt"), F.lit(reference_date).cast("date")
    unread = {d: F.col(f"{d}_raw").isNotNull() & F.col(f"{d}_dt").isNull() for d in ("invoice_date", "due_date")}
    return [
        _flag(unread["invoice_date"], "date_format", "medium",
              fill(fv.MESSAGES["invoice_date_format"], invoice_date_raw=F.col("invoice_date_raw")),
              raw_value=F.col("invoice_date_raw")),
        _flag(unread["due_date"], "date_format", "low",
              fill(fv.MESSAGES["due_date_format"], due_date_raw=F.col("due_date_raw")),
              raw_value=F.col("due_date_raw")),
        _flag(due < invoiced, "date_logic", "high",
              fill(fv.MESSAGES["due_before_invoice"], due=due, invoiced=invoiced),
              invoice_date=invoiced, due_date=due),
        _flag(invoiced > today, "date_logic", "high",
              fill(fv.MESSAGES["future_date"], invoiced=invoiced, today=today),
              invoice_date=invoiced, reference_date=today),
    ]


def amount_rules() -> list[Column]:
    subtotal, tax, total = F.col("subtotal"), F.col("tax"), F.col("total_amount")
    expected = F.round(subtotal + tax, 2)
    difference = F.abs(expected - total)
    whole = (F.round(subtotal, 0) == subtotal) & (F.round(total, 0) == total) & (total != 0)
    return [
        _flag(difference > fv.AMOUNT_TOLERANCE, "arithmetic", "high",
              fill(fv.MESSAGES["arithmetic"], total=grouped(total, 2), subtotal=grouped(subtotal, 2),
                   tax=grouped(tax, 2), expected=grouped(expected, 2), difference=grouped(difference, 2)),
              subtotal=subtotal, tax=tax, total_amount=total, expected_total=expected),
        _flag((subtotal >= fv.ROUND_SUBTOTAL_MINIMUM) & whole, "round_numbers", "low",
              fill(fv.MESSAGES["round_numbers"], subtotal=grouped(subtotal, 2)), subtotal=subtotal),
    ]


def outlier_rule(zscore_threshold: float = fv.ZSCORE_THRESHOLD) -> list[Column]:
    z = F.col("zscore")
    return [_flag(F.abs(z) >= zscore_threshold, "amount_outlier",
                  F.when(F.abs(z) >= fv.ZSCORE_HIGH, "high").otherwise("medium"),
                  fill(fv.MESSAGES["amount_outlier"], z=fixed(F.abs(z), 1),
                       direction=F.when(z > 0, "higher").otherwise("lower")),
                  zscore=z)]


def duplicate_rule() -> list[Column]:
    number = F.col("invoice_number")
    return [_flag(F.col("number_known"), "duplicate", "high",
                  fill(fv.MESSAGES["duplicate"], invoice_number=number), invoice_number=number)]


def lookalike_rule() -> list[Column]:
    name, closest, similarity = F.col("vendor_name"), F.col("closest_vendor"), F.col("vendor_similarity")
    return [_flag(similarity.between(fv.VENDOR_SIMILARITY_LOW, fv.VENDOR_SIMILARITY_HIGH)
                  & (similarity < fv.VENDOR_SIMILARITY_HIGH), "vendor_lookalike", "high",
                  fill(fv.MESSAGES["vendor_lookalike"], vendor_name=name, closest_vendor=closest,
                       percent=fixed(similarity * 100, 0)),
                  vendor_name=name, closest_known_vendor=closest, similarity=similarity)]


def conflict_rules() -> list[Column]:
    total = F.col("total_amount")
    return [
        _flag(F.col("mentions_paid_in_full") & F.col("mentions_balance_due") & (total > 0),
              "conflicting_statement", "high",
              fill(fv.MESSAGES["paid_and_due"], total=grouped(total, 2)), total_amount=total),
        _flag(F.col("mentions_draft") & F.col("mentions_final"), "conflicting_statement", "medium",
              F.lit(fv.MESSAGES["draft_and_final"])),
    ]


def mark_known_numbers(docs: DataFrame, baseline: Baseline, row_key: str = "doc_id") -> DataFrame:
    """Adds number_known: the invoice number is in the history (any vendor, exact)."""
    known = baseline.invoice_numbers.select(F.col("invoice_number").alias("_key"), F.lit(True).alias("_hit"))
    keyed = docs.withColumn("_key", spread_nulls("invoice_number", row_key))
    return keyed.join(shuffled(known), "_key", "left").select(
        *docs.columns, F.coalesce("_hit", F.lit(False)).alias("number_known"))


def collect_flags(docs: DataFrame, rules: list[Column]) -> DataFrame:
    """Adds ``flags``: the flags that fire, in the order of ``rules``."""
    docs = docs.withColumn("_missing", missing_fields())
    return docs.withColumn("flags", F.array_compact(F.array(*rules))).drop("_missing")


def run_rules(docs: DataFrame, reference_date: datetime.date,
              zscore_threshold: float = fv.ZSCORE_THRESHOLD) -> DataFrame:
    """All rules over documents that carry fields, zscore, number_known and the closest vendor."""
    return collect_flags(docs, missing_rule() + date_rules(reference_date) + amount_rules()
                         + outlier_rule(zscore_threshold) + duplicate_rule() + lookalike_rule() + conflict_rules())


def explode_flags(flagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """Long form: one row per document and flag, numbered from 0 in emission order."""
    # The outer form keeps the optimiser from testing size(flags), all rules once more, before the explode.
    rows = flagged.select(key, F.posexplode_outer("flags").alias("flag_no", "flag")).where("flag_no is not null")
    return rows.select(
        key, "flag_no", "flag.category", "flag.severity", "flag.message", "flag.evidence")
