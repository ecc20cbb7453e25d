
from __future__ import annotations

import functools
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from fixtures import invoice_tables as tables, small_forest  # noqa: E402
from paperwarden.functions.fixed_values import FEATURE_NAMES  # noqa: E402
from paperwarden.functions.text import digit_count  # noqa: E402
from paperwarden.operators import (baseline, extract, features, forest, neardup, percentiles, profiles,  # noqa: E402
                                   reasons, rules, scaling, vendors)
from paperwarden.operators.scale import materialise, workspace  # noqa: E402
from paperwarden.plans import pipeline  # noqa: E402
from paperwarden.sources.documents import normalise_text, rejects  # noqa: E402
from paperwarden.sources.history import read_history_checked  # noqa: E402
from paperwarden.sources.reports import read_batches, write_batch  # noqa: E402

try:  # the training-data operators are a part that can be left out
    import corpus_pipeline  # noqa: E402
    from paperwarden.llm import oracle as llm_oracle, queries as llm_queries  # noqa: E402
except ImportError:
    corpus_pipeline = llm_oracle = llm_queries = None

ENTRY_DIR = "/root/testdata/sf0.001"
ROUNDED = 6


def entry(spark: SparkSession) -> DataFrame:
    """Risk-ranked report of the arriving invoices, with rules, forest and near-duplicates."""
    return reasons.by_risk(full_report(spark, ENTRY_DIR))


# --- shared inputs -------------------------------------------------------------------------


@functools.lru_cache(maxsize=4)
def _baseline(spark: SparkSession, sf_dir: str) -> baseline.Baseline:
    return baseline.fit_baseline(tables.history(spark, sf_dir))


@functools.lru_cache(maxsize=4)
def _model(spark: SparkSession, sf_dir: str) -> pipeline.DocumentModel:
    return pipeline.fit(tables.history(spark, sf_dir))


@functools.lru_cache(maxsize=4)
def _near_duplicates(spark: SparkSession, sf_dir: str) -> neardup.NearDuplicates:
    return neardup.find_near_duplicates(_documents(spark, sf_dir), text_col="text")


@functools.lru_cache(maxsize=4)
def _all_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice as a document, written once so that queries start from a table of texts."""
    return materialise(tables.all_documents(spark, sf_dir))


@functools.lru_cache(maxsize=4)
def _new_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(tables.new_documents(spark, sf_dir))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_fields(_all_invoices(spark, sf_dir))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arriving invoices after extraction, lookups and all rules."""
    fields = pipeline.extract_batch(_new_invoices(spark, sf_dir))
    return pipeline.check_documents(fields, _baseline(spark, sf_dir), tables.REFERENCE_DATE)


def _with_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reasons.add_reasons(_checked(spark, sf_dir), ml=False)


# --- extraction ----------------------------------------------------------------------------


def extract_fields(spark, sf_dir):
    return extract.extract_raw(_all_invoices(spark, sf_dir)).select(
        "doc_id", "vendor_name", "invoice_number_raw", "po_number_raw", "payment_terms_raw", "invoice_date_raw",
        "due_date_raw", "subtotal_raw", "tax_raw", "total_amount_raw")


def extract_phrases(spark, sf_dir):
    return extract.phrase_flags(_all_invoices(spark, sf_dir)).select("doc_id", *extract.PHRASE_FLAGS)


def clean_dates(spark, sf_dir):
    return _fields(spark, sf_dir).select("doc_id", "invoice_date", "invoice_date_dt", "invoice_date_parse_ok",
                                         "due_date", "due_date_dt", "due_date_parse_ok")


def clean_money(spark, sf_dir):
    return _fields(spark, sf_dir).select("doc_id", "subtotal", "tax", "total_amount")


def text_sources(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    length = F.length("text")
    return docs.select(
        "doc_id", F.md5(normalise_text(F.col("text"))).alias("digest"), length.cast("long").alias("text_length"),
        F.round(F.coalesce(F.try_divide(digit_count(F.col("text")), length), F.lit(0.0)), ROUNDED)
        .alias("digit_density"))


def rejected_paths(spark, sf_dir):
    return rejects(spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("url").alias("path")))


@functools.lru_cache(maxsize=4)
def _checked_history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Past invoices written out as lines, some of them broken, and read back."""
    lines = f"{workspace(spark).path}/lines"
    tables.history_lines(spark, sf_dir).write.text(lines)
    return read_history_checked(spark, lines, header=False)


def history_csv(spark, sf_dir):
    return _checked_history(spark, sf_dir)[0]


def history_rejects(spark, sf_dir):
    return _checked_history(spark, sf_dir)[1].drop("path")


# --- baselines and features ----------------------------------------------------------------


def vendor_profiles(spark, sf_dir):
    return profiles.vendor_profiles(tables.history(spark, sf_dir)).select(
        "vendor_name", F.round("amount_mean", 4).alias("amount_mean"), F.round("amount_std", 4).alias("amount_std"),
        "typical_terms", "typical_net_days", "invoice_count")


def global_profile(spark, sf_dir):
    return profiles.global_profile(tables.history(spark, sf_dir)).select(
        F.round("amount_mean", 4).alias("amount_mean"), F.round("amount_std", 4).alias("amount_std"),
        "latest_date", "invoice_count")


def merged_profiles(spark, sf_dir):
    """Vendor profiles of two halves of the history, merged."""
    past = tables.history(spark, sf_dir)
    late = F.year("invoice_date") % 2 == 0
    whole = profiles.history_profile(past.where(late)).merge(profiles.history_profile(past.where(~late)))
    return whole.vendors().select(
        "vendor_name", F.round("amount_mean", 4).alias("amount_mean"), F.round("amount_std", 4).alias("amount_std"),
        "typical_terms", "typical_net_days", "invoice_count")


def known_keys(spark, sf_dir):
    past = tables.history(spark, sf_dir)
    known = profiles.history_profile(past)
    return (known.numbers.select(F.lit("invoice_number").alias("kind"), F.col("invoice_number").alias("key"))
            .unionAll(known.known_vendors().select(F.lit("vendor_name"), "vendor_name"))
            .unionAll(profiles.invoice_numbers_by_vendor(past).select(
                F.lit("vendor_invoice"), F.concat_ws("|", "vendor_name", "invoice_number"))))


def doc_features(spark, sf_dir):
    fields = extract.extract_fields(_new_invoices(spark, sf_dir)).drop("raw_text")
    found = features.add_features(fields, _baseline(spark, sf_dir))
    return found.select("doc_id", *[F.round(f"features.{n}", ROUNDED).alias(n) for n in FEATURE_NAMES])


def feature_vectors(spark, sf_dir):
    fields = extract.extract_fields(_new_invoices(spark, sf_dir)).drop("raw_text")
    found = features.add_features(fields, _baseline(spark, sf_dir))
    return found.select("doc_id", F.posexplode(features.feature_vector()).alias("place", "value")).withColumn(
        "value", F.round("value", ROUNDED))


def _history_features(spark, sf_dir):
    return features.history_features(tables.history(spark, sf_dir), _baseline(spark, sf_dir))


def history_features(spark, sf_dir):
    return _history_features(spark, sf_dir).select(
        "invoice_number", *[F.round(n, ROUNDED).alias(n) for n in FEATURE_NAMES])


def scaler_stats(spark, sf_dir):
    return scaling.scaler_stats(materialise(_history_features(spark, sf_dir)), FEATURE_NAMES).select(
        "feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


def feature_medians(spark, sf_dir):
    medians = scaling.exact_medians(materialise(_history_features(spark, sf_dir)), FEATURE_NAMES)
    return spark.createDataFrame(list(medians.items()), "feature string, median double").select(
        "feature", F.round("median", ROUNDED).alias("median"))


# --- rules ---------------------------------------------------------------------------------


def _rule(make: Callable[[], list]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        flagged = rules.collect_flags(_fields(spark, sf_dir), make())
        return rules.explode_flags(flagged).select("doc_id", "category", "severity", "message")
    return query


def _rule_on_arrivals(category: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        return rules.explode_flags(_checked(spark, sf_dir)).where(F.col("category") == category).select(
            "doc_id", "category", "severity", "message")
    return query


def vendor_lookalikes(spark, sf_dir):
    names = extract.extract_raw(_new_invoices(spark, sf_dir)).select("vendor_name")
    return vendors.lookalike_vendors(names, _baseline(spark, sf_dir).vendors).select(
        "vendor_name", "closest_vendor", F.round("vendor_similarity", ROUNDED).alias("vendor_similarity"))


def flags_long(spark, sf_dir):
    return rules.explode_flags(_checked(spark, sf_dir)).drop("evidence")


def flag_counts(spark, sf_dir):
    return flags_long(spark, sf_dir).groupBy("category", "severity").agg(F.count("*").alias("flags"))


# --- similarity ----------------------------------------------------------------------------


def tfidf_weights(spark, sf_dir):
    tokenised = neardup.tokenise(_documents(spark, sf_dir), text_col="text")
    terms = materialise(neardup.term_counts(tokenised))
    return neardup.unit_weights(materialise(tokenised.select("doc_id", "bag")), terms).withColumn(
        "weight", F.round("weight", ROUNDED))


def near_duplicates(spark, sf_dir):
    return neardup.partner_summary(_near_duplicates(spark, sf_dir)).select(
        "doc_id", "n_partners", F.round("best_similarity", ROUNDED).alias("best_similarity"))


def near_dup_groups(spark, sf_dir):
    return neardup.near_dup_groups(_near_duplicates(spark, sf_dir)).withColumn("rho", F.round("rho", ROUNDED))


def near_dup_links(spark, sf_dir):
    return neardup.near_dup_links(_near_duplicates(spark, sf_dir)).withColumn(
        "similarity", F.round("similarity", ROUNDED))


def near_dup_reasons(spark, sf_dir):
    return reasons.near_dup_reasons(_near_duplicates(spark, sf_dir)).select(
        "doc_id", "n_partners", F.posexplode_outer("near_dup_reasons").alias("reason_no", "reason")).select(
        "doc_id", "n_partners", "reason_no", "reason.message")


# --- model ---------------------------------------------------------------------------------


def forest_scores(spark, sf_dir):
    checked = features.add_features(
        extract.extract_fields(_new_invoices(spark, sf_dir)).drop("raw_text"), _baseline(spark, sf_dir))
    return _model(spark, sf_dir).forest.score(checked).select(
        "doc_id", F.round("score", ROUNDED).alias("score"), F.round("percentile", ROUNDED).alias("percentile"))


def attributions(spark, sf_dir):
    checked = features.add_features(
        extract.extract_fields(_new_invoices(spark, sf_dir)).drop("raw_text"), _baseline(spark, sf_dir))
    return _model(spark, sf_dir).forest.score(checked).select(
        "doc_id", F.posexplode_outer("top_features").alias("place", "f")).select(
        "doc_id", "place", "f.feature", F.round("f.value", ROUNDED).alias("value"),
        F.round("f.contribution", ROUNDED).alias("contribution"))


@functools.lru_cache(maxsize=4)
def _small_forest(spark: SparkSession, sf_dir: str) -> forest.ForestModel:
    """A forest written by hand, with the scores of the history as its reference."""
    model = forest.ForestModel(FEATURE_NAMES, small_forest.node_table(), small_forest.SUBSAMPLE, small_forest.MEDIANS)
    model.reference = percentiles.fit_reference(model.score_only(_history_features(spark, sf_dir)))
    return model


def _small_forest_scored(spark, sf_dir):
    fields = extract.extract_fields(_new_invoices(spark, sf_dir)).drop("raw_text")
    return _small_forest(spark, sf_dir).score(features.add_features(fields, _baseline(spark, sf_dir)))


def fixed_forest_scores(spark, sf_dir):
    return _small_forest_scored(spark, sf_dir).select(
        "doc_id", F.round("score", ROUNDED).alias("score"), F.round("percentile", ROUNDED).alias("percentile"))


def fixed_forest_attributions(spark, sf_dir):
    return _small_forest_scored(spark, sf_dir).select("doc_id", F.posexplode("top_features").alias("place", "f")).select(
        "doc_id", "place", "f.feature", (F.round("f.value", ROUNDED) + 0.0).alias("value"),
        (F.round("f.contribution", ROUNDED) + 0.0).alias("contribution"))


def _total_percentiles(spark, sf_dir, scored: DataFrame) -> DataFrame:
    reference = percentiles.fit_reference(tables.history(spark, sf_dir), "total_amount")
    return percentiles.add_percentiles(scored, reference)


def score_percentiles(spark, sf_dir):
    """Percentiles of a fixed score: the printed total against all past totals."""
    arriving = extract.extract_fields(_new_invoices(spark, sf_dir)).select(
        "doc_id", F.col("total_amount").alias("score"))
    return _total_percentiles(spark, sf_dir, arriving).withColumn("percentile", F.round("percentile", ROUNDED))


def ml_reasons(spark, sf_dir):
    """Reason texts for given attributions, taken from the line items."""
    def top(name, value, contribution):
        return F.struct(F.lit(name).alias("feature"), value.alias("value"), contribution.alias("contribution"))

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    given = F.array(top("subtotal", F.col("l_extendedprice"), F.col("l_discount")),
                    top("tax_ratio", F.col("l_quantity"), F.col("l_tax") * 10))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                        F.explode_outer(reasons.ml_reasons(given)).alias("r")).where("r is not null").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "r.category", "r.severity", "r.message")


# --- report --------------------------------------------------------------------------------


def risk_levels(spark, sf_dir):
    return _with_reasons(spark, sf_dir).select("doc_id", "risk_weight", "risk_level")


def combined_risk(spark, sf_dir):
    """Risk from rules plus a percentile, here that of the printed total."""
    scored = _checked(spark, sf_dir).withColumn("score", F.col("total_amount"))
    scored = _total_percentiles(spark, sf_dir, scored)
    weight = reasons.rule_weight(F.col("flags")) + reasons.ml_weight(F.col("percentile"))
    return scored.select("doc_id", weight.alias("risk_weight")).withColumn(
        "risk_level", reasons.risk_level(F.col("risk_weight")))


def reason_rows(spark, sf_dir):
    return _with_reasons(spark, sf_dir).select("doc_id", F.posexplode_outer("reasons").alias("reason_no", "r")).select(
        "doc_id", "reason_no", "r.source", "r.category", "r.severity", "r.message")


def rule_report(spark, sf_dir):
    report = reasons.report(_with_reasons(spark, sf_dir), ml=False)
    return report.select("doc_id", "risk_level", "extracted_fields.*",
                         F.array_join("reasons.message", " | ").alias("messages"))


def summary_lines(spark, sf_dir):
    return reasons.summary_lines(reasons.report(_with_reasons(spark, sf_dir), ml=False))


def report_batches(spark, sf_dir):
    """Reports written as two batches, one of them first with rows that do not belong to it, and read back."""
    reports = materialise(reasons.report(_with_reasons(spark, sf_dir), ml=False))
    odd = F.split("doc_id", "-")[1].cast("long") % 2 == 1
    path = f"{workspace(spark).path}/reports"
    for batch, rows in ((0, reports), (0, reports.where(~odd)), (1, reports.where(odd))):
        write_batch(rows, path, batch)
    return read_batches(spark, path).select("doc_id", "risk_level", "batch")


def detection_table(spark, sf_dir):
    labels = _new_invoices(spark, sf_dir).select(
        F.col("doc_id").alias("filename"), F.col("kind").alias("ground_truth_note"))
    return reasons.detection_table(reasons.report(_with_reasons(spark, sf_dir), ml=False), labels)


def full_report(spark, sf_dir):
    return _model(spark, sf_dir).score(_new_invoices(spark, sf_dir), tables.REFERENCE_DATE)


def fixed_report(spark, sf_dir):
    """The whole report with the hand-written forest, over the arriving invoices and those that were sent twice."""
    batch = materialise(tables.with_resent(_new_invoices(spark, sf_dir).drop("kind")))
    model = pipeline.DocumentModel(_baseline(spark, sf_dir), _small_forest(spark, sf_dir))
    found = model.score(batch, tables.REFERENCE_DATE)
    return found.select("doc_id", "risk_level", "ml_anomaly_score", "ml_anomaly_percentile", "extracted_fields.*",
                        F.array_join("reasons.message", " | ").alias("messages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "extract_fields": extract_fields, "extract_phrases": extract_phrases, "clean_dates": clean_dates,
        "clean_money": clean_money, "text_sources": text_sources, "rejects": rejected_paths, "history_csv": history_csv, "history_rejects": history_rejects,
        "vendor_profiles": vendor_profiles, "merged_profiles": merged_profiles,
        "global_profile": global_profile, "known_keys": known_keys,
        "doc_features": doc_features, "feature_vectors": feature_vectors, "history_features": history_features, "scaler_stats": scaler_stats,
        "feature_medians": feature_medians,
        "rule_missing": _rule(rules.missing_rule),
        "rule_date_format": _rule(lambda: rules.date_rules(tables.REFERENCE_DATE)[:2]),
        "rule_date_logic": _rule(lambda: rules.date_rules(tables.REFERENCE_DATE)[2:]),
        "rule_arithmetic": _rule(lambda: rules.amount_rules()[:1]),
        "rule_round": _rule(lambda: rules.amount_rules()[1:]),
        "rule_conflict": _rule(rules.conflict_rules),
        "rule_outlier": _rule_on_arrivals("amount_outlier"),
        "rule_duplicate": _rule_on_arrivals("duplicate"),
        "rule_lookalike": _rule_on_arrivals("vendor_lookalike"),
        "vendor_lookalikes": vendor_lookalikes, "flags_long": flags_long, "flag_counts": flag_counts,
        "tfidf_weights": tfidf_weights, "near_duplicates": near_duplicates, "near_dup_groups": near_dup_groups,
        "near_dup_links": near_dup_links, "near_dup_reasons": near_dup_reasons,
        "forest_scores": forest_scores, "attributions": attributions,
        "fixed_forest_scores": fixed_forest_scores, "fixed_forest_attributions": fixed_forest_attributions,
        "percentiles": score_percentiles,
        "ml_reasons": ml_reasons, "risk_levels": risk_levels, "combined_risk": combined_risk,
        "reasons": reason_rows, "rule_report": rule_report, "summary_lines": summary_lines, "report_batches": report_batches,
        "detection_table": detection_table, "full_report": full_report,
        "fixed_report": fixed_report,
        **({**llm_queries.queries(), "pipeline": corpus_pipeline.run} if llm_queries else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**oracle_queries.oracle_sql(), **(llm_oracle.oracle_sql() if llm_oracle else {})}
