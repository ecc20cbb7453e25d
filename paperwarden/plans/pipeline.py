"""The whole job: fit on history, then score batches of documents."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions import fixed_values as fv
from ..operators.baseline import Baseline, fit_baseline, from_profile
from ..operators.extract import extract_fields
from ..operators.features import add_features, history_features
from ..operators.forest import ForestModel, fit_forest
from ..operators.neardup import NearDuplicates, find_near_duplicates
from ..operators.profiles import HistoryProfile
from ..operators.reasons import add_reasons, near_dup_reasons, report
from ..operators.rules import mark_known_numbers, run_rules
from ..operators.scale import materialise
from ..operators.vendors import attach_closest_vendor


def check_documents(fields: DataFrame, baseline: Baseline, reference_date: datetime.date,
                    zscore_threshold: float = fv.ZSCORE_THRESHOLD) -> DataFrame:
    """Features, lookups and rule flags for extracted documents (text no longer needed).

    ``fields`` is read more than once, so it should be a table, as ``extract_batch`` gives it.
    """
    checked = attach_closest_vendor(fields, baseline.vendors)
    checked = add_features(checked, baseline)
    checked = mark_known_numbers(checked, baseline)
    return run_rules(checked, reference_date, zscore_threshold)


def extract_batch(docs: DataFrame, extractor: Callable[[DataFrame], DataFrame] = extract_fields) -> DataFrame:
    """Fields of a batch without the text, written once: several later steps read them."""
    return materialise(extractor(docs).drop("raw_text"))


@dataclass
class DocumentModel:
    """What is fitted on the history of invoices."""

    baseline: Baseline
    forest: ForestModel

    def score(self, docs: DataFrame, reference_date: datetime.date, near_duplicates: bool = True,
              zscore_threshold: float = fv.ZSCORE_THRESHOLD, top_k: int = fv.TOP_FEATURES,
              near_duplicate_threshold: float = fv.NEAR_DUPLICATE_THRESHOLD,
              extractor: Callable[[DataFrame], DataFrame] = extract_fields,
              finder: Callable[..., NearDuplicates] = find_near_duplicates) -> DataFrame:
        """Report of a batch (doc_id, raw_text). Near-duplicates are looked for inside the batch.

        ``extractor`` and ``finder`` may be replaced by functions that give the same columns.
        """
        fields = extract_batch(docs, extractor)
        checked = check_documents(fields, self.baseline, reference_date, zscore_threshold)
        scored = self.forest.score(checked, top_k=top_k)
        found = None
        if near_duplicates:
            found = near_dup_reasons(finder(docs, threshold=near_duplicate_threshold))
        return report(add_reasons(scored, near_dups=found))

    def save(self, path: str) -> None:
        profile = self.baseline.profile
        profile.moments.write.mode("overwrite").parquet(f"{path}/moments")
        profile.numbers.write.mode("overwrite").parquet(f"{path}/invoice_numbers")
        self.forest.save(self.baseline.vendors.sparkSession, f"{path}/forest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "DocumentModel":
        profile = HistoryProfile(spark.read.parquet(f"{path}/moments"), spark.read.parquet(f"{path}/invoice_numbers"))
        return DocumentModel(from_profile(profile), ForestModel.load(spark, f"{path}/forest"))


def fit(history: DataFrame, text_col: str | None = None, trees: int = fv.FOREST_TREES,
        subsample: int = fv.FOREST_SUBSAMPLE, seed: int = fv.FOREST_SEED) -> DocumentModel:
    """Baselines and forest from past invoices."""
    baseline = fit_baseline(history)
    rows = materialise(history_features(history, baseline, text_col).select(*fv.FEATURE_NAMES))
    return DocumentModel(baseline, fit_forest(rows, trees=trees, subsample=subsample, seed=seed))
