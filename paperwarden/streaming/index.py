"""What earlier micro-batches held, for checks that reach across them."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.fixed_values import NEAR_DUPLICATE_THRESHOLD
from ..operators.baseline import Baseline
from ..operators.neardup import NearDuplicates, search, tokenise
from ..operators.profiles import HistoryProfile


class DocumentIndex:
    """Token sequences and invoice numbers of all micro-batches so far, one folder a batch below ``path``.

    A batch that is added again replaces what it added before, so a retried batch changes nothing, and a restarted
    stream goes on from the folders. Texts are tokenised once, when their batch arrives; near-duplicates are searched
    among all batches, as weights of terms follow from all documents.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, batch: int, docs: DataFrame, fields: DataFrame) -> None:
        """``docs`` (doc_id, raw_text) and their extracted ``fields`` (doc_id, invoice_number)."""
        tokenise(docs).write.mode("overwrite").parquet(f"{self.path}/tokens/batch={batch}")
        numbers = fields.where("invoice_number is not null").select("invoice_number").distinct()
        numbers.write.mode("overwrite").parquet(f"{self.path}/numbers/batch={batch}")

    def _read(self, part: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.path}/{part}")

    def near_duplicates(self, batch: int, doc_type: str, threshold: float = NEAR_DUPLICATE_THRESHOLD) -> NearDuplicates:
        """The relation of the documents of all batches up to ``batch``; ``doc_type`` is the type of their ids."""
        rows = self._read("tokens", f"doc_id {doc_type}, bag binary, words array<string>").where(F.col("batch") <= batch)
        return search(rows.drop("batch"), threshold)

    def with_numbers(self, baseline: Baseline, batch: int) -> Baseline:
        """``baseline`` with the invoice numbers of the batches before ``batch`` as known ones."""
        if not batch:
            return baseline
        earlier = self._read("numbers", "invoice_number string").where(F.col("batch") < batch).select("invoice_number")
        numbers = baseline.invoice_numbers.unionByName(earlier).distinct()
        return dataclasses.replace(baseline, profile=HistoryProfile(baseline.profile.moments, numbers))
