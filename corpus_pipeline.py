"""A training corpus from raw documents: filter, deduplicate, decontaminate and mix, one operator a stage.

Defined cases. A null or empty text has no words, so the first stage rejects its row. Rows that say the same, also twice
under one id, are one group in the second stage, whose first row stays; a row without an id is as good as any. A text
that the third stage empties stays as an empty one. Texts are read whole, whatever their length. A table without rows
gives none. All columns of the documents, whatever their names, reach the last stage, which returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperwarden.llm import decontaminate, jaccard_join, mixing, quality_rules, sentence_spans
from paperwarden.operators.scale import Workspace


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return jaccard_join.keep_first(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand in an earlier one."""
    cleaned = sentence_spans.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.length("text").cast(kind))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix_sources(docs)


STAGES = [("quality_rules", quality_stage), ("jaccard_join", near_duplicate_stage), ("sentence_spans", substring_stage),
          ("decontamination", decontamination_stage), ("source_mix", mixing_stage)]

#: Connected components and alignments are beyond SQL here; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written and read again."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
