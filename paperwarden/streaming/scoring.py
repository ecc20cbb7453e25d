"""Arriving documents: every micro-batch goes through the same plan as a static batch."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.scale import temporary_workspace
from ..plans.pipeline import DocumentModel, extract_batch
from .index import DocumentIndex


def score_stream(docs: DataFrame, model: DocumentModel, reference_date: datetime.date, path: str,
                 checkpoint_location: str, near_duplicates: bool = False, available_now: bool = False,
                 index: str | None = None) -> StreamingQuery:
    """Write the report of each micro-batch of ``docs`` (doc_id, raw_text) to ``path`` as JSON.

    A batch writes its own folder and a retried batch replaces it, so results appear once.
    Documents need nothing from earlier batches; near-duplicates, if asked for, are those inside a micro-batch. With
    ``index``, a folder that is kept from batch to batch, near-duplicates and repeated invoice numbers are also looked
    for in all batches before. Intermediate tables of a batch are removed when it is written.
    """
    def scored(batch: DataFrame, batch_id: int) -> DataFrame:
        if index is None:
            return model.score(batch, reference_date, near_duplicates=near_duplicates)
        seen, fields = DocumentIndex(batch.sparkSession, index), extract_batch(batch)
        seen.add(batch_id, batch, fields)
        doc_type = batch.schema["doc_id"].dataType.simpleString()
        return DocumentModel(seen.with_numbers(model.baseline, batch_id), model.forest).score(
            batch, reference_date, extractor=lambda _: fields.withColumn("raw_text", F.lit(None).cast("string")),
            finder=lambda _, threshold: seen.near_duplicates(batch_id, doc_type, threshold))

    def write(batch: DataFrame, batch_id: int) -> None:
        with temporary_workspace(batch.sparkSession):
            reports = scored(batch, batch_id)
            (reports.write.mode("overwrite").option("ignoreNullFields", False)
             .json(f"{path}/batch={batch_id}"))

    writer = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
