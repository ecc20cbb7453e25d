"""Finds suspicious business documents with Spark: fields, rules, isolation forest, near-duplicates, reasons."""

import sys

from pyspark import cloudpickle

from .operators.baseline import fit_baseline
from .operators.extract import extract_fields
from .operators.forest import fit_forest
from .operators.neardup import find_near_duplicates, partner_summary, partners_of
from .operators.reasons import by_risk, detection_table, summary_lines
from .operators.scale import temporary_workspace
from .plans.pipeline import DocumentModel, fit
from .sources.documents import documents_of, read_documents, read_folder, read_rejects
from .sources.history import read_history, read_history_checked, read_labels, read_labels_checked
from .sources.reports import read_batches, write_batch, write_report
from .streaming.scoring import score_stream

__all__ = [
    "DocumentModel", "by_risk", "detection_table", "documents_of", "extract_fields", "find_near_duplicates", "fit", "fit_baseline",
    "fit_forest", "partner_summary", "partners_of", "read_batches", "read_documents", "read_folder", "read_history",
    "read_history_checked", "read_labels", "read_labels_checked", "read_rejects", "score_stream", "summary_lines",
    "temporary_workspace", "write_batch", "write_report",
]

# Functions sent to executors are pickled by value, so they need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
