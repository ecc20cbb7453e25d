"""Folders of document files. Plain text is read; every other file is listed as rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TEXT_FILES = "*.[tT][xX][tT]"
NEEDS_RECOGNITION = [".pdf", ".png", ".jpg", ".jpeg", ".tiff", ".tif", ".bmp"]  # fixed values


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^/](\.[^./]*)$", 1))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def normalise_text(raw: Column) -> Column:
    """Bytes that are not UTF-8 dropped, every line end as one newline; replacement signs of the text itself stay."""
    sign, held = F.lit("\ufffd"), F.lit("\ufdd0\ufdd1")
    mended = F.replace(F.make_valid_utf8(F.replace(raw, sign, held)), sign, F.lit(""))
    valid = F.when(F.is_valid_utf8(raw), raw).otherwise(F.replace(mended, held, sign))
    return F.regexp_replace(valid, "\r\n?", "\n")


def read_documents(spark: SparkSession, path: str | list[str], id_from: str = "name") -> DataFrame:
    """(doc_id, path, raw_text) of the text files in a folder, one row per file.

    doc_id is the file name; with several folders that repeat names use ``id_from="path"``.
    """
    if id_from not in ("name", "path"):
        raise ValueError("id_from must be 'name' or 'path'")
    files = (spark.read.text(path, wholetext=True, pathGlobFilter=TEXT_FILES)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), "value"))
    return files.select(F.col(id_from).alias("doc_id"), "path", normalise_text(F.col("value")).alias("raw_text"))


FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_folder(spark: SparkSession, path: str, id_from: str = "name", stream: bool = False) -> DataFrame:
    """(doc_id, path, ext, raw_text, reason) of all files of a folder, from one scan.

    Files that are not plain text have a ``reason`` and no text. With ``stream`` the rows are those of files as they
    arrive. ``documents_of`` and ``rejects`` take the two parts.
    """
    if id_from not in ("name", "path"):
        raise ValueError("id_from must be 'name' or 'path'")
    reader = (spark.readStream if stream else spark.read).format("binaryFile").schema(FILE_SCHEMA)
    name = base_name(F.col("path"))
    files = reader.load(path).select(
        (name if id_from == "name" else F.col("path")).alias("doc_id"), "path", extension(name).alias("ext"), "content")
    text = F.when(F.col("ext") == ".txt", normalise_text(F.col("content").cast("string")))
    return files.select("doc_id", "path", "ext", text.alias("raw_text"), _reject_reason().alias("reason"))


def documents_of(files: DataFrame) -> DataFrame:
    """(doc_id, path, raw_text) of the text files among the rows of ``read_folder``."""
    return files.where("reason is null").select("doc_id", "path", "raw_text")


def _reject_reason() -> Column:
    """Why a file with this ``ext`` is not read; null for plain text."""
    ext = F.col("ext")
    return F.when(ext.isin(NEEDS_RECOGNITION), F.lit("needs text recognition")).when(
        ext != ".txt", F.concat(F.lit("Unsupported file type: "), ext))


def read_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, ext, reason) of the files that are not plain text; their contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return rejects(files)


def rejects(files: DataFrame) -> DataFrame:
    """(path, ext, reason) of the paths in ``files`` that are not plain text."""
    listed = files.select("path", extension(base_name(F.col("path"))).alias("ext")).where("ext <> '.txt'")
    return listed.select("path", "ext", _reject_reason().alias("reason"))
