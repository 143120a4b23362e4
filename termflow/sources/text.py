"""Text sources: line files, whole files, numeric vector lines, a manifest of
files, and in-memory rows.

All return DataFrames; nothing is read on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.functions.text import normalize_lines, parse_doubles, split_lines
from termflow.sources.manifest import listed_files


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line of the files: ``value STRING``."""
    return spark.read.text(path)


def lines_of(df: DataFrame, text_col: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """One row per line of a text column (same line rules as a file
    reader), with the ``keep`` columns alongside: ``*keep, line_no, value``."""
    from termflow.operators.tokens import explode_items

    arr = df.select(*keep, split_lines(text_col).alias("_lines"))
    return explode_items(arr, "_lines", "value", list(keep), with_pos="line_no")


def whole_text_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: ``doc_name STRING`` (full path), ``content STRING``."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("doc_name"),
                    F.col("value").alias("content")))


def numeric_vectors(lines: DataFrame, value_col: str = "value", strict: bool = True,
                    id_col: str | None = None) -> DataFrame:
    """Lines of space-separated numbers → ``[id,] values ARRAY<DOUBLE>``.

    ``id_col`` names an existing key to keep as ``id``; to number lines in
    file order use :func:`termflow.operators.vocab.ordered_index`.
    """
    cols = [F.col(id_col).alias("id")] if id_col else []
    return lines.select(*cols, parse_doubles(value_col, strict).alias("values"))


def manifest_documents(spark: SparkSession, manifest_path: str, root: str | None = None) -> DataFrame:
    """A text file listing one path per line → ``doc_name, content`` with the
    content normalised as the file feeder sent it (each line + one space).

    Tasks read ranges of the manifest and the files that it names
    (:mod:`termflow.sources.manifest`), so neither the list nor a file passes through the
    driver. A file named twice comes twice, as the feeder sent it; a file that cannot
    be read has null content. Where only Spark's own readers can open the listed files,
    give the ``root`` folder of all of them: it is scanned as a whole, then joined with
    the manifest on the path.
    """
    if root is None:
        return listed_files(spark, manifest_path).select("doc_name", normalize_lines("value").alias("content"))
    manifest = spark.read.text(manifest_path).select(F.col("value").alias("doc_name"))
    files = (spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
             .select(_path_key(F.col("_metadata.file_path")).alias("_key"),
                     normalize_lines("value").alias("content")))
    return (manifest.withColumn("_key", _path_key(F.col("doc_name")))
            .join(files, "_key", "left").select("doc_name", "content"))


def _path_key(path):
    """A path without its scheme and authority (``file:``, ``hdfs://nn:8020``,
    ``s3a://bucket``), so a listed path matches the qualified URI that
    ``_metadata.file_path`` reports."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def in_memory(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Small driver-side rows as a DataFrame (tests, fixed fixtures)."""
    return spark.createDataFrame(rows, schema)
