"""Streaming document sources: ``doc_name, content`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.functions.text import normalize_lines
from termflow.sinks.messages import DOC_TOPIC_PATTERN, as_documents, kafka_options

DOC_SCHEMA = "doc_name string, content string"


def doc_stream(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
               path: str | None = None, bootstrap: str | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of documents.

    * ``kafka``: topics matching ``(?i)docs`` (key = name, value = contents);
      the Kafka connector must be on the class path.
    * ``text``: each new file in ``path`` is one document, its path the name, its
      contents as the feeder sends them (each line followed by one space).
    * any other file format with columns ``doc_name, content``.
    """
    if fmt == "kafka":
        opts = options or kafka_options(bootstrap or "localhost:9092",
                                        subscribe_pattern=DOC_TOPIC_PATTERN)
        return as_documents(spark.readStream.format("kafka").options(**opts).load())
    r = spark.readStream.options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "text":
        return (r.text(path, wholetext=True)
                .select(F.col("_metadata.file_path").alias("doc_name"),
                        normalize_lines("value").alias("content")))
    return r.schema(DOC_SCHEMA).format(fmt).load(path)


def read_documents_once(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                        path: str | None = None, bootstrap: str | None = None) -> DataFrame:
    """One poll: every document available now, as a batch DataFrame
    (Kafka: from the earliest to the latest offsets of the document topics)."""
    if fmt == "kafka":
        opts = options or kafka_options(bootstrap or "localhost:9092",
                                        subscribe_pattern=DOC_TOPIC_PATTERN,
                                        endingOffsets="latest")
        return as_documents(spark.read.format("kafka").options(**opts).load())
    r = spark.read.options(**(options or {}))
    if fmt == "text":
        return (r.text(path, wholetext=True)
                .select(F.col("_metadata.file_path").alias("doc_name"),
                        normalize_lines("value").alias("content")))
    return r.schema(DOC_SCHEMA).format(fmt).load(path)
