"""The document feeder: a manifest of files → one message per file.

The original feeder read each listed file line by line (each line plus one
space) and sent ``(path, contents)``, sleeping between sends to simulate
arrival. Here the files are read by Spark in one distributed job and
written as messages; pacing belongs to the reader (``maxFilesPerTrigger``
or the trigger interval), not to the writer.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from termflow.sinks.messages import DOC_TOPIC, publish_documents
from termflow.sources.text import manifest_documents


def feed(spark: SparkSession, manifest_path: str, fmt: str = "kafka", topic: str = DOC_TOPIC,
         options: dict | None = None, path: str | None = None) -> int:
    """Publish the listed files; returns the number of documents sent."""
    docs = manifest_documents(spark, manifest_path).persist()
    try:
        publish_documents(docs, fmt, topic, options, path)
        return docs.count()
    finally:
        docs.unpersist()
