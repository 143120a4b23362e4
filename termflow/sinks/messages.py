"""Message sinks and sources: Kafka when its connector is on the class path,
files otherwise (tests, or a lake folder instead of a topic).

A message frame has ``value`` and optionally ``key`` and ``topic`` columns,
the shape the Kafka sink takes. File sinks write one folder per topic
(``topic=<name>``) and, inside a stream, one per batch, so a replayed batch
overwrites its own output instead of adding to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from termflow.functions.constants import (DOC_TOPIC, DOC_TOPIC_PATTERN,  # noqa: F401
                                          NOTICE_TOPIC, SCORE_TOPIC)


def kafka_options(bootstrap: str, subscribe_pattern: str | None = None,
                  subscribe: str | None = None, **extra) -> dict[str, str]:
    """Reader options: pattern or list subscription, earliest offsets when
    none are committed or they are out of range, no failure on lost data.
    Offsets live in the query checkpoint, which replaces auto commit."""
    opts = {"kafka.bootstrap.servers": bootstrap, "startingOffsets": "earliest",
            "failOnDataLoss": "false"}
    if subscribe_pattern:
        opts["subscribePattern"] = subscribe_pattern
    if subscribe:
        opts["subscribe"] = subscribe
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def as_documents(records: DataFrame) -> DataFrame:
    """Kafka records → ``doc_name, content`` (both nullable strings)."""
    return records.select(F.col("key").cast("string").alias("doc_name"),
                          F.col("value").cast("string").alias("content"))


def write_messages(messages: DataFrame, fmt: str, topic: str | None = None,
                   options: dict | None = None, path: str | None = None,
                   batch_id: int | None = None) -> None:
    """Write messages. Kafka: ``topic`` option (or a ``topic`` column per
    row, the per-topic fan-out). Files: ``path/topic=<t>[/batch_id=<n>]``,
    overwritten as a unit; messages with a ``topic`` column and no batch id are
    appended, so send those once."""
    if fmt == "kafka":
        w = messages.write.format("kafka").options(**(options or {}))
        if topic:
            w = w.option("topic", topic)
        w.save()
        return
    if path is None:
        raise ValueError("file sinks need a path")
    if topic is not None:
        target = f"{path.rstrip('/')}/topic={topic}"
        out = messages.drop("topic") if "topic" in messages.columns else messages
        if batch_id is not None:
            target += f"/batch_id={batch_id}"
        out.write.mode("overwrite").format(fmt).options(**(options or {})).save(target)
        return
    # Per-row topics: one folder per topic value.
    if batch_id is not None:
        messages = messages.withColumn("batch_id", F.lit(batch_id))
        (messages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("topic", "batch_id").format(fmt).save(path))
    else:
        messages.write.mode("append").partitionBy("topic").format(fmt).save(path)


def fan_out(messages: DataFrame, topics: list[str]) -> dict[str, DataFrame]:
    """The messages of each named topic (a filter per topic)."""
    return {t: messages.filter(F.col("topic") == F.lit(t)).drop("topic") for t in topics}


def document_messages(docs: DataFrame, name_col: str = "doc_name",
                      content_col: str = "content") -> DataFrame:
    """Documents as messages: ``key`` = name (path), ``value`` = contents."""
    return docs.select(F.col(name_col).cast("string").alias("key"),
                       F.col(content_col).cast("string").alias("value"))


def publish_documents(docs: DataFrame, fmt: str = "kafka", topic: str = DOC_TOPIC,
                      options: dict | None = None, path: str | None = None) -> None:
    """Send documents to the document topic (or a file folder)."""
    write_messages(document_messages(docs), fmt, topic=topic, options=options, path=path)
