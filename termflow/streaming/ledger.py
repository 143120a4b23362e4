"""The poll job's own record of what it read: offsets from and to, for each batch.

``messages`` are rows with ``topic``, ``partition``, ``offset`` and more columns (a
Kafka batch read, or message files). A poll takes, of each partition, what follows
the last committed offset. Where that offset is out of range (older messages were
deleted, or the partition begins anew), it starts at the earliest message there is.
The batch's offsets are written before its rows are worked on and committed by a
marker after they were published: a poll that stopped in between is repeated over
the same offsets, so with the same messages and the same batch number.

Defined results: a partition never seen is read from its earliest message; one that
has nothing new is left out; no new messages at all give no batch; messages that
arrive between planning and reading wait for the next poll; rows with a null offset
are not messages and play no part; messages given twice come twice. One row for each
partition is kept in a ledger entry, however many messages there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.session import delete_path, hadoop_fs, hadoop_path, path_exists

_KEY = ["topic", "partition"]
_SCHEMA = "topic string, partition int, first bigint, last bigint"


class OffsetLedger:
    """The ledger in the folder ``path``, one folder for each batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, batch: int) -> str:
        return f"{self.path}/batch={batch}"

    def _batches(self) -> list[int]:
        if not path_exists(self.spark, self.path):
            return []
        found = hadoop_fs(self.spark, self.path).listStatus(hadoop_path(self.spark, self.path))
        return sorted(int(s.getPath().getName().removeprefix("batch=")) for s in found)

    def is_committed(self, batch: int) -> bool:
        return path_exists(self.spark, f"{self._at(batch)}/committed")

    def offsets(self, batch: int) -> DataFrame:
        """``topic, partition, first, last`` of a batch. An entry holds all partitions
        ever read; those with nothing in this batch have ``first`` beyond ``last``."""
        return self.spark.read.schema(_SCHEMA).parquet(f"{self._at(batch)}/offsets")

    def plan(self, messages: DataFrame) -> int | None:
        """The batch to work on: an unfinished one, or a new one over all that is
        there now; None if nothing is new."""
        batches = self._batches()
        done = [b for b in batches if self.is_committed(b)]
        last = done[-1] if done else None
        for b in batches:
            if (last is None or b > last) and path_exists(self.spark, f"{self._at(b)}/offsets/_SUCCESS"):
                return b
        there = (messages.where("offset IS NOT NULL").groupBy(*_KEY)
                 .agg(F.min("offset").alias("low"), F.max("offset").alias("high")))
        before = self.offsets(last).select(*_KEY, F.expr("last + 1").alias("next")) if last is not None else (
            self.spark.createDataFrame([], "topic string, partition int, next bigint"))
        # Out of range: before the earliest, or beyond the message that would be next.
        first = F.when(F.col("next").between(F.col("low"), F.col("high") + 1), F.col("next")).otherwise(F.col("low"))
        now = (there.join(before, _KEY, "full")
               .select("topic", F.col("partition").cast("int").alias("partition"),
                       F.when(F.col("low").isNull(), F.col("next")).otherwise(first).alias("first"),
                       F.coalesce("high", F.col("next") - 1).cast("bigint").alias("last")))
        batch = 0 if last is None else last + 1
        now.write.mode("overwrite").parquet(f"{self._at(batch)}/offsets")
        if self.offsets(batch).where("first <= last").isEmpty():
            delete_path(self.spark, self._at(batch))
            return None
        return batch

    def rows(self, messages: DataFrame, batch: int) -> DataFrame:
        """The messages of a batch, with their columns."""
        span = F.broadcast(self.offsets(batch).where("first <= last").select(
            *[F.col(c).alias(f"__{c}") for c in (*_KEY, "first", "last")]))
        mine = ((F.col("topic") == F.col("__topic")) & (F.col("partition") == F.col("__partition"))
                & F.col("offset").between(F.col("__first"), F.col("__last")))
        return messages.join(span, mine, "left_semi")

    def commit(self, batch: int) -> None:
        hadoop_fs(self.spark, self.path).create(hadoop_path(self.spark, f"{self._at(batch)}/committed"), True).close()

    def forget(self) -> None:
        """Delete committed entries before the last, which is all that a poll looks at."""
        done = [b for b in self._batches() if self.is_committed(b)]
        for b in done[:-1]:
            delete_path(self.spark, self._at(b))


def poll(messages: DataFrame, ledger: OffsetLedger, publish: Callable[[DataFrame, int], None]) -> int | None:
    """Publish what is new and commit its offsets: the batch's number, or None if there
    was nothing. ``publish`` gets the rows and the number, under which a repeated batch
    can replace what it published before."""
    batch = ledger.plan(messages)
    if batch is not None:
        publish(ledger.rows(messages, batch), batch)
        ledger.commit(batch)
    return batch
