"""Messages that a replayed batch does not send again.

A batch's messages go to an outbox table first and are sent from there; a marker
says that they were sent. A replay finds the marker and sends nothing, or finds
the table and sends the same messages, whatever it would compute now. Sinks that
replace a batch's output as a whole (files) so get each message once, also if the
stream ends between sending and the marker. For a sink that cannot (Kafka), the
messages sent in that moment come twice, with the same ``message_id`` in their headers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.session import delete_path, hadoop_fs, hadoop_path, path_exists


class Outbox:
    """The outbox in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, topic: str, batch_id: int) -> str:
        return f"{self.path}/topic={topic}/batch={batch_id}"

    def is_sent(self, topic: str, batch_id: int) -> bool:
        return path_exists(self.spark, f"{self._at(topic, batch_id)}/sent")

    def has(self, topic: str, batch_id: int) -> bool:
        """Whether the batch's messages are in the outbox, sent or not."""
        return path_exists(self.spark, f"{self._at(topic, batch_id)}/messages/_SUCCESS")

    def send(self, topic: str, batch_id: int, messages: DataFrame | None, deliver: Callable[[DataFrame], None]) -> bool:
        """Send a batch's messages unless they were sent; whether they were now.
        ``messages`` is not looked at (and may be None) once the outbox has them."""
        here = self._at(topic, batch_id)
        if self.is_sent(topic, batch_id):
            return False
        if not self.has(topic, batch_id):
            # Kept in one order, so that a message has one id in every reading.
            number = F.monotonically_increasing_id().cast("string")
            (messages.withColumn("message_id", F.concat(F.lit(f"{topic}:{batch_id}:"), number))
             .write.mode("overwrite").parquet(f"{here}/messages"))
        deliver(self.spark.read.parquet(f"{here}/messages"))
        hadoop_fs(self.spark, here).create(hadoop_path(self.spark, f"{here}/sent"), True).close()
        return True

    def forget(self, topic: str, before: int) -> None:
        """Delete the messages of sent batches under ``before``; their markers stay."""
        folder = f"{self.path}/topic={topic}"
        if path_exists(self.spark, folder):
            for s in hadoop_fs(self.spark, folder).listStatus(hadoop_path(self.spark, folder)):
                batch = int(s.getPath().getName().removeprefix("batch="))
                if batch < before and self.is_sent(topic, batch):
                    delete_path(self.spark, f"{folder}/batch={batch}/messages")


def with_headers(messages: DataFrame) -> DataFrame:
    """``message_id`` as a Kafka header."""
    header = F.struct(F.lit("message_id").alias("key"), F.encode("message_id", "UTF-8").alias("value"))
    return messages.withColumn("headers", F.array(header)).drop("message_id")
