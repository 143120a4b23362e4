"""The price stream job.

    price messages (key = symbol, value = JSON record) --foreachBatch--> per batch N:
        statistics of batch N per symbol         -> stats table, batch_id=N
        latest statistic per symbol up to N      -> state table, batch_id=N
        stats N joined to state N-1 (one row per symbol)
                                                 -> delta, position -> output lines

The previous statistic of a symbol comes from the state written by the
previous batch: one row per symbol, read by partition pruning, so a batch
costs the same however long the stream has run. State is written for every
batch id, also when nothing arrived, and every write overwrites its own
``batch_id`` folder, so replaying a batch gives the same output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from termflow.functions.constants import POSITION_THRESHOLD, PRICE_TOPIC
from termflow.operators import prices as P
from termflow.session import delete_path, path_exists, stream_checkpoint

_STAT_FIELDS = ("batch_id",) + P.STAT_COLUMNS


def price_stream(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                 path: str | None = None, topic: str = PRICE_TOPIC,
                 bootstrap: str = "localhost:9092") -> DataFrame:
    """Price records ``symbol, timestamp, open, high, low, close, volume``
    from messages (Kafka, or files of ``key, value`` JSON-lines)."""
    if fmt == "kafka":
        opts = options or {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
                           "startingOffsets": "earliest", "failOnDataLoss": "false"}
        raw = spark.readStream.format("kafka").options(**opts).load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    else:
        raw = (spark.readStream.options(**(options or {})).schema("key string, value string")
               .format(fmt).load(path))
    return P.from_price_json(raw)


@dataclass
class PriceJob:
    stats_path: str
    state_path: str
    output_path: str
    output_format: str = "json"
    threshold: float = POSITION_THRESHOLD
    digits: int | None = None

    def _state(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Latest statistic per symbol as of ``batch_id`` (None if no state)."""
        if batch_id < 0:
            return None
        part = f"{self.state_path.rstrip('/')}/batch_id={batch_id}"
        if path_exists(spark, part):
            return spark.read.parquet(part)
        if not path_exists(spark, self.stats_path):
            return None
        # No state for that batch (e.g. the job was changed): rebuild it from
        # the statistics table, one row per symbol.
        st = spark.read.parquet(self.stats_path).filter(F.col("batch_id") <= F.lit(batch_id))
        return st.groupBy("symbol").agg(
            F.max_by(F.struct(*_STAT_FIELDS), "batch_id").alias("s")).select("symbol", "s.*")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = self._state(spark, batch_id - 1)
        stats_dir = f"{self.stats_path.rstrip('/')}/batch_id={batch_id}"
        stats = P.batch_stats(batch.withColumn("_b", F.lit(batch_id).cast("long")),
                              batch_col="_b", digits=self.digits).drop("batch_id")
        stats.write.mode("overwrite").parquet(stats_dir)
        current = spark.read.parquet(stats_dir).withColumn("batch_id", F.lit(batch_id).cast("long"))
        cur_state = current.select("symbol", *_STAT_FIELDS)
        if prev is not None:
            keep = prev.join(current.select("symbol"), "symbol", "left_anti")
            cur_state = cur_state.unionByName(keep.select("symbol", *_STAT_FIELDS))
        cur_state.write.mode("overwrite").parquet(
            f"{self.state_path.rstrip('/')}/batch_id={batch_id}")
        # Batch N only ever reads the state of N-1 (also when replayed), so
        # older state is dropped and the state folder stays two batches deep.
        delete_path(spark, f"{self.state_path.rstrip('/')}/batch_id={batch_id - 2}")
        if prev is None:
            return
        prev_stat = prev.select("symbol", P.aggregated_stat().alias("prevStat"))
        joined = (current.withColumn("stat", P.aggregated_stat())
                  .join(prev_stat, "symbol")  # first batch of a symbol: no row
                  .withColumn("deltaPercentage",
                              P.delta_percentage(F.col("stat"), F.col("prevStat"))))
        out = P.positions(joined, self.threshold).withColumn("line", P.output_line())
        (out.write.mode("overwrite").format(self.output_format)
         .save(f"{self.output_path.rstrip('/')}/batch_id={batch_id}"))


def start(source: DataFrame, job: PriceJob, checkpoint_location: str | None = None,
          trigger: dict | None = None, query_name: str = "termflow_prices") -> StreamingQuery:
    """Default trigger: a micro-batch every 5 seconds."""
    loc = stream_checkpoint(source.sparkSession, job.stats_path, checkpoint_location)
    w = (source.writeStream.queryName(query_name).foreachBatch(job.process)
         .option("checkpointLocation", loc))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
