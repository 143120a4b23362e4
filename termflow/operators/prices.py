"""Price pipeline: records → per-batch statistics → delta → position.

    price records (symbol, timestamp, open, high, low, close, volume)
      -> batch statistics   groupBy(symbol, batch): means, last timestamp, last close
      -> aggregated stat    meanVolume * (meanHigh + meanLow + meanOpen + meanClose) / 4
      -> delta percentage   (stat - previous stat) / (100 * meanVolume)
      -> position           sell / buy / hold against a threshold

Over a table, a batch is a tumbling window of ``batch_days`` calendar days
(aligned to 1970-01-01, like ``window()``). In the stream
(:mod:`termflow.streaming.prices`) a batch is a micro-batch.

The ``events`` table stands in for prices: each event type is a symbol and
each day of events one daily bar (first and last value by time, highest,
lowest, number of events as volume).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from termflow.functions.constants import (POSITION_BUY, POSITION_HOLD, POSITION_SELL,
                                          POSITION_THRESHOLD)

# CSV export: Date,Open,High,Low,Close,Volume,Adj Close (newest first).
CSV_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
    T.StructField("Adj Close", T.DoubleType()),
])

# The price record on the wire (JSON), keyed by symbol.
RECORD_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

STAT_COLUMNS = ("lastTimestamp", "meanHigh", "meanLow", "meanOpen", "meanClose",
                "meanVolume", "lastClose")


def read_price_csv(spark, path: str, symbol: str) -> DataFrame:
    """A CSV export as price records ``symbol, timestamp, open, high, low,
    close, volume`` (``Adj Close`` dropped), oldest first."""
    df = spark.read.csv(path, header=True, schema=CSV_SCHEMA)
    return oldest_first(csv_records(df.withColumn("symbol", F.lit(symbol))))


def csv_records(rows: DataFrame) -> DataFrame:
    """Rows of the export's columns and a symbol as price records."""
    return rows.select("symbol", F.col("Date").alias("timestamp"),
                       F.col("Open").alias("open"), F.col("High").alias("high"),
                       F.col("Low").alias("low"), F.col("Close").alias("close"),
                       F.col("Volume").alias("volume"))


def oldest_first(records: DataFrame) -> DataFrame:
    """The export is newest first; replay needs time order."""
    return records.orderBy(F.to_timestamp("timestamp"), "symbol")


def _micros(ts_col: str, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01 as DECIMAL(38,0), free of the session
    time zone: TIMESTAMP_NTZ from its date and clock fields, TIMESTAMP
    (an instant) from ``unix_micros``."""
    dec = "DECIMAL(38,0)"
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(
            f"CAST(unix_date(CAST(`{ts_col}` AS DATE)) AS {dec}) * 86400000000"
            f" + CAST(hour(`{ts_col}`) * 3600 + minute(`{ts_col}`) * 60 AS {dec}) * 1000000"
            f" + CAST(date_part('SECOND', `{ts_col}`) * 1000000 AS {dec})")
    return F.expr(f"CAST(unix_micros(`{ts_col}`) AS {dec})")


def time_order_key(events: DataFrame, ts_col: str, id_col: str) -> Column:
    """One DECIMAL(38,0) that orders like ``(ts, id)``: micros * 2^64 +
    (id + 2^63). A single numeric key keeps ``min_by``/``max_by`` in a hash
    aggregate (a struct key forces a sort-based aggregate, a sort of every
    event in the partial stage)."""
    dec = "DECIMAL(38,0)"
    micros = _micros(ts_col, events.schema[ts_col].dataType)
    shifted_id = F.expr(f"CAST(`{id_col}` AS {dec}) + CAST('9223372036854775808' AS {dec})")
    return micros * F.expr(f"CAST('18446744073709551616' AS {dec})") + shifted_id


def daily_bars(events: DataFrame, symbol_col: str = "event_type", ts_col: str = "ts",
               value_col: str = "value", id_col: str = "event_id") -> DataFrame:
    """One price record per symbol and day from raw events. Open and close
    are the first and last value by ``(ts, id)``. A hash aggregate with
    partial aggregation, so a hot symbol is folded map-side."""
    order = time_order_key(events, ts_col, id_col)
    day = F.to_date(ts_col)
    return (events.groupBy(F.col(symbol_col).alias("symbol"), day.alias("_day"))
            .agg(F.min_by(value_col, order).alias("open"), F.max(value_col).alias("high"),
                 F.min(value_col).alias("low"), F.max_by(value_col, order).alias("close"),
                 F.count(F.lit(1)).alias("volume"))
            .select("symbol", F.date_format("_day", "yyyy-MM-dd").alias("timestamp"),
                    "open", "high", "low", "close", "volume"))


def to_price_json(records: DataFrame) -> DataFrame:
    """``key`` (symbol), ``value`` (JSON record) for a message sink."""
    return records.select(F.col("symbol").alias("key"),
                          F.to_json(F.struct(*[f.name for f in RECORD_SCHEMA])).alias("value"))


def from_price_json(messages: DataFrame) -> DataFrame:
    """Inverse of :func:`to_price_json`."""
    return messages.select(F.col("key").alias("symbol"),
                           F.from_json("value", RECORD_SCHEMA).alias("r")).select("symbol", "r.*")


def batch_of_days(timestamp: str | Column, batch_days: int) -> Column:
    ts = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.floor(F.unix_date(F.to_date(ts)) / F.lit(batch_days)).cast("long")


def _mean(c: str, digits: int | None) -> Column:
    m = F.avg(c)
    return F.round(m, digits) if digits is not None else m


def batch_stats(records: DataFrame, batch_col: str | None = None, batch_days: int = 5,
                digits: int | None = None) -> DataFrame:
    """Statistics per ``(symbol, batch)``: ``symbol, batch_id, lastTimestamp,
    meanHigh, meanLow, meanOpen, meanClose, meanVolume, lastClose``.

    ``batch_col`` names an existing batch id (a stream's micro-batch);
    otherwise batches are tumbling windows of ``batch_days`` days.
    ``digits`` rounds the means (for display or exact comparison).
    """
    batch = F.col(batch_col) if batch_col else batch_of_days("timestamp", batch_days)
    # The last record by its full time; of several of one time the one with the
    # highest close.
    last = F.max(F.struct(F.to_timestamp("timestamp").alias("t"), F.col("close"),
                          F.col("timestamp").alias("given")))
    return (records.groupBy("symbol", batch.alias("batch_id"))
            .agg(last.alias("_last"),
                 _mean("high", digits).alias("meanHigh"), _mean("low", digits).alias("meanLow"),
                 _mean("open", digits).alias("meanOpen"), _mean("close", digits).alias("meanClose"),
                 _mean("volume", digits).alias("meanVolume"))
            .select("symbol", "batch_id",
                    F.col("_last.given").alias("lastTimestamp"), "meanHigh", "meanLow", "meanOpen",
                    "meanClose", "meanVolume", F.col("_last.close").alias("lastClose")))


def aggregated_stat() -> Column:
    return (F.col("meanVolume") * (F.col("meanHigh") + F.col("meanLow") + F.col("meanOpen")
                                   + F.col("meanClose")) / F.lit(4.0))


def delta_percentage(current: Column, previous: Column) -> Column:
    """``(current - previous) / (100 * meanVolume)`` with the current batch's
    mean volume."""
    return (current - previous) / (F.lit(100) * F.col("meanVolume"))


def deltas(stats: DataFrame) -> DataFrame:
    """Adds ``stat`` and ``deltaPercentage`` against the symbol's previous
    batch; a symbol's first batch has no previous statistic and no row.

    The window is over the statistics (one row per symbol and batch), not
    over records, so even a symbol with most of the records has few rows.
    """
    w = Window.partitionBy("symbol").orderBy("batch_id")
    with_stat = stats.withColumn("stat", aggregated_stat())
    return (with_stat.withColumn("prevStat", F.lag("stat").over(w))
            .filter(F.col("prevStat").isNotNull())
            .withColumn("deltaPercentage", delta_percentage(F.col("stat"), F.col("prevStat")))
            .drop("prevStat"))


def position(delta: str | Column = "deltaPercentage",
             threshold: float = POSITION_THRESHOLD) -> Column:
    """sell when the delta is above the threshold, buy when it is negative
    and its size is above the threshold, else hold."""
    d = F.col(delta) if isinstance(delta, str) else delta
    return (F.when(d > F.lit(threshold), F.lit(POSITION_SELL))
            .when((d < F.lit(0)) & (F.abs(d) > F.lit(threshold)), F.lit(POSITION_BUY))
            .otherwise(F.lit(POSITION_HOLD)))


def positions(with_delta: DataFrame, threshold: float = POSITION_THRESHOLD) -> DataFrame:
    """The output line fields: ``lastTimestamp, stockSymbol, lastClose,
    deltaPercentage, position``."""
    return with_delta.select("lastTimestamp", F.col("symbol").alias("stockSymbol"),
                             "lastClose", "deltaPercentage",
                             position("deltaPercentage", threshold).alias("position"))


def output_line() -> Column:
    """``lastTimestamp,stockSymbol,lastClose,deltaPercentage,position`` as
    one CSV text line (numbers as Java prints doubles)."""
    return F.concat_ws(",", "lastTimestamp", "stockSymbol", F.col("lastClose").cast("string"),
                       F.col("deltaPercentage").cast("string"), "position")
