"""Registered price queries over ``events`` (event type = symbol, one bar
per day, batches of 5 days). The chain runs at full precision; only output
columns are rounded, so that they compare exactly across engines."""

from __future__ import annotations


from pyspark.sql import functions as F

from termflow.operators import prices as P
from termflow.session import spread
from termflow.sources.tables import read_table

DIGITS = 6
BATCH_DAYS = 5


def _bars(spark, sf_dir):
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"))
    return P.daily_bars(ev)


def _stats(spark, sf_dir):
    return P.batch_stats(_bars(spark, sf_dir), batch_days=BATCH_DAYS)


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, DIGITS) for c in cols})


def q_price_csv(spark, sf_dir):
    """CSV export lines (newest first, with a header and an adjusted close)
    made of the bars, parsed again, oldest first."""
    day = F.col("timestamp")
    lines = _bars(spark, sf_dir).select(
        "symbol", day, F.concat_ws(",", day, *[F.col(c).cast("string") for c in (
            "open", "high", "low", "close", "volume", "close")]).alias("value"))
    parsed = lines.select("symbol", F.from_csv("value", P.CSV_SCHEMA.simpleString()[7:-1]
                                               .replace("Adj Close", "`Adj Close`").replace(":", " ")).alias("r"))
    return P.oldest_first(P.csv_records(parsed.select("symbol", "r.*")))


def q_price_bars(spark, sf_dir):
    return _bars(spark, sf_dir)


def q_price_json_roundtrip(spark, sf_dir):
    return P.from_price_json(P.to_price_json(_bars(spark, sf_dir)))


def q_price_stats(spark, sf_dir):
    return _rounded(_stats(spark, sf_dir), "meanHigh", "meanLow", "meanOpen", "meanClose", "meanVolume")


def q_price_delta(spark, sf_dir):
    return _rounded(P.deltas(_stats(spark, sf_dir)).select(
        "symbol", "batch_id", "stat", "deltaPercentage"), "stat", "deltaPercentage")


def q_price_position(spark, sf_dir):
    return _rounded(P.positions(P.deltas(_stats(spark, sf_dir))), "deltaPercentage")


QUERIES = {
    "price_bars": q_price_bars,
    "price_json_roundtrip": q_price_json_roundtrip,
    "price_csv": q_price_csv,
    "price_stats": q_price_stats,
    "price_delta": q_price_delta,
    "price_position": q_price_position,
}

_BARS = """
    SELECT event_type AS symbol, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS timestamp,
           arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
           arg_max(value, (ts, event_id)) AS close, count(*) AS volume
    FROM events GROUP BY event_type, CAST(ts AS DATE)"""

_STATS = f"""
    SELECT symbol,
           CAST(floor((CAST(timestamp AS DATE) - DATE '1970-01-01') / {BATCH_DAYS}) AS BIGINT)
               AS batch_id,
           max(timestamp) AS lastTimestamp,
           avg(high) AS meanHigh, avg(low) AS meanLow, avg(open) AS meanOpen,
           avg(close) AS meanClose, avg(volume) AS meanVolume, arg_max(close, timestamp) AS lastClose
    FROM ({_BARS}) b GROUP BY 1, 2"""

_DELTA = f"""
    SELECT *, (stat - prevStat) / (100 * meanVolume) AS deltaPercentage FROM (
        SELECT *, lag(stat) OVER (PARTITION BY symbol ORDER BY batch_id) AS prevStat FROM (
            SELECT *, meanVolume * (meanHigh + meanLow + meanOpen + meanClose) / 4.0 AS stat
            FROM ({_STATS}) s) a) b
    WHERE prevStat IS NOT NULL"""

ORACLE = {
    "price_bars": _BARS,
    "price_json_roundtrip": _BARS,
    "price_csv": _BARS,
    "price_stats": f"""
        SELECT symbol, batch_id, lastTimestamp, round(meanHigh, {DIGITS}) AS meanHigh,
               round(meanLow, {DIGITS}) AS meanLow, round(meanOpen, {DIGITS}) AS meanOpen,
               round(meanClose, {DIGITS}) AS meanClose, round(meanVolume, {DIGITS}) AS meanVolume,
               lastClose FROM ({_STATS}) s""",
    "price_delta": f"""
        SELECT symbol, batch_id, round(stat, {DIGITS}) AS stat,
               round(deltaPercentage, {DIGITS}) AS deltaPercentage FROM ({_DELTA}) d""",
    "price_position": f"""
        SELECT lastTimestamp, symbol AS stockSymbol, lastClose,
               round(deltaPercentage, {DIGITS}) AS deltaPercentage,
               CASE WHEN deltaPercentage > 0.01 THEN 'sell'
                    WHEN deltaPercentage < 0 AND abs(deltaPercentage) > 0.01 THEN 'buy'
                    ELSE 'hold' END AS position
        FROM ({_DELTA}) d""",
}
