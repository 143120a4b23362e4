"""Reading the parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``. Column pruning and filters reach the scan
    through Catalyst; select what you need right after this call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
