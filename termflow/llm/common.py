"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termflow.session import delete_path, ensure_checkpoint_dir
from termflow.sources.tables import read_table

#: Rows and bytes of one Arrow batch between the JVM and Python, so that a
#: batch of long texts stays small in a worker's memory.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


#: The folder of the package, which Python workers on this machine import it from.
#: On a cluster the package is installed or sent with --py-files.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session (a setting that the session
    carries already with another value than Spark's default is kept), and let
    its Python workers find this package."""
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    for key, value in ARROW_CONF.items():
        now = spark.conf.get(key, None)
        if now is None or now in ("10000", "-1", str(2**63 - 1), str(2**31 - 1)):
            spark.conf.set(key, value)


def source(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; batches to Python are bounded from here on."""
    prepare(spark)
    return read_table(spark, sf_dir, name).select(*columns)


def whole_text(column: Column | str) -> Column:
    """The text itself; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a frame as Parquet in the shared folder and read it back: cuts the
    lineage and survives the loss of executors. Returns the frame and its path."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, *paths: str) -> None:
    """Delete folders that :func:`written` made, once nothing reads them."""
    for path in paths:
        delete_path(spark, path)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name in taken:
        name += "_"
    return name
