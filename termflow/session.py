"""Session helpers: building a session for local runs, the checkpoint folder,
and scan parallelism.

Library code never creates its own session; callers pass one in. Only tests,
``bench.py`` and command-line use go through :func:`local_session`.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours should carry. AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splits a hot key's
# partition on the big side of a sort-merge join.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable RDD checkpoints once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # task results (e.g. LDA's per-task topic statistics) and shuffled rows
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "termflow", extra: dict | None = None) -> SparkSession:
    """A ``local[cores]`` session for tests and benchmarks."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
               .config("spark.default.parallelism", str(n))
               .config("spark.driver.memory", "8g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a folder and return it.

    The folder comes from the session (``spark.checkpoint.dir``, normally a
    shared file system path set by the cluster). Only a local-mode session
    with no setting gets a fresh temporary folder: there the whole "cluster"
    is this machine. A cluster session without the setting is an error, since
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="termflow-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss")
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint: cuts lineage and pins a nondeterministic
    ordering (range bounds, ids) so later passes all see the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder under the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Spark's setting to delete an execution's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a frame as Parquet under the checkpoint folder and read it back;
    the frame and its folder, which the caller deletes when nothing reads it. The
    shuffle files of the write go with its end, not when the driver collects garbage."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


#: Inputs from this size on arrive in enough file splits of their own.
SMALL_INPUT = 1 << 30


def spread(df: DataFrame, min_partitions: int | None = None, small: int = SMALL_INPUT) -> DataFrame:
    """Give the scan of a small input at least ``default parallelism`` partitions.

    A small table stored as one parquet row group arrives as one partition, and
    the heavy per-row work after it (tokenising) would run on one core; such a
    frame is dealt out round-robin. An input of ``small`` bytes or more, by the
    scan's own size, is returned as it is, whatever the number of cores.

    Call it on a scan: asking a frame with exchanges for its partitions
    would run those stages early.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) >= small:
        return df
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine find this package. On a cluster the package
    is installed or sent with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop file system of a path: local, HDFS and object-store paths alike."""
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(hadoop_fs(spark, path).exists(hadoop_path(spark, path)))


def stream_checkpoint(spark: SparkSession, data_path: str, location: str | None = None) -> str:
    """Checkpoint folder of a stream: ``location``, or the one beside the data
    that the stream writes, so that both are kept, moved and deleted together.

    The data of a stream is keyed by batch number, and the numbers come from the
    checkpoint. Without it they would start again from 0 over the old data, so a
    start on data whose checkpoint is gone is refused.
    """
    location = location or f"{data_path.rstrip('/')}_checkpoint"
    if path_exists(spark, data_path) and not path_exists(spark, f"{location.rstrip('/')}/offsets"):
        raise RuntimeError(f"{data_path} has data of a stream whose checkpoint is not in {location}; "
                           "name that checkpoint, or a new data path")
    return location


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder (recursively)."""
    fs, p = hadoop_fs(spark, path), hadoop_path(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               min_partitions: int = 200, max_partitions: int = 200_000) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of (compressed) input.

    Scan splits and shuffle partitions are sized so one task's data stays
    around ``target_partition_bytes``. Text expands when decompressed and
    tokenised, so the shuffle gets roughly twice the scan's partition count
    as its starting point, and AQE coalesces from there. Skew-join and
    checkpoint clean-up are on.
    """
    scan = max(1, input_bytes // target_partition_bytes)
    shuffle = int(min(max(2 * scan, min_partitions), max_partitions))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }
