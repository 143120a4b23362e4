"""Checkpoint folder policy: session setting first; a temporary folder only
in local mode; never on a cluster."""

import os

import pytest

from termflow.session import ensure_checkpoint_dir, spread, stream_checkpoint


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, values):
        self.master = master
        self._conf = _Conf(values)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, values=None):
        self.sparkContext = _Context(master, values or {})
        self.conf = _Conf(values or {})


def test_cluster_without_setting_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("spark://cluster:7077"))


def test_cluster_setting_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"


def test_local_without_setting_gets_a_temporary_folder():
    d = ensure_checkpoint_dir(_Session("local[2]"))
    assert d and "termflow-ckpt-" in d


def test_stream_checkpoint_lies_beside_the_data(spark, tmp_dir):
    data = f"{tmp_dir}/corpus"
    assert stream_checkpoint(spark, data) == f"{data}_checkpoint"
    os.makedirs(data)
    with pytest.raises(RuntimeError, match="checkpoint"):  # data without its checkpoint
        stream_checkpoint(spark, data)
    os.makedirs(f"{data}_checkpoint/offsets")
    assert stream_checkpoint(spark, data) == f"{data}_checkpoint"
    with pytest.raises(RuntimeError):
        stream_checkpoint(spark, data, f"{tmp_dir}/another")


def test_spread_leaves_a_large_scan_alone(spark, tmp_dir):
    """Whatever the number of cores: an input of the given size is not dealt out."""
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_dir}/t")
    scan = spark.read.parquet(f"{tmp_dir}/t")
    assert spread(scan, min_partitions=1000, small=1).rdd.getNumPartitions() == scan.rdd.getNumPartitions()
    plan = spread(scan, min_partitions=1000, small=1)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan
    assert spread(scan, min_partitions=7).rdd.getNumPartitions() == 7
