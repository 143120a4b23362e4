"""Vector tables dealt into shards, and query blocks brought to every shard.

A shard is a bounded number of vectors that one task indexes. Queries travel in
blocks to each shard of their dimension, a sort-merge join of blocks with shards that
holds one shard's index at a time; only shard results, a few rows for each query, meet again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

HITS = "query_id bigint, vec_id bigint, score"


def usable(table: DataFrame, vec_id: str, vec: str, zero: bool) -> DataFrame:
    """Rows of ``vec_id`` and ``vec`` (doubles) that can take part: neither is
    null, all components are finite numbers, and some is not 0 unless ``zero``."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vec") > 0) & F.forall(
        "vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
    return rows if zero else rows.where(F.exists("vec", lambda x: x != 0))


def matrix(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a group in ascending order, and its vectors as rows."""
    ids = group["vec_id"].to_numpy()
    flat = group["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(len(ids), -1)
    order = np.lexsort((*vectors.T[::-1], ids))
    return ids[order], np.ascontiguousarray(vectors[order])


def search(table: DataFrame, queries: DataFrame, index: Callable[[np.ndarray, np.ndarray], bytes],
           find: Callable[[bytes, np.ndarray, np.ndarray], Iterator[tuple]], score: str, k: int,
           shard_rows: int, block_rows: int) -> DataFrame:
    """The ``k`` best hits of each query: query_id, rank from 1, vec_id, score; ties
    to the smaller vec_id. ``index`` makes a shard's index of ids and vectors;
    ``find`` gives arrays of query_id, vec_id and score for a block of queries, at
    least a shard's k best for each. Rows of one id are one candidate, or one query,
    with the best of their scores."""
    shards = max(1, -(-table.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    dimension = F.size("vec").alias("dim")

    def indexed(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                         "index": pa.array([index(*matrix(group))], pa.binary())})

    def block(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        ids, vectors = matrix(group)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "ids": [ids.astype("<i8").tobytes()],
                         "vectors": [vectors.astype("<f8").tobytes()]})

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, data, ids, vectors in zip(*[b.column(c).to_pylist() for c in ("dim", "index", "ids", "vectors")]):
                for found in find(data, np.frombuffer(ids, "<i8"), np.frombuffer(vectors, "<f8").reshape(-1, dim)):
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), ["query_id", "vec_id", "score"])

    def dealt(rows: DataFrame, n: int, name: str) -> DataFrame:
        return rows.select("vec_id", "vec", dimension, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(name))

    made = (dealt(table, shards, "shard").repartition(shards, "dim", "shard").groupBy("dim", "shard")
            .applyInArrow(indexed, "dim int, shard int, index binary"))
    asked = dealt(queries, blocks, "block").groupBy("dim", "block").applyInArrow(block, "dim int, ids binary, vectors binary")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # Never broadcast: Spark knows the blocks' size before they are copied to every shard.
    found = (asked.hint("merge").join(made, ["dim", "shard"]).select("dim", "index", "ids", "vectors")
             .mapInArrow(hits, f"{HITS} {score}"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
