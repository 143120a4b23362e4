"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from termflow.session import checkpoint

#: Edges of one task that writes them.
EDGES = 20_000


def star_roots(edges: DataFrame) -> DataFrame:
    """The smallest node of the component of every node that has an edge, but for
    those smallest nodes themselves: rows of ``node`` and ``root``.

    ``edges`` has two columns of node numbers. In turns, larger neighbours of a
    node are hung on its smallest neighbour, then smaller ones, until every edge
    ends at its component's smallest node. The number of turns grows with the
    logarithm of the longest path; each is joins and grouped minima.
    """
    a, b = edges.columns
    now = checkpoint(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct())
    print_of, parts = None, None
    while True:
        both = now.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(
            now.select(F.col("root").alias("u"), F.col("node").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("node"), F.col("m").alias("root")),
            F.struct(F.col("v").alias("node"), F.col("m").alias("root")))).alias("e")).select("e.*")
        small = small.where("node <> root").distinct()
        now = checkpoint(small if parts is None else small.coalesce(parts))  # few files where few edges are left
        was, print_of = print_of, now.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        parts = 1 + print_of[0] // EDGES
        if was == print_of:
            return now
