"""Vocabulary: frequency order, dropping the rarest terms, dense indices.

The vocabulary is the list of distinct terms ordered by corpus count
(descending; ties by term ascending), without the 20 least frequent ones,
numbered 0..N-21 in that order.

Numbering without a single-partition window
-------------------------------------------
A global ``row_number()`` with no ``PARTITION BY`` moves every term into one
task. Instead :func:`ordered_index` range-partitions the rows on the sort key
(one shuffle, partitions sized by sampling), sorts within partitions, and
tags each row with its partition id and its position inside the partition.
That frame is checkpointed (reliable), so its order is fixed even if an
executor is lost later. The per-partition row counts (one row per partition,
bounded by the partition count) give each partition's offset; a broadcast
join of that tiny table turns local positions into global indices.

The total count N falls out of the same partition sizes, so the size guard
needs no extra job, and the tail terms are just the indices >= N - 20.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from termflow.functions.constants import TAIL_DROP
from termflow.session import checkpoint


def vocab_order() -> tuple[Column, Column]:
    """Vocabulary order: most frequent first, ties by term ascending."""
    return (F.desc("cnt"), F.asc("term"))


_LOW_33_BITS = (1 << 33) - 1


class CorpusTooSmall(Exception):
    """Fewer than 2 x drop + 1 distinct terms: no usable vocabulary."""


class Indexed:
    """A frame numbered 0..total-1 in a given order."""

    def __init__(self, df: DataFrame, total: int):
        self.df = df
        self.total = total


def ordered_index(df: DataFrame, order: tuple[Column, ...] | list[Column], name: str = "idx",
                  num_partitions: int | None = None) -> Indexed:
    """Number the rows of ``df`` 0..n-1 following ``order`` (which must be a
    total order for a deterministic result)."""
    spark = df.sparkSession
    # Without an explicit count AQE sizes the range partitions from the data
    # (coalescing neighbours keeps the ranges contiguous, so order holds).
    rp = df.repartitionByRange(num_partitions, *order) if num_partitions else \
        df.repartitionByRange(*order)
    ranged = (rp.sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_33_BITS))))
    ranged = checkpoint(ranged)
    sizes = sorted((r["_pid"], r["_n"]) for r in
                   ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, total = [], 0
    for pid, cnt in sizes:  # one entry per partition: bounded by the partition count
        offsets.append((pid, total))
        total += cnt
    if not offsets:
        return Indexed(ranged.select(*df.columns, F.lit(None).cast("long").alias(name)).limit(0), 0)
    off = spark.createDataFrame(offsets, "_pid int, _off long")
    out = (ranged.join(F.broadcast(off), "_pid")
           .select(*df.columns, (F.col("_off") + F.col("_pos")).alias(name)))
    return Indexed(out, total)


def rank_terms(counts: DataFrame) -> Indexed:
    """All terms numbered in vocabulary order: ``term, cnt, rank``."""
    return ordered_index(counts.select("term", "cnt"), vocab_order(), "rank")


def check_size(total: int, drop: int = TAIL_DROP) -> None:
    if total - drop <= drop:
        raise CorpusTooSmall(f"Doc too small: {total}")


def vocabulary_from_ranked(ranked: Indexed, drop: int = TAIL_DROP, end: str = "tail",
                           check: bool = True) -> DataFrame:
    """``term, cnt, term_idx`` from ranked terms.

    ``end='tail'`` removes the ``drop`` least frequent terms (what the
    original jobs did, although the constant was named for stop words);
    ``end='head'`` removes the ``drop`` most frequent ones instead.
    """
    if check:
        check_size(ranked.total, drop)
    r = ranked.df
    if end == "tail":
        kept = r.filter(F.col("rank") < F.lit(ranked.total - drop))
        idx = F.col("rank")
    elif end == "head":
        kept = r.filter(F.col("rank") >= F.lit(drop))
        idx = F.col("rank") - F.lit(drop)
    else:
        raise ValueError(f"end must be 'tail' or 'head', not {end!r}")
    return kept.select("term", "cnt", idx.alias("term_idx"))


def dropped_terms(ranked: Indexed, drop: int = TAIL_DROP, end: str = "tail") -> DataFrame:
    """The terms :func:`vocabulary_from_ranked` removes: ``term, cnt``."""
    r = ranked.df
    cond = (F.col("rank") >= F.lit(ranked.total - drop)) if end == "tail" else (
        F.col("rank") < F.lit(drop))
    return r.filter(cond).select("term", "cnt")


def vocabulary(counts: DataFrame, drop: int = TAIL_DROP, end: str = "tail",
               check: bool = True) -> DataFrame:
    """Term counts → numbered vocabulary ``term, cnt, term_idx``."""
    return vocabulary_from_ranked(rank_terms(counts), drop, end, check)


def tail_terms(counts: DataFrame, n: int = TAIL_DROP) -> DataFrame:
    """The ``n`` rarest terms by a top-k (TakeOrderedAndProject: each task
    keeps its own n, the driver merges n x tasks rows)."""
    return counts.orderBy(F.asc("cnt"), F.desc("term")).limit(n)


def vocab_size(counts: DataFrame, drop: int = TAIL_DROP) -> DataFrame:
    """``vocab_size`` = distinct terms minus ``drop`` (one row)."""
    return counts.agg((F.count(F.lit(1)) - F.lit(drop)).alias("vocab_size"))


def index_documents(docs: DataFrame, order: tuple[Column, ...] | list[Column],
                    name: str = "doc_idx") -> DataFrame:
    """Number documents that have no key 0..n-1 in a total ``order`` of
    their columns (e.g. ``batch_id, doc_name``), with the same distributed
    method as the vocabulary; use an existing key column instead when there
    is one."""
    idx = ordered_index(docs, order, name)
    return idx.df.withColumn(name, F.col(name).cast("long"))
