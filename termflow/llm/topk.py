"""Exact top-k by integer inner product over a bit-sliced index.

A component x becomes floor(256 * x). A shard keeps, for each dimension, the bits
of its components above the dimension's smallest one as bitmaps over its rows.
For a query the weighted slices are added with bitmap arithmetic: a full adder
takes three bitmaps of one weight to one of that weight and one of the next. A
negative weight takes the complement of a slice, so all sums are of numbers from
0 up. The top rows are then selected from the most significant sum slice down;
rows that tie at the boundary are resolved by their ids, and scores are computed
from the integers themselves.

Defined results: rows whose vector is null or empty, or holds a null or a
non-finite component, take no part; a zero vector does; a query sees rows of its
own dimension only, and no row of its own id; repeated rows of one id and vector
are one row, and rows of one id with several vectors have the best of their
scores; ties go to the smaller vec_id; an empty table gives no rows. Components
of any size are exact; a score among a shard's best that does not fit a bigint
ends the query with an error.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from math import floor

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.llm.common import source
from termflow.llm.vectors import search, usable

SHARD_ROWS, BLOCK_ROWS, BATCH = 4096, 512, 64
K = 5


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of each component: 64-bit integers, or Python's where one is too large."""
    if np.abs(vectors).max(initial=0) < 2.0**53:
        return np.floor(256.0 * vectors).astype(np.int64)
    # From 2 ** 53 on every double is an integer.
    flat = [int(x) * 256 if abs(x) >= 2.0**53 else floor(256.0 * x) for x in vectors.ravel().tolist()]
    return np.array(flat, object).reshape(vectors.shape)


def scores(ints: np.ndarray, query: np.ndarray) -> list[int]:
    """The inner products of rows with a query, in Python's integers where a sum could overflow."""
    large = ints.dtype == object or query.dtype == object
    if large or np.abs(ints).max(0, initial=0).astype(float) @ np.abs(query).astype(float) >= 2.0**62:
        ints, query = ints.astype(object), query.astype(object)
    return [int(x) for x in ints @ query]


def packed(bits: np.ndarray) -> np.ndarray:
    """Bits along the last axis as 64-bit words, padded with zeros."""
    pad = -bits.shape[-1] % 64
    bits = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), bits.dtype)], -1)
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def build(ids: np.ndarray, vectors: np.ndarray) -> bytes:
    """A shard's index: ids, integers, and the slices of each dimension."""
    ints = quantised(vectors)
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] != ids[:-1]) | (ints[1:] != ints[:-1]).any(1)
    ids, ints = ids[keep], ints[keep]
    low = ints.min(0)
    above = (ints - low).T
    slices = [[packed((row >> b & 1).astype(np.uint8)) for b in range(int(row.max()).bit_length())] for row in above]
    return pickle.dumps((ids, ints, slices))


class Adder:
    """Bitmaps of one weight, reduced three to two; carries go to the next weight."""

    def __init__(self):
        self.now: list[np.ndarray] = []
        self.carries: list[np.ndarray] = []

    def add(self, bitmap: np.ndarray) -> None:
        self.now.append(bitmap)
        if len(self.now) == 3:
            a, b, c = self.now
            half = a ^ b
            self.carries.append(half & c | a & b)
            self.now = [half ^ c]

    def finish(self) -> np.ndarray | None:
        """The sum bitmap; a pair left over becomes a half adder's."""
        if len(self.now) == 2:
            a, b = self.now
            self.carries.append(a & b)
            self.now = [a ^ b]
        return self.now[0] if self.now else None


def sums(slices: list[list[np.ndarray]], queries: np.ndarray) -> list[np.ndarray | None]:
    """The bit-slices, least significant first, of each query's sums over all rows:
    the inner product less what is the same for all rows."""
    weight, negative = np.abs(queries), queries < 0
    flip = np.where(negative, np.uint64(2**64 - 1), np.uint64(0))
    heights = [int(weight[:, d].max(initial=0)).bit_length() for d in range(len(slices))]
    top = max([0, *(h + len(s) - 1 for h, s in zip(heights, slices) if h and s)])
    out, carries, w = [], [], 0
    while w < top or carries:
        adder = Adder()
        for c in carries:
            adder.add(c)
        for d, (planes, height) in enumerate(zip(slices, heights)):
            for j in range(max(0, w - len(planes) + 1), min(height, w + 1)):
                has = (weight[:, d] >> j & 1).astype(bool)
                if has.any():
                    mask = np.where(has, np.uint64(2**64 - 1), np.uint64(0))
                    adder.add((planes[w - j][None, :] ^ flip[:, d, None]) & mask[:, None])
        out.append(adder.finish())
        carries, w = adder.carries, w + 1
    return out


def select(planes: list[np.ndarray | None], candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the rows that are certainly among its k highest, and those
    that tie for the places left."""
    sure, tied = np.zeros_like(candidates), candidates.copy()
    for plane in reversed(planes):
        if plane is None:
            continue
        with_one = tied & plane
        n = np.bitwise_count(sure | with_one).sum(1, dtype=np.int64)[:, None]
        sure = np.where(n <= k, sure | with_one, sure)
        tied = np.where(n <= k, tied & ~plane, with_one)
    return sure, tied


def find(data: bytes, query_ids: np.ndarray, vectors: np.ndarray, k: int = K) -> Iterator[tuple]:
    ids, ints, slices = pickle.loads(data)
    queries = quantised(vectors)
    rows_all = packed(np.ones((1, len(ids)), np.uint8))
    # Rows of one id are told apart afterwards, so as many more can be needed.
    spare = int(np.unique(ids, return_counts=True)[1].max()) - 1
    for at in range(0, len(queries), BATCH):
        q, qid = queries[at:at + BATCH], query_ids[at:at + BATCH]
        own = packed((ids[None, :] == qid[:, None]).astype(np.uint8))
        sure, tied = select(sums(slices, q), rows_all & ~own, k * (1 + spare))
        who, vec, score = [], [], []
        for i in range(len(q)):
            rows = np.flatnonzero(np.unpackbits(sure[i].view(np.uint8), bitorder="little"))
            ties = np.flatnonzero(np.unpackbits(tied[i].view(np.uint8), bitorder="little"))
            # Rows stand in order of their ids, so the first ties are those of the smallest.
            rows = np.concatenate([rows, ties[:k * (1 + spare) - len(rows)]])
            best: dict[int, int] = {}
            for r, s in zip(ids[rows].tolist(), scores(ints[rows], q[i])):
                best[r] = max(s, best.get(r, s))
            for r, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]:
                if not -2**63 <= s < 2**63:
                    raise OverflowError(f"the score of rows {qid[i]} and {r} does not fit a bigint")
                who.append(qid[i])
                vec.append(r)
                score.append(s)
        yield np.array(who, np.int64), np.array(vec, np.int64), np.array(score, np.int64)


def exact_top_k(table: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", k: int = K,
                shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` rows of highest integer inner product with each query row."""
    def finder(data, query_ids, vectors):
        return find(data, query_ids, vectors, k)
    asked = usable(queries, vec_id, vec, zero=True).distinct()
    best = search(usable(table, vec_id, vec, zero=True), asked, build, finder, "bigint", k, shard_rows, BLOCK_ROWS)
    return best


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest scores of every fiftieth vector, among all others."""
    table = source(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return exact_top_k(table, table.where(F.col("vec_id") % 50 == 0))


#: The same rows by comparing all queries with all rows.
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
