"""Packing documents into sequences: best fit, then a swap-based local search.

Documents longer than a sequence are cut; a full piece is a sequence of its own.
The other pieces are dealt at random into shards of a bounded number of pieces.
A shard is packed best fit first, and a local search between underfull bins then
moves a document, exchanges one for one or two for one, always so that the sum
of squared fills grows, until bins run empty or no exchange helps. The bins that
stay least filled, with up to 1/8 of the pieces, are dealt into fewer shards and
packed again, until one shard holds all that is left. Work and memory of a task are those of one shard.

Defined results: a null or empty text is one piece that holds the end id alone;
every row is packed, repeated rows and rows with equal or null ids each for
themselves; ties go to the earlier bin and the longer fit; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termflow.llm.common import free_name, source, whole_text
from termflow.llm.library import ids_with_end
from termflow.session import checkpoint

#: Pieces of one shard, at the most expected; the packing of a shard is one task.
SHARD = 4096


def piece_list(text: Column, path: str, capacity: int, end: int) -> Column:
    """Each text's pieces: number, start, length and CRC-32 of the ids."""

    @F.arrow_udf("array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>")
    def cut_pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            flat, ends = ids_with_end(texts, path, end)
            size = np.diff(ends)
            count = -(-size // capacity)
            first = np.concatenate([[0], np.cumsum(count)])
            number = np.arange(first[-1]) - np.repeat(first[:-1], count)
            begin = np.repeat(ends[:-1], count) + number * capacity
            length = np.minimum(capacity, np.repeat(ends[1:], count) - begin)
            crc = [zlib.crc32(flat[a:a + n]) for a, n in zip(begin.tolist(), length.tolist())]
            rows = pa.StructArray.from_arrays(
                [pa.array(number, pa.int32()), pa.array(number * capacity, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["piece", "start", "length", "ids_crc32"])
            yield pa.ListArray.from_arrays(pa.array(first, pa.int32()), rows)

    return cut_pieces(whole_text(text))


def best_fit(length: np.ndarray, capacity: int) -> np.ndarray:
    """Each piece's bin: longest pieces first, each into the fullest bin that takes it."""
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, made = 0, 0  # bit r of free: some bin has r places left
    where = np.empty(len(length), np.int64)
    for i in np.argsort(-length, kind="stable").tolist():
        n = int(length[i])
        fits = free >> n
        if fits:
            r = (fits & -fits).bit_length() - 1 + n
            b = bins[r].pop()
            if not bins[r]:
                free &= ~(1 << r)
        else:
            r, b, made = capacity, made, made + 1
        where[i] = b
        bins[r - n].append(b)
        free |= 1 << r - n
    return where


class LocalSearch:
    """Exchanges between the bins of a shard; a bin gives to a fuller one, or to
    one that becomes fuller by it, so the sum of squared fills grows each time."""

    def __init__(self, length: np.ndarray, where: np.ndarray, capacity: int):
        self.length, self.where, self.capacity = length, where.copy(), capacity
        self.fill = np.bincount(where, length, where.max() + 1).astype(np.int64) if len(where) else np.empty(0, np.int64)

    def run(self) -> np.ndarray:
        least = -(-int(self.length.sum()) // self.capacity)
        moved = True
        while moved and (self.fill > 0).sum() > least:
            moved = False
            for donor in np.argsort(self.fill, kind="stable").tolist():
                if not 0 < self.fill[donor] < self.capacity:
                    continue
                while self.fill[donor] and self.exchange(donor):
                    moved = True
                if (self.fill > 0).sum() <= least:
                    break
        return self.where

    def exchange(self, donor: int) -> bool:
        """The best exchange that takes from the donor; cheaper kinds first."""
        own = np.flatnonzero(self.where == donor)
        others = np.flatnonzero((self.where != donor) & (self.fill[self.where] < self.capacity))
        bins = np.unique(self.where[others])
        for kind in (self.move, self.one_for_one, self.two_for_one, self.one_for_two):
            found = kind(donor, own, others, bins)
            if found:
                give, take, target = found
                d = int(self.length[give].sum() - self.length[take].sum())
                self.where[give], self.where[take] = target, donor
                self.fill[target] += d
                self.fill[donor] -= d
                return True
        return False

    def gain(self, donor: int, target: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Growth of the sum of squares when ``d`` goes to ``target``; 0 where it can't."""
        fits = (d > 0) & (self.fill[target] + d <= self.capacity)
        return np.where(fits, 2 * d * (self.fill[target] - self.fill[donor] + d), 0)

    def move(self, donor, own, others, bins):
        g = self.gain(donor, bins[None, :], self.length[own][:, None])
        if g.size and g.max() > 0:
            i, j = np.unravel_index(g.argmax(), g.shape)
            return [own[i]], [], bins[j]

    def one_for_one(self, donor, own, others, bins):
        g = self.gain(donor, self.where[others][None, :], self.length[own][:, None] - self.length[others][None, :])
        if g.size and g.max() > 0:
            i, j = np.unravel_index(g.argmax(), g.shape)
            return [own[i]], [others[j]], self.where[others[j]]

    def two_for_one(self, donor, own, others, bins):
        best, found = 0, None
        for i, j in combinations(own.tolist(), 2):
            g = self.gain(donor, self.where[others], self.length[i] + self.length[j] - self.length[others])
            if g.size and g.max() > best:
                best, found = g.max(), ([i, j], [others[g.argmax()]], self.where[others[g.argmax()]])
        return found

    def one_for_two(self, donor, own, others, bins):
        best, found = 0, None
        order = others[np.argsort(self.where[others], kind="stable")]
        for part in np.split(order, np.flatnonzero(np.diff(self.where[order])) + 1):
            if len(part) < 2:
                continue
            i, j = np.triu_indices(len(part), 1)
            pair = self.length[part][i] + self.length[part][j]
            target = self.where[part[0]]
            g = self.gain(donor, np.full((1, 1), target), self.length[own][:, None] - pair[None, :])
            if g.max() > best:
                a, b = np.unravel_index(g.argmax(), g.shape)
                best, found = g.max(), ([own[a]], [part[i[b]], part[j[b]]], target)
        return found


def pack_shard(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each piece's bin, its place there, and how full that bin is."""
    where = LocalSearch(length, best_fit(length, capacity), capacity).run()
    _, where = np.unique(where, return_inverse=True)
    order = np.argsort(where, kind="stable")
    sizes = length[order]
    before = np.cumsum(sizes) - sizes
    first = np.flatnonzero(np.diff(where[order], prepend=-1))
    offset = np.empty(len(length), np.int64)
    offset[order] = before - np.repeat(before[first], np.diff(np.append(first, len(order))))
    return where, offset, np.bincount(where, length)[where].astype(np.int64)


def left_over(where: np.ndarray, fill: np.ndarray, capacity: int) -> np.ndarray:
    """The pieces to pack again with those of other shards: the least filled bins
    that leave more than 1/64 free, up to 1/8 of the pieces, so that each round
    has at most 1/8 of the last one's; the least filled bin in any case."""
    by_fill = np.lexsort((where, fill))
    again = np.arange(1, len(where) + 1) * 8 <= len(where)
    again &= fill[by_fill] * 64 < capacity * 63
    some = np.unique(where[by_fill[again]])
    # A bin goes whole or not at all.
    some = some[np.isin(some, where[by_fill[~again]], invert=True)]
    if not len(some) and len(where) > 1:
        some = where[by_fill[:1]]
    return np.isin(where, some)


def packer(capacity: int, level: int, last: bool, shards: int):
    """Packs the pieces of one shard, given as a table with a column ``shard``."""

    def packed(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.drop_columns(["shard"])
        # The order of rows that reach a task is open; the result is not.
        group = group.sort_by([(c, "ascending") for c in group.column_names
                               if pa.types.is_integer(group[c].type)])
        length = group["length"].to_numpy()
        where, offset, fill = pack_shard(length, capacity)
        settled = np.full(len(length), last) | ~left_over(where, fill, capacity)
        number = (level << 56) + (key[0].as_py() << 56 - shards.bit_length()) + where
        for name, column in (("sequence_id", number), ("offset", offset), ("settled", settled)):
            group = group.append_column(name, pa.array(column))
        return group

    return packed


def pack(pieces: DataFrame, capacity: int, shard: int = SHARD) -> DataFrame:
    """``pieces`` (with a column ``length`` of 1 to ``capacity``) with the columns
    ``sequence_id`` and ``offset``."""
    columns = pieces.columns
    # The salt deals equal rows apart; the checkpoint fixes it.
    salt = free_name(pieces, "salt")
    pieces = pieces.withColumn(salt, F.monotonically_increasing_id())
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, " \
             "sequence_id bigint, offset bigint, settled boolean"
    pieces = checkpoint(pieces)
    out = pieces.where(F.col("length") >= capacity).select(
        *columns, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, level, before = pieces.where(F.col("length") < capacity), 0, None
    while True:
        n = rest.count()
        shards = max(1, -(-n // shard))
        level += 1
        # What no longer shrinks is settled where it is.
        last = n <= shard or before is not None and 2 * n > before
        before = n

        key = F.pmod(F.xxhash64(F.lit(level), salt), F.lit(shards)).alias("shard")
        got = checkpoint(rest.select(*columns, salt, key).repartition(shards, "shard").groupBy("shard").applyInArrow(packer(capacity, level, last, shards), schema))
        out = out.unionByName(got.where("settled").drop("settled", salt))
        if last:
            return out
        rest = got.where("NOT settled").select(*columns, salt)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """A row for each piece of each document: the other columns of ``docs`` than
    its text, where the piece begins and its length, and its place in a sequence."""
    rest = [c for c in docs.columns if c != "text" and c.lower() not in
            ("piece", "start", "length", "ids_crc32", "sequence_id", "offset", "settled", "shard")]
    cut = docs.select(*[F.col(f"`{c}`") for c in rest],
                      F.inline(piece_list(F.col("text"), path, capacity, end)))
    return pack(cut, capacity)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences of at most 2048 tokens."""
    import public_tokenizers

    made = pack_documents(source(spark, sf_dir, "documents", "doc_id", "text"),
                          public_tokenizers.path("word_bpe_49k.json"))
    return made.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
