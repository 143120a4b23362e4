"""Documents counted block by block, before their terms have numbers.

Texts are dealt to blocks by document; a block's task cuts its texts into terms, counts them
by document, and keeps its distinct terms once, with their counts. Only those, one row for each
block and term, are summed to the vocabulary, sorted and joined with its numbers; they
come back to the block, whose rows know their term by its place among the block's terms. No row for each
(document, term) is ever shuffled, and no text is cut twice.

Defined results: rows of one id are one document. A document with a null id has no rows, as
in any fit, but its terms count for the vocabulary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from termflow.operators import blocks as bl
from termflow.operators.parcels import NONE
from termflow.session import delete_path, let_workers_import, new_folder, stored

#: Bytes of text that are taken for one (document, term) count; a term has five at least.
BYTES_OF_COUNT = 16
#: Distinct terms in one stored row.
WORDS = 1 << 16


def dealt(rows: DataFrame, payload: str, size: Column, k: int) -> tuple[DataFrame, int]:
    """Rows (id, ``payload``) with their block, a partition for each, and the number of
    blocks, which follows from the sum of ``size``, the bytes of text."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    count = (rows.agg(F.sum(size.cast("long"))).first()[0] or 0) // BYTES_OF_COUNT
    blocks = bl.whole_waves(bl.block_count(-(-count * max(k, bl.BLOCK_TOPICS) // bl.BLOCK_TOPICS), cores), cores)
    # Documents without an id are no one document: they are dealt by what they hold.
    place = F.xxhash64("id", F.when(F.col("id").isNull(), F.col(payload)))
    return rows.select("id", payload, F.pmod(place, F.lit(blocks)).cast("int").alias("block")).repartitionById(blocks, "block"), blocks


class Counting:
    """The counts of one block, taken batch by batch."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.docs: list[np.ndarray] = []
        self.words: list[pa.Array] = []
        self.counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = self.seen = 0

    def add(self, batch: pa.RecordBatch) -> None:
        terms = batch.column("terms")
        sizes = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
        at, words = np.repeat(np.arange(len(sizes)), sizes), terms.flatten()
        if words.null_count:
            at, words = at[words.is_valid().to_numpy(zero_copy_only=False)], words.drop_null()
        coded = words.dictionary_encode()
        n = max(len(coded.dictionary), 1)
        pairs, tf = np.unique(at * n + coded.indices.to_numpy(), return_counts=True)
        self.counts.append(((pairs // n + self.rows).astype(np.int32), (pairs % n + self.seen).astype(np.int32), tf.astype(np.int32)))
        self.words.append(coded.dictionary)
        self.ids.append(batch.column("id"))
        self.docs.append(batch.column("doc").to_numpy(zero_copy_only=False))
        self.rows += len(sizes)
        self.seen += len(coded.dictionary)

    def table(self, number: int) -> pa.Table:
        """The documents with an id, by id; their rows, by document and term; the block's
        terms with their counts over all its documents."""
        ids = pa.concat_arrays(self.ids)
        row, code, tf = (np.concatenate(x) for x in zip(*self.counts))
        self.counts.clear()
        coded = pa.concat_arrays(self.words).dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy()[code].astype(np.int64)
        counts = np.bincount(code, tf, len(words)).astype(np.int64)
        doc = pc.rank(ids, tiebreaker="dense").to_numpy().astype(np.int64) - 1
        whose = ids.is_valid().to_numpy(zero_copy_only=False)[row]
        row, code, tf = row[whose], code[whose], tf[whose]
        n = max(len(words), 1)
        pairs = doc[row] * n + code
        order = np.argsort(pairs, kind="stable")
        pairs, row, tf = pairs[order], row[order], tf[order].astype(float)
        # Rows of one id are one document.
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        if len(first) < len(pairs):
            pairs, row, tf = pairs[first], row[first], np.add.reduceat(tf, first)
        of = np.flatnonzero(np.diff(pairs // n, prepend=-1))
        at, local = row[of], pairs % n
        rows, parts = range(0, len(tf), bl.SLICE), range(0, len(words), WORDS)
        before, after = [None] * (1 + len(rows)), [None] * len(parts)
        size = 1 + len(rows) + len(parts)
        ends = [0] * (2 + len(rows)) + [min(i + WORDS, len(words)) for i in parts]
        return bl.packed(pa.table({
            "block": pa.array([number] * size, pa.int32()), "part": pa.array(range(size), pa.int32()),
            "ids": pa.ListArray.from_arrays(pa.array([0] + [len(of)] * size, pa.int32()), ids.take(pa.array(at))),
            "docs": bl.lists([np.concatenate(self.docs)[at], *[None] * (size - 1)], pa.int64()),
            "sizes": bl.lists([np.diff(np.append(of, len(tf))), *[None] * (size - 1)], pa.int32()),
            "local": bl.lists([None, *[local[i:i + bl.SLICE] for i in rows], *after], pa.int32()),
            "tf": bl.lists([None, *[tf[i:i + bl.SLICE] for i in rows], *after], pa.float64()),
            "first": pa.array([*before, *parts], pa.int32()),
            "words": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words),
            "counts": bl.lists([*before, *[counts[i:i + WORDS] for i in parts]], pa.int64())}))


def count_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition has whole blocks: their counts."""
    found: dict[int, Counting] = {}
    for batch in batches:
        for number in pc.unique(batch.column("block")).to_pylist():
            found.setdefault(number, Counting()).add(batch.filter(pc.equal(batch.column("block"), number)))
    for number in sorted(found):
        yield from found.pop(number).table(number).to_batches()


class CountedBlocks:
    """The counts of ``docs`` (id, terms ARRAY<STRING>, block; dealt by :func:`dealt`)."""

    def __init__(self, docs: DataFrame, blocks: int):
        let_workers_import(docs.sparkSession)
        kind = docs.schema["id"].dataType.simpleString()
        number = F.col("id").cast("long") if kind in ("bigint", "int", "smallint", "tinyint") else F.xxhash64("id")
        rows = docs.select("block", "id", F.coalesce(number, F.lit(0)).alias("doc"), "terms")
        self.blocks, self.id_type = blocks, kind
        self.table, self.path = stored(rows.mapInArrow(count_all, (
            f"block int, part int, ids array<{kind}>, docs binary, sizes binary, local binary, tf binary, "
            "first int, words array<string>, counts array<bigint>")), "counted")

    def words(self) -> DataFrame:
        """``block, local, term, cnt``: the terms of each block and their places there."""
        pairs = F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x")
        return self.table.where("first IS NOT NULL").select("block", "first", pairs).select(
            "block", (F.col("first") + F.col("at")).alias("local"), F.col("x.words").alias("term"), F.col("x.counts").alias("cnt"))

    def term_counts(self) -> DataFrame:
        """``term, cnt`` over all documents."""
        return self.words().groupBy("term").agg(F.sum("cnt").alias("cnt"))

    def numbered(self, vocab: DataFrame, folder: str, more: tuple[int, ...] = ()) -> DataFrame:
        """The blocks with the numbers of ``vocab`` (term, term_idx), to go rounds over, as files in ``folder`` and
        references to them; rows of other terms are left out. Each block has the numbers ``more`` besides, without a row."""
        shards, more_terms = self.blocks, np.array(more, np.int64)
        kept = ["block", "part", "ids", "docs", "sizes", "local", "tf"]
        nothing = pa.schema([("block", pa.int32()), *NONE])

        def cut(key: tuple[pa.Scalar, ...], mine: pa.Table, numbers: pa.Table) -> pa.Table:
            mine = bl.unpacked(mine).sort_by("part")
            place, number = numbers["local"].to_numpy(), numbers["term_idx"].to_numpy()
            local, tf, sizes = bl.flat(mine["local"]), bl.flat(mine["tf"]), bl.flat(mine["sizes"])
            if not len(number):
                return nothing.empty_table()
            # By number, so that a document's rows are in one order whatever the blocks' places.
            order = np.argsort(number)
            of = np.full(max(int(place.max()), int(local.max(initial=0))) + 1, -1)
            of[place[order]] = np.arange(len(order))
            doc, local = np.repeat(np.arange(len(sizes)), sizes), of[local]
            known = local >= 0
            doc, local, tf = doc[known], local[known], tf[known]
            by = np.argsort(doc * len(order) + local)
            sizes = np.bincount(doc, minlength=len(sizes))
            have = np.flatnonzero(sizes)
            ids = mine["ids"].combine_chunks().flatten().take(pa.array(have))
            return bl.put_block(folder, key[0].as_py(), bl.block_rows(key[0].as_py(), ids, bl.flat(mine["docs"])[have], sizes[have],
                                                                      np.append(number[order], more_terms), local[by], tf[by], shards))

        # Never broadcast: Spark takes the rows of terms for as small as the lists they are made from.
        numbers = self.words().hint("merge").join(vocab.select("term", "term_idx"), "term").select(F.col("block").alias("to"), "local", F.col("term_idx").cast("long").alias("term_idx"))
        mine = self.table.where("first IS NULL").select(*kept)
        return mine.repartitionById(shards, "block").groupBy("block").cogroup(
            numbers.repartitionById(shards, "to").groupBy("to")).applyInArrow(cut, bl.BLOCK)

    def rounds(self, vocab: DataFrame, id_col: str, k: int, first: Callable, step: Callable | None, more: tuple[int, ...] = ()) -> bl.Rounds:
        """Rounds over the numbered blocks. The counts are deleted."""
        folder = new_folder(self.table.sparkSession, "em-blocks")
        run = bl.Rounds.over(self.numbered(vocab, folder, more), folder, self.id_type, id_col, k, self.blocks, first, step)
        self.delete()
        return run

    def delete(self) -> None:
        delete_path(self.table.sparkSession, self.path)
