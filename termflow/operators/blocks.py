"""Rounds of a topic model over blocks of documents and shards of terms.

A block holds the ``(term, count)`` rows of some millions of counts, all those of its
documents, and their topic numbers; a shard holds every n-th term. A round is
two shuffles of packed arrays: each block sends a shard one array with its own sums
for the terms that it has, and the shard sends each block the whole sums of
just those terms. Terms that a block has many times go over once, and no row of the
term table is ever sent for each of its occurrences. A block's task holds its rows and the
terms it meets, a shard's task its share of the terms; no task and not
the driver holds a vocabulary. What a block gets comes in the order in which it sent, so
numbers of terms go one way only.

Blocks are made once and lie packed in files of the checkpoint folder, as do messages; Spark deals
out references to them (``operators/parcels.py``), those of the blocks once, one to a partition. A block's
own numbers stay where its task wrote them for its next one. Each half of a round is written as references, which
cuts the lineage, and then the files that it has read are deleted: on disk are, besides the blocks,
two sets of messages at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from termflow.operators import parcels
from termflow.session import delete_path, let_workers_import, new_folder, stored

#: Counts of a block, at most expected (a document is never cut), and of a small one.
BLOCK_ROWS, SMALL_BLOCK_ROWS = 6 << 20, 1 << 16
#: Counts in one row of a stored block.
SLICE = 1 << 18
#: Topics up to which a block holds so many counts; with more it holds fewer.
BLOCK_TOPICS = 32
#: Columns of a block's reference, of those to its messages, and of those to a shard's answers.
BLOCK = f"block int, {parcels.REFERENCE}"
SENT = f"block int, shard int, of_docs boolean, {parcels.REFERENCE}"
BACK = f"block int, shard int, {parcels.REFERENCE}"


def block_count(rows: int, parallelism: int) -> int:
    """Blocks of a bounded size, and on small inputs one for each core."""
    return max(1, -(-rows // BLOCK_ROWS), min(parallelism, rows // SMALL_BLOCK_ROWS))


def whole_waves(blocks: int, parallelism: int) -> int:
    """As many blocks as fill all cores some times over, at most a quarter larger: with one
    block more than cores, all others wait for it in every round. Few blocks stay as they are."""
    return blocks if blocks <= parallelism else -(-4 * blocks // (5 * parallelism)) * parallelism


def flat(column: pa.ChunkedArray) -> np.ndarray:
    """All numbers of a column of lists, one list after the other."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def lists(arrays: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
    sizes = [0 if a is None else len(a) for a in arrays]
    values = np.concatenate([a for a in arrays if a is not None] or [np.empty(0)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values).cast(kind))


#: What the lists hold that travel as bytes.
KINDS = {"docs": pa.int64(), "sizes": pa.int32(), "terms": pa.int64(), "local": pa.int32(), "tf": pa.float64(),
         "n": pa.float64(), "totals": pa.float64()}


def packed(table: pa.Table) -> pa.Table:
    """The table with its lists of numbers (none null) as bytes."""
    for name in KINDS.keys() & set(table.column_names):
        x = table[name].combine_chunks()
        width = KINDS[name].byte_width
        values = np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False))
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(x).to_numpy(zero_copy_only=False))])
        offsets = pa.array(ends * width).cast(pa.int32())  # fails beyond 2 GB
        table = table.set_column(table.column_names.index(name), name, pa.Array.from_buffers(
            pa.binary(), len(x), [None, offsets.buffers()[1], pa.py_buffer(values.view(np.uint8))]))
    return table


def unpacked(table: pa.Table) -> pa.Table:
    """What was :func:`packed`, as it was."""

    def as_list(x: pa.Array, kind: pa.DataType) -> pa.Array:
        x = x.cast(pa.binary())
        _, offsets, values = x.buffers()
        ends = np.frombuffer(offsets, np.int32)[x.offset:x.offset + len(x) + 1] // kind.byte_width
        count = int(ends[-1]) if len(ends) else 0
        numbers = pa.Array.from_buffers(kind, count, [None, values]) if count else pa.array([], kind)
        return pa.ListArray.from_arrays(pa.array(ends if len(ends) else [0], pa.int32()), numbers)

    for i, name in enumerate(table.column_names):
        if name in KINDS:
            kind = KINDS[name]
            table = table.set_column(i, name, pa.chunked_array([as_list(x, kind) for x in table[name].chunks], pa.list_(kind)))
    return table


@dataclass
class Block:
    """A block's rows, ordered by document and term: ``local`` numbers their terms in
    the order of ``terms``, by shard and number; ``sizes`` counts the rows of each document."""

    number: int
    ids: pa.Array
    docs: np.ndarray
    sizes: np.ndarray
    terms: np.ndarray
    local: np.ndarray
    tf: np.ndarray

    @staticmethod
    def of(number: int, table: pa.Table) -> Block:
        table = table.sort_by("part")
        return Block(number, table["ids"].combine_chunks().flatten(), *[
            flat(table[c]) for c in ("docs", "sizes", "terms")], flat(table["local"]).astype(np.intp), flat(table["tf"]))

    def by_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums of a number of each row, for each document."""
        return np.add.reduceat(values, np.cumsum(self.sizes) - self.sizes)

    def by_term(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.local, values, len(self.terms))

    def to_rows(self, of_docs: np.ndarray) -> np.ndarray:
        return np.repeat(of_docs, self.sizes)


def block_rows(number: int, ids: pa.Array, docs: np.ndarray, sizes: np.ndarray, terms: np.ndarray, local: np.ndarray,
               tf: np.ndarray, shards: int) -> pa.Table:
    """A block as it is stored: its documents with the number of their rows, its distinct
    terms, and the rows by document, where ``local`` is a place in ``terms``."""
    order = np.lexsort((terms, terms % shards))
    place = np.empty(len(terms), np.int32)
    place[order] = np.arange(len(terms), dtype=np.int32)
    local = place[local]
    parts = range(0, len(tf), SLICE)
    none = [None] * len(parts)
    return pa.table({
        "block": pa.array([number] * (1 + len(parts)), pa.int32()),
        "part": pa.array(range(1 + len(parts)), pa.int32()),
        "ids": pa.ListArray.from_arrays(pa.array([0] + [len(ids)] * (1 + len(parts)), pa.int32()), ids),
        "docs": lists([docs, *none], pa.int64()),
        "sizes": lists([sizes, *none], pa.int32()),
        "terms": lists([terms[order], *none], pa.int64()),
        "local": lists([None, *[local[i:i + SLICE] for i in parts]], pa.int32()),
        "tf": lists([None, *[tf[i:i + SLICE] for i in parts]], pa.float64())})


def cutter(id_col: str, shards: int) -> Callable:
    """Makes the rows (id, doc, term_idx, tf) of a block into a stored one."""

    def cut(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        ids = group[id_col].combine_chunks()
        # Codes in order of the ids, whatever their type.
        code = pc.rank(ids, tiebreaker="dense").to_numpy()
        term = group["term_idx"].to_numpy()
        by_id = np.lexsort((term, code))
        code, term, tf = code[by_id], term[by_id], group["tf"].to_numpy()[by_id]
        first = np.flatnonzero(np.diff(code, prepend=0))
        at = by_id[first]
        terms, local = np.unique(term, return_inverse=True)
        return block_rows(key[0].as_py(), ids.take(pa.array(at)), group["doc"].to_numpy()[at], np.diff(np.append(first, len(tf))),
                          terms, local, tf, shards)

    return cut


def messages(block: Block, shards: int, of_terms: np.ndarray, of_docs: np.ndarray) -> pa.Table:
    """A block's sums (a line for each topic) to the shards of its terms, and its
    documents' numbers, which pass a shard unchanged and come back with its answer."""
    cut = np.searchsorted(block.terms % shards, np.arange(shards + 1))
    to = [s for s in range(shards) if cut[s] < cut[s + 1]]
    mine = block.number % shards
    ids = [None] * len(to) + [block.ids]
    return pa.table({
        "block": pa.array([block.number] * (len(to) + 1), pa.int32()), "shard": pa.array([*to, mine], pa.int32()),
        "of_docs": pa.array([False] * len(to) + [True]),
        "ids": pa.ListArray.from_arrays(pa.array([0] * len(ids) + [len(block.ids)], pa.int32()), block.ids),
        "terms": lists([*[block.terms[cut[s]:cut[s + 1]] for s in to], None], pa.int64()),
        "n": lists([*[of_terms[:, cut[s]:cut[s + 1]].ravel() for s in to], of_docs.ravel()], pa.float64())})


def term_sums(group: pa.Table, k: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's messages in order of their blocks, its terms, where each sent number
    stands among them, and their sums."""
    sent = group.filter(pc.invert(group["of_docs"])).sort_by("block")
    terms, at = np.unique(flat(sent["terms"]), return_inverse=True)
    values = [x.values.to_numpy().reshape(k, -1) for x in sent["n"]]
    sums = np.array([np.bincount(at, np.concatenate([v[t] for v in values] or [np.empty(0)]), len(terms)) for t in range(k)])
    return sent, terms, at, sums


def put_block(folder: str, number: int, table: pa.Table) -> pa.Table:
    """Write a block (a table of :func:`block_rows`); its reference."""
    return parcels.put(folder, [table], "lz4").add_column(0, "block", pa.array([number], pa.int32()))


def the_block(key: tuple[pa.Scalar, ...], mine: pa.Table) -> Block:
    return Block.of(key[0].as_py(), parcels.get(mine)[0])


def put_messages(up: str, own: str, sent: pa.Table) -> pa.Table:
    """Write what goes to the shards, and apart from it what stays the block's own; the references."""
    goes = pc.invert(sent["of_docs"])
    return pa.concat_tables([
        add_columns(parcels.put(folder, parcels.rows(part.drop_columns(["block", "shard", "of_docs"]))), part, "block", "shard", "of_docs")
        for folder, part in ((up, sent.filter(goes)), (own, sent.filter(sent["of_docs"])))])


def add_columns(references: pa.Table, of: pa.Table, *columns: str) -> pa.Table:
    for i, c in enumerate(columns):
        references = references.add_column(i, c, of[c])
    return references


def got_messages(references: pa.Table) -> pa.Table:
    """A shard's messages from the blocks."""
    references = references.filter(pc.invert(references["of_docs"]))
    tables = [add_columns(t, references.slice(i, 1), "block", "of_docs") for i, t in enumerate(parcels.get(references))]
    return pa.concat_tables(tables)


def answerer(k: int, blocks: int, down: str) -> Callable:
    """A shard's answers, written: to each block the whole sums of the terms it sent, and to all
    blocks the totals of the shard. References to blocks' own numbers go back unread."""

    def answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        own = group.filter(group["of_docs"])
        own = add_columns(own.select(parcels.NONE.names), pa.table({"block": own["block"], "shard": pa.array([-1] * len(own), pa.int32())}), "block", "shard")
        if len(own) == len(group):
            return own
        sent, _, at, sums = term_sums(got_messages(group), k)
        ends = np.cumsum(pc.list_value_length(sent["terms"]).to_numpy())
        back: list[np.ndarray | None] = [None] * blocks
        for b, i, j in zip(sent["block"].to_pylist(), [0, *ends.tolist()], ends.tolist()):
            back[b] = sums[:, at[i:j]].ravel()
        to = pa.table({"block": pa.array(range(blocks), pa.int32()), "shard": pa.array([key[0].as_py()] * blocks, pa.int32())})
        totals = sums.sum(axis=1)
        answers = (pa.table({"n": lists([x], pa.float64()), "totals": lists([totals], pa.float64())}) for x in back)
        return pa.concat_tables([add_columns(parcels.put(down, answers), to, "block", "shard"), own])

    return answer


def received(references: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sums of a block's terms, the totals over all terms and the block's own
    documents' numbers, a line for each topic."""
    references = references.sort_by("shard")
    of_terms, totals, of_docs = [], np.zeros(k), np.empty((k, 0))
    for shard, part in zip(references["shard"].to_pylist(), parcels.get(references)):
        values = flat(part["n"]).reshape(k, -1)
        if shard < 0:
            of_docs = values
        else:
            of_terms.append(values)
            totals += flat(part["totals"])
    return np.concatenate(of_terms, axis=1), totals, of_docs


class Rounds:
    """Rounds over ``rows`` (id, doc, term_idx, tf; ``doc`` a number that follows from the id).

    ``first(block)`` gives the sums of a block's terms and documents before the
    first round, ``step(block, of_terms, totals, of_docs)`` those of a round."""

    def __init__(self, rows: DataFrame, id_col: str, k: int, count: int, first: Callable, step: Callable):
        blocks = block_count(-(-count * max(k, BLOCK_TOPICS) // BLOCK_TOPICS), rows.sparkSession.sparkContext.defaultParallelism)
        id_type = rows.schema[id_col].dataType.simpleString()
        dealt = rows.select(F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("block"), id_col, "doc", "term_idx", "tf")
        cut, folder = cutter(id_col, blocks), new_folder(rows.sparkSession, "em-blocks")

        # A partition has whole blocks, so that its rows need no sort by block.
        def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = list(batches)
            whole = pa.Table.from_batches(parts) if parts else None
            for number in pc.unique(whole["block"]) if parts else ():
                yield from put_block(folder, number.as_py(), cut((number,), whole.filter(pc.equal(whole["block"], number)))).to_batches()

        let_workers_import(rows.sparkSession)
        self._start(dealt.repartitionById(blocks, "block").mapInArrow(cut_all, BLOCK), folder, id_type, id_col, k, blocks, first, step)

    @classmethod
    def over(cls, table: DataFrame, folder: str, id_type: str, id_col: str, k: int, blocks: int, first: Callable, step: Callable) -> Rounds:
        """Rounds over blocks that are cut already: ``table`` makes their references, and their files in ``folder``."""
        run = cls.__new__(cls)
        run._start(table, folder, id_type, id_col, k, blocks, first, step)
        return run

    def _start(self, table: DataFrame, folder: str, id_type: str, id_col: str, k: int, blocks: int, first: Callable, step: Callable) -> None:
        self.spark = table.sparkSession
        let_workers_import(self.spark)
        self.k, self.step, self.id_col, self.id_type, self.done, self.blocks = k, step, id_col, id_type, 0, blocks
        made, path = stored(table, "em-blocks")
        # Kept as they are dealt, so that no round deals them again; counted, since Spark
        # knows how a kept table is dealt once it is there.
        self.table = made.repartitionById(blocks, "block").persist(StorageLevel.DISK_ONLY)
        self.table.count()
        # The folders of this half of a round's messages and own numbers, and what can go after it.
        self.up, self.own = new_folder(self.spark, "em-up"), new_folder(self.spark, "em-own")
        self.always, self.old, self.kept = [folder, path], [], False
        up, own = self.up, self.own

        def begin(key: tuple[pa.Scalar, ...], mine: pa.Table) -> pa.Table:
            block = the_block(key, mine)
            return put_messages(up, own, messages(block, blocks, *first(block)))

        self.sent = self.table.groupBy("block").applyInArrow(begin, SENT)

    def more(self, rounds: int) -> None:
        for _ in range(rounds):
            self.keep()
            self._round()

    def _round(self) -> None:
        k, blocks, step = self.k, self.blocks, self.step
        down, own, up = (new_folder(self.spark, f"em-{x}") for x in ("down", "own", "up"))
        back, path = stored(self.sent.repartitionById(blocks, "shard").groupBy("shard").applyInArrow(answerer(k, blocks, down), BACK), "em-answers")
        self._drop([self.up, *self.old])

        def go_on(key: tuple[pa.Scalar, ...], mine: pa.Table, got: pa.Table) -> pa.Table:
            if not len(mine):  # no document fell into this block
                return nothing.empty_table()
            block = the_block(key, mine)
            return put_messages(up, own, messages(block, blocks, *step(block, *received(got, k))))

        nothing = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("of_docs", pa.bool_()), *parcels.NONE])
        self.old, self.up, self.own, self.kept = [path, down, self.own], up, own, False
        self.sent = self.table.groupBy("block").cogroup(
            back.repartitionById(blocks, "block").groupBy("block")).applyInArrow(go_on, SENT)
        self.done += 1

    def keep(self) -> None:
        """Write the last messages; what they were made from is deleted."""
        if not self.kept:
            self.sent, path = stored(self.sent, "em-messages")
            self._drop(self.old)
            self.old, self.kept = [path], True

    def _drop(self, paths: list[str]) -> None:
        for path in paths:
            delete_path(self.spark, path)

    def tables(self, means: bool = False) -> tuple[DataFrame, DataFrame]:
        """The sums (or means over blocks) of all terms (term_idx, n0..), and those of documents (the id, n0..)."""
        self.keep()
        k, id_col = self.k, self.id_col
        columns = ", ".join(f"n{t} double" for t in range(k))

        def of_terms(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
            _, terms, at, sums = term_sums(got_messages(group), k)
            if means:
                sums /= np.bincount(at, minlength=len(terms))
            return pa.table({"term_idx": pa.array(terms, pa.int64())} | {f"n{t}": sums[t] for t in range(k)})

        def of_docs(batches):
            for b in batches:
                for part in parcels.get(pa.Table.from_batches([b])):
                    ids, n = part["ids"].combine_chunks().flatten(), flat(part["n"]).reshape(k, -1)
                    yield pa.RecordBatch.from_arrays([ids, *map(pa.array, n)], [id_col, *[f"n{t}" for t in range(k)]])

        return (self.sent.where("NOT of_docs").repartitionById(self.blocks, "shard").groupBy("shard").applyInArrow(of_terms, f"term_idx bigint, {columns}"),
                self.sent.where("of_docs").select(*parcels.NONE.names).mapInArrow(of_docs, f"`{id_col}` {self.id_type}, {columns}"))

    def close(self) -> None:
        self.table.unpersist()
        self._drop([self.up, self.own, *self.old, *self.always])
