"""Document counts of hashed features, brought back to the rows that asked.

A table of counts as large as the corpus can neither be broadcast nor joined row
by row cheaply. Here the rows of a table are taken in parts (ranges of rows of one
file). Each part sends the distinct features of its rows once, cut into blocks of
the hash space with 4 bytes for each; a block adds up the parts' counts and answers
each part with those of its features that occur more than once, and a level
of their count. The answers of a part are one small file in the shared folder,
which whoever reads that part's rows again looks up. Blocks and parts have a bounded
size, so nothing that one task holds grows with the corpus.

Two features can share the 32 bits and more that a block tells apart; a count is never
too small for it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from termflow.llm.common import written
from termflow.llm.files import opened, write_file

#: Rows of a file in one part, and bytes of text for one block.
PART_ROWS = 8192
BLOCK_BYTES = 16 << 20
#: Nodes of a plan that keeps the rows of its files where they are.
_PLAIN = {"Project", "Filter", "Relation", "SubqueryAlias"}


def in_parts(rows: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """``rows`` with a bigint column ``part``: the file and range of rows where each
    stands. A frame that is no plain scan is written first; returns the folders
    that this made."""
    paths = []
    plan = rows._jdf.queryExecution().analyzed().toString().strip().splitlines()
    if any(re.match(r"[\s:+-]*(\w*)", line).group(1) not in _PLAIN for line in plan):
        rows, path = written(rows, name)
        paths.append(path)
    at = F.expr(f"_metadata.row_index div {PART_ROWS}")
    return rows.withColumn("part", F.xxhash64(F.col("_metadata.file_path"), at)), paths


def slices(b: pa.RecordBatch, size: int = 1 << 20) -> Iterator[tuple[int, pa.RecordBatch]]:
    """A batch's rows by runs of one part with about ``size`` bytes of ``text``, one
    row at least, each with its part."""
    part = b.column("part").to_numpy()
    data = b.column("text").cast(pa.large_binary())
    end = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + b.num_rows + 1]
    first = 0
    while first < b.num_rows:
        run = np.flatnonzero(part[first:] != part[first])
        stop = first + int(run[0]) if len(run) else b.num_rows
        stop = min(stop, max(first + 1, int(np.searchsorted(end, end[first] + size, side="right")) - 1))
        yield int(part[first]), b.slice(first, stop - first)
        first = stop


class Levels:
    """The counts that :func:`counted` wrote, for tasks: the levels of one part's features."""

    def __init__(self, folder: str, bits: int):
        self.folder, self.bits = folder, bits
        self.part, self.keys, self.level = None, np.empty(0, np.uint64), np.empty(0, np.uint8)

    def __reduce__(self):
        return Levels, (self.folder, self.bits)

    def key(self, value: np.ndarray) -> np.ndarray:
        return value >> np.uint64(32 - self.bits)

    def of(self, part: int, value: np.ndarray) -> np.ndarray:
        """The level of each feature that rows of ``part`` have: 0 if no other row has it,
        else one and two more for each doubling of its count."""
        if part != self.part:
            self.part = part
            system, path = opened(f"{self.folder}/{part}")
            self.keys, self.level = np.empty(0, np.uint64), np.empty(0, np.uint8)
            if system.get_file_info(path).is_file:
                with system.open_input_stream(path) as f:
                    data = f.read()
                n = len(data) // 9
                self.keys, self.level = np.frombuffer(data, "<u8", n), np.frombuffer(data, np.uint8, n, 8 * n)
        if not len(self.keys):
            return np.zeros(len(value), np.uint8)
        key = self.key(value)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.level[at], 0).astype(np.uint8)


def counted(rows: DataFrame, text_bytes: int, features: Callable[[pa.Array], np.ndarray], folder: str) -> Levels:
    """Count in how many rows each feature occurs. ``rows`` has ``part`` and ``text``;
    ``features`` gives the hashes of some texts' features, each once for each text."""
    blocks = 1
    while blocks * BLOCK_BYTES < text_bytes and blocks < 1 << 31:
        blocks *= 2
    levels = Levels(folder, blocks.bit_length() - 1)
    low = np.uint64(32)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            key, count = np.unique(levels.key(np.concatenate(held)), return_counts=True)
            held.clear()
            ends = np.searchsorted(key >> low, np.arange(blocks + 1, dtype=np.uint64)) if blocks < len(key) else None
            block = (key >> low).astype(np.int64)
            first = np.flatnonzero(np.diff(block, prepend=-1) != 0) if ends is None else np.flatnonzero(np.diff(ends))
            at = first if ends is None else ends[:-1][first]
            edges = np.append(at, len(key)).astype(np.int64)

            def binary(values: np.ndarray) -> pa.Array:
                width = values.dtype.itemsize
                return pa.Array.from_buffers(pa.binary(), len(at), [
                    None, pa.py_buffer((edges * width).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])
            if len(key):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), part)), pa.array(block[at]), binary(key.astype("<u4")),
                     binary(np.minimum(count, 255).astype(np.uint8))], ["part", "block", "cells", "counts"])

        for whole in batches:
            for p, b in slices(whole):
                if held and p != part:
                    yield from flush()
                part = p
                held.append(features(b.column("text")))
        if held:
            yield from flush()

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, cells, counts = [], [], []
        for b in batches:
            parts += b.column("part").to_pylist()
            cells += [np.frombuffer(c.as_buffer(), "<u4") for c in b.column("cells")]
            counts += [np.frombuffer(c.as_buffer(), np.uint8) for c in b.column("counts")]
        flat = np.concatenate(cells)
        order = np.argsort(flat, kind="stable")
        head = np.flatnonzero(np.diff(flat[order].astype(np.int64), prepend=-1) != 0)
        total = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), head)
        level = np.where(total > 1, 1 + np.floor(2 * np.log2(total)), 0).astype(np.uint8)
        of = np.empty(len(flat), np.uint8)
        of[order] = np.repeat(level, np.diff(np.append(head, len(flat))))
        at = 0
        for p, c in zip(parts, cells):
            mine = of[at:at + len(c)]
            at += len(c)
            if mine.any():
                yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int64()), "block": pa.array([key[0].as_py()], pa.int64()),
                                                  "cells": [c[mine > 0].tobytes()], "levels": [mine[mine > 0].tobytes()]})

    def keep(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        cells = [np.frombuffer(c, "<u4").astype(np.uint64) | np.uint64(b << 32)
                 for c, b in zip(t["cells"].to_pylist(), t["block"].to_pylist())]
        keys = np.concatenate(cells)
        level = np.frombuffer(b"".join(t["levels"].to_pylist()), np.uint8)
        keys, first = np.unique(keys, return_index=True)
        # Under a name of its own first: a second attempt must not be read half written.
        final = f"{folder}/{key[0].as_py()}"
        write_file(f"{final}.{uuid.uuid4().hex[:8]}", [keys.astype("<u8").tobytes(), level[first].tobytes()], final)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([len(keys)], pa.int64())})

    answers = (rows.select("part", "text").mapInArrow(send, "part bigint, block bigint, cells binary, counts binary")
               .groupBy("block").applyInArrow(add, "part bigint, block bigint, cells binary, levels binary"))
    answers.groupBy("part").applyInArrow(keep, "part bigint, n bigint").agg(F.sum("n")).collect()
    return levels
