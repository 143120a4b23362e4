"""Removal of word sequences that repeat across a corpus, found behind a
count-min prefilter.

A window is a number of consecutive words of one document. Every word covered by
a window whose words also start somewhere else, in the same document or another,
is removed.

* **First pass.** The windows of a text are stood for by anchors: the first of
  the shorter grams in a window that has the smallest hash. Equal windows have
  equal anchors at the same place, so a gram is an anchor at least as often as
  any of its windows occurs, and one anchor stands for about ten windows. Each
  task counts anchors in count-min sketches of :data:`ROWS` rows, up to
  :data:`HOT` in a cell, and the tasks' sketches are merged by block of cells. The least of an
  anchor's cells never falls short of its count, so a window that is not
  estimated repeated is not: none is lost. A sketch has a cell for every 16 bytes
  of text, so its estimates are as good at any size.
* Two bits of each merged cell (a count of 2, and one of :data:`HOT`) are broadcast
  up to :data:`BROADCAST_BYTES`; a larger sketch stays a table of cells, and the
  anchors are joined with it. The result is the same.
* **Second pass.** Only the windows of anchors estimated repeated go through a
  shuffle, as runs (an anchor, where its first window starts, hashes of all its
  windows), and are grouped exactly. Those of a hot anchor, many of which differ
  around one passage, go by their own hash. A task sends no more than two rows for a
  window that it meets again and again, and marks the rest by itself, so a
  passage that a third of all documents hold is no hot group.
* The marked windows of a document meet its text again in one join.

Windows are told apart by 128 bits (anchor and window) of hashes keyed anew in
every run.

Defined results: a null text has no words; a text without words or with fewer
than a window's is kept as it is (its words joined by one space); rows are
documents of their own, also with equal or null ids, so a row given twice
repeats itself; an empty table gives no rows; other columns play no part, whatever
their names. Texts of any length are cut whole.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.llm.common import source, whole_text
from termflow.llm.words import cut, mix
from termflow.session import checkpoint

WINDOW = 35
#: Words of a gram, of a window of 35: twenty grams stand in a window.
GRAM = 16
ROWS = 2
#: Cells of one merged block, and anchors that a task counts before it sends them.
BLOCK_BITS = 22
FLUSH = 1 << 20
#: An anchor estimated to occur so often has its windows grouped each by itself.
HOT = 100
#: Bytes of the merged sketch that may be broadcast.
BROADCAST_BYTES = 64 << 20
#: Slots, as a power of two, in which a task remembers the windows that it has met.
SEEN_BITS = 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
RUN = "anchor bigint, id bigint, mark bigint, start int, hashes binary, repeated bigint"


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive values, from hashes of powers of two."""
    size = 1
    while 2 * size <= k:
        h, size = mix(h[:-size] * _STEP + h[size:]), 2 * size
    return h if size == k else mix(h[:len(h) - (k - size)] * _STEP + (h[k - size:] ^ np.uint64(k)))


def least(value: np.ndarray, k: int) -> np.ndarray:
    """For every ``k`` consecutive values, the number of the first smallest one."""
    place, size = np.arange(len(value)), 1

    def smaller(step: int) -> tuple[np.ndarray, np.ndarray]:
        right = value[step:] < value[:-step]
        return np.where(right, value[step:], value[:-step]), np.where(right, place[step:], place[:-step])

    while 2 * size <= k:
        value, place = smaller(size)
        size *= 2
    return smaller(k - size)[1] if size < k else place


class Windows:
    """The windows of a batch of texts: for each its text, where it starts in it
    (``start``) and in the batch (``at``), and its anchor's place."""

    def __init__(self, texts: pa.Array, window: int, gram: int, seed: int):
        words = cut(texts)
        self.first = words.first[:-1]
        size = np.diff(words.first)
        n = np.maximum(size - window + 1, 0)
        self.row = np.repeat(np.arange(len(size)), n)
        self.start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.at = self.start + self.first[self.row]
        self.hashes = words.hashes(seed=seed) if len(self.at) else np.empty(0, np.uint64)
        self.gram = rolled(self.hashes, gram) if len(self.at) else self.hashes
        self.anchor = least(self.gram, window - gram + 1)[self.at] if len(self.at) else self.at
        #: Where runs of windows of one anchor begin.
        self.run = np.flatnonzero(np.diff(self.anchor, prepend=-1) != 0)


def batches_of(b: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes of text, one text at least."""
    total, first = 0, 0
    lengths = pc.binary_length(b.column("text")).to_pylist()
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield b.slice(first, i - first)
            total, first = 0, i
        total += n
    if first < b.num_rows:
        yield b.slice(first)


def cells(value: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each anchor in each row of a sketch with 2^bits cells."""
    shift = np.uint64(64 - bits)
    return [mix(value + np.uint64((r + 1) * int(_STEP) & 2**64 - 1)) >> shift for r in range(ROWS)]


def merged_sketch(texts: DataFrame, window: int, gram: int, seed: int, bits: int) -> DataFrame:
    """The sketch of all anchors: rows of ``row``, ``block``, and a bit for each cell
    of the block, set where the merged count is 2 or more (``often``) or :data:`HOT`
    or more (``hot``)."""
    low = min(bits, BLOCK_BITS)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for r, cell in enumerate(cells(np.concatenate(held), bits)):
                cell, count = np.unique(cell, return_counts=True)
                block = (cell >> np.uint64(low)).astype(np.int64)
                cell = (cell & np.uint64((1 << low) - 1)).astype("<u4")
                ends = np.append(np.flatnonzero(np.diff(block, prepend=-1) != 0), len(block))
                for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    yield pa.RecordBatch.from_pylist([{
                        "row": r, "block": int(block[a]), "cells": cell[a:z].tobytes(),
                        "counts": np.minimum(count[a:z], HOT).astype(np.uint8).tobytes()}], schema)

        schema = pa.schema([("row", pa.int32()), ("block", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())])
        for whole in batches:
            for b in batches_of(whole):
                w = Windows(b.column("text"), window, gram, seed)
                if len(w.run):
                    held.append(w.gram[w.anchor[w.run]])
                    n += len(w.run)
                if n >= FLUSH:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << low, np.uint8)
        for b in batches:
            for part, n in zip(b.column("cells"), b.column("counts")):
                at = np.frombuffer(part.as_buffer(), "<u4")
                count[at] = np.minimum(count[at] + np.frombuffer(n.as_buffer(), np.uint8), HOT)
        yield pa.RecordBatch.from_pydict({
            "row": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()),
            "often": [np.packbits(count > 1, bitorder="little").tobytes()],
            "hot": [np.packbits(count >= HOT, bitorder="little").tobytes()]})

    return (texts.select("text").mapInArrow(sketch, "row int, block bigint, cells binary, counts binary")
            .groupBy("row", "block").applyInArrow(merge, "row int, block bigint, often binary, hot binary"))


def anchor_rows(texts: DataFrame, window: int, gram: int, seed: int, bits: int) -> DataFrame:
    """Each anchor's place in its text, and its cells: id, mark, place, cell0, cell1."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in batches_of(whole):
                w = Windows(b.column("text"), window, gram, seed)
                of = pa.array(w.row[w.run])
                place = w.anchor[w.run] - w.at[w.run] + w.start[w.run]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(of), b.column("mark").take(of), pa.array(place, pa.int32()),
                     *[pa.array(c.astype(np.int64)) for c in cells(w.gram[w.anchor[w.run]], bits)]],
                    ["id", "mark", "place", *[f"cell{r}" for r in range(ROWS)]])

    return texts.mapInArrow(rows, "id bigint, mark bigint, place int, " + ", ".join(f"cell{r} bigint" for r in range(ROWS)))


def joined_estimates(texts: DataFrame, sketch: DataFrame, window: int, gram: int, seed: int, bits: int) -> DataFrame:
    """``texts`` with ``places``: the anchors whose cells all have a count of 2,
    each its place doubled, and 1 more where all are hot."""
    low = min(bits, BLOCK_BITS)

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, block, *planes in zip(*[b.column(c).to_pylist() for c in ("row", "block", "often", "hot")]):
                often_bits, hot_bits = (np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little") for x in planes)
                on = np.flatnonzero(often_bits)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(on), r, np.int32)), pa.array(on + (block << low)),
                                                  pa.array(hot_bits[on].astype(np.int32))], ["row", "cell", "hot"])

    on = sketch.mapInArrow(often, "row int, cell bigint, hot int")
    found = anchor_rows(texts, window, gram, seed, bits)
    for r in range(ROWS):
        found = found.join(on.where(F.col("row") == r).select(F.col("cell").alias(f"cell{r}"), F.col("hot").alias(f"hot{r}")), f"cell{r}")
    hot = F.least(*[F.col(f"hot{r}") for r in range(ROWS)]).cast("long")
    places = (found.groupBy(F.col("id").alias("p_id"), F.col("mark").alias("p_mark"))
              .agg(F.collect_list(F.col("place") * F.lit(2).cast("long") + hot).alias("places")))
    return texts.join(places, F.col("id").eqNullSafe(F.col("p_id")) & (F.col("mark") == F.col("p_mark"))).select(
        "id", "mark", "text", "places")


def candidate_runs(texts: DataFrame, window: int, gram: int, seed: int, bits: int, sketch=None) -> DataFrame:
    """Runs of windows whose anchors are estimated repeated, by the broadcast
    ``sketch`` or else by ``places``: to be grouped by anchor, but for those whose
    windows a task has met twice before, which have their windows marked already."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Windows met by this task, the last of each slot, and how often, up to 2.
        slot_key, slot_met = np.zeros(1 << SEEN_BITS, np.uint64), np.zeros(1 << SEEN_BITS, np.int64)
        for whole in batches:
            for b in batches_of(whole):
                w = Windows(b.column("text"), window, gram, seed)
                if not len(w.run):
                    continue
                anchor = w.gram[w.anchor[w.run]]
                if sketch is not None:
                    often, hot = np.ones((2, len(anchor)), bool)
                    for planes, cell in zip(sketch.value, cells(anchor, bits)):
                        cell = cell.astype(np.int64)
                        for plane, on in zip(planes, (often, hot)):
                            on &= (plane[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
                else:
                    lists = b.column("places")
                    places = lists.flatten().to_numpy()
                    whole_place = (places >> 1) + np.repeat(w.first, np.diff(lists.offsets.to_numpy()))
                    often = np.isin(w.anchor[w.run], whole_place)
                    hot = np.isin(w.anchor[w.run], whole_place[places & 1 == 1])
                if not often.any():
                    continue
                size = np.diff(np.append(w.run, len(w.at)))[often]
                run, anchor, hot = w.run[often], anchor[often], hot[often]
                of = np.repeat(np.arange(len(run)), size)
                inside = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
                key = windows_at(w.hashes, w.at[run][of] + inside, window)
                known = key ^ mix(anchor)[of]
                # How often the task has met each window before: 0, 1, or 2 and more.
                order = np.lexsort((np.arange(len(known)), known))
                ordered = known[order]
                head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
                first = np.flatnonzero(head)
                count = np.diff(np.append(first, len(known)))
                uniq = ordered[first]
                slot = (uniq >> np.uint64(64 - SEEN_BITS)).astype(np.int64)
                before = np.where(slot_key[slot] == uniq, slot_met[slot], 0)
                slot_key[slot] = uniq
                slot_met[slot] = np.where(slot_key[slot] == uniq, np.minimum(before + count, 2), 0)
                met = np.empty(len(known), bool)
                met[order] = np.arange(len(known)) - np.repeat(first - before, count) > 1
                # Runs by anchor; windows of a hot anchor each by itself; marks that are sure.
                send = (np.bincount(of, ~met, len(run)) > 0) & ~hot
                single = np.flatnonzero(~met & hot[of])
                mask = np.zeros(len(run), np.int64)
                np.bitwise_or.at(mask, of[met], np.int64(1) << inside[met])
                mask[send] = 0
                done = np.flatnonzero(mask)
                row = pa.array(w.row[run])
                ids, marks = b.column("id").take(row), b.column("mark").take(row)
                for rows, route, shift, data, count, bits_ in (
                        (np.flatnonzero(send), anchor[send], 0, key[send[of]], size[send], 0),
                        (of[single], mix(key[single]), inside[single], key[single], np.ones(len(single), np.int64), 0),
                        (done, mix(anchor[done] + done.astype(np.uint64)), 0, key[:0], np.zeros(len(done), np.int64), mask[done])):
                    if len(rows):
                        ends = np.concatenate([[0], np.cumsum(8 * count)]).astype(np.int32)
                        take = pa.array(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(route.view(np.int64)), ids.take(take), marks.take(take),
                             pa.array(w.start[run[rows]] + shift, pa.int32()),
                             pa.Array.from_buffers(pa.binary(), len(rows), [
                                 None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.astype("<u8").tobytes())]),
                             pa.array(np.broadcast_to(bits_, len(rows)), pa.int64())],
                            ["anchor", "id", "mark", "start", "hashes", "repeated"])

    return texts.mapInArrow(runs, RUN)


def windows_at(h: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """A hash of the ``window`` values from each place on."""
    size = 1
    while 2 * size <= window:
        h, size = mix(h[:-size] * _STEP + h[size:] + np.uint64(1)), 2 * size
    return mix(h[at] * _STEP + (h[at + window - size] ^ np.uint64(window)))


def repeated_windows(runs: DataFrame) -> DataFrame:
    """id, mark, start and the bits of the repeated windows from there on, of runs
    that have some; runs of one anchor stand together."""

    def marked(t: pa.Table) -> list[pa.RecordBatch]:
        anchor, mask = t["anchor"].to_numpy(), t["repeated"].to_numpy().copy()
        data = t["hashes"].combine_chunks()
        ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64) // 8
        size = np.diff(ends)
        key = np.frombuffer(data.buffers()[2], "<u8")[ends[0]:ends[-1]] if size.sum() else np.empty(0, "<u8")
        of = np.repeat(np.arange(len(anchor)), size)
        order = np.lexsort((key, anchor[of]))
        a, k = anchor[of][order], key[order]
        same = (a[1:] == a[:-1]) & (k[1:] == k[:-1])
        again = np.zeros(len(k), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        bit = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        np.bitwise_or.at(mask, of[again], np.int64(1) << bit[again])
        some = pa.array(mask != 0)
        out = pa.table({"id": t["id"], "mark": t["mark"], "start": t["start"], "repeated": mask}).filter(some)
        return out.combine_chunks().to_batches()

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            anchor = b.column("anchor").to_numpy()
            # All but the last anchor of what is held is complete.
            cut_at = int(np.searchsorted(anchor, anchor[-1]))
            if held and held[-1].column("anchor")[-1].as_py() != anchor[-1] or cut_at:
                yield from marked(pa.Table.from_batches([*held, b.slice(0, cut_at)]))
                held = [b.slice(cut_at)]
            else:
                held.append(b)
        if held:
            yield from marked(pa.Table.from_batches(held))

    return runs.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        group, "id bigint, mark bigint, start int, repeated bigint")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                    gram: int | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """For each row of ``docs``: doc_id, ``text`` (the words that stay, joined by
    one space), n_words and n_removed. A window has 2 to 62 words."""
    if not 2 <= window <= 62:
        raise ValueError(f"a window has 2 to 62 words, not {window}")
    gram = gram or max(1, window * GRAM // WINDOW)
    spark = docs.sparkSession
    seed = secrets.randbits(64)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(whole_text(text)).alias("mark"),
                        whole_text(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(BLOCK_BITS - 6, (size // 16).bit_length())
    sketch = merged_sketch(texts, window, gram, seed, bits)
    shared = None
    if 2 * ROWS << bits - 3 <= broadcast_bytes:
        blocks = np.zeros((ROWS, 2, 1 << bits - 3), np.uint8)
        step = 1 << min(bits, BLOCK_BITS) - 3
        for r in sketch.collect():  # bounded by broadcast_bytes
            for plane, data in enumerate((r["often"], r["hot"])):
                blocks[r["row"], plane, r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(data, np.uint8)
        shared = spark.sparkContext.broadcast(blocks)
        likely = texts
    else:
        likely = joined_estimates(texts, checkpoint(sketch), window, gram, seed, bits)
    marks = repeated_windows(candidate_runs(likely, window, gram, seed, bits, shared))
    spans = marks.groupBy(F.col("id").alias("s_id"), F.col("mark").alias("s_mark")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("repeated").alias("bits"))
    rows = texts.join(spans, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("mark") == F.col("s_mark")), "left")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in batches_of(whole):
                kept, n_words, n_removed = [], [], []
                for t, starts, masks in zip(b.column("text").cast(pa.large_binary()).to_pylist(),
                                            b.column("starts"), b.column("bits")):
                    words = t.split()  # ASCII white space: a space and \x09-\x0D
                    n = len(words)
                    if starts.is_valid:
                        gone = covered(starts.values.to_numpy(), masks.values.to_numpy(), n, window)
                        words = [x for x, g in zip(words, gone.tolist()) if not g]
                    kept.append(b" ".join(words))
                    n_words.append(n)
                    n_removed.append(n - len(words))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()),
                     pa.array(n_removed, pa.int64())], ["doc_id", "text", "n_words", "n_removed"])

    return rows.select("id", "text", "starts", "bits").mapInArrow(
        keep, "doc_id bigint, text string, n_words bigint, n_removed bigint")


def covered(starts: np.ndarray, masks: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of a text's words the marked windows cover."""
    bit = np.arange(64 if not len(masks) else int(masks.max()).bit_length())
    run, at = np.nonzero(masks[:, None] >> bit[None, :] & 1)
    first = starts[run].astype(np.int64) + at
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.subtract.at(edge, first + window, 1)
    return np.cumsum(edge[:-1]) > 0


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without the 35-word windows that repeat."""
    kept = without_repeats(source(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
    SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM words
), keyed AS (
    SELECT doc_id, i, w[i] AS word,
           CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS seq FROM places
), marked AS (
    SELECT doc_id, i, word,
           CASE WHEN seq IS NOT NULL AND count(*) OVER (PARTITION BY seq) > 1 THEN 1 ELSE 0 END AS again FROM keyed
), gone AS (
    SELECT doc_id, i, word,
           max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS removed
    FROM marked
), kept AS (
    SELECT doc_id, count(*) AS n_words, sum(removed) AS n_removed,
           coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE removed = 0), '') AS kept FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
