"""Ranked lexical search: items rank all documents by whole-number term weights.

One pass over the texts writes, for each document, the items' terms that it holds
and how often (its forward row); sizes and document counts are sums over these
rows. A second pass reads the forward rows, builds postings for one bounded shard
of documents after another, and searches each shard for all items. Every task
keeps the ten best of each item over its shards, whose last score is the bar for
the next shard, and sends only these.

A search of a shard is a hybrid. The short posting lists of an item are merged
term at a time: one sum for each document that stands in any of them. These sums
are then one list among the long ones, with a greatest value like theirs, and
all are walked document at a time, in windows of documents. A window
whose lists' greatest values don't reach the bar is skipped whole. In the others
candidates come from the lists that can lift a document to the bar (the essential
ones); each further list is looked up only for candidates that can still reach it.

Defined results: null texts have no terms and are no documents for the counts;
rows are documents of their own, also of one id, and a row without an id
counts but is not returned; rows of one item id are one item with the terms of all;
an item whose terms occur nowhere has no rows; ties go to the smaller doc_id;
empty tables give no rows; other columns play no part. Texts of any length are
read whole. Terms are told apart by 64-bit hashes keyed anew in every run.
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from termflow.llm.common import drop_written, source, whole_text, written
from termflow.llm.words import cut
from termflow.session import checkpoint

TOP = 10
#: Bytes of item texts that one search broadcasts the terms of; more items are
#: searched in several blocks.
ITEM_BYTES = 16 << 20
#: Postings and documents of one shard.
SHARD_POSTINGS = 2_000_000
SHARD_DOCS = 1 << 16
#: Documents of one window, and the share of a shard's documents up to which a list is short.
WINDOW_DOCS = 1024
SHORT = 1 / 32
#: Bytes between terms: all of ASCII but letters and digits.
BETWEEN = np.zeros(256, bool)
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


@dataclass
class Items:
    """A block of items: their ids, for each the numbers of its terms, and all
    terms' hashes in ascending order."""

    ids: list
    terms: list[np.ndarray]
    hashes: np.ndarray
    seed: int


def items_of(rows: list[tuple], seed: int) -> Items:
    """Rows of (item id, text) as items."""
    words = cut(pa.array([t or "" for _, t in rows], pa.string()), lower=True, space=BETWEEN)
    h = words.hashes(seed=seed) if len(words) else np.empty(0, np.uint64)
    hashes = np.unique(h)
    number = np.searchsorted(hashes, h)
    of: dict = {}
    for k, (i, _) in enumerate(rows):
        of.setdefault(i, []).append(number[words.first[k]:words.first[k + 1]])
    return Items(list(of), [np.unique(np.concatenate(t)) for t in of.values()], hashes, seed)


def forward(docs: DataFrame, doc_id: str, text: str, items) -> DataFrame:
    """For each document with a term: doc_id, n (terms with repeats), and which of
    the items' terms it holds (ascending, as 4-byte numbers) and how often."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seed = items.value.hashes, items.value.seed
        for b in batches:
            words = cut(b.column("text"), lower=True, space=BETWEEN)
            n = np.diff(words.first)
            if not len(words):
                continue
            h = words.hashes(seed=seed)
            at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            hit = known[at] == h if len(known) else np.zeros(len(h), bool)
            row = np.repeat(np.arange(len(n)), n)[hit]
            key, tf = np.unique(row * max(len(known), 1) + at[hit], return_counts=True)
            row, term = np.divmod(key, max(len(known), 1))
            ends = (4 * np.searchsorted(row, np.arange(len(n) + 1))).astype(np.int32)

            def binary(values: np.ndarray) -> pa.Array:
                return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.tobytes()),
                                                                   pa.py_buffer(values.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), binary(term), binary(tf)],
                ["doc_id", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(
        rows, "doc_id bigint, n bigint, terms binary, tfs binary")


def document_counts(rows: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each of the items' terms occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros(terms, np.int64)
        for b in batches:
            got += np.bincount(flat(b.column("terms")), minlength=terms)
        some = np.flatnonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(got[some])], ["term", "df"])

    df = np.zeros(terms, np.int64)
    for r in rows.select("terms").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


def flat(column: pa.Array) -> np.ndarray:
    """All 4-byte numbers of a binary column."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, "<u4")[ends[0] // 4:ends[-1] // 4] if data is not None and ends[-1] > ends[0] else np.empty(0, "<u4")


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def length_norms(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """100 - 90 + ((90 * n * docs) div total) of each document."""
    if int(n.max(initial=0)) * 90 * docs < 2**63:
        return 10 + 90 * n * docs // total
    return np.array([10 + 90 * int(x) * docs // total for x in n], np.int64)


class Shard:
    """Postings of a bounded number of documents: for each term the documents that
    hold it, ascending, and what they get for it."""

    def __init__(self, ids: np.ndarray, norm: np.ndarray, size: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids = ids[order]
        doc = np.repeat(place, size)
        tf = tf.astype(np.int64)
        value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(norm, size)))
        by_term = np.argsort(term.astype(np.int64) << 32 | doc)
        self.doc, self.value = doc[by_term], value[by_term]
        self.ends = np.searchsorted(term[by_term], np.arange(len(weight) + 1))

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, z = self.ends[term], self.ends[term + 1]
        return self.doc[a:z], self.value[a:z]


def window_tops(doc: np.ndarray, value: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The greatest value of a list in each window; 0 where it has none."""
    some = cuts[1:] > cuts[:-1]
    out = np.zeros(len(some), np.int64)
    if some.any():
        out[some] = np.maximum.reduceat(value, cuts[:-1][some])
    return out


class Best:
    """The best documents of an item so far."""

    def __init__(self, top: int):
        self.top = top
        self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def bar(self) -> int:
        """What a further document must score at least (an equal score may have the smaller id)."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[:self.top]
        self.ids, self.scores = ids[order], scores[order]


def search_shard(shard: Shard, terms: np.ndarray, best: Best, window: int = WINDOW_DOCS, short: float = SHORT) -> int:
    """Add a shard's best documents for an item's terms to ``best``; the number of
    postings that were read."""
    docs = len(shard.ids)
    lists = [p for p in map(shard.postings, terms.tolist()) if len(p[0])]
    brief = [p for p in lists if len(p[0]) <= short * docs]
    lists = [p for p in lists if len(p[0]) > short * docs]
    read = 0
    if brief:  # term at a time
        doc, value = (np.concatenate(x) for x in zip(*brief))
        read += len(doc)
        sums = np.zeros(docs, np.int64)
        np.add.at(sums, doc, value)
        doc = np.unique(doc)
        lists.append((doc, sums[doc]))
    if not lists:
        return read
    # Document at a time over the sums and the long lists, those of small values first.
    lists.sort(key=lambda p: int(p[1].max()))
    edges = np.arange(0, docs + window, window)
    cuts = [np.searchsorted(doc, edges) for doc, _ in lists]
    tops = np.array([window_tops(doc, value, c) for (doc, value), c in zip(lists, cuts)])
    below = np.cumsum(tops, axis=0)  # what the first lists can give in each window
    for w in np.flatnonzero(below[-1] >= best.bar).tolist():
        bar = best.bar
        if below[-1, w] < bar:
            continue
        # Lists before the essential ones cannot lift a document to the bar by themselves.
        essential = int(np.searchsorted(below[:, w], bar))
        first = w * window
        score = np.zeros(window, np.int64)
        for (doc, value), c in zip(lists[essential:], cuts[essential:]):
            a, z = c[w], c[w + 1]
            score[doc[a:z] - first] += value[a:z]
            read += z - a
        found = np.flatnonzero(score)
        for k in range(essential - 1, -1, -1):
            found = found[score[found] + below[k, w] >= bar]
            a, z = cuts[k][w], cuts[k][w + 1]
            if not len(found) or a == z:
                continue
            doc, value = lists[k]
            at = np.minimum(np.searchsorted(doc[a:z], found + first), z - a - 1)
            hit = doc[a:z][at] == found + first
            score[found[hit]] += value[a:z][at[hit]]
            read += int(hit.sum())
        found = found[score[found] >= bar]
        if len(found):
            best.add(shard.ids[first + found], score[found])
    return read


def search(rows: DataFrame, items, stats: tuple[int, int], weight, top: int, shard_postings: int, shard_docs: int) -> DataFrame:
    """Each task's best documents of each item: item (its number), doc_id, score."""
    n_docs, n_terms = stats

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items.value.ids]
        held: list[tuple] = []

        def flush() -> None:
            shard = Shard(*[np.concatenate(x) for x in zip(*held)], weight.value)
            for b, terms in zip(best, items.value.terms):
                search_shard(shard, terms, b)
            held.clear()

        for b in batches:
            b = b.filter(b.column("doc_id").is_valid())
            n = b.column("n").to_numpy()
            ends = np.frombuffer(b.column("terms").buffers()[1], np.int32)[b.column("terms").offset:][:len(n) + 1] if len(n) else np.zeros(1, np.int32)
            held.append((b.column("doc_id").to_numpy(), length_norms(n, n_docs, n_terms), np.diff(ends) // 4,
                         flat(b.column("terms")).astype(np.int64), flat(b.column("tfs"))))
            if sum(len(x[3]) for x in held) >= shard_postings or sum(len(x[0]) for x in held) >= shard_docs:
                flush()
        if held:
            flush()
        for i, b in enumerate(best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(b.ids), pa.int64()), pa.array(b.ids), pa.array(b.scores)],
                                                 ["item", "doc_id", "score"])

    return rows.mapInArrow(find, "item bigint, doc_id bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", top: int = TOP, item_bytes: int = ITEM_BYTES,
                  shard_postings: int = SHARD_POSTINGS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), whole_text(item_text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + int(size) // item_bytes
    found = []
    for k in range(blocks):
        some = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        mine = items_of([tuple(r) for r in some.collect()], secrets.randbits(64))
        shared = spark.sparkContext.broadcast(mine)
        rows, path = written(forward(docs, doc_id, text, shared), "forward")
        n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = spark.sparkContext.broadcast(weights(document_counts(rows, len(mine.hashes)), n_docs))
        hits = search(rows, shared, (n_docs, max(n_terms, 1)), weight, top, shard_postings, shard_docs)
        names = spark.createDataFrame(list(enumerate(mine.ids)), "item bigint, item_id bigint")
        best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        kept = checkpoint(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        drop_written(spark, path)
        found.append(kept)
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return ranked_search(source(spark, sf_dir, "documents", "doc_id", "text"), source(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE_SQL = r"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), tf AS (
    SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term
), size AS (
    SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS big_n, sum(n) AS big_l FROM size
), weight AS (
    SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus
), norm AS (
    SELECT doc_id, (10 + (90 * n * big_n) // big_l)::BIGINT AS m FROM size, corpus
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN norm USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
