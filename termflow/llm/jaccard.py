"""N-gram Jaccard join by vertical partitioning, without all pairs of a group.

Documents are sets of hashed word shingles. All shingles stand in one global
order, rare ones first: by the level of their document count (every other
shingle is counted, over the whole corpus, see ``levels.py``), then by hash. Two sets
with a Jaccard similarity of at least t share a shingle among the first
``n - ceil(t * n) + 1`` of either, so only documents that meet there can link. Early
shingles that are known to stand in one document alone meet nobody and go nowhere.

The hash order is cut into fragments. For a candidate pair the overlap is counted in
each fragment by itself, and the partial counts are summed per pair. Before that,
exact bounds drop pairs that cannot reach t: their sizes, the parities of their
shingles on 512 bits (sets differ in at least as many shingles as in bits), and
the overlap of their early shingles with all that may follow. Only the sets of
pairs that are left are cut and sent.

Equal sets are one class and stand for all their copies. Classes whose shingles are
about equally frequent, the likely originals of near copies, come first. Every class is first
compared with the first class of most of its buckets (a bucket: the classes that
share an early shingle). Then all pairs across different components are compared, members
of a bucket's largest component with outsiders alone. So a group of many near
copies costs a few comparisons for each, and every link between two components
is still found.

Defined results: a null or empty text, or one without words, has no shingles
and links with nothing; a row without an id links with nothing and its
component is null; rows with one id are one document: its component is the
smallest that its rows reach; ties do not arise, the component is a minimum; an
empty table gives no rows. Other columns play no part. Shingles are 64-bit hashes
keyed anew in every run, sets are told apart by 112 bits.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termflow.llm.common import drop_written, free_name, shared_folder, source, whole_text, written
from termflow.llm.components import star_roots
from termflow.llm.levels import Levels, counted, in_parts, slices
from termflow.llm.words import cut, mix
from termflow.session import checkpoint

WORDS = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: The rank of shingles that were not counted: behind counts of up to 8.
UNCOUNTED = 8
FRAGMENTS = 4
#: Members of a large bucket that one task compares with the others.
BUCKET = 256
#: Rows of ids that may be broadcast: 16 MB.
BROADCAST_IDS = 1_000_000
#: 64-bit words of parities.
PARITY = 8
BITS = tuple(f"bits{i}" for i in range(PARITY))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, and where each begins."""
    words = cut(texts, lower=True)
    h = words.hashes(seed=seed)
    size = np.diff(words.first)
    rows, hashes = [], []
    full = np.maximum(size - WORDS + 1, 0)
    at = np.repeat(words.first[:-1], full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
    rows.append(np.repeat(np.arange(len(size)), full))
    hashes.append(combined(h, at, WORDS))
    for k in range(1, WORDS):
        of = np.flatnonzero(size == k)
        rows.append(of)
        hashes.append(combined(h, words.first[:-1][of], k))
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[keep], value[keep]
    return value, np.searchsorted(row, np.arange(len(size) + 1))


def combined(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    value = np.full(len(at), k, np.uint64)
    for i in range(k):
        value = mix(value * _STEP + h[at + i])
    return value


def sums(value: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The wrapping sum of each text's values."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    return total[ends[1:]] - total[ends[:-1]]


def set_classes(value: np.ndarray, ends: np.ndarray, score: np.ndarray | None = None) -> np.ndarray:
    """16 bytes for each set: 14 of a hash, equal for equal sets, behind two for a
    ``score`` under 2^16 of the set, by which classes sort."""
    n = np.diff(ends).astype(np.uint64)
    both = np.column_stack([mix(sums(mix(value ^ _STEP), ends) + n), mix(sums(mix(value + _STEP), ends) ^ n)])
    as_bytes = np.ascontiguousarray(both).view(np.uint8).reshape(len(n), 16)
    as_bytes[:, :2] = 0 if score is None else score.astype(">u2").view(np.uint8).reshape(len(n), 2)
    return as_bytes


def oddity(rank: np.ndarray, counted: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """A score of each set: the share of its shingles that are far more or less
    frequent than its median one. The original of many near copies has few: it has
    neither their changes nor the lines that some share with other documents."""
    row, rank = row[counted], rank[counted].astype(np.int64)
    rank = rank[np.lexsort((rank, row))]  # rows ascend as they are
    ends = np.searchsorted(row, np.arange(rows + 1))
    size = np.diff(ends)
    median = rank[np.minimum(ends[:-1] + size // 2, max(len(rank) - 1, 0))] if len(rank) else np.zeros(rows, np.int64)
    far = np.bincount(row[np.abs(rank - median[row]) > 2], minlength=rows)
    return (65535 * far // np.maximum(size, 1)).astype(np.uint16)


def is_counted(value: np.ndarray) -> np.ndarray:
    """The shingles that are counted: every other one by its hash."""
    return value & np.uint64(1) == 0


def ranks(levels: Levels, part: int, value: np.ndarray) -> np.ndarray:
    """The first part of the global order: shingles known to be of one row, then rare
    ones, then those that were not counted, then frequent ones."""
    level = levels.of(part, value)
    return np.where(is_counted(value), level, np.uint8(UNCOUNTED)).astype(np.uint8)


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-n * percent // 100) + 1, 0)


def sketches(docs: DataFrame, levels: Levels, percent: int, seed: int) -> DataFrame:
    """Rows of id, set size, class, where the early shingles end in the order, the
    parities of the set, and those of the early shingles that another row may have;
    of the copies that one task meets only the first has these."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for whole in batches:
            for part, b in slices(whole):
                value, ends = shingle_sets(b.column("text"), seed)
                n = np.diff(ends)
                row = np.repeat(np.arange(len(n)), n)
                parity = parities(value, row, len(n))
                rank = ranks(levels, part, value)
                of = set_classes(value, ends, oddity(rank, is_counted(value), row, len(n)))
                order = np.lexsort((value, rank, row))
                value, rank = value[order], rank[order]
                take = prefix_size(n, percent)
                # Where the early shingles end in the global order: rank, then hash.
                last = np.zeros(len(n), np.int64)
                some = n > 0
                end = ends[:-1][some] + take[some] - 1
                last[some] = rank[end].astype(np.int64) << 56 | (value[end] >> np.uint64(8)).astype(np.int64)
                if len(seen) > 1_000_000:
                    seen.clear()
                known = b.column("doc_id").is_valid().to_pylist()
                classes = [c.tobytes() for c in of]
                for i, c in enumerate(classes):
                    if c in seen or not known[i]:
                        take[i] = 0
                    else:
                        seen.add(c)
                at = np.repeat(ends[:-1], take) + np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
                shared = rank[at] > 0
                size = np.bincount(np.repeat(np.arange(len(n)), take)[shared], minlength=len(n))
                first = np.concatenate([[0], np.cumsum(size)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(classes, pa.binary()), pa.array(last),
                     *[pa.array(parity[:, i].copy()) for i in range(PARITY)],
                     pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(value[at[shared]].view(np.int64)))],
                    ["doc_id", "n", "class", "last", *BITS, "early"])

    return docs.mapInArrow(sketch, f"doc_id bigint, n bigint, class binary, last bigint, {', '.join(f'{b} bigint' for b in BITS)}, "
                                   "early array<bigint>")


def parities(value: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """For each set, ``64 * PARITY`` bits: of a hash of its shingles, how many fall
    on the bit, odd or even. A shingle that only one of two sets has changes one
    bit, so two sets differ in as many shingles at least as in bits."""
    bit = (mix(value ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.int64) * (64 * PARITY) >> 32
    odd = np.bincount(row * (64 * PARITY) + bit, minlength=rows * 64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(rows, PARITY)


def segments(docs: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """The sets of the wanted (doc_id, class) rows, cut into fragments."""

    def cut_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for _, b in slices(whole):
                value, ends = shingle_sets(b.column("text"), seed)
                asked = np.frombuffer(b"".join(b.column("class").to_pylist()), np.uint8).reshape(-1, 16)
                right = (set_classes(value, ends)[:, 2:] == asked[:, 2:]).all(axis=1)
                row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                fragment = (value >> np.uint64(32)).astype(np.int64) * FRAGMENTS >> 32
                mine = right[row]
                row, fragment, value = row[mine], fragment[mine], value[mine]
                first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(fragment, prepend=-1) != 0))
                yield pa.RecordBatch.from_arrays(
                    [b.column("class").take(pa.array(row[first])), pa.array(fragment[first], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(value.view(np.int64)))],
                    ["class", "fragment", "shingles"])

    return docs.join(wanted, "doc_id").select("class", "text", F.lit(0).cast("long").alias("part")).mapInArrow(
        cut_sets, "class binary, fragment int, shingles array<bigint>")


def can_link(a: str, b: str, percent: int) -> Column:
    """Whether two sets can link by their sizes and parities; the columns of the
    two have the prefixes ``a`` and ``b``."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    apart = sum((F.bit_count(F.col(a + x).bitwiseXOR(F.col(b + x))) for x in BITS), F.lit(0))
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            # 100 * common >= percent * union, with common = (na + nb - apart) / 2 at most
            & (100 * (na + nb - apart) >= percent * (na + nb + apart)))


def early_enough(a: str, b: str, common: Column, percent: int) -> Column:
    """Whether two sets can link by the overlap of their early shingles. All
    shingles that they share up to the first end of the two are among these; of the
    others the set that ends first has no more than it has late shingles."""
    na, nb, ends_a, ends_b = (F.col(c) for c in (f"{a}n", f"{b}n", f"{a}last", f"{b}last"))

    def late(c: str) -> Column:
        return F.expr(f"({c}n * {percent} + 99) div 100 - 1")
    most = common + F.when(ends_a < ends_b, late(a)).when(ends_b < ends_a, late(b)).otherwise(F.greatest(late(a), late(b)))
    return 100 * most >= percent * (na + nb - most)


def prefixed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in columns])


def similar(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link: overlaps counted by fragment, summed by pair."""
    left = sets.select(F.col("class").alias("a"), "fragment", F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), "fragment", F.col("shingles").alias("sb"))
    partial = (near.join(left, "a").join(right, ["b", "fragment"])
               .select("a", "b", "na", "nb", "fragment", F.size(F.array_intersect("sa", "sb")).alias("common")))
    # Rows of one id and text give a segment each; they count once.
    partial = partial.groupBy("a", "b", "na", "nb", "fragment").agg(F.max("common").alias("common"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return total.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def relabelled(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (class, part) with the parts that the links join made one."""
    edges = (links.join(prefixed(parts, "a_", "class", "part"), F.col("a") == F.col("a_class"))
             .join(prefixed(parts, "b_", "class", "part"), F.col("b") == F.col("b_class")).select("a_part", "b_part"))
    roots = star_roots(edges).withColumnsRenamed({"node": "part"})
    return parts.join(roots, "part", "left").select("class", F.coalesce("root", "part").alias("part"))


def across(buckets: DataFrame, fronts: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) of classes of different components that share an early
    shingle and can link; members of a bucket's largest component meet outsiders alone.

    Partners in a large bucket are dealt over several tasks, and a member meets each of
    these. A class stands in many buckets, so what goes there is of a fixed size; the early
    shingles of a pair are looked up once it is known to meet and to be near by its parities."""
    labelled = buckets.select("shingle", "class").join(parts, "class")
    most = (labelled.groupBy("shingle", "part").count()
            .groupBy("shingle").agg(F.max(F.struct("count", "part"))["part"].alias("largest"), F.count("*").alias("parts"),
                                    F.sum("count").alias("members"))
            .where("parts > 1").select("shingle", "largest", F.expr(f"int(members div {BUCKET} + 1)").alias("salts")))
    rest = (labelled.join(most, "shingle").join(fronts.select("class", "n", *BITS), "class")
            .withColumn("salt", F.pmod(F.xxhash64("class"), F.col("salts")).cast("int")))
    facts = ("shingle", "class", "part", "n", *BITS)
    left = prefixed(rest.where("part <> largest").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))),
                    "l_", *facts, "largest", "salt")
    met = left.join(prefixed(rest, "r_", *facts, "salt"), (
        F.col("l_shingle") == F.col("r_shingle")) & (F.col("l_salt") == F.col("r_salt")) & (F.col("l_part") != F.col("r_part")) & (
        (F.col("r_part") == F.col("l_largest")) | (F.col("l_class") < F.col("r_class"))) & can_link("l_", "r_", percent))
    swap = F.col("l_class") > F.col("r_class")
    met = met.select(*[F.when(swap, F.col(f"r_{c}")).otherwise(F.col(f"l_{c}")).alias(f"a_{c}") for c in ("class", "n")],
                     *[F.when(swap, F.col(f"l_{c}")).otherwise(F.col(f"r_{c}")).alias(f"b_{c}") for c in ("class", "n")]).distinct()
    near = (met.join(prefixed(fronts, "a_", "class", "last", "early"), "a_class")
            .join(prefixed(fronts, "b_", "class", "last", "early"), "b_class")
            .where(early_enough("a_", "b_", F.size(F.array_intersect("a_early", "b_early")), percent)))
    return near.select(F.col("a_class").alias("a"), F.col("a_n").alias("na"), F.col("b_class").alias("b"), F.col("b_n").alias("nb"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """For each row of ``docs``: doc_id, n_shingles, and component_id, the smallest
    id that its document reaches over links."""
    spark = docs.sparkSession
    docs, copies = in_parts(docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")), "texts")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    folder = shared_folder(spark, "levels")
    seed = secrets.randbits(64) | 1

    def counted_shingles(texts: pa.Array) -> np.ndarray:
        value, _ = shingle_sets(texts, seed)
        return value[is_counted(value)]

    levels = counted(docs, size, counted_shingles, folder)
    full, path = written(sketches(docs, levels, percent, seed), "sketches")
    docs = docs.select("doc_id", "text")
    paths = [folder, *copies, path]

    def kept(df: DataFrame, name: str) -> DataFrame:
        df, at = written(df, name)
        paths.append(at)
        return df

    # Buckets: classes that share an early shingle, and the smallest of them.
    known = full.where("n > 0 AND doc_id IS NOT NULL")
    early = known.select("class", F.explode("early").alias("shingle")).distinct()
    shared = early.groupBy("shingle").agg(F.count("*").alias("size"), F.min("class").alias("low")).where("size > 1")
    buckets = kept(early.join(shared.select("shingle", "low"), "shingle"), "buckets")
    met = buckets.groupBy("class", "low").agg(F.collect_list("shingle").alias("early"))
    active = met.groupBy("class").agg(F.max(F.struct(F.size("early"), "low"))["low"].alias("low"),
                                      F.flatten(F.collect_list("early")).alias("early"))
    facts = known.groupBy("class").agg(*[F.min(c).alias(c) for c in ("doc_id", "n", "last", *BITS)])
    fronts = kept(active.join(facts, "class"), "fronts")

    def linked(near: DataFrame, parts: DataFrame) -> DataFrame:
        near = kept(near, "pairs")
        members = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        ids = fronts.select("doc_id", "class").join(members, "class")
        sets = kept(segments(docs, F.broadcast(ids) if near.count() <= BROADCAST_IDS // 2 else ids, seed), "sets")
        return checkpoint(relabelled(parts, similar(near, sets, percent)))

    # First each class with the smallest one of most of its buckets.
    facts = ("class", "n", *BITS)
    first = (prefixed(fronts, "b_", *facts, "low").where("b_low < b_class")
             .join(prefixed(fronts, "a_", *facts), F.col("b_low") == F.col("a_class")).where(can_link("a_", "b_", percent))
             .select(F.col("a_class").alias("a"), F.col("b_class").alias("b"), F.col("a_n").alias("na"), F.col("b_n").alias("nb")))
    parts = linked(first, fronts.select("class", F.col("class").alias("part")))

    # Then all pairs across components; a bucket's largest component only as partner.
    parts = linked(across(buckets, fronts, parts, percent), parts)

    # Classes to components, components to their smallest id; rows of one id are one document.
    part = F.coalesce("part", "class")
    of = known.select("doc_id", "class").join(parts, "class", "left").select("doc_id", part.alias("part"))
    several = of.groupBy("doc_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    if not several.isEmpty():
        edges = of.join(several, "doc_id").where("part <> low").select("low", "part")
        roots = star_roots(edges).withColumnsRenamed({"node": "part"})
        of = of.join(roots, "part", "left").select("doc_id", F.coalesce("root", "part").alias("part"))
    smallest = of.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    component = of.distinct().join(smallest, "part").select("doc_id", "component_id")
    out = checkpoint(full.select("doc_id", "n").join(component, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
    drop_written(spark, *paths)
    return out


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that link, directly or over others, with one
    of smaller id; same columns."""
    gone = near_duplicates(docs).where("component_id <> doc_id").select(F.col("doc_id").alias(free_name(docs, "id")))
    gone = gone.distinct()
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(side, docs["doc_id"] == side[gone.columns[0]], "left_anti")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate components of all documents."""
    return near_duplicates(source(spark, sf_dir, "documents", "doc_id", "text"))
