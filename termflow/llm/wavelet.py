"""Token ids in wavelet matrices, one compressed file for each shard.

A shard holds the ids of neighbouring documents. Its file has one bit-plane for
each bit of the largest id; in each plane the ids are ordered by the bits above
it, and a directory of one-bit counts every 512 bits gives rank and select. So
the same bits serve to read tokens anywhere, to count a token in a range and to
find its occurrences, by reads of a few bytes each, in less space than the ids.

File layout, all numbers little-endian: ``WVMATRX1``; tokens, documents, planes
(unsigned 64-bit); the documents' ids (signed 64-bit), whether each id is null
(a byte each), and where each document ends (unsigned 64-bit); the zeros of each
plane (unsigned 64-bit); then for each plane its directory (unsigned 32-bit
counts before each block of 512 bits, one more than there are blocks) and its
bits, most significant bit first, padded to 64 bytes.

Defined results: a null or empty text holds the end id alone; documents follow
their ids (null ids first), rows of one id their texts' hash; repeated rows are
all kept; an empty table gives no files and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.llm.common import shared_folder, source, whole_text
from termflow.llm.files import opened, write_file
from termflow.llm.library import ids_with_end
from termflow.session import checkpoint

MAGIC = b"WVMATRX1"
BLOCK = 512
#: Tokens after which a task begins its next file.
SHARD_TOKENS = 4 << 20


def build(ids: np.ndarray) -> tuple[list[np.ndarray], list[int], int]:
    """The packed planes of an array of ids, each plane's zeros, and their number."""
    planes, zeros = [], []
    height = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    now = ids.astype(np.uint16 if height <= 16 else np.uint32)
    for level in range(height - 1, -1, -1):
        one = (now & now.dtype.type(1 << level)).astype(bool)
        planes.append(np.packbits(one))
        low, high = np.flatnonzero(~one), np.flatnonzero(one)
        zeros.append(len(low))
        now = np.concatenate([now.take(low), now.take(high)])
    return planes, zeros, height


def restore(planes: list[np.ndarray], zeros: list[int], n: int) -> np.ndarray:
    """All ids of a shard, from the last plane up."""
    height = len(planes)
    now = np.zeros(n, np.uint16 if height <= 16 else np.uint32)
    for level, (plane, z) in enumerate(zip(reversed(planes), reversed(zeros))):
        one = np.unpackbits(plane, count=n).view(bool)
        now[z:] |= now.dtype.type(1 << level)
        before = np.empty_like(now)
        before[one] = now[z:]
        np.logical_not(one, out=one)
        before[one] = now[:z]
        now = before
    return now


def directory(plane: np.ndarray) -> tuple[bytes, bytes]:
    """A plane's counts before each block, and its bits padded to whole blocks."""
    bits = np.zeros(-(-len(plane) * 8 // BLOCK) * BLOCK // 8, np.uint8)
    bits[:len(plane)] = plane
    counts = np.bitwise_count(bits.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1)
    return np.concatenate([[0], np.cumsum(counts)]).astype("<u4").tobytes(), bits.tobytes()


def shard_bytes(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> list[bytes]:
    """The parts of a shard's file."""
    planes, zeros, height = build(ids)
    parts = [MAGIC, np.array([len(ids), len(doc_ids), height], "<u8").tobytes(),
             np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids),
             np.asarray(ends).astype("<u8").tobytes(), np.array(zeros, "<u8").tobytes()]
    for p in planes:
        parts += directory(p)
    return parts


class WaveletMatrix:
    """A shard read through ``read(offset, size)``; token queries read only the
    blocks they need, :meth:`tokens` all planes."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        head = read(0, 32)
        if head[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self.n, self.docs, self.height = map(int, np.frombuffer(head[8:], "<u8"))
        at = 32
        raw = read(at, 17 * self.docs + 8 * self.height)
        ids = np.frombuffer(raw, "<i8", self.docs).tolist()
        null = raw[8 * self.docs:9 * self.docs]
        self.doc_ids = [None if z else i for i, z in zip(ids, null)]
        self.ends = np.frombuffer(raw, "<u8", self.docs, 9 * self.docs).astype(np.int64)
        self.zeros = np.frombuffer(raw, "<u8", self.height, 17 * self.docs).astype(np.int64).tolist()
        at += len(raw)
        blocks = -(-self.n // BLOCK)
        step = 4 * (blocks + 1) + blocks * BLOCK // 8
        self.at = [at + k * step for k in range(self.height)]
        self.bits_at = [a + 4 * (blocks + 1) for a in self.at]

    def tokens(self) -> np.ndarray:
        """All tokens, decoded at once."""
        size = -(-self.n // 8)
        return restore([np.frombuffer(self.read(a, size), np.uint8) for a in self.bits_at], self.zeros, self.n)

    def ones(self, plane: int, i: int) -> int:
        """The one bits of a plane before position ``i``."""
        block, left = divmod(i, BLOCK)
        count = int(np.frombuffer(self.read(self.at[plane] + 4 * block, 4), "<u4")[0])
        if left:
            bits = np.unpackbits(np.frombuffer(self.read(self.bits_at[plane] + block * BLOCK // 8, -(-left // 8)), np.uint8))
            count += int(bits[:left].sum())
        return count

    def bit(self, plane: int, i: int) -> int:
        return self.read(self.bits_at[plane] + i // 8, 1)[0] >> 7 - i % 8 & 1

    def access(self, i: int) -> int:
        """The token at a position."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for p in range(self.height):
            one, before = self.bit(p, i), self.ones(p, i)
            token = token << 1 | one
            i = self.zeros[p] + before if one else i - before
        return token

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often a token occurs in a range of positions."""
        a, b, _ = self.range_of(token, start, self.n if end is None else end)
        return b - a

    def range_of(self, token: int, a: int, b: int) -> tuple[int, int, list[tuple[int, int]]]:
        if token >> self.height or token < 0 or a >= b:
            return 0, 0, []
        path, low = [], 0
        for p in range(self.height):
            one = token >> self.height - 1 - p & 1
            a, b, low = [self.zeros[p] + self.ones(p, x) if one else x - self.ones(p, x) for x in (a, b, low)]
            path.append((p, one))
        return a, b, path

    def select(self, token: int, k: int) -> int:
        """The position of a token's ``k``-th occurrence, from 0."""
        a, b, path = self.range_of(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for p, one in reversed(path):
            i = self.find(p, one, i - self.zeros[p] if one else i)
        return i

    def find(self, plane: int, one: int, k: int) -> int:
        """The position of the ``k``-th bit of a kind, by binary search over ranks."""
        low, high = 0, self.n
        while high - low > 1:
            mid = (low + high) // 2
            ones = self.ones(plane, mid)
            if (ones if one else mid - ones) <= k:
                low = mid
            else:
                high = mid
        return low


def file_reader(uri: str) -> Callable[[int, int], bytes]:
    """Reads of byte ranges of a file, wherever it lies."""
    system, path = opened(uri)
    f = system.open_input_file(path)
    return lambda at, size: f.read_at(size, at)


def write_shards(docs: DataFrame, folder: str, path: str, end: int, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the ids of all texts, in order of doc_id, as shards. A row for each
    shard: its file, the task that wrote it and its number there, documents, tokens."""
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
               .repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task, number = context.partitionId(), 0
        ids, doc_ids, ends, n = [], [], [], 0

        def shard() -> pa.RecordBatch:
            name = f"{folder}/shard-{task:07d}-{number:05d}-{context.taskAttemptId()}.wvm"
            write_file(name, shard_bytes(np.concatenate(ids), doc_ids, np.concatenate(ends)))
            return pa.RecordBatch.from_pylist([{"task": task, "number": number, "file": name,
                                                "docs": len(doc_ids), "tokens": n}], schema=made)

        made = pa.schema([("task", pa.int32()), ("number", pa.int32()), ("file", pa.string()),
                          ("docs", pa.int64()), ("tokens", pa.int64())])
        for b in batches:
            flat, first = ids_with_end(b.column("text"), path, end)
            ids.append(flat)
            doc_ids += b.column("doc_id").to_pylist()
            ends.append(first[1:] + n)
            n += len(flat)
            if n >= shard_tokens:
                yield shard()
                ids, doc_ids, ends, n, number = [], [], [], 0, number + 1
        if doc_ids:
            yield shard()

    return checkpoint(ordered.mapInArrow(write, "task int, number int, file string, docs bigint, tokens bigint"))


def shard_starts(shards: DataFrame) -> DataFrame:
    """The shards with the tokens before each. Sums of tasks, one number for each,
    meet at the driver; shards follow from them within their task."""
    from pyspark.sql import Window

    before, rows = 0, []
    for r in shards.groupBy("task").agg(F.sum("tokens").alias("n")).orderBy("task").toLocalIterator():
        rows.append((r["task"], before))
        before += r["n"]
    tasks = shards.sparkSession.createDataFrame(rows, "task int, before bigint")
    within = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (shards.withColumn("within", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
            .join(F.broadcast(tasks), "task").select("file", "tokens", (F.col("before") + F.col("within")).alias("start")))


def read_documents(shards: DataFrame) -> DataFrame:
    """A row for each document of the shards (file, start): its id, the tokens
    before it in all shards, its tokens and their CRC-32, decoded from the file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist()):
                m = WaveletMatrix(file_reader(file))
                ids = m.tokens().astype("<u4")
                begin = np.concatenate([[0], m.ends])[:-1]
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(begin.tolist(), m.ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m.doc_ids, pa.int64()), pa.array(begin + start), pa.array(m.ends - begin),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (shards.select("file", "start").repartition(n)
            .mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def op9_wavelet_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of all documents, read back from wavelet matrix files."""
    import public_tokenizers

    shards = write_shards(source(spark, sf_dir, "documents", "doc_id", "text"), shared_folder(spark, "wavelet"),
                          public_tokenizers.path("word_bpe_49k.json"), 2)
    return read_documents(shard_starts(shards))
