"""WARC records in ZIP-packaged archives, read by ranges without extraction.

Each task writes archives: a ZIP file with a stored member of records, each
gzipped by itself, and a stored index of where each record lies. The reader
finds the central directory from the end of the file (through the ZIP64 records
where there are any), locates members by it and by their local headers, takes
the index, and reads each record by its own byte range, so that records are
dealt out one by one over the cluster.

Equal payloads of at least ``least`` bytes are kept once, with the largest
page_id; the other pages hold a revisit record that refers to it.

Defined results: a null html is an empty payload, kept as it is; a null url
gives no target URI; line ends in a url are percent-encoded; a page without an
id is always a response and never referred to; rows of one id and payload that
hold the largest id are all responses; an empty table writes no archive.
"""

from __future__ import annotations

import base64
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.llm.common import shared_folder, source
from termflow.llm.files import opened
from termflow.session import checkpoint

# Fixed values of the two formats.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Bytes and records after which a task begins its next archive.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64 << 20, 50_000
#: Revisits that may be broadcast: about 20 MB.
BROADCAST_REVISITS = 200_000
#: Bytes of an archive that are read at once, and that lie between records of one read.
RANGE_BYTES, GAP_BYTES = 8 << 20, 64 << 10


# --- records ---------------------------------------------------------------

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:termflow:page:{'' if page_id is None else page_id}:{digest}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP headers and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
              ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record; ``payload`` is None for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    revisit = fields["warc-type"] == "revisit"

    def page(value: str | None) -> int | None:
        number = value.split(":")[-2] if value else ""
        return int(number) if number else None

    return {"page_id": page(fields["warc-record-id"]), "record_type": fields["warc-type"],
            "refers_to": page(fields.get("warc-refers-to")), "target_uri": fields.get("warc-target-uri"),
            "declared_bytes": length, "payload": None if revisit else payload,
            "declared_digest": base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()}


# --- archives --------------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int
    stored: int
    header: int


class ZipDirectory:
    """The members of a ZIP file that is read through ``read(offset, size)``."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read = read
        tail_at = max(0, size - 65_557)
        tail = read(tail_at, size - tail_at)
        end = tail.rfind(EOCD)
        if end < 0:
            raise ValueError("no end of a central directory")
        count, length, at = struct.unpack("<HII", tail[end + 10:end + 20])
        locator = tail[end - 20:end] if end >= 20 else b""
        if locator[:4] == LOCATOR64:
            where, = struct.unpack("<Q", locator[8:16])
            record = read(where, 56)
            if record[:4] != EOCD64:
                raise ValueError("no ZIP64 end of a central directory")
            count, length, at = struct.unpack("<QQQ", record[32:56])
        self.members: dict[str, Member] = {}
        self.parse(read(at, length), count)

    def parse(self, raw: bytes, count: int) -> None:
        at = 0
        for _ in range(count):
            if raw[at:at + 4] != CENTRAL:
                raise ValueError("a damaged central directory")
            flags, method = struct.unpack("<HH", raw[at + 8:at + 12])
            stored, size, n_name, n_extra, n_comment = struct.unpack("<IIHHH", raw[at + 20:at + 34])
            header, = struct.unpack("<I", raw[at + 42:at + 46])
            name = raw[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = raw[at + 46 + n_name:at + 46 + n_name + n_extra]
            while len(extra) >= 4:
                kind, n = struct.unpack("<HH", extra[:4])
                if kind == 1:  # ZIP64: only the values that don't fit, in this order
                    values = iter(struct.unpack(f"<{n // 8}Q", extra[4:4 + n // 8 * 8]))
                    size = next(values) if size == 0xFFFFFFFF else size
                    stored = next(values) if stored == 0xFFFFFFFF else stored
                    header = next(values) if header == 0xFFFFFFFF else header
                extra = extra[4 + n:]
            self.members[name] = Member(name, method, size, stored, header)
            at += 46 + n_name + n_extra + n_comment

    def data_at(self, name: str) -> int:
        """Where a member's bytes begin."""
        m = self.members[name]
        local = self.read(m.header, 30)
        if local[:4] != LOCAL:
            raise ValueError("no local header")
        n_name, n_extra = struct.unpack("<HH", local[26:30])
        return m.header + 30 + n_name + n_extra

    def content(self, name: str) -> bytes:
        m = self.members[name]
        raw = self.read(self.data_at(name), m.stored)
        return zlib.decompress(raw, -15) if m.method == 8 else raw


class ArchiveWriter:
    """An archive that is written in one pass; the index follows the records."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, raw: bytes) -> None:
        pack = zlib.compressobj(5, wbits=31)
        part = pack.compress(raw) + pack.flush()
        self.data.write(part)
        self.lines.append(f"{self.at} {len(part)}\n")
        self.at += len(part)

    def close(self) -> int:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
            f.write("".join(self.lines).encode())
        self.zip.close()
        self.out.close()
        return len(self.lines)


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """The pages (page_id, digest) that revisit another, and which."""
    keys = pages.where(F.col("page_id").isNotNull() & (F.length("payload") >= least)).select(
        "page_id", F.sha1("payload").alias("digest"))
    last = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low"))
    return keys.join(last.where("low < refers_to"), "digest").where("page_id <> refers_to").select(
        "page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, least: int = 1000, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES, archive_records: int = ARCHIVE_RECORDS) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html). A row for
    each archive: its file and the records in it."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    again = checkpoint(revisits(pages, least))
    rows = pages.withColumn("digest", F.sha1("payload")).join(
        F.broadcast(again) if again.count() <= BROADCAST_REVISITS else again, ["page_id", "digest"], "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, number, archive = TaskContext.get(), 0, None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([archive.close()], pa.int64())})

        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in zip(*columns):
                if archive is None:
                    name = f"{folder}/pages-{context.partitionId():07d}-{number:05d}-{context.taskAttemptId()}.wacz"
                    archive, number = ArchiveWriter(name), number + 1
                archive.add(record_bytes(*row, date))
                if archive.at >= archive_bytes or len(archive.lines) >= archive_records:
                    yield closed()
                    archive = None
        if archive is not None:
            yield closed()

    return checkpoint(rows.select("page_id", "url", "payload", "digest", "refers_to")
                      .mapInArrow(write, "file string, records bigint"))


def read_index(archives: DataFrame) -> DataFrame:
    """A row for each record of the archives: its file, offset and length there."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column("file").to_pylist():
                system, path = opened(file)
                with system.open_input_file(path) as f:
                    zip_file = ZipDirectory(lambda at, size: f.read_at(size, at), f.size())
                    base = zip_file.data_at(DATA)
                    lines = [tuple(map(int, x.split())) for x in zip_file.content(INDEX).splitlines()]
                yield pa.RecordBatch.from_pydict({
                    "file": [file] * len(lines), "at": pa.array([base + a for a, _ in lines], pa.int64()),
                    "length": pa.array([n for _, n in lines], pa.int64())})

    return archives.select("file").mapInArrow(read, "file string, at bigint, length bigint")


def read_records(index: DataFrame) -> DataFrame:
    """The records at the given places: neighbouring ones are read by one range."""
    made = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                      ("target_uri", pa.string()), ("declared_bytes", pa.int64()), ("payload", pa.binary()),
                      ("declared_digest", pa.string())])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
        """Neighbouring records of a file, up to about RANGE_BYTES together: the file,
        where they end, and their places."""
        file, end, places = None, 0, []
        for b in batches:
            for name, at, length in zip(*[b.column(c).to_pylist() for c in ("file", "at", "length")]):
                if places and (name != file or at > end + GAP_BYTES or at + length - places[0][0] > RANGE_BYTES):
                    yield file, end, places
                    places = []
                file, end = name, max(at + length, end if places else 0)
                places.append((at, length))
        if places:
            yield file, end, places

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, opened_file, rows, size = None, None, [], 0
        try:
            for file, end, places in ranges(batches):
                if file != name:
                    if opened_file is not None:
                        opened_file.close()
                    system, path = opened(file)
                    name, opened_file = file, system.open_input_file(path)
                first = places[0][0]
                data = memoryview(opened_file.read_at(end - first, first))
                for at, length in places:
                    rows.append(parse_record(zlib.decompress(data[at - first:at - first + length], wbits=31)))
                    size += len(rows[-1]["payload"] or b"")
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=made)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=made)
        finally:
            if opened_file is not None:
                opened_file.close()

    # Records of one range of a file go to one task, in the order in which they stand there.
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = (index.withColumn("range", F.expr(f"at div {RANGE_BYTES}")).repartition(n, "file", "range")
             .sortWithinPartitions("file", "at").drop("range"))
    return index.mapInArrow(
        read, "page_id bigint, record_type string, refers_to bigint, target_uri string, declared_bytes bigint, "
              "payload binary, declared_digest string")


def op7_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages say of each, read back from them."""
    archives = write_archives(source(spark, sf_dir, "pages", "page_id", "url", "html"), shared_folder(spark, "warc"))
    return read_records(read_index(archives)).select(
        "page_id", F.coalesce(F.length("payload"), "declared_bytes").cast("long").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "declared_digest").alias("payload_digest"), "record_type", "refers_to")


#: The same rows from the table alone.
ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT payload_digest, max(page_id) AS last FROM k WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT k.page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, k.payload_digest,
       CASE WHEN m.last IS NULL OR k.page_id IS NULL OR m.last = k.page_id OR payload_bytes < 1000
            THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN m.last IS NULL OR k.page_id IS NULL OR m.last = k.page_id OR payload_bytes < 1000
            THEN NULL ELSE m.last END AS refers_to
FROM k LEFT JOIN m ON k.payload_digest = m.payload_digest
"""
