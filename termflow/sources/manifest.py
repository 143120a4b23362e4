"""A Python data source for the files that a manifest lists.

Planning looks at the manifest's size alone: a partition is a range of its bytes,
and owns the lines that begin there. A task reads its range, then the files that
the lines name, one row each, in the order of the manifest. So a manifest of any
length needs no list on the driver, and a lost executor's range is read again.

Rows: ``line_at`` (the byte where the line begins, which orders the documents of all
partitions), ``doc_name`` (the line), ``value`` (the file's text) and ``error``.
Defined results: a file that is missing or cannot be read is one row with a null
value and the reason; a file named twice comes twice; an empty file has an empty
value; bytes that are no UTF-8 become U+FFFD; an empty line names nothing and gives
no row; lines end at ``\\n`` or ``\\r\\n``; an empty manifest gives no rows. A manifest
that is missing ends the query.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from termflow.session import let_workers_import

SCHEMA = "line_at bigint, doc_name string, value string, error string"
#: Bytes of the manifest in one partition: some hundreds of paths.
RANGE_BYTES = 32 << 10
#: Bytes of texts in one batch, one text at least.
BATCH_BYTES = 4 << 20
_CHUNK = 8 << 10


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """A path or URI as file system and path on it."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), re.sub(r"^file:(//[^/]*)?", "", path)
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return fs.LocalFileSystem(), os.path.abspath(path)


def lines_from(f, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """The lines of an open file that begin in [begin, end), with their positions;
    only the bytes of these are read, and the rest of the last one."""
    at, left = begin, b""
    if begin:  # the line that holds byte begin - 1 is another range's
        at = begin - 1
        f.seek(at)
        skip = True
    else:
        f.seek(0)
        skip = False
    while at < end or skip:
        stop = left.find(b"\n")
        if stop < 0:
            more = f.read(_CHUNK)
            if more:
                left += more
                continue
            if left and not skip:
                yield at, left.removesuffix(b"\r")
            return
        if not skip:
            yield at, left[:stop].removesuffix(b"\r")
        skip = False
        at, left = at + stop + 1, left[stop + 1:]


class Range(InputPartition):
    def __init__(self, begin: int, end: int):
        self.begin, self.end = begin, end


class ManifestReader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[Range]:
        system, path = _opened(self.path)
        info = system.get_file_info(path)
        if not info.is_file:
            raise FileNotFoundError(f"no manifest at {self.path}")
        return [Range(at, min(at + self.size, info.size)) for at in range(0, info.size, self.size)] or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        system, path = _opened(self.path)
        with system.open_input_file(path) as manifest:
            for at, line in lines_from(manifest, partition.begin, partition.end):
                name = line.decode("utf-8", "replace")
                if not name:
                    continue
                value, error = contents(name)
                rows.append((at, name, value, error))
                held += len(value or "")
                if held >= BATCH_BYTES or len(rows) >= 1000:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)


def contents(name: str) -> tuple[str | None, str | None]:
    """A file's text and no error, or no text and the reason."""
    try:
        system, path = _opened(name)
        with system.open_input_stream(path, compression=None) as f:
            return f.read().decode("utf-8", "replace"), None
    except (OSError, ValueError, pa.ArrowException) as e:
        return None, f"{type(e).__name__}: {e}"


def batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["line_at", "doc_name", "value", "error"])


class ManifestFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "manifest_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ManifestReader:
        return ManifestReader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)))


def listed_files(spark: SparkSession, manifest_path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The files that a manifest lists: ``line_at, doc_name, value, error``."""
    let_workers_import(spark)
    spark.dataSource.register(ManifestFiles)
    return spark.read.format("manifest_files").option("rangebytes", str(range_bytes)).load(manifest_path)
