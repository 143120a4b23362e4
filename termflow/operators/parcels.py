"""Tables in files of the checkpoint folder, of which Spark moves references alone.

Large arrays that tasks send each other every round would stay in Spark's shuffle files until
the driver happens to collect its garbage. Here a task writes what it sends to one new file, a table
after the other, and a reference to each (file, start, size) goes through the shuffle; who gets
it reads that part of the file. A folder is deleted as soon as no reference to it is left. A task that
runs again writes another file, so references stay true.

All executors reach the folder through ``pyarrow.fs``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyarrow import fs

#: Columns of a reference.
REFERENCE = "file string, start bigint, size bigint"
NONE = pa.schema([("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())])


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    # Hadoop writes a local path as it is after the scheme, whatever its characters.
    path = re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri) if re.match(r"^\w+:", path) else (fs.LocalFileSystem(), path)


def put(folder: str, tables: Iterable[pa.Table], compression: str | None = None) -> pa.Table:
    """Write tables to a new file of the folder; a reference to each."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    name, sizes = uuid.uuid4().hex, [0]
    with system.open_output_stream(f"{path}/{name}", compression=None) as f:
        for table in tables:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=compression)) as w:
                w.write_table(table)
            data = sink.getvalue()
            f.write(data)
            sizes.append(data.size)
    return pa.table([pa.array([f"{folder}/{name}"] * (len(sizes) - 1), pa.string()), pa.array(np.cumsum(sizes)[:-1], pa.int64()),
                     pa.array(sizes[1:], pa.int64())], schema=NONE)


def get(references: pa.Table) -> list[pa.Table]:
    """The tables that were put, in order of the references."""
    found = []
    for file, start, size in zip(*[references[c].to_pylist() for c in NONE.names]):
        system, path = opened(file)
        with system.open_input_file(path) as f:
            found.append(pa.ipc.open_stream(f.read_at(size, start)).read_all())
    return found


def rows(table: pa.Table) -> Iterable[pa.Table]:
    return (table.slice(i, 1) for i in range(len(table)))
