"""Files of our own formats in the folder that driver and executors share."""

from __future__ import annotations

import re

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    uri = re.sub(r"^file:/*", "file:///", uri)
    if not re.match(r"^\w+:", uri):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, parts: list[bytes], final: str | None = None) -> int:
    """Write a new file in one go; its size. With ``final``, it gets that name when it
    is whole; a whole file of that name is as good."""
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as f:
        for p in parts:
            f.write(p)
        size = f.tell()
    if final is not None:
        try:
            system.move(path, opened(final)[1])
        except OSError:
            if not system.get_file_info(opened(final)[1]).is_file:
                raise
            system.delete_file(path)
    return size
