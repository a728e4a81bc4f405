"""Opening shared-storage files from inside a task."""

from __future__ import annotations

import io
from urllib.parse import unquote, urlsplit


def local_path(path: str) -> str | None:
    """The mounted path behind a plain or ``file:`` path, else None."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return unquote(parts.path) if parts.scheme else path
    return None


def open_input(path: str):
    """A seekable binary stream over a mounted or remote file."""
    from pyarrow import fs

    mounted = local_path(path)
    if mounted is not None:
        return open(mounted, "rb")
    system, inner = fs.FileSystem.from_uri(path)
    stream = system.open_input_file(inner)
    # Seeking before the start must raise OSError, as zip readers of tiny files expect.
    return io.BytesIO(stream.read()) if stream.size() < 1 << 16 else stream


def stored_bytes(spark, path: str) -> int:
    """The size of a file, or of all files of a folder, on any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
