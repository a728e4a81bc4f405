"""Raw files for the reader queries, written from derived tables by Spark tasks.

Each partition becomes one archive or database of its own in the shared folder.
"""

from __future__ import annotations

import io
import os
import sqlite3
import uuid
import zipfile
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cantogram.sources.files import local_path
from cantogram.sources.sqlite import quote


def write_once(path: str, content: bytes) -> None:
    """Write a file under a name of its own, then move it to its final name.

    A task that is run again replaces its own file with equal content.
    """
    from pyarrow import fs

    mounted = local_path(path)
    if mounted is not None:
        system, inner = fs.LocalFileSystem(), mounted
    else:
        system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(inner), recursive=True)
    draft = os.path.join(
        os.path.dirname(inner), f"_{uuid.uuid4().hex}.{os.path.basename(inner)}.part"
    )
    with system.open_output_stream(draft) as out:
        out.write(content)
    system.move(draft, inner)


def write_zip_parts(lines: DataFrame, folder: str, column: str = "value") -> int:
    """Write each partition's lines as one zip below ``folder``; returns the lines written."""

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count, buffer = 0, io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            with archive.open("lines.txt", "w") as member:
                for part in batches:
                    for line in part.column(0).to_pylist():
                        member.write(line.encode("utf-8") + b"\n")
                        count += 1
        index = TaskContext.get().partitionId()
        write_once(f"{folder}/part-{index:05d}.zip", buffer.getvalue())
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["lines"])

    written = lines.select(column).mapInArrow(pack, "lines long")
    return written.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]


def write_sqlite_parts(df: DataFrame, folder: str, table: str) -> int:
    """Write each partition as one SQLite file below ``folder``; returns the rows written."""
    kinds = {"string": "TEXT", "double": "REAL", "float": "REAL"}
    columns = ", ".join(f"{quote(n)} {kinds.get(t, 'INTEGER')}" for n, t in df.dtypes)
    marks = ", ".join("?" * len(df.columns))

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count, db = 0, sqlite3.connect(":memory:")
        db.execute(f"CREATE TABLE {quote(table)} ({columns})")
        for part in batches:
            rows = zip(*(column.to_pylist() for column in part.columns))
            db.executemany(f"INSERT INTO {quote(table)} VALUES ({marks})", rows)
            count += part.num_rows
        db.commit()
        index = TaskContext.get().partitionId()
        write_once(f"{folder}/part-{index:05d}.db", db.serialize())
        db.close()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["rows"])

    return df.mapInArrow(pack, "rows long").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
