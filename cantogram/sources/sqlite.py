"""SQLite tables as a Spark data source, split by rowid."""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote as escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cantogram.schemas import RAW_LYRICS
from cantogram.sources.files import local_path, open_input

ROWS_PER_BATCH = 50_000
ROWS_PER_PARTITION = 500_000


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def connect(path: str):
    """A read-only connection; a file that is not mounted is read into memory."""
    mounted = local_path(path)
    if mounted is not None:
        return sqlite3.connect(f"file:{escape(mounted)}?mode=ro&immutable=1", uri=True)
    connection = sqlite3.connect(":memory:")
    with open_input(path) as stream:
        connection.deserialize(stream.read())
    return connection


def list_files(path: str) -> list[str]:
    """Files behind a path: one file, a folder of them, or a glob on mounted storage."""
    from pyarrow import fs

    mounted = local_path(path)
    if mounted is not None:
        if os.path.isdir(mounted):
            mounted = os.path.join(glob.escape(mounted), "*.db")
            return sorted(glob.glob(mounted))
        found = sorted(glob.glob(mounted)) if glob.has_magic(mounted) else [mounted]
        missing = [name for name in found if not os.path.isfile(name)]
        if missing or not found:
            raise FileNotFoundError(path)
        return found
    system, inner = fs.FileSystem.from_uri(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.Directory:
        scheme = path.split("://", 1)[0]
        found = system.get_file_info(fs.FileSelector(inner))
        return sorted(f"{scheme}://{f.path}" for f in found if f.path.endswith(".db"))
    return [path]


@dataclass
class RowRange(InputPartition):
    """Rows of one file: rowids ``low <= rowid < high``, or a slice in key order."""

    file: str
    low: int | None
    high: int | None
    by_key: tuple[str, ...] = ()


class SqliteTableReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.table = options["table"]
        self.where = options.get("where")
        self.parts = int(options.get("numpartitions", 0))
        self.rows_per_partition = int(options.get("rowsperpartition", ROWS_PER_PARTITION))

    def _split(self, low: int, high: int, files: int) -> list[tuple[int, int]]:
        """Even half-open ranges over ``[low, high)``."""
        span = high - low
        count = -(-self.parts // files) if self.parts else -(-span // self.rows_per_partition)
        count = max(1, min(count, span))
        edges = [low + span * i // count for i in range(count + 1)]
        return list(zip(edges, edges[1:]))

    def partitions(self) -> list[RowRange]:
        files = list_files(self.path)
        found: list[RowRange] = []
        for file in files:
            with connect(file) as db:
                try:
                    low, high = db.execute(
                        f"SELECT min(rowid), max(rowid) FROM {quote(self.table)}"
                    ).fetchone()
                    if low is not None:
                        found += [RowRange(file, *r) for r in self._split(low, high + 1, len(files))]
                except sqlite3.OperationalError:
                    # WITHOUT ROWID: slices of the primary key order instead.
                    info = db.execute(f"PRAGMA table_info({quote(self.table)})").fetchall()
                    key = tuple(c[1] for c in sorted((c for c in info if c[5]), key=lambda c: c[5]))
                    if not key:
                        raise
                    rows = db.execute(f"SELECT count(*) FROM {quote(self.table)}").fetchone()[0]
                    if rows:
                        found += [
                            RowRange(file, *r, key) for r in self._split(0, rows, len(files))
                        ]
            db.close()
        return found or [RowRange(files[0], None, None)] if files else []

    def read(self, partition: RowRange) -> Iterator:
        import pyarrow as pa

        if partition.low is None:
            return
        target = to_arrow_schema(self.schema)
        columns = ", ".join(quote(name) for name in self.schema.names)
        source = f"SELECT {columns} FROM {quote(self.table)}"
        if partition.by_key:
            order = ", ".join(quote(name) for name in partition.by_key)
            source = (
                f"SELECT * FROM {quote(self.table)} ORDER BY {order} "
                f"LIMIT {partition.high - partition.low} OFFSET {partition.low}"
            )
            source = f"SELECT {columns} FROM ({source})"
            if self.where:
                source += f" WHERE {self.where}"
        else:
            source += f" WHERE rowid >= {partition.low} AND rowid < {partition.high}"
            if self.where:
                source += f" AND ({self.where})"
        db = connect(partition.file)
        try:
            cursor = db.execute(source)
            while rows := cursor.fetchmany(ROWS_PER_BATCH):
                arrays = [
                    pa.array(values, type=field.type) for values, field in zip(zip(*rows), target)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
        finally:
            db.close()


class SqliteTableSource(DataSource):
    """``spark.read.format("sqlite_table")`` with ``path``, ``table`` and a schema.

    Only the columns of the schema are read. ``path`` is a file on storage all
    executors share, a folder of ``.db`` files, or a glob. Options: ``where`` (a
    filter SQLite applies), ``numPartitions``, ``rowsPerPartition``.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        return "track_id string, word string, count int"

    def reader(self, schema: StructType) -> SqliteTableReader:
        return SqliteTableReader(schema, dict(self.options))


def read_sqlite(
    spark: SparkSession,
    path: str,
    table: str,
    schema: StructType | str,
    where: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Columns of a SQLite table, read in parallel rowid ranges."""
    spark.dataSource.register(SqliteTableSource)
    reader = spark.read.format("sqlite_table").schema(schema)
    reader = reader.option("path", path).option("table", table)
    if where:
        reader = reader.option("where", where)
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load()


def read_lyrics(
    spark: SparkSession,
    path: str,
    split: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The lyrics table of a bag-of-words database; ``split`` may be "train" or "test"."""
    flags = {None: None, "train": "is_test = 0", "test": "is_test <> 0"}
    if split not in flags:
        raise ValueError(f"split must be one of {list(flags)}, not {split!r}")
    return read_sqlite(spark, path, "lyrics", RAW_LYRICS, flags[split], partitions)
