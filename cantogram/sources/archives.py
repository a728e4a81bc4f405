"""Zip archives as text lines."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from cantogram.sources.files import open_input

LINES_PER_BATCH = 50_000


def _first_member_lines(batches: Iterator) -> Iterator:
    import pyarrow as pa

    def batch(lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    for paths in batches:
        for path in paths.column(0).to_pylist():
            with open_input(path) as raw, zipfile.ZipFile(raw) as archive:
                members = archive.namelist()
                if not members:
                    continue
                with archive.open(members[0]) as member:
                    lines: list[str] = []
                    for line in io.BufferedReader(member, 1 << 20):
                        lines.append(line.removesuffix(b"\n").decode("utf-8"))
                        if len(lines) == LINES_PER_BATCH:
                            yield batch(lines)
                            lines = []
                    if lines:
                        yield batch(lines)


def read_zip_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the first member of each archive, as column ``value``.

    Spark lists the archives and spreads them over tasks; only their paths go to
    Python, where each archive is streamed in bounded batches. Text that is not
    UTF-8 raises.
    """
    archives = spark.read.format("binaryFile").load(path).select("path")
    return archives.mapInArrow(_first_member_lines, "value string")
