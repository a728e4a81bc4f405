"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cantogram.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back: its lineage ends here.

    A lost executor costs no recomputation of what is stored. The files go when the session ends,
    or earlier through ``discard``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    _folder(spark, path, "deleteOnExit")  # only a folder that exists can be marked
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files as they end, not when the driver next collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later plan reads."""
    for df in tables:
        if path := getattr(df, "_scratch", None):
            _folder(df.sparkSession, path, "delete")


def _folder(spark: SparkSession, path: str, action: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if action == "delete":
        files.delete(where, True)
    else:
        files.deleteOnExit(where)
