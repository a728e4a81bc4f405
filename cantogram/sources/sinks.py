"""Writers: datasets, saved tables, clustering, row counts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cantogram.operators.checks import CheckFailed
from cantogram.sources import generations


def observe_rows(df: DataFrame, not_null: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """The same rows, with an observation that counts them, and the nulls of some columns, as they are written."""
    seen = Observation()
    nulls = (F.count_if(F.col(c).isNull()).alias(f"nulls {c}") for c in not_null)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), seen


def _require_values(name: str, seen: Observation, not_null: Sequence[str]) -> None:
    found = [f"{name}.{c} not_null: {seen.get[f'nulls {c}']}" for c in not_null if seen.get[f"nulls {c}"]]
    if found:
        raise CheckFailed("; ".join(found))


def cluster_by(df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rows ordered so that each file holds a narrow range of the clustering columns.

    Partition columns ``within`` come first, so a task writes few of them. A hash
    of the whole row ends the range key: rows that share one clustering value,
    however many, spread over as many tasks as they fill.
    """
    hashable = [name for name, kind in df.dtypes if not kind.startswith("map")]
    keys = [*within, *columns]
    ranged = df.repartitionByRange(*keys, F.xxhash64(*hashable))
    return ranged.sortWithinPartitions(*keys)


def _stored(
    df: DataFrame, path: str, max_rows: int | None, partition_by: Sequence[str], not_null: Sequence[str] = ()
) -> tuple[str, Observation]:
    """Write a new generation of a dataset, not yet current; its id and the count of its rows."""
    spark = df.sparkSession
    counted, seen = observe_rows(df, not_null)
    writer = counted.write
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    key = generations.begin(spark, path)
    try:
        writer.parquet(generations.folder(path, key))
    except Exception:
        generations.abandon(spark, path, key)
        raise
    return key, seen


def write_dataset(
    df: DataFrame,
    path: str,
    max_rows: int | None = None,
    partition_by: Sequence[str] = (),
) -> int:
    """Replace a Parquet dataset; returns the rows written, without a second scan.

    The rows go to a generation of their own, which becomes the current one in a single step once
    the job is complete: at any moment :func:`cantogram.sources.tables.open_dataset` reads either the old rows or the new ones.
    """
    spark = df.sparkSession
    key, seen = _stored(df, path, max_rows, partition_by)
    generations.switch(spark, path, key)
    generations.clear(spark, path)
    return seen.get["rows"]


def load_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    clustering: Sequence[str] = (),
    buckets: tuple[int, Sequence[str]] | None = None,
    not_null: Sequence[str] = (),
) -> int:
    """Replace the content of a saved table; returns the rows loaded.

    All rows are stored, as a generation below ``path`` or as a table of the warehouse, before one change of the
    catalog points the name to them: readers of the name see the old rows or the new ones. ``buckets``
    is a number and the columns whose hash deals the rows to so many files, each sorted by ``clustering``.
    Nulls in ``not_null`` columns are counted as the rows are written; any of them raises before the name is pointed to
    the new rows.
    """
    spark = df.sparkSession
    if "." not in name:
        name = f"{spark.catalog.currentDatabase()}.{name}"
    generations.begin_table(spark, name)
    if buckets:
        key, seen = _bucketed(df, name, path, buckets, clustering, not_null)
    else:
        if clustering:
            df = cluster_by(df, clustering, within=partition_by)
        if path:
            key, seen = _stored(df, path, None, partition_by, not_null)
            _described(spark, generations.table_of(name, key), df, generations.folder(path, key), partition_by)
        else:
            key = uuid.uuid4().hex
            counted, seen = observe_rows(df, not_null)
            writer = counted.write.format("parquet")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.saveAsTable(generations.table_of(name, key))
    _require_values(name, seen, not_null)
    if path:
        generations.switch(spark, path, key)
    generations.switch_table(spark, name, key)
    generations.clear_table(spark, name)
    if path:
        generations.clear(spark, path)
    return seen.get["rows"]


def _bucketed(
    df: DataFrame,
    name: str,
    path: str | None,
    buckets: tuple[int, Sequence[str]],
    clustering: Sequence[str],
    not_null: Sequence[str],
) -> tuple[str, Observation]:
    """Write a bucketed generation: the rows are dealt as the buckets are, so that each is one sorted file."""
    spark, (count, columns) = df.sparkSession, buckets
    key = generations.begin(spark, path) if path else uuid.uuid4().hex
    counted, seen = observe_rows(df.repartition(count, *columns), not_null)
    writer = counted.write.format("parquet").bucketBy(count, *columns).sortBy(*(clustering or columns))
    if path:
        writer = writer.option("path", generations.folder(path, key))
    try:
        writer.saveAsTable(generations.table_of(name, key))
    except Exception:
        if path:
            generations.abandon(spark, path, key)
        raise
    return key, seen


def _described(spark: SparkSession, table: str, df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Enter a stored dataset in the catalog, with the columns of ``df``."""
    quoted = lambda c: f"`{c.replace('`', '``')}`"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path {path!r}){parts}")
    if partition_by:
        spark.catalog.recoverPartitions(table)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Register a model as a view: nothing is computed until it is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, name: str, path: str | None = None, not_null: Sequence[str] = ()) -> DataFrame:
    """Save a model as a table and return the stored rows; nulls in ``not_null`` columns raise, and the old table stays."""
    load_table(df, name, path, not_null=not_null)
    return df.sparkSession.table(name)
