"""Joins. No side is broadcast by hand: the optimizer does so below its size limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cantogram.operators.filters import all_of
from cantogram.sources.buckets import salted


def literal_table(spark: SparkSession, values: Sequence, name: str) -> DataFrame:
    """A one-column table of literal values."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(name))


def join_genres(df: DataFrame, genres: DataFrame, key: str = "track_id") -> DataFrame:
    """Rows of tracks or lyrics that have a genre label, with that label.

    Where both sides are stored by key and salt they meet on both, in place. Else a track that holds very many rows makes one large sort-merge partition; the
    adaptive skew join splits it, as nothing above needs the join's partitioning.
    """
    keys = salted(key, df, genres)
    return df.join(genres.select(*keys, "genre"), keys, "inner")


def join_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Each row with the columns of a one-row aggregate.

    The aggregate is a scalar subquery: Spark runs it once and hands its single
    row to the tasks. More than one row raises.
    """
    row = bounds.select(F.struct("*").alias("_row")).scalar()
    return df.withColumn("_row", row).select(
        *df.columns, *(F.col("_row").getField(c).alias(c) for c in bounds.columns)
    )


def not_in(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """SQL ``NOT IN`` against a one-column table of any length.

    A null in the list leaves no row, a null value is left out, and an empty list
    keeps everything. Written as an anti join so that a long list is shuffled
    rather than broadcast.
    """
    (name,) = listed.columns
    sizes = listed.agg(F.count(F.lit(1)).alias("n"), F.count(name).alias("known"))
    size = sizes.select(F.struct("n", "known")).scalar()
    keeps = (size.getField("n") == 0) | (
        F.col(column).isNotNull() & (size.getField("n") == size.getField("known"))
    )
    return df.filter(keeps).join(
        listed.select(F.col(name).alias(column)), column, "left_anti"
    )


def zip_tables(tables: Mapping[str, DataFrame], index: str = "row_idx") -> DataFrame:
    """Row-aligned tables side by side, matched on a stored position.

    Tables of different length raise at once; counting reads file footers where the
    tables are Parquet, other sources are scanned once more. A position that a table holds
    twice, and one of the first table that another one lacks, raise while the join
    runs. The check for repeats shares the join's shuffle and sort. Left joins keep the first
    table's partitioning, so it is shuffled once.
    """
    sizes = {name: table.count() for name, table in tables.items()}
    if len(set(sizes.values())) > 1:
        raise ValueError(f"row counts differ: {sizes}")
    joined, marks = None, []
    for name, table in tables.items():
        table = _once(table, index)
        if joined is None:
            joined = table
            continue
        marks.append(f"_has_{name}")
        joined = joined.join(table.withColumn(marks[-1], F.lit(True)), index, "left")
    if not marks:
        return joined
    complete = all_of([F.col(mark).isNotNull() for mark in marks])
    position = F.coalesce(F.col(index).cast("string"), F.lit("null"))
    failure = F.raise_error(F.concat(F.lit("no row at position "), position))
    checked = joined.filter(F.when(complete, F.lit(True)).otherwise(failure.cast("boolean")))
    return checked.drop(*marks)


def _once(table: DataFrame, index: str) -> DataFrame:
    """The same rows; a position that comes twice raises."""
    nth = F.row_number().over(Window.partitionBy(index).orderBy(index))
    position = F.coalesce(F.col(index).cast("string"), F.lit("null"))
    failure = F.raise_error(F.concat(F.lit("repeated position "), position)).cast("boolean")
    numbered = table.withColumn("_nth", nth)
    return numbered.filter(F.when(F.col("_nth") == 1, F.lit(True)).otherwise(failure)).drop("_nth")


def lookup_codes(
    df: DataFrame,
    lookup: DataFrame,
    key: str = "cc",
    code: str = "country",
    name: str = "country_name",
) -> DataFrame:
    """Country code and name of a two-letter code; an unknown code stands for both.

    A code that ``lookup`` lists more than once gives a row for each listing.
    """
    known = lookup.select(
        F.col("iso2").alias(key), F.col("iso3").alias("_code"), F.col("name").alias("_name")
    )
    return (
        df.join(known, key, "left")
        .withColumn(code, F.coalesce("_code", key))
        .withColumn(name, F.coalesce("_name", key))
        .drop("_code", "_name")
    )


def join_totals(df: DataFrame, totals: DataFrame, key: str = "country") -> DataFrame:
    return df.join(totals, key, "inner")


def join_names(
    df: DataFrame, named: DataFrame, key: str = "country", name: str = "country_name"
) -> DataFrame:
    """Rows with the distinct names of their key."""
    return df.join(named.select(key, name).distinct(), key, "inner")
