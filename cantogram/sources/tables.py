"""Typed scans of stored datasets, lookups and marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cantogram.functions.fixed_values import (
    COUNTRY_CODES,
    YEAR_RANGE_END,
    YEAR_RANGE_START,
    YEAR_RANGE_STEP,
)
from cantogram.functions.scalars import range_bucket
from cantogram.schemas import COUNTRIES, RAW
from cantogram.sources.generations import current_path


def read_dataset(
    spark: SparkSession, folder: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """A Parquet dataset with its declared schema; nothing is inferred."""
    return open_dataset(spark, f"{folder}/{name}", schema or RAW[name])


def open_dataset(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The current rows of a dataset, written in generations or a plain Parquet folder."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(current_path(spark, path))


def read_lookup(
    spark: SparkSession,
    path: str,
    schema: StructType = COUNTRIES,
    null_value: str | None = None,
) -> DataFrame:
    """A header CSV lookup. The text ``NA`` stays text unless ``null_value`` says otherwise."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def country_lookup(spark: SparkSession) -> DataFrame:
    """The built-in country codes as (iso2, iso3, name)."""
    rows = [tuple(line.split(",", 2)) for line in COUNTRY_CODES.splitlines()]
    return spark.createDataFrame(rows, COUNTRIES)


def scan_mart(
    spark: SparkSession,
    name: str,
    where: Column | str | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """A saved mart, whole or filtered and sorted."""
    df = spark.table(name)
    if where is not None:
        df = df.filter(where)
    return df.orderBy(*order_by) if order_by else df


def filter_years(df: DataFrame, first: int, last: int) -> DataFrame:
    """Years ``first`` to ``last``, with the matching predicate on ``year_bucket``.

    The predicate on the partition column lets the scan skip whole partitions.
    Years outside the ranges live in the partition without a bucket.
    """
    bucket, step = F.col("year_bucket"), YEAR_RANGE_STEP
    low = (first - YEAR_RANGE_START) // step * step + YEAR_RANGE_START
    wanted = (bucket >= low) & (bucket <= last)
    if first < YEAR_RANGE_START or last >= YEAR_RANGE_END:
        wanted = wanted | bucket.isNull()
    return df.filter(wanted & F.col("year").between(first, last))


def years_in(df: DataFrame, years: DataFrame, column: str = "year") -> DataFrame:
    """The rows of a table stored by ``year_bucket`` whose year is listed in ``years``.

    The years are known only as the query runs: a join on the partition column hands the listed
    ranges to the scan, which then skips the other partitions. A null year is in no list; listed years
    outside the ranges are looked for in the partition without a bucket alone.
    """
    listed = years.select(F.col(column).cast("int").alias("_year")).filter("_year IS NOT NULL").distinct()
    bucketed = listed.withColumn("_bucket", range_bucket("_year", YEAR_RANGE_START, YEAR_RANGE_END, YEAR_RANGE_STEP))
    same = F.col("year").cast("int") == F.col("_year")
    inside = df.join(bucketed.filter("_bucket IS NOT NULL"), (F.col("year_bucket") == F.col("_bucket")) & same, "left_semi")
    rest = df.filter("year_bucket IS NULL").join(bucketed.filter("_bucket IS NULL"), same, "left_semi")
    return inside.unionByName(rest)


def with_year_bucket(df: DataFrame) -> DataFrame:
    """Add the decade partition column of the stored track table."""
    bucket = range_bucket("year", YEAR_RANGE_START, YEAR_RANGE_END, YEAR_RANGE_STEP)
    return df.withColumn("year_bucket", bucket)
