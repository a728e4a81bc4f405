"""Label files: tab-separated text with ``#`` comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cantogram.functions.scalars import (
    optional_field,
    required_field,
    split_fields,
    strip_blank,
)

FAILFAST, DROPMALFORMED = "FAILFAST", "DROPMALFORMED"


def skip_comments(lines: DataFrame, column: str = "value") -> DataFrame:
    """Drop lines that start with ``#`` once stripped."""
    return lines.filter(~F.startswith(strip_blank(column), F.lit("#")))


def parse_labels(
    lines: DataFrame,
    mode: str = FAILFAST,
    dropped: Observation | None = None,
    column: str = "value",
) -> DataFrame:
    """Lines to (track_id, genre, minority_genre).

    A line without a second field raises, or is left out with ``DROPMALFORMED``;
    ``dropped`` then receives the number of such lines as ``malformed``.
    """
    if mode not in (FAILFAST, DROPMALFORMED):
        raise ValueError(f"mode must be {FAILFAST} or {DROPMALFORMED}, not {mode!r}")
    rows = skip_comments(lines, column).select(split_fields(column).alias("fields"))
    if mode == DROPMALFORMED:
        short = F.size("fields") < 2
        if dropped is not None:
            rows = rows.observe(dropped, F.count_if(short).alias("malformed"))
        rows = rows.filter(~short)
    fields = F.col("fields")
    return rows.select(
        F.get(fields, F.lit(0)).alias("track_id"),
        required_field(fields, 1).alias("genre"),
        optional_field(fields, 2).alias("minority_genre"),
    )


def read_labels(
    spark: SparkSession,
    path: str,
    mode: str = FAILFAST,
    dropped: Observation | None = None,
) -> DataFrame:
    """Label rows of plain text files, or of the first member of zip archives."""
    from cantogram.sources.archives import read_zip_text

    if path.lower().endswith(".zip"):
        return parse_labels(read_zip_text(spark, path), mode, dropped)
    return parse_labels(spark.read.text(path), mode, dropped)
