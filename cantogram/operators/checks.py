"""Data checks and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cantogram.operators.aggregates import count_and_distinct
from cantogram.operators.filters import all_of
from cantogram.operators.ranking import preview_rows
from cantogram.sources.buckets import SALT
from cantogram.sources.generations import is_generation


@dataclass(frozen=True)
class Rules:
    """Checks of one table: columns without nulls, and keys without repeats.

    ``placed`` names columns that every key of ``unique`` determines; a table that is stored by them is grouped where it is.
    """

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    placed: Sequence[str] = ()


_KEY = ("track_id",)

SOURCE_RULES = {
    "tracks": Rules(["track_id"], [_KEY]),
    "genres": Rules(["track_id", "genre"], [_KEY]),
    "lyrics": Rules(["track_id", "word"]),
}

# The composite keys are stated for these tables; checking them is an addition.
STAGING_RULES = {
    "stg_tracks": Rules(["track_id"], [_KEY]),
    "stg_genres": Rules(["track_id", "genre"], [_KEY]),
    "stg_lyrics": Rules(["track_id", "word"], [("track_id", "word")], [SALT]),
}

MART_RULES = {
    "features_by_year": Rules(["year", "track_count"], [("year",)]),
    "features_by_year_genre": Rules(["year", "genre", "track_count"], [("year", "genre")]),
    "genre_fingerprints": Rules(["genre", "track_count"], [("genre",)]),
    "top_words": Rules(["genre", "word", "total_count", "word_rank"]),
    "lyrical_diversity": Rules(
        ["genre", "track_count", "avg_vocab_size", "avg_total_words", "avg_type_token_ratio"],
        [("genre",)],
    ),
    "genre_by_location": Rules(["lat", "lon", "genre", "artist_count"]),
}


class CheckFailed(RuntimeError):
    """Raised when a data check counts failing rows."""


def check_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """(column, failures): rows without a value, all columns in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def check_unique(df: DataFrame, *columns: str, placed: Sequence[str] = ()) -> DataFrame:
    """Values, none of them null, that occur more than once, with their count.

    ``placed`` are columns that the key determines: grouping by them too changes nothing, and a table
    that is stored by them and a part of the key needs no exchange.
    """
    known = df.filter(all_of([F.col(c).isNotNull() for c in columns]))
    counted = known.groupBy(*columns, *placed).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1).select(*columns, "copies")


def _keyed_checks(df: DataFrame, rule: Rules) -> DataFrame:
    """(column, check, failures) of a rule's first key and all its columns without nulls, from one grouping by that key.

    A group without a null counts for the key; a column of the key is null in whole groups, another one in some rows of a group.
    """
    key = rule.unique[0]
    placed = [c for c in rule.placed if c in df.columns]
    others = [c for c in rule.not_null if c not in key]
    counted = df.groupBy(*key, *placed).agg(
        F.count(F.lit(1)).alias("_copies"), *(F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in others)
    )
    known = all_of([F.col(c).isNotNull() for c in key])
    zero = F.lit(0).cast("long")
    sums = [(", ".join(key), "unique", F.count_if(known & (F.col("_copies") > 1)))]
    for c in rule.not_null:
        nulls = F.sum(f"_nulls_{c}") if c in others else F.sum(F.when(F.col(c).isNull(), F.col("_copies")))
        sums.append((c, "not_null", F.coalesce(nulls, zero)))
    row = counted.agg(*(failures.alias(f"f{i}") for i, (_, _, failures) in enumerate(sums)))
    lines = [F.struct(F.lit(c).alias("column"), F.lit(check).alias("check"), F.col(f"f{i}").alias("failures")) for i, (c, check, _) in enumerate(sums)]
    return row.select(F.inline(F.array(*lines)))


def run_checks(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """(table, column, check, failures) for every rule. A table with a key is read once for it and for its null counts."""
    parts = []
    for name, rule in rules.items():
        df = tables[name]
        if rule.unique:
            parts.append(_keyed_checks(df, rule).select(F.lit(name).alias("table"), "column", "check", "failures"))
        elif rule.not_null:
            parts.append(
                check_not_null(df, *rule.not_null).select(
                    F.lit(name).alias("table"), "column", F.lit("not_null").alias("check"),
                    "failures",
                )
            )
        for key in rule.unique[1:]:
            placed = [c for c in rule.placed if c in df.columns]
            parts.append(
                check_unique(df, *key, placed=placed).agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(name).alias("table"), F.lit(", ".join(key)).alias("column"),
                    F.lit("unique").alias("check"), "failures",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def require_passed(report: DataFrame) -> None:
    """Raise if a check of the report counted failures. A report has one row per rule."""
    failed = report.filter(F.col("failures") > 0).collect()
    if failed:
        lines = [f"{r.table}.{r.column} {r.check}: {r.failures}" for r in failed]
        raise CheckFailed("; ".join(lines))


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, row_count) of each table."""
    parts = []
    for name, df in tables.items():
        columns = [
            F.struct(
                F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type")
            )
            for i, (c, t) in enumerate(df.dtypes)
        ]
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(
            counted.select(F.lit(name).alias("table"), "row_count", F.inline(F.array(*columns)))
        )
    return reduce(DataFrame.unionByName, parts)


def list_tables(
    spark: SparkSession, pattern: str | None = None, n: int = 5, key: str = "track_id"
) -> DataFrame:
    """Each table of the catalog with its rows, distinct keys, and ``n`` rows as JSON."""
    parts = []
    for entry in spark.catalog.listTables(pattern=pattern):
        if is_generation(entry.name):
            continue
        df = spark.table(entry.name)
        if key in df.columns:
            counted = count_and_distinct(df, key)
        else:
            counted = df.agg(
                F.count(F.lit(1)).alias("row_count"), F.lit(None).cast("long").alias("distinct_count")
            )
        sample = preview_rows(df, n).agg(
            F.collect_list(F.to_json(F.struct("*"))).alias("preview")
        )
        parts.append(
            counted.select(F.lit(entry.name).alias("table"), "row_count", "distinct_count")
            .withColumn("preview", sample.scalar())
        )
    if not parts:
        raise ValueError(f"no tables match {pattern!r}")
    return reduce(DataFrame.unionByName, parts)
