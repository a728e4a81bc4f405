"""Aggregations. All combine on the map side, so a hot key costs no hot task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cantogram.functions.scalars import round_degrees, safe_div
from cantogram.operators.filters import select_group
from cantogram.operators.joins import join_bounds, join_totals
from cantogram.session import checkpoint_dir
from cantogram.sources.buckets import SALT, salted


@dataclass(frozen=True)
class Feature:
    """A measured column and the names its statistics get.

    ``norm`` and ``norm_std`` are set for features that are min-max scaled.
    """

    column: str
    mean: str
    std: str
    norm: str | None = None
    norm_std: str | None = None


AUDIO_FEATURES = (
    Feature("tempo", "avg_tempo", "std_tempo", "norm_tempo", "norm_std_tempo"),
    Feature("loudness", "avg_loudness", "std_loudness", "norm_loudness", "norm_std_loudness"),
    Feature("duration", "avg_duration", "std_duration", "norm_duration", "norm_std_duration"),
    Feature(
        "song_hotttnesss", "avg_hotttnesss", "std_hotttnesss",
        "norm_hotttnesss", "norm_std_hotttnesss",
    ),
    Feature("mode", "pct_major", "std_mode"),
)


def group_profile(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[Feature] = AUDIO_FEATURES,
    with_std: bool = True,
) -> DataFrame:
    """Row count, and mean and sample deviation of each feature, per key."""
    stats = [F.count(F.lit(1)).alias("track_count")]
    for feature in features:
        stats.append(F.avg(feature.column).alias(feature.mean))
        if with_std:
            stats.append(F.stddev_samp(feature.column).alias(feature.std))
    return df.groupBy(*keys).agg(*stats)


def bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``min_c`` and ``max_c`` of each column."""
    return df.agg(
        *(F.min(c).alias(f"min_{c}") for c in columns),
        *(F.max(c).alias(f"max_{c}") for c in columns),
    )


def minmax_normalize(
    df: DataFrame, features: Sequence[Feature] = AUDIO_FEATURES, with_std: bool = True
) -> DataFrame:
    """Means moved to 0..1 and deviations divided by the same range; null on a zero range.

    The bounds are taken over every statistic of the profile, not only those
    scaled: profile and bounds then ask for the same columns and share one shuffle.
    """
    scaled = [f for f in features if f.norm]
    statistics = [c for f in features for c in (f.mean, f.std) if c in df.columns]
    counts = [c for c in ("track_count",) if c in df.columns]
    limits = bounds(df, [*counts, *statistics])
    out = list(map(F.col, df.columns))
    for f in scaled:
        low, high = F.col(f"min_{f.mean}"), F.col(f"max_{f.mean}")
        out.append(safe_div(F.col(f.mean) - low, high - low).alias(f.norm))
        if with_std:
            out.append(safe_div(F.col(f.std), high - low).alias(f.norm_std))
    return join_bounds(df, limits).select(*out)


def vocab_per_track(lyrics: DataFrame, genres: DataFrame) -> DataFrame:
    """Distinct words and word total per (track, genre).

    Lyrics shrink to a row per track before they meet the labels, so no join
    partition grows with a track's words. Repeated labels of a track multiply its
    total, as they would had every word row been joined. Lyrics that are stored by track and salt shrink where they
    are, without an exchange: a word has one salt, so distinct words of the salts add up.
    """
    per_track = lyrics.groupBy(*salted("track_id", lyrics)).agg(
        F.count_distinct("word").alias("vocab_size"), F.sum("count").alias("_words")
    )
    if SALT in lyrics.columns:
        per_track = per_track.groupBy("track_id").agg(F.sum("vocab_size").alias("vocab_size"), F.sum("_words").alias("_words"))
    labels = genres.groupBy("track_id", "genre").agg(F.count(F.lit(1)).alias("_copies"))
    return per_track.join(labels, "track_id").select(
        "track_id",
        "genre",
        "vocab_size",
        (F.col("_words") * F.col("_copies")).alias("total_words"),
    )


def avg_of_ratios(per_track: DataFrame) -> DataFrame:
    """Per genre: tracks, mean vocabulary, mean total, and mean of each track's ratio."""
    ratio = safe_div("vocab_size", "total_words")
    return per_track.groupBy("genre").agg(
        F.count(F.lit(1)).alias("track_count"),
        F.avg("vocab_size").alias("avg_vocab_size"),
        F.avg("total_words").alias("avg_total_words"),
        F.avg(ratio).alias("avg_type_token_ratio"),
    )


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def word_totals(df: DataFrame) -> DataFrame:
    """Total count per (genre, word)."""
    return sum_by(df, ["genre", "word"], "count", "total_count")


def word_totals_all(ranked: DataFrame) -> DataFrame:
    """Total per word over the rows given, whichever genres they survive in."""
    return sum_by(ranked, ["word"], "total_count", "total_count")


def distinct_per_cell(
    df: DataFrame,
    lat: str = "artist_latitude",
    lon: str = "artist_longitude",
    keys: Sequence[str] = ("genre",),
    column: str = "artist_name",
    name: str = "artist_count",
    digits: int = 0,
) -> DataFrame:
    """Distinct values per rounded coordinate and key."""
    cells = df.select(
        round_degrees(lat, digits).alias("lat"),
        round_degrees(lon, digits).alias("lon"),
        *keys,
        column,
    )
    return cells.groupBy("lat", "lon", *keys).agg(F.count_distinct(column).alias(name))


def distinct_levels(df: DataFrame, levels: Mapping[str, Sequence[str]], column: str, name: str = "distinct_count") -> DataFrame:
    """(level, all level columns, count): exact distinct values of a column for several groupings, from one pass over the rows.

    Values get numbers, and each group of all columns a set of bits per 32 768 numbers. Sets of bits merge without the rows:
    a coarser level joins those of its groups. A hot group is spread over its ranges of numbers, and
    each task combines what it has before anything is shuffled. Nulls of the column are not counted; columns
    that a level does not have are null.
    """
    finest = list(dict.fromkeys(c for keys in levels.values() for c in keys))
    values = df.filter(F.col(column).isNotNull()).select(column).distinct()
    numbered = values.repartitionByRange(column).sortWithinPartitions(column).withColumn("_number", F.monotonically_increasing_id())
    checkpoint_dir(df.sparkSession)
    coded = df.select(*finest, column).join(numbered.checkpoint(), column, "left")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("_bits")
    base = coded.groupBy(*finest, F.bitmap_bucket_number("_number").alias("_range")).agg(bits).checkpoint()
    out = []
    for level, keys in levels.items():
        merged = base if set(keys) == set(finest) else base.groupBy(*keys, "_range").agg(F.bitmap_or_agg("_bits").alias("_bits"))
        counted = merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).alias(name))
        others = {c: F.lit(None).cast(df.schema[c].dataType) for c in finest if c not in keys}
        out.append(counted.withColumns({"level": F.lit(level), **others}).select("level", *finest, name))
    return reduce(DataFrame.unionByName, out)


def artists_per_country_genre(cells: DataFrame) -> DataFrame:
    """Cell counts summed per (country, genre); an artist in two cells counts twice."""
    return sum_by(cells, ["country", "genre"], "artist_count", "artist_count")


def country_totals(df: DataFrame, name: str = "total") -> DataFrame:
    return sum_by(df, ["country"], "artist_count", name)


def share_of_total(df: DataFrame, genre: str) -> DataFrame:
    """A genre's artists as percent of all artists of each country that has the genre."""
    members = country_totals(select_group(df, genre), "genre_artists")
    shares = join_totals(members, country_totals(df, "total_artists"))
    percent = safe_div("genre_artists", "total_artists") * 100
    return shares.withColumn("pct", percent)


def scale_by_max(df: DataFrame, column: str, name: str) -> DataFrame:
    """A column divided by its largest value over all rows."""
    largest = df.agg(F.max(column)).scalar()
    return df.withColumn(name, safe_div(F.col(column), largest))


def weighted_total(
    df: DataFrame, label: str, value: str, weight: str, metrics: Sequence[str]
) -> DataFrame:
    """One labelled row: the sum of weights and the weighted mean of each metric."""
    total = F.sum(weight)
    return df.agg(
        total.alias(weight),
        *(safe_div(F.sum(F.col(m) * F.col(weight)), total).alias(m) for m in metrics),
    ).select(F.lit(value).alias(label), weight, *metrics)


def count_and_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(column).alias("distinct_count"),
    )


def distinct_values(df: DataFrame, *columns: str, ordered: bool = True) -> DataFrame:
    """Distinct values or tuples, sorted by the columns unless told otherwise."""
    found = df.select(*columns).distinct()
    return found.orderBy(*columns) if ordered else found
