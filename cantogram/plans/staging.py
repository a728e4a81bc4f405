"""Staging models: the cleaned form of the raw datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from cantogram.functions.scalars import nan_to_null, sentinel_to_null
from cantogram.sources.buckets import SALT

_WIDE = ("duration", "tempo", "loudness")
_SMALL = ("key", "mode", "time_signature")
_NAN_MEANS_MISSING = (
    "song_hotttnesss", "artist_hotttnesss", "artist_latitude", "artist_longitude",
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the declared order and types; a value that does not fit raises."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def stage_tracks(raw: DataFrame, known_year: bool = False) -> DataFrame:
    """One cleaned row per track: year 0 and NaN coordinates or popularity become null.

    ``known_year`` leaves out tracks without a year by a predicate on the raw
    column, which reaches the Parquet scan; one on the cleaned column does not.
    """
    if known_year:
        raw = raw.filter(F.col("year") != 0)
    return raw.select(
        "track_id",
        "title",
        "artist_name",
        "release",
        "artist_location",
        sentinel_to_null(F.col("year").cast("int"), 0).alias("year"),
        *(F.col(c).cast("double").alias(c) for c in _WIDE),
        *(F.col(c).cast("int").alias(c) for c in _SMALL),
        *(nan_to_null(F.col(c).cast("double")).alias(c) for c in _NAN_MEANS_MISSING),
    )


def stage_genres(raw: DataFrame) -> DataFrame:
    return raw.select("track_id", "genre", "minority_genre")


def stage_lyrics(raw: DataFrame) -> DataFrame:
    """Track, word and count; and the salt, where the lyrics are stored by it."""
    return raw.select("track_id", "word", "count", *[c for c in raw.columns if c == SALT])
