"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cantogram.functions.fixed_values import (
    FINGERPRINT_GENRES,
    PANEL_MAX_RANK,
    PANEL_MIN_LENGTH,
    STOP_WORDS,
    TREND_FIRST_YEAR,
    TREND_MIN_TRACKS,
)
from cantogram.functions.scalars import word_length


def year_known(df: DataFrame, column: str = "year") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def located_only(
    df: DataFrame, lat: str = "artist_latitude", lon: str = "artist_longitude"
) -> DataFrame:
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def drop_stop_words(
    df: DataFrame, column: str = "word", words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Drop rows whose word is listed, and rows without a word."""
    return df.filter(~F.col(column).isin(list(words)) & F.col(column).isNotNull())


def train_split(df: DataFrame, column: str = "is_test") -> DataFrame:
    """Rows of the training split."""
    return df.filter(F.col(column) == 0)


def trend_window(
    df: DataFrame, first_year: int = TREND_FIRST_YEAR, min_tracks: int = TREND_MIN_TRACKS
) -> DataFrame:
    """Years from ``first_year`` on that rest on enough tracks."""
    return df.filter((F.col("year") >= first_year) & (F.col("track_count") >= min_tracks))


def select_group(df: DataFrame, value=None, column: str = "genre") -> DataFrame:
    """One group, or everything when no group is named."""
    return df if value is None else df.filter(F.col(column) == value)


def rank_cut(df: DataFrame, k: int = PANEL_MAX_RANK, column: str = "word_rank") -> DataFrame:
    return df.filter(F.col(column) <= k)


def min_word_length(
    df: DataFrame, n: int = PANEL_MIN_LENGTH, column: str = "word"
) -> DataFrame:
    return df.filter(word_length(column) >= n)


def groups_in(
    df: DataFrame, values: Sequence[str] = FINGERPRINT_GENRES, column: str = "genre"
) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value, neither null nor NaN, in every listed column."""
    return df.dropna(subset=list(columns))


def all_of(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out
