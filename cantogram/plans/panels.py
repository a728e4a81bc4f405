"""Panel tables: what the plots show, computed from the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cantogram.functions.fixed_values import (
    DIVERSITY_METRICS,
    FINGERPRINT_GENRES,
    PANEL_MAX_RANK,
    PANEL_MIN_LENGTH,
    PANEL_WORDS,
    TREND_FIRST_YEAR,
    TREND_MIN_TRACKS,
)
from cantogram.functions.scalars import band_edges
from cantogram.operators.aggregates import (
    artists_per_country_genre,
    country_totals,
    share_of_total,
    sum_by,
    weighted_total,
    word_totals_all,
)
from cantogram.operators.filters import (
    groups_in,
    min_word_length,
    rank_cut,
    select_group,
    trend_window,
)
from cantogram.operators.joins import join_names, join_totals, lookup_codes
from cantogram.operators.nearest import nearest_join
from cantogram.operators.ranking import argmax_by, top_by_rank, top_k, union_total_row
from cantogram.operators.series import (
    FINGERPRINT_SERIES,
    TREND_SERIES,
    feature_series,
    rescale,
)


def trend(
    by_year: DataFrame,
    by_year_genre: DataFrame,
    genre: str | None = None,
    first_year: int = TREND_FIRST_YEAR,
    min_tracks: int = TREND_MIN_TRACKS,
) -> DataFrame:
    """Feature series over the years with their band, for all tracks or one genre.

    A row whose deviation is missing keeps its value and has no band.
    """
    source = by_year if genre is None else select_group(by_year_genre, genre)
    long = feature_series(trend_window(source, first_year, min_tracks), ["year"], TREND_SERIES)
    lower, upper = band_edges("value", "std", "track_count")
    return long.withColumn("lower", lower).withColumn("upper", upper)


def fingerprint(
    fingerprints: DataFrame, genres: Sequence[str] = FINGERPRINT_GENRES
) -> DataFrame:
    """Radar values of the chosen genres."""
    long = feature_series(groups_in(fingerprints, genres), ["genre"], FINGERPRINT_SERIES)
    return long.drop("std", "track_count")


def words(
    top_words: DataFrame,
    genre: str | None = None,
    min_length: int = PANEL_MIN_LENGTH,
    k: int = PANEL_WORDS,
    max_rank: int = PANEL_MAX_RANK,
) -> DataFrame:
    """The most used words of one genre, or over all genres.

    The length cut follows the rank cut, so fewer than ``k`` words may be left.
    """
    kept = min_word_length(rank_cut(top_words, max_rank), min_length)
    if genre is None:
        return top_k(word_totals_all(kept), "total_count", "word", k)
    return top_by_rank(select_group(kept, genre), "word_rank", k).select("word", "total_count")


def diversity(lyrical_diversity: DataFrame, metric: str = DIVERSITY_METRICS[0]) -> DataFrame:
    """Genres by a metric, after one row for all genres weighted by tracks."""
    if metric not in DIVERSITY_METRICS:
        raise ValueError(f"metric must be one of {list(DIVERSITY_METRICS)}, not {metric!r}")
    total = weighted_total(lyrical_diversity, "genre", "All", "track_count", DIVERSITY_METRICS)
    rows = lyrical_diversity.select(*total.columns)
    return union_total_row(total, rows, metric)


def add_countries(cells: DataFrame, places: DataFrame, countries: DataFrame) -> DataFrame:
    """Country code and name of each cell, from the place nearest to it."""
    return lookup_codes(nearest_join(cells, places), countries).drop(
        "place_id", "cc", "distance_km"
    )


def _per_country(cells: DataFrame, places: DataFrame, countries: DataFrame) -> DataFrame:
    """Artists per (country, name, genre): the small table both maps are made of.

    It is read three times, so it is checkpointed.
    """
    located = add_countries(cells, places, countries)
    return sum_by(
        located, ["country", "country_name", "genre"], "artist_count", "artist_count"
    ).checkpoint()


def dominant_genre(cells: DataFrame, places: DataFrame, countries: DataFrame) -> DataFrame:
    """Per country: its largest genre, that genre's artists, and the country's total."""
    located = _per_country(cells, places, countries)
    by_genre = artists_per_country_genre(located)
    largest = argmax_by(by_genre, "country", "artist_count", "genre")
    scaled = rescale(join_totals(largest, country_totals(by_genre)), "total")
    return join_names(scaled, located).select(
        "country", "country_name", "genre", "artist_count", "total", "norm_total", "opacity"
    )


def genre_share(
    cells: DataFrame, genre: str, places: DataFrame, countries: DataFrame
) -> DataFrame:
    """Per country with the genre: its artists there, all artists, and the percentage."""
    located = _per_country(cells, places, countries)
    return join_names(share_of_total(located, genre), located).select(
        "country", "country_name", "genre_artists", "total_artists", "pct"
    )
