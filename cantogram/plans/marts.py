"""The six marts, each a short composition of operators over staged tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cantogram.functions.fixed_values import PANEL_MAX_RANK, STOP_WORDS
from cantogram.operators.aggregates import (
    AUDIO_FEATURES,
    avg_of_ratios,
    distinct_per_cell,
    group_profile,
    minmax_normalize,
    vocab_per_track,
    word_totals,
)
from cantogram.operators.filters import drop_stop_words, located_only, year_known
from cantogram.operators.joins import join_genres
from cantogram.operators.ranking import order_by_keys, rank_within, top_within


def features_by_year(tracks: DataFrame) -> DataFrame:
    """Yearly means and deviations of the audio features, raw and scaled."""
    yearly = group_profile(year_known(tracks), ["year"])
    return order_by_keys(minmax_normalize(yearly), "year")


def features_by_year_genre(tracks: DataFrame, genres: DataFrame) -> DataFrame:
    """The same per year and genre, scaled by the bounds of all (year, genre) rows."""
    labelled = join_genres(year_known(tracks), genres)
    profile = group_profile(labelled, ["year", "genre"])
    return order_by_keys(minmax_normalize(profile), "year", "genre")


def pass_through_major(df: DataFrame) -> DataFrame:
    """``pct_major`` under the name of a scaled column; a share needs no scaling."""
    return df.withColumnRenamed("pct_major", "norm_pct_major")


def genre_fingerprints(tracks: DataFrame, genres: DataFrame) -> DataFrame:
    """Mean features per genre, raw and scaled, over tracks of any or no year."""
    profile = group_profile(join_genres(tracks, genres), ["genre"], with_std=False)
    scaled = pass_through_major(minmax_normalize(profile, with_std=False))
    features = [f for f in AUDIO_FEATURES if f.norm]
    return scaled.select(
        "genre",
        "track_count",
        *(f.mean for f in features),
        *(f.norm for f in features),
        "norm_pct_major",
    )


def genre_by_location(tracks: DataFrame, genres: DataFrame, digits: int = 0) -> DataFrame:
    """Distinct artists per rounded coordinate and genre."""
    return distinct_per_cell(join_genres(located_only(tracks), genres), digits=digits)


def lyrical_diversity(lyrics: DataFrame, genres: DataFrame) -> DataFrame:
    """Vocabulary size, length, and mean word variety per genre."""
    return avg_of_ratios(vocab_per_track(lyrics, genres))


def _genre_word_totals(
    lyrics: DataFrame, genres: DataFrame, stop_words: Sequence[str]
) -> DataFrame:
    return word_totals(join_genres(drop_stop_words(lyrics, "word", stop_words), genres))


def top_words(
    lyrics: DataFrame, genres: DataFrame, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """All words of each genre with their total and rank."""
    totals = _genre_word_totals(lyrics, genres, stop_words)
    return rank_within(totals, ["genre"], "total_count", "word", "word_rank")


def top_words_cut(
    lyrics: DataFrame,
    genres: DataFrame,
    k: int = PANEL_MAX_RANK,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Only the first ``k`` words of each genre, in one plan without the full ranking."""
    totals = _genre_word_totals(lyrics, genres, stop_words)
    return top_within(totals, ["genre"], "total_count", "word", k, "word_rank")
