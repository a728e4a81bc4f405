"""Filters, joins, aggregates, series on hand-made frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cantogram.operators import aggregates as A
from cantogram.operators import filters as K
from cantogram.operators import joins as J
from cantogram.operators.series import (
    TREND_SERIES,
    Series,
    confidence_band,
    feature_series,
    rescale,
)
from tests.conftest import rows

NAN = float("nan")


# Filters


def test_stop_words_and_null_words_are_dropped(spark):
    df = spark.createDataFrame([("the",), ("love",), (None,), ("The",)], "word string")
    assert rows(K.drop_stop_words(df)) == [("The",), ("love",)]
    assert rows(K.drop_stop_words(df, words=["love"])) == [("The",), ("the",)]


def test_simple_filters(spark):
    df = spark.createDataFrame(
        [(1919, "a", 90), (1920, "a", 50), (1990, "b", 49), (None, "b", 99)],
        "year int, genre string, track_count long",
    )
    assert rows(K.trend_window(df)) == [(1920, "a", 50)]
    assert K.year_known(df).count() == 3
    assert K.select_group(df, "b").count() == 2 and K.select_group(df).count() == 4
    assert rows(K.groups_in(df, ["b", "z"]).select("genre")) == [("b",), ("b",)]
    assert K.rank_cut(df.withColumn("word_rank", F.lit(20))).count() == 4
    assert K.rank_cut(df.withColumn("word_rank", F.lit(21))).count() == 0


def test_location_and_null_filters(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (None, 2.0), (1.0, None), (NAN, 1.0)], "lat double, lon double"
    )
    assert K.located_only(df, "lat", "lon").count() == 2  # NaN is cleaned in staging
    assert rows(K.drop_null_rows(df, ["lat", "lon"])) == [(1.0, 2.0)]


def test_min_word_length_and_split(spark):
    df = spark.createDataFrame([("né", 0), ("chat", 1)], "word string, is_test int")
    assert rows(K.min_word_length(df, 2)) == rows(df)
    assert rows(K.min_word_length(df, 3)) == [("chat", 1)]
    assert rows(K.train_split(df)) == [("né", 0)]


# Joins


def listed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "listed string")


def test_not_in_follows_sql(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "word string")
    for values in (["a"], ["a", None], [], ["a", "a", "z"]):
        table = listed(spark, values)
        df.createOrReplaceTempView("not_in_left")
        table.createOrReplaceTempView("not_in_right")
        want = spark.sql(
            "SELECT * FROM not_in_left WHERE word NOT IN (SELECT listed FROM not_in_right)"
        )
        assert rows(J.not_in(df, "word", table)) == rows(want), values


def test_join_bounds_attaches_one_row_and_refuses_more(spark):
    df = spark.createDataFrame([(1,), (3,)], "v int")
    got = J.join_bounds(df, A.bounds(df, ["v"]))
    assert rows(got) == [(1, 1, 3), (3, 1, 3)]
    with pytest.raises(Exception, match="[Mm]ore than one row"):
        J.join_bounds(df, df.withColumnRenamed("v", "w")).collect()


def test_zip_tables(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y")], "row_idx long, a string")
    b = spark.createDataFrame([(1, 10), (0, 20)], "row_idx long, b int")
    assert rows(J.zip_tables({"a": a, "b": b})) == [(0, "x", 20), (1, "y", 10)]
    with pytest.raises(ValueError, match="row counts differ"):
        J.zip_tables({"a": a, "b": b.limit(1)})
    shifted = b.withColumn("row_idx", F.col("row_idx") + 1)
    with pytest.raises(Exception, match="no row at position 0"):
        J.zip_tables({"a": a, "b": shifted}).collect()
    for twice in ({"a": b.withColumn("row_idx", F.lit(0)), "b": a}, {"a": a, "b": b.withColumn("row_idx", F.lit(1))}):
        with pytest.raises(Exception, match="repeated position|no row at position"):
            J.zip_tables(twice).collect()
    same = a.withColumn("row_idx", F.lit(0))
    with pytest.raises(Exception, match="repeated position 0"):
        J.zip_tables({"a": same, "b": same.withColumnRenamed("a", "b")}).collect()


def test_lookup_falls_back_to_the_code(spark):
    df = spark.createDataFrame([("FR",), ("ZZ",), ("NA",), (None,)], "cc string")
    from cantogram.sources.tables import country_lookup

    got = rows(J.lookup_codes(df, country_lookup(spark)))
    assert got == [
        ("FR", "FRA", "France"), ("NA", "NAM", "Namibia"), ("ZZ", "ZZ", "ZZ"), (None, None, None)
    ]


def test_names_and_totals(spark):
    df = spark.createDataFrame(
        [("A", "Ay", "x", 2), ("A", "Ay", "y", 3), ("B", "Be", "x", 1)],
        "country string, country_name string, genre string, artist_count long",
    )
    totals = A.country_totals(df)
    assert rows(J.join_names(totals, df)) == [("A", 5, "Ay"), ("B", 1, "Be")]
    assert rows(J.join_totals(df.select("country", "genre"), totals)) == [
        ("A", "x", 5), ("A", "y", 5), ("B", "x", 1)
    ]


def test_literal_table(spark):
    assert rows(J.literal_table(spark, ["b", "a"], "word")) == [("a",), ("b",)]


# Aggregates


def profile_input(spark):
    return spark.createDataFrame(
        [("a", 100.0, -5.0, 10.0, 0.5, 1), ("a", 120.0, -5.0, 20.0, None, 0),
         ("b", 90.0, -5.0, 30.0, 0.25, 1)],
        "genre string, tempo double, loudness double, duration double,"
        " song_hotttnesss double, mode int",
    )


def test_profile_uses_sample_deviation_and_skips_nulls(spark):
    got = {r.genre: r for r in A.group_profile(profile_input(spark), ["genre"]).collect()}
    assert got["a"].track_count == 2 and got["a"].avg_tempo == 110.0
    assert got["a"].std_tempo == pytest.approx(math.sqrt(200))
    assert got["a"].avg_hotttnesss == 0.5 and got["a"].std_hotttnesss is None
    assert got["a"].pct_major == 0.5
    assert got["b"].std_tempo is None  # one row has no sample deviation


def test_nan_in_an_uncleaned_measure_reaches_the_mean(spark):
    df = profile_input(spark).withColumn("tempo", F.lit(NAN))
    got = A.group_profile(df, ["genre"]).first()
    assert math.isnan(got.avg_tempo)


def test_normalize_is_null_on_a_zero_range(spark):
    got = {
        r.genre: r
        for r in A.minmax_normalize(A.group_profile(profile_input(spark), ["genre"])).collect()
    }
    assert (got["a"].norm_tempo, got["b"].norm_tempo) == (1.0, 0.0)
    assert got["a"].norm_std_tempo == pytest.approx(math.sqrt(200) / 20)
    assert got["a"].norm_loudness is None and got["a"].norm_std_loudness is None
    assert "norm_pct_major" not in got["a"].asDict()


def test_vocabulary_and_mean_of_ratios(spark):
    lyrics = spark.createDataFrame(
        [("1", "x", 3), ("1", "y", 1), ("2", "x", 0), ("3", "x", 5), ("9", "x", 1),
         ("3", None, 5), ("3", "x", 2)],
        "track_id string, word string, count int",
    )
    genres = spark.createDataFrame(
        [("1", "a"), ("2", "a"), ("3", "b"), ("7", "b")], "track_id string, genre string"
    )
    per_track = A.vocab_per_track(lyrics, genres)
    assert rows(per_track) == [("1", "a", 2, 4), ("2", "a", 1, 0), ("3", "b", 1, 12)]
    assert rows(A.avg_of_ratios(per_track)) == [
        ("a", 2, 1.5, 2.0, 0.5), ("b", 1, 1.0, 12.0, pytest.approx(1 / 12))
    ]


def test_vocabulary_matches_the_plain_join_with_repeated_labels(spark):
    lyrics = spark.createDataFrame(
        [("1", "x", 3), ("1", "y", 1)], "track_id string, word string, count int"
    )
    genres = spark.createDataFrame(
        [("1", "a"), ("1", "a"), ("1", "b")], "track_id string, genre string"
    )
    plain = lyrics.join(genres, "track_id").groupBy("track_id", "genre").agg(
        F.count_distinct("word"), F.sum("count")
    )
    assert rows(A.vocab_per_track(lyrics, genres)) == rows(plain)


def test_distinct_artists_per_cell(spark):
    df = spark.createDataFrame(
        [(2.5, -2.5, "p", "g"), (2.6, -2.6, "p", "g"), (3.4, -3.0, "q", "g"),
         (3.0, -3.0, None, "g"), (-0.4, 0.4, "p", "g")],
        "artist_latitude double, artist_longitude double, artist_name string, genre string",
    )
    assert rows(A.distinct_per_cell(df)) == [(0.0, 0.0, "g", 1), (3.0, -3.0, "g", 2)]


def country_rows(spark):
    return spark.createDataFrame(
        [("A", "x", 3), ("A", "y", 1), ("A", "x", 2), ("B", "y", 4)],
        "country string, genre string, artist_count long",
    )


def test_shares(spark):
    df = country_rows(spark)
    assert rows(A.artists_per_country_genre(df)) == [("A", "x", 5), ("A", "y", 1), ("B", "y", 4)]
    assert rows(A.share_of_total(df, "x")) == [("A", 5, 6, pytest.approx(500 / 6))]
    every = [A.share_of_total(df, g).select("country", "pct") for g in ("x", "y")]
    sums = every[0].union(every[1]).groupBy("country").sum("pct").collect()
    assert all(r[1] == pytest.approx(100) for r in sums)


def test_scaling_by_the_maximum(spark):
    df = A.country_totals(country_rows(spark))
    assert rows(rescale(df, "total")) == [
        ("A", 6, 1.0, 1.0), ("B", 4, pytest.approx(2 / 3), pytest.approx(2 / 3 * 0.7 + 0.3))
    ]


def test_weighted_total(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("b", 3, 2.0)], "genre string, track_count long, m double"
    )
    assert rows(A.weighted_total(df, "genre", "All", "track_count", ["m"])) == [("All", 4, 4.0)]


def test_counts_and_distinct_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v string")
    assert rows(A.count_and_distinct(df, "v")) == [(4, 2)]
    assert [r.v for r in A.distinct_values(df.dropna(), "v").collect()] == ["a", "b"]


# Series


def test_series_keep_order_and_values(spark):
    df = spark.createDataFrame([(1990, 60, 0.1, 100.0, 0.2)], "year int, track_count long, a double, b double, c double")
    spec = [Series("One", "a", "b", "c", "BPM"), Series("Two", "b", "b", None, "")]
    assert rows(feature_series(df, ["year"], spec)) == [
        (1990, 60, 0, "One", 0.1, 100.0, 0.2, "BPM"),
        (1990, 60, 1, "Two", 100.0, 100.0, None, ""),
    ]
    assert [s.label for s in TREND_SERIES][-1] == "% Major Key"


def test_band_drops_rows_with_a_missing_input(spark):
    df = spark.createDataFrame(
        [(0.5, 0.2, 4), (0.5, None, 4), (NAN, 0.2, 4)], "value double, std double, track_count long"
    )
    got = confidence_band(df).collect()
    assert len(got) == 1 and got[0].upper == pytest.approx(0.696)


def test_distinct_values_of_all_levels_from_one_pass(spark):
    rng = random.Random(3)
    data = [(rng.choice([1, 1, 1, 2, None]), rng.choice("xy"), rng.choice([None, *map(str, range(60))])) for _ in range(900)] + [(9, "x", None)]
    df = spark.createDataFrame(data, "a int, b string, v string")
    got = A.distinct_levels(df, {"fine": ["a", "b"], "coarse": ["a"], "all": []}, "v", "n")
    want = [("fine", *r) for r in rows(df.groupBy("a", "b").agg(F.count_distinct("v")))]
    want += [("coarse", r[0], None, r[1]) for r in rows(df.groupBy("a").agg(F.count_distinct("v")))]
    want += [("all", None, None, df.agg(F.count_distinct("v")).first()[0])]
    assert rows(got) == sorted(want, key=repr)
    assert rows(A.distinct_levels(df.limit(0), {"fine": ["a"], "all": []}, "v", "n")) == [("all", None, 0)]
