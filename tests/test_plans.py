"""Marts, panels, checks and the build, and the shape of their plans."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cantogram.operators import checks as C
from cantogram.operators.aggregates import group_profile, minmax_normalize
from cantogram.operators.joins import join_genres
from cantogram.plans import marts, panels
from cantogram.plans.pipeline import build_all, load_raw
from cantogram.plans.staging import conform, stage_genres, stage_lyrics, stage_tracks
from cantogram.schemas import RAW_GENRES, RAW_LYRICS, RAW_TRACKS
from cantogram.session import checkpoint_dir, scratch_path
from cantogram.sources.buckets import SALT
from cantogram.sources.tables import country_lookup, read_dataset
from cantogram.sources.sinks import write_dataset
from tests.conftest import rows

NAN = float("nan")


def raw_track(i, **values):
    row = dict(
        track_id=f"T{i}", title="t", artist_name=f"A{i % 3}", release="r", artist_location="l",
        year=1990 + i % 2, duration=100.0 + i, tempo=90.0 + i, loudness=-5.0, key=i % 12,
        mode=i % 2, time_signature=4, danceability=0.0, energy=0.0, song_hotttnesss=0.5,
        artist_hotttnesss=0.5, artist_latitude=48.9, artist_longitude=2.3,
    )
    row.update(values)
    return tuple(row[name] for name in RAW_TRACKS.names)


@pytest.fixture(scope="module")
def inputs(spark):
    tracks = [raw_track(i) for i in range(8)]
    tracks += [
        raw_track(8, year=0, artist_latitude=NAN),
        raw_track(9, song_hotttnesss=NAN, artist_latitude=-33.9, artist_longitude=151.2),
    ]
    genres = [(f"T{i}", "Rock" if i % 3 else "Jazz", None) for i in range(9)]
    lyrics = [(f"T{i}", w, 1 + i % 4) for i in range(10) for w in ("the", "love", f"word{i}")]
    return {
        "tracks": spark.createDataFrame(tracks, RAW_TRACKS),
        "genres": spark.createDataFrame(genres, RAW_GENRES),
        "lyrics": spark.createDataFrame(lyrics, RAW_LYRICS),
    }


@pytest.fixture(scope="module")
def staged(inputs):
    return (
        stage_tracks(inputs["tracks"]), stage_genres(inputs["genres"]),
        stage_lyrics(inputs["lyrics"]),
    )


# Staging


def test_staging_cleans_only_what_stands_for_missing(spark):
    raw = spark.createDataFrame(
        [raw_track(1, year=0, tempo=NAN, artist_hotttnesss=NAN, artist_longitude=None)], RAW_TRACKS
    )
    got = stage_tracks(raw)
    row = got.first()
    assert row.year is None and row.artist_hotttnesss is None and row.artist_longitude is None
    assert row.tempo != row.tempo  # tempo keeps its NaN
    assert len(got.columns) == 16 and "energy" not in got.columns
    kinds = dict(got.dtypes)
    assert kinds["year"] == kinds["mode"] == "int" and kinds["tempo"] == "double"
    assert stage_tracks(raw, known_year=True).count() == 0


def test_known_year_reaches_the_scan(spark, tmp_path, inputs, plan_of):
    write_dataset(inputs["tracks"], f"{tmp_path}/tracks")
    raw = read_dataset(spark, str(tmp_path), "tracks")
    plan = plan_of(marts.features_by_year(stage_tracks(raw, known_year=True)))
    assert "Not(EqualTo(year,0))" in plan
    scanned = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert set(c.split(":")[0] for c in scanned.split(",")) == {
        "year", "duration", "tempo", "loudness", "mode", "song_hotttnesss"
    }


def test_conform_raises_on_overflow(spark):
    df = spark.createDataFrame([("a", "w", 2**40)], "track_id string, word string, count long")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        conform(df, RAW_LYRICS).collect()


# Marts


def test_year_mart(staged):
    got = marts.features_by_year(staged[0]).collect()
    assert [r.year for r in got] == [1990, 1991]
    assert [r.track_count for r in got] == [4, 5]
    assert (got[0].norm_tempo, got[1].norm_tempo) == (0.0, 1.0)
    assert got[0].norm_loudness is None
    assert len(got[0]) == 20


def test_year_genre_mart_is_scaled_over_all_rows(staged):
    got = marts.features_by_year_genre(*staged[:2]).collect()
    assert [(r.year, r.genre) for r in got] == [
        (1990, "Jazz"), (1990, "Rock"), (1991, "Jazz"), (1991, "Rock")
    ]
    norms = [r.norm_tempo for r in got]
    assert min(norms) == 0.0 and max(norms) == 1.0


def test_fingerprints_use_tracks_of_no_year(staged):
    got = {r.genre: r for r in marts.genre_fingerprints(*staged[:2]).collect()}
    assert got["Rock"].track_count == 6 and got["Jazz"].track_count == 3
    assert len(got["Rock"]) == 11 and not any("std" in c for c in got["Rock"].asDict())
    assert got["Rock"].norm_pct_major == pytest.approx(0.5)


def test_location_mart(staged):
    assert rows(marts.genre_by_location(*staged[:2])) == [
        (49.0, 2.0, "Jazz", 1), (49.0, 2.0, "Rock", 2)
    ]


def test_word_marts(staged):
    _, genres, lyrics = staged
    ranked = marts.top_words(lyrics, genres)
    assert not ranked.filter("word = 'the'").count()
    top = {r.genre: r.word for r in ranked.filter("word_rank = 1").collect()}
    assert top == {"Rock": "love", "Jazz": "love"}
    counts = ranked.groupBy("genre").agg(F.count("*").alias("n"), F.max("word_rank").alias("m"))
    assert all(r.n == r.m for r in counts.collect())
    assert rows(marts.top_words_cut(lyrics, genres, 2)) == rows(ranked.filter("word_rank <= 2"))
    diverse = {r.genre: r for r in marts.lyrical_diversity(lyrics, genres).collect()}
    assert diverse["Jazz"].track_count == 3 and diverse["Jazz"].avg_vocab_size == 3.0


# Panels


def test_trend_panel_keeps_rows_without_a_band(spark, staged):
    year = marts.features_by_year(staged[0])
    genre = marts.features_by_year_genre(*staged[:2])
    got = panels.trend(year, genre, min_tracks=1)
    assert got.count() == 10
    loud = got.filter("feature = 'Loudness'").collect()
    assert all(r.value is None and r.lower is None and r.upper is None for r in loud)
    major = got.filter("feature = '% Major Key'").first()
    assert major.value == major.raw_value and major.unit == "pct"
    only = panels.trend(year, genre, "Jazz", min_tracks=1)
    assert only.count() == 10 and only.columns == got.columns
    assert panels.trend(year, genre).count() == 0  # fewer than 50 tracks


def test_fingerprint_panel(staged):
    got = panels.fingerprint(marts.genre_fingerprints(*staged[:2]), ["Jazz"])
    assert [r.feature for r in got.orderBy("position").collect()] == [
        "Tempo", "Loudness", "Duration", "Hotttnesss", "% Major"
    ]


def test_word_panel_counts_only_surviving_rows(spark):
    mart = spark.createDataFrame(
        [("a", "love", 9, 1), ("a", "oh", 8, 2), ("a", "sun", 7, 20), ("a", "far", 6, 21),
         ("b", "sun", 5, 1), ("b", "love", 4, 25)],
        "genre string, word string, total_count long, word_rank int",
    )
    assert [tuple(r) for r in panels.words(mart).collect()] == [("sun", 12), ("love", 9)]
    assert [tuple(r) for r in panels.words(mart, "a").collect()] == [("love", 9), ("sun", 7)]
    assert [r.word for r in panels.words(mart, "a", min_length=2, k=2).collect()] == ["love", "oh"]


def test_diversity_panel(spark):
    mart = spark.createDataFrame(
        [("a", 1, 10.0, 20.0, 0.5), ("b", 3, 30.0, 40.0, 0.9)],
        "genre string, track_count long, avg_vocab_size double, avg_total_words double,"
        " avg_type_token_ratio double",
    )
    got = panels.diversity(mart).collect()
    assert [r.genre for r in got] == ["All", "b", "a"]
    assert got[0].track_count == 4 and got[0].avg_vocab_size == pytest.approx(25.0)
    low, high = min(r.avg_type_token_ratio for r in got[1:]), max(r.avg_type_token_ratio for r in got[1:])
    assert low <= got[0].avg_type_token_ratio <= high
    with pytest.raises(ValueError):
        panels.diversity(mart, "genre")


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from("abcd"), st.integers(-50, 50), st.integers(0, 1)),
        min_size=1, max_size=25,
    )
)
def test_scaled_means_span_zero_to_one(spark, values):
    df = spark.createDataFrame(
        [(g, float(v), float(v), 1.0, None, m) for g, v, m in values],
        "genre string, tempo double, loudness double, duration double,"
        " song_hotttnesss double, mode int",
    )
    got = minmax_normalize(group_profile(df, ["genre"])).collect()
    means = [r.avg_tempo for r in got]
    norms = [r.norm_tempo for r in got]
    if min(means) == max(means):
        assert norms == [None] * len(got)
    else:
        assert min(norms) == 0.0 and max(norms) == 1.0
    assert all(r.norm_duration is None and r.norm_hotttnesss is None for r in got)


@pytest.fixture(scope="module")
def maps(spark):
    cells = spark.createDataFrame(
        [(49.0, 2.0, "Rock", 3), (48.0, 2.0, "Jazz", 3), (-34.0, 151.0, "Rock", 1),
         (0.0, -140.0, "Jazz", 2)],
        "lat double, lon double, genre string, artist_count long",
    )
    places = spark.createDataFrame(
        [(1, 48.86, 2.35, "FR"), (2, -33.9, 151.2, "AU"), (3, 0.0, -150.0, "QQ")],
        "place_id long, lat double, lon double, cc string",
    )
    return cells, places, country_lookup(spark)


def test_dominant_genre_panel(maps):
    assert rows(panels.dominant_genre(*maps)) == [
        ("AUS", "Australia", "Rock", 1, 1, pytest.approx(1 / 6), pytest.approx(0.7 / 6 + 0.3)),
        ("FRA", "France", "Jazz", 3, 6, 1.0, 1.0),
        ("QQ", "QQ", "Jazz", 2, 2, pytest.approx(1 / 3), pytest.approx(0.7 / 3 + 0.3)),
    ]


def test_genre_share_panel(maps):
    cells, places, countries = maps
    assert rows(panels.genre_share(cells, "Rock", places, countries)) == [
        ("AUS", "Australia", 1, 1, 100.0), ("FRA", "France", 3, 6, 50.0)
    ]


# Checks and the build


def test_checks_count_failures(spark):
    df = spark.createDataFrame(
        [("1", "a"), ("1", None), (None, "a"), (None, "a")], "track_id string, word string"
    )
    assert rows(C.check_not_null(df, "track_id", "word")) == [("track_id", 2), ("word", 1)]
    assert rows(C.check_unique(df, "track_id")) == [("1", 2)]
    assert rows(C.check_unique(df, "track_id", "word")) == []
    report = C.run_checks({"t": df}, {"t": C.Rules(["word"], [("track_id",)])})
    assert rows(report) == [("t", "track_id", "unique", 1), ("t", "word", "not_null", 1)]
    with pytest.raises(C.CheckFailed, match="t.track_id unique: 1"):
        C.require_passed(report)


def test_rules_hold_the_declared_checks():
    every = [*C.SOURCE_RULES.values(), *C.STAGING_RULES.values(), *C.MART_RULES.values()]
    assert sum(len(r.not_null) for r in every) == 30
    keys = [k for r in every for k in r.unique]
    assert sum(len(k) == 1 for k in keys) == 7 and sum(len(k) == 2 for k in keys) == 2


def test_profiles(spark):
    df = spark.createDataFrame([("1", 2)], "track_id string, n int")
    assert rows(C.profile_tables({"t": df})) == [
        ("t", 1, 0, "track_id", "string"), ("t", 1, 1, "n", "int")
    ]
    df.createOrReplaceTempView("listed_one")
    df.drop("track_id").createOrReplaceTempView("listed_two")
    got = rows(C.list_tables(spark, "listed_*"))
    assert got == [
        ("listed_one", 1, 1, ['{"track_id":"1","n":2}']), ("listed_two", 1, None, ['{"n":2}'])
    ]


def test_build_makes_every_model(spark, inputs, tmp_path):
    loaded = load_raw(spark, inputs, "bt_raw_", str(tmp_path))
    built = build_all(spark, loaded, "bt_", str(tmp_path))
    assert set(built) == {"stg_tracks", "stg_genres", "stg_lyrics", *C.MART_RULES}
    assert built["features_by_year"].count() == 2
    assert spark.catalog.tableExists("bt_top_words")
    first = rows(built["genre_by_location"])
    again = build_all(spark, loaded, "bt_", str(tmp_path))  # replaces
    assert rows(again["genre_by_location"]) == first and len(first) == 2


def test_whole_run_from_raw_files(spark, tmp_path):
    import sqlite3

    from cantogram.plans.pipeline import run_pipeline
    from cantogram.schemas import TRACK_PARTS

    labels = tmp_path / "labels.cls"
    labels.write_text("# track\tgenre\n" + "".join(f"T{i}\tRock\n" for i in range(6)))
    db = sqlite3.connect(tmp_path / "lyrics.db")
    db.execute("CREATE TABLE lyrics (track_id TEXT, word TEXT, count INTEGER)")
    db.executemany("INSERT INTO lyrics VALUES (?, ?, 2)", [(f"T{i}", f"w{i % 4}") for i in range(9)])
    db.commit()
    db.close()
    tracks = spark.createDataFrame([raw_track(i) for i in range(8)], RAW_TRACKS)
    tracks = tracks.withColumn("row_idx", F.substring("track_id", 2, 9).cast("long"))
    parts = {name: tracks.select("row_idx", *columns) for name, columns in TRACK_PARTS.items()}
    built = run_pipeline(
        spark, str(tmp_path / "out"), str(labels), parts, str(tmp_path / "lyrics.db"), "wr_"
    )
    assert rows(built["top_words"]) == [
        ("Rock", "w0", 4, 1), ("Rock", "w1", 4, 2), ("Rock", "w2", 2, 3), ("Rock", "w3", 2, 4)
    ]
    assert rows(built["features_by_year"].select("year", "track_count")) == [(1990, 4), (1991, 4)]
    assert list((tmp_path / "out/tables/wr_raw_tracks").glob("_generation-*/year_bucket=1990"))


def test_build_stops_at_a_failed_check(spark, inputs, tmp_path):
    doubled = {**inputs, "genres": inputs["genres"].union(inputs["genres"])}
    with pytest.raises(C.CheckFailed, match="genres.track_id unique: 9"):
        build_all(spark, doubled, "bad_", str(tmp_path))
    assert not spark.catalog.tableExists("bad_top_words")


def test_nulls_stop_a_load_before_the_table_changes(spark, inputs, tmp_path):
    load_raw(spark, inputs, "nn_raw_", str(tmp_path))
    nameless = inputs["lyrics"].withColumn("word", F.when(F.col("word") != "the", F.col("word")))
    with pytest.raises(C.CheckFailed, match="nn_raw_lyrics.word not_null: 10"):
        load_raw(spark, {**inputs, "lyrics": nameless}, "nn_raw_", str(tmp_path))
    assert spark.table("nn_raw_lyrics").filter("word IS NULL").isEmpty() and spark.table("nn_raw_lyrics").count() == 30


# Plan shape


@pytest.fixture(scope="module")
def hot_lyrics(spark, tmp_path_factory):
    """Loaded tables where one track has a third of all lyrics rows, some rows come twice, and some tracks have two labels."""
    track = F.when(F.col("id") % 3 == 0, "T0").otherwise(F.concat(F.lit("T"), F.col("id") % 40))
    words = spark.range(0, 6000).select(track.alias("track_id"), F.concat(F.lit("w"), F.col("id") % 1500).alias("word"), F.lit(1).alias("count"))
    genres = spark.range(45).selectExpr("concat('T', id % 38) AS track_id", "concat('g', id % 3) AS genre", "cast(null AS string) AS minority_genre")
    tracks = spark.createDataFrame([raw_track(0)], RAW_TRACKS)
    plain = {"tracks": tracks, "genres": genres, "lyrics": words}
    return plain, load_raw(spark, plain, "hl_raw_", str(tmp_path_factory.mktemp("hot")))


def test_a_hot_track_fills_several_buckets(hot_lyrics):
    plain, loaded = hot_lyrics
    assert rows(loaded["lyrics"].drop(SALT)) == rows(plain["lyrics"])
    salts = {r[0]: r[1] for r in loaded["lyrics"].groupBy("track_id").agg(F.count_distinct(SALT)).collect()}
    assert salts.pop("T0") >= 3 and set(salts.values()) == {1}
    files = loaded["lyrics"].groupBy(F.input_file_name()).count().collect()
    assert max(r[1] for r in files) < 2000 + 1500
    assert rows(loaded["lyric_labels"].filter("salt = 0").drop(SALT)) == rows(plain["genres"].select("track_id", "genre"))


def test_lyrics_stay_where_they_are(spark, hot_lyrics, plan_of):
    """No exchange between the scan of the lyrics and the aggregates and joins on their track."""
    plain, loaded = hot_lyrics
    lyrics, labels, genres = stage_lyrics(loaded["lyrics"]), loaded["lyric_labels"], stage_genres(loaded["genres"])
    assert rows(marts.lyrical_diversity(lyrics, genres)) == rows(marts.lyrical_diversity(plain["lyrics"], plain["genres"]))
    assert rows(marts.top_words(lyrics, labels)) == rows(marts.top_words(plain["lyrics"], plain["genres"]))
    repeated = C.check_unique(lyrics, "track_id", "word", placed=[SALT])
    assert rows(repeated) == rows(C.check_unique(plain["lyrics"], "track_id", "word")) and repeated.count() > 0
    per_track = lyrics.groupBy("track_id", SALT).agg(F.count_distinct("word"), F.sum("count"))
    for kept in (repeated, per_track):
        assert "Exchange" not in plan_of(kept)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "-1")
        met = join_genres(lyrics, labels)
        assert "SortMergeJoin" in plan_of(met) and "Exchange" not in plan_of(met)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_table_is_read_once_for_its_key_and_null_counts(spark, plan_of):
    df = spark.createDataFrame([("1", "a", 1), ("1", None, None), (None, "a", 2)], "track_id string, word string, n int")
    report = C.run_checks({"t": df}, {"t": C.Rules(["track_id", "word", "n"], [("track_id", "word")])})
    assert plan_of(report).count("Scan ExistingRDD") == 1
    assert rows(report) == [("t", "n", "not_null", 1), ("t", "track_id", "not_null", 1), ("t", "track_id, word", "unique", 0), ("t", "word", "not_null", 1)]


def test_a_hot_track_is_split_by_the_skew_join(spark, plan_of):
    """A third of all lyrics rows on one track, with a label table too big to broadcast."""
    track = F.when(F.col("id") % 3 == 0, "T0").otherwise(F.concat(F.lit("T"), F.col("id") % 5000))
    lyrics = spark.range(0, 300000, 1, 8).select(
        track.alias("track_id"),
        F.concat(F.lit("w"), F.col("id") % 100000).alias("word"),
        F.lit(1).alias("count"),
    )
    genres = spark.range(5000).select(
        F.concat(F.lit("T"), F.col("id")).alias("track_id"),
        F.concat(F.lit("g"), F.col("id") % 3).alias("genre"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    want = rows(marts.top_words_cut(lyrics, genres, 3))
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        mart = marts.top_words_cut(lyrics, genres, 3)
        assert rows(mart) == want
        assert "SortMergeJoin(skew=true)" in plan_of(mart)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_bounds_share_the_profile_shuffle(staged, plan_of):
    for mart in (marts.features_by_year(staged[0]), marts.features_by_year_genre(*staged[:2])):
        mart.collect()
        assert "ReusedExchange" in plan_of(mart)


def test_raw_and_staged_checks_share_shuffles(spark, inputs, tmp_path, plan_of):
    loaded = load_raw(spark, inputs, "cs_raw_", str(tmp_path))
    models = {
        "stg_tracks": stage_tracks(loaded["tracks"]), "stg_genres": stage_genres(loaded["genres"]),
        "stg_lyrics": stage_lyrics(loaded["lyrics"]),
    }
    report = C.run_checks({**loaded, **models}, {**C.SOURCE_RULES, **C.STAGING_RULES})
    assert all(r.failures == 0 for r in report.collect())
    assert plan_of(report).count("ReusedExchange") >= 2


def test_cut_is_pushed_below_the_shuffle(staged, plan_of):
    plan = plan_of(marts.top_words_cut(staged[2], staged[1]))
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_marts_stay_in_the_jvm_without_cross_joins(staged, plan_of):
    tracks, genres, lyrics = staged
    for mart in (
        marts.features_by_year(tracks), marts.features_by_year_genre(tracks, genres),
        marts.genre_fingerprints(tracks, genres), marts.genre_by_location(tracks, genres),
        marts.lyrical_diversity(lyrics, genres), marts.top_words_cut(lyrics, genres),
    ):
        plan = plan_of(mart)
        for operator in ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoop"):
            assert operator not in plan


def test_scratch_follows_the_configured_folder(spark):
    folder = checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert not configured or folder == configured.rstrip("/")
    assert scratch_path(spark, "x").startswith(folder)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
