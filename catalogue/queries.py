"""Registered queries: every operator on tables derived from the given ones.

Deviations and mean ratios depend in their last bits on the order of addition, so
they are rounded here, at the edge; the library never rounds them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cantogram.functions import scalars as S
from cantogram.functions.fixed_values import LYRICS_ROWS_PER_FILE, STOP_WORDS
from cantogram.operators import aggregates as A
from cantogram.operators import checks as C
from cantogram.operators import filters as K
from cantogram.operators import joins as J
from cantogram.operators import ranking as R
from cantogram.operators.nearest import nearest_join
from cantogram.operators.series import confidence_band, feature_series, rescale
from cantogram.plans import marts, panels
from cantogram.plans.pipeline import build_all, load_raw
from cantogram.plans.staging import conform
from cantogram.schemas import RAW, RAW_TRACKS, TRACK_PARTS
from cantogram.session import scratch_path
from cantogram.sources import archives, labels, sinks, sqlite, tables
from cantogram.sources.buckets import SALT
from catalogue import domain as D, raw_files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

GENRE = "MACHINERY"
GENRES = ("MACHINERY", "FURNITURE")
DECIMALS = {"avg_type_token_ratio": 9}
_NARROW = {"tinyint": "int", "smallint": "int", "float": "double"}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, extra: dict[str, int] | None = None) -> DataFrame:
    """Order-dependent statistics at a fixed number of decimals."""
    digits = {**DECIMALS, **(extra or {})}
    out = []
    for name in df.columns:
        places = digits.get(name, 6 if "std" in name else None)
        out.append(F.col(name) if places is None else F.round(name, places).alias(name))
    return df.select(*out)


def widened(df: DataFrame) -> DataFrame:
    """Narrow numbers as int and double, for comparison."""
    return df.select(*(F.col(n).cast(_NARROW.get(t, t)).alias(n) for n, t in df.dtypes))


def table_name(label: str) -> str:
    import uuid

    return f"cantogram_{label}_{uuid.uuid4().hex[:8]}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """A mart as panels find it: saved as a table and scanned."""
    spark, name = df.sparkSession, table_name(label)
    sinks.materialize_table(df, name, scratch_path(spark, label))
    return tables.scan_mart(spark, name)


# Shared inputs


def yearly(spark, folder):
    return A.group_profile(K.year_known(D.tracks(spark, folder)), ["year"])


def labelled_tracks(spark, folder):
    return J.join_genres(D.tracks(spark, folder), D.genres(spark, folder))


def labelled_lyrics(spark, folder):
    return J.join_genres(D.lyrics(spark, folder), D.genres(spark, folder))


def yearly_genre(spark, folder):
    return A.group_profile(K.year_known(labelled_tracks(spark, folder)), ["year", "genre"])


def by_year(spark, folder):
    return marts.features_by_year(D.tracks(spark, folder))


def by_year_genre(spark, folder):
    return marts.features_by_year_genre(D.tracks(spark, folder), D.genres(spark, folder))


def fingerprints(spark, folder):
    return marts.genre_fingerprints(D.tracks(spark, folder), D.genres(spark, folder))


def cells(spark, folder):
    return marts.genre_by_location(D.tracks(spark, folder), D.genres(spark, folder))


def diversity(spark, folder):
    return marts.lyrical_diversity(D.lyrics(spark, folder), D.genres(spark, folder))


def ranked(spark, folder):
    return marts.top_words(D.lyrics(spark, folder), D.genres(spark, folder))


def cut(spark, folder):
    return marts.top_words_cut(D.lyrics(spark, folder), D.genres(spark, folder))


# Sources


@query
def read_label_file(spark, folder):
    path = scratch_path(spark, "labels")
    D.label_lines(spark, folder).write.text(path)
    return labels.read_labels(spark, path)


@query
def read_zip_lines(spark, folder):
    path = scratch_path(spark, "zip")
    raw_files.write_zip_parts(D.label_lines(spark, folder), path)
    return archives.read_zip_text(spark, f"{path}/*.zip")


@query
def read_sqlite_table(spark, folder):
    path = scratch_path(spark, "sqlite")
    raw_files.write_sqlite_parts(D.raw_lyrics(spark, folder), path, "lyrics")
    return sqlite.read_lyrics(spark, path, partitions=8)


@query
def zip_row_aligned(spark, folder):
    rows = D.raw_tracks(spark, folder).withColumn("row_idx", F.col("track_id").cast("long"))
    path = scratch_path(spark, "aligned")
    for name, columns in TRACK_PARTS.items():
        sinks.write_dataset(rows.select("row_idx", *columns), f"{path}/{name}")
    parts = {name: tables.open_dataset(spark, f"{path}/{name}") for name in TRACK_PARTS}
    return widened(conform(J.zip_tables(parts), RAW_TRACKS))


@query
def scan_parquet(spark, folder):
    path = scratch_path(spark, "dataset")
    sinks.write_dataset(D.raw_tracks(spark, folder), f"{path}/tracks")
    return widened(tables.read_dataset(spark, path, "tracks"))


@query
def scan_lookup_csv(spark, folder):
    path = scratch_path(spark, "lookup")
    D.countries(spark, folder).write.option("header", True).csv(path)
    return tables.read_lookup(spark, path)


@query
def scan_mart(spark, folder):
    name = table_name("mart")
    sinks.materialize_table(by_year_genre(spark, folder), name, scratch_path(spark, "mart"))
    return rounded(tables.scan_mart(spark, name, F.col("genre") == GENRE, ["year"]))


# Sinks


@query
def write_parquet(spark, folder):
    path = scratch_path(spark, "dataset")
    sinks.write_dataset(D.raw_genres(spark, folder), f"{path}/genres")
    return tables.read_dataset(spark, path, "genres")


@query
def write_parquet_bounded(spark, folder):
    path = scratch_path(spark, "bounded")
    lyrics = D.raw_lyrics(spark, folder)
    sinks.write_dataset(lyrics, f"{path}/lyrics", max_rows=LYRICS_ROWS_PER_FILE)
    return tables.read_dataset(spark, path, "lyrics")


@query
def load_truncate(spark, folder):
    name, path = table_name("genres"), scratch_path(spark, "genres")
    rows = D.raw_genres(spark, folder)
    sinks.load_table(rows.unionByName(rows), name, path)
    sinks.load_table(rows, name, path)
    return spark.table(name)


@query
def range_partition_by_year(spark, folder):
    path = scratch_path(spark, "decades")
    rows = tables.with_year_bucket(D.raw_tracks(spark, folder))
    spread = sinks.cluster_by(rows, ["artist_name"], within=["year_bucket"])
    sinks.write_dataset(spread, path, partition_by=["year_bucket"])
    return widened(tables.open_dataset(spark, path).select("track_id", "year", "year_bucket"))


@query
def cluster_by(spark, folder):
    name = table_name("lyrics")
    sinks.load_table(
        D.raw_lyrics(spark, folder), name, scratch_path(spark, "lyrics"),
        clustering=["track_id", "word"],
    )
    return spark.table(name)


@query
def load_row_count(spark, folder):
    path, out = scratch_path(spark, "counted"), []
    for name in RAW:
        written = sinks.write_dataset(getattr(D, f"raw_{name}")(spark, folder), f"{path}/{name}")
        stored = tables.read_dataset(spark, path, name)
        out.append(
            stored.agg(F.count(F.lit(1)).alias("rows_read")).select(
                F.lit(name).alias("dataset"), "rows_read", F.lit(written).alias("rows_written")
            )
        )
    return reduce(DataFrame.unionByName, out)


@query
def materialize_view(spark, folder):
    return sinks.materialize_view(D.tracks(spark, folder), table_name("tracks"))


@query
def materialize_table(spark, folder):
    path = scratch_path(spark, "fingerprints")
    return sinks.materialize_table(fingerprints(spark, folder), table_name("fingerprints"), path)


@query
def build_all_models(spark, folder):
    inputs = {name: getattr(D, f"raw_{name}")(spark, folder) for name in RAW}
    prefix = table_name("build") + "_"
    built = build_all(spark, inputs, prefix, scratch_path(spark, "build"))
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("model"), "row_count")
        for name, df in built.items()
    ]
    return reduce(DataFrame.unionByName, counts)


_QUERIES["build_all"] = _QUERIES.pop("build_all_models")


def stored_tracks(spark, folder):
    """Tracks stored by decade."""
    path = scratch_path(spark, "decades")
    sinks.write_dataset(tables.with_year_bucket(D.raw_tracks(spark, folder)), path, partition_by=["year_bucket"])
    return tables.open_dataset(spark, path).select("track_id", "year", "year_bucket")


@query
def filter_years(spark, folder):
    return widened(tables.filter_years(stored_tracks(spark, folder), 1993, 1996))


@query
def years_in(spark, folder):
    fast = by_year(spark, folder).filter("norm_tempo > 0.5")
    return widened(tables.years_in(stored_tracks(spark, folder), fast))


@query
def bounded_files(spark, folder):
    """Rows of a dataset written with a bound that most tasks reach, and of its files."""
    path, bound = scratch_path(spark, "bounded"), 2000
    sinks.write_dataset(D.raw_lyrics(spark, folder), path, max_rows=bound)
    files = tables.open_dataset(spark, path).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("rows"))
    return files.agg(
        F.sum("rows").alias("rows"),
        F.count_if(F.col("rows") > bound).alias("files_over"),
        (F.count(F.lit(1)) * bound >= F.sum("rows")).alias("enough_files"),
    )


def bucketed(spark, folder, lyrics=None):
    """Loaded tables, with lyrics and their labels in the same buckets."""
    inputs = {name: getattr(D, f"raw_{name}")(spark, folder) for name in RAW}
    if lyrics is not None:
        inputs["lyrics"] = lyrics
    return load_raw(spark, inputs, table_name("bucketed") + "_", scratch_path(spark, "bucketed"))


@query
def bucketed_lyrics(spark, folder):
    return bucketed(spark, folder)["lyrics"].drop(SALT)


@query
def bucketed_diversity(spark, folder):
    loaded = bucketed(spark, folder)
    return rounded(marts.lyrical_diversity(loaded["lyrics"], loaded["genres"]))


@query
def bucketed_top_words(spark, folder):
    loaded = bucketed(spark, folder)
    return marts.top_words(loaded["lyrics"], loaded["lyric_labels"])


@query
def bucketed_key_check(spark, folder):
    """Lyrics where the words of the test split come twice."""
    flagged = D.flagged_lyrics(spark, folder)
    copies = F.array_repeat(F.lit(1), F.when(F.col("is_test") == 1, 2).otherwise(1))
    twice = flagged.withColumn("_copy", F.explode(copies)).drop("is_test", "_copy")
    return C.check_unique(bucketed(spark, folder, twice)["lyrics"], "track_id", "word", placed=[SALT])


@query
def country_table(spark, folder):
    """Customers by country, where the built-in table knows the nation's name."""
    nations, known = D.table(spark, folder, "nation"), tables.country_lookup(spark)
    coded = nations.join(known.select(F.col("iso2").alias("cc"), F.lower("name").alias("_known")), F.lower("n_name") == F.col("_known"), "left")
    customers = D.table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    found = J.lookup_codes(coded.select("n_nationkey", F.coalesce("cc", "n_name").alias("cc")), known)
    return found.join(customers, "n_nationkey").select("cc", "country", "country_name", "customers")


@query
def distinct_levels(spark, folder):
    """Artists of each cell, of each row of cells, and of the whole world, per genre."""
    located = K.located_only(labelled_tracks(spark, folder)).select(
        S.round_degrees("artist_latitude").alias("lat"), S.round_degrees("artist_longitude").alias("lon"), "genre", "artist_name"
    )
    levels = {"cell": ["lat", "lon", "genre"], "row": ["lat", "genre"], "world": ["genre"]}
    return A.distinct_levels(located, levels, "artist_name", "artist_count")


# Projections


@query
def stg_tracks(spark, folder):
    return D.tracks(spark, folder)


@query
def stg_genres(spark, folder):
    return D.genres(spark, folder)


@query
def stg_lyrics(spark, folder):
    return D.lyrics(spark, folder)


@query
def sentinel_to_null(spark, folder):
    year = S.sentinel_to_null(F.col("year").cast("int"), 0)
    return D.raw_tracks(spark, folder).select("track_id", year.alias("year"))


@query
def nan_to_null(spark, folder):
    columns = ("song_hotttnesss", "artist_latitude")
    cleaned = (S.nan_to_null(F.col(c).cast("double")).alias(c) for c in columns)
    return D.raw_tracks(spark, folder).select("track_id", *cleaned)


@query
def decode_utf8(spark, folder):
    stored = D.table(spark, folder, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("bytes")
    )
    return stored.select("doc_id", S.decode_utf8("bytes").alias("text"))


@query
def narrow_types(spark, folder):
    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("l_orderkey", T.StringType()),
            T.StructField("l_linenumber", T.ByteType()),
            # A key grows with its table: a short ends at 32 767 suppliers.
            T.StructField("l_suppkey", T.IntegerType()),
            T.StructField("l_extendedprice", T.FloatType()),
        ]
    )
    return widened(conform(D.table(spark, folder, "lineitem"), schema))


@query
def trim_split(spark, folder):
    fields = F.col("fields")
    return D.label_lines(spark, folder).select(S.split_fields("value").alias("fields")).select(
        fields[0].alias("first_field"),
        fields[1].alias("second_field"),
        F.size(fields).alias("n_fields"),
    )


@query
def optional_field(spark, folder):
    fields = S.split_fields("value")
    return D.label_lines(spark, folder).select(
        fields[0].alias("track_id"), S.optional_field(fields, 2).alias("third_field")
    )


@query
def round_grid(spark, folder):
    return D.tracks(spark, folder).select(
        "track_id",
        S.round_degrees("artist_latitude").alias("lat"),
        S.round_degrees("artist_longitude").alias("lon"),
    )


@query
def safe_divide(spark, folder):
    ratio = S.safe_div("l_extendedprice", "l_discount").alias("ratio")
    return D.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", ratio)


@query
def confidence_band_rows(spark, folder):
    series = feature_series(by_year_genre(spark, folder), ["year", "genre"])
    return rounded(confidence_band(series), {"lower": 6, "upper": 6})


_QUERIES["confidence_band"] = _QUERIES.pop("confidence_band_rows")


@query
def opacity_scale(spark, folder):
    return rescale(A.country_totals(D.country_cells(spark, folder)), "total")


@query
def unnest_literal(spark, folder):
    listed = J.literal_table(spark, STOP_WORDS, "word")
    found = D.lyrics(spark, folder).join(listed, "word")
    return A.sum_by(found, ["word"], "count", "total_count")


@query
def rename_passthrough(spark, folder):
    profile = A.group_profile(labelled_tracks(spark, folder), ["genre"], with_std=False)
    return marts.pass_through_major(profile)


@query
def word_length(spark, folder):
    return D.lyrics(spark, folder).select(
        "track_id", "word", S.word_length("word").alias("letters")
    )


@query
def unpivot_features(spark, folder):
    return rounded(feature_series(by_year(spark, folder), ["year"]))


# Filters


@query
def year_known(spark, folder):
    return K.year_known(D.tracks(spark, folder)).select("track_id", "year")


@query
def located_only(spark, folder):
    return K.located_only(D.tracks(spark, folder)).select(
        "track_id", "artist_latitude", "artist_longitude"
    )


@query
def skip_comments(spark, folder):
    return labels.skip_comments(D.label_lines(spark, folder))


@query
def stoplist_filter(spark, folder):
    return K.drop_stop_words(D.lyrics(spark, folder))


@query
def train_split_only(spark, folder):
    return K.train_split(D.flagged_lyrics(spark, folder))


@query
def trend_support(spark, folder):
    return rounded(K.trend_window(yearly_genre(spark, folder)))


@query
def select_group(spark, folder):
    return rounded(K.select_group(yearly_genre(spark, folder), GENRE))


@query
def rank_cut(spark, folder):
    return K.rank_cut(ranked(spark, folder))


@query
def min_word_length(spark, folder):
    return K.min_word_length(D.lyrics(spark, folder))


@query
def genres_in(spark, folder):
    return K.groups_in(fingerprints(spark, folder), GENRES)


@query
def drop_null_rows(spark, folder):
    columns = ["year", "song_hotttnesss"]
    return K.drop_null_rows(D.tracks(spark, folder), columns).select("track_id", *columns)


# Joins


@query
def join_tracks_genres(spark, folder):
    return labelled_tracks(spark, folder).select("track_id", "artist_name", "year", "genre")


@query
def join_lyrics_genres(spark, folder):
    return labelled_lyrics(spark, folder)


@query
def join_bounds(spark, folder):
    profile = yearly(spark, folder)
    means = ["avg_tempo", "avg_loudness", "avg_duration", "avg_hotttnesss"]
    return J.join_bounds(profile, A.bounds(profile, means)).select(
        "year", "track_count", "avg_tempo", "min_avg_tempo", "max_avg_tempo"
    )


@query
def not_in_subquery(spark, folder):
    return J.not_in(D.lyrics(spark, folder), "word", D.listed_words(spark, folder))


@query
def lookup_with_fallback(spark, folder):
    found = J.lookup_codes(D.places(spark, folder), D.countries(spark, folder))
    return found.select("place_id", "cc", "country", "country_name")


@query
def nearest_place(spark, folder):
    points = saved(cells(spark, folder), "cells").select("lat", "lon").distinct()
    return nearest_join(points, D.places(spark, folder))


@query
def join_totals(spark, folder):
    by_genre = A.artists_per_country_genre(D.country_cells(spark, folder))
    return J.join_totals(by_genre, A.country_totals(by_genre))


@query
def join_names(spark, folder):
    rows = D.country_cells(spark, folder)
    return J.join_names(A.country_totals(rows), rows)


# Aggregations


@query
def profile_by_key(spark, folder):
    return rounded(yearly(spark, folder))


@query
def global_bounds(spark, folder):
    means = ["avg_tempo", "avg_loudness", "avg_duration", "avg_hotttnesss"]
    return A.bounds(yearly_genre(spark, folder), means)


@query
def minmax_normalize(spark, folder):
    return rounded(A.minmax_normalize(A.group_profile(labelled_tracks(spark, folder), ["genre"])))


@query
def vocab_per_track(spark, folder):
    return A.vocab_per_track(D.lyrics(spark, folder), D.genres(spark, folder))


@query
def avg_of_ratios(spark, folder):
    per_track = A.vocab_per_track(D.lyrics(spark, folder), D.genres(spark, folder))
    return rounded(A.avg_of_ratios(per_track))


@query
def word_totals(spark, folder):
    return A.word_totals(labelled_lyrics(spark, folder))


@query
def artists_per_cell(spark, folder):
    return A.distinct_per_cell(K.located_only(labelled_tracks(spark, folder)))


@query
def word_totals_all(spark, folder):
    return A.word_totals_all(K.min_word_length(K.rank_cut(cut(spark, folder))))


@query
def artists_per_country_genre(spark, folder):
    return A.artists_per_country_genre(D.country_cells(spark, folder))


@query
def argmax_per_group(spark, folder):
    by_genre = A.artists_per_country_genre(D.country_cells(spark, folder))
    return R.argmax_by(by_genre, "country", "artist_count", "genre")


@query
def country_totals(spark, folder):
    return A.country_totals(D.country_cells(spark, folder))


@query
def share_of_total(spark, folder):
    return A.share_of_total(D.country_cells(spark, folder), GENRE)


@query
def scale_by_max(spark, folder):
    totals = A.country_totals(D.country_cells(spark, folder))
    return A.scale_by_max(totals, "total", "norm_total")


@query
def weighted_total_row(spark, folder):
    metrics = ["avg_type_token_ratio", "avg_vocab_size", "avg_total_words"]
    total = A.weighted_total(diversity(spark, folder), "genre", "All", "track_count", metrics)
    return rounded(total, {m: 9 for m in metrics})


@query
def count_and_distinct(spark, folder):
    return A.count_and_distinct(D.lyrics(spark, folder), "track_id")


@query
def distinct_values(spark, folder):
    return A.distinct_values(D.genres(spark, folder), "genre")


# Windows, sorts, sets


@query
def rank_words(spark, folder):
    totals = A.word_totals(labelled_lyrics(spark, folder))
    return R.rank_within(totals, ["genre"], "total_count", "word", "word_rank")


@query
def order_by_keys(spark, folder):
    return rounded(R.order_by_keys(yearly_genre(spark, folder), "year", "genre"))


@query
def topk_words(spark, folder):
    totals = A.sum_by(D.lyrics(spark, folder), ["word"], "count", "total_count")
    return R.top_k(totals, "total_count", "word")


@query
def topk_by_rank(spark, folder):
    return R.top_by_rank(K.select_group(ranked(spark, folder), GENRE))


@query
def sort_by_metric(spark, folder):
    return rounded(R.sort_by_metric(diversity(spark, folder), "avg_vocab_size"))


@query
def preview_rows(spark, folder):
    return rounded(R.preview_rows(by_year(spark, folder)))


@query
def union_total_row(spark, folder):
    rows = saved(diversity(spark, folder), "diversity")
    metrics = ["avg_type_token_ratio", "avg_vocab_size", "avg_total_words"]
    total = A.weighted_total(rows, "genre", "All", "track_count", metrics)
    both = R.union_total_row(total, rows, "avg_vocab_size")
    return rounded(both, {m: 9 for m in metrics})


# Marts


@query
def mart_features_by_year(spark, folder):
    return rounded(by_year(spark, folder))


@query
def mart_features_by_year_genre(spark, folder):
    return rounded(by_year_genre(spark, folder))


@query
def mart_genre_fingerprints(spark, folder):
    return fingerprints(spark, folder)


@query
def mart_genre_by_location(spark, folder):
    return cells(spark, folder)


@query
def mart_lyrical_diversity(spark, folder):
    return rounded(diversity(spark, folder))


@query
def mart_top_words(spark, folder):
    return ranked(spark, folder)


@query
def mart_top_words_cut(spark, folder):
    return cut(spark, folder)


# Panels


@query
def panel_trend(spark, folder):
    series = panels.trend(by_year(spark, folder), by_year_genre(spark, folder))
    return rounded(series, {"lower": 6, "upper": 6})


@query
def panel_trend_genre(spark, folder):
    series = panels.trend(by_year(spark, folder), by_year_genre(spark, folder), GENRE)
    return rounded(series, {"lower": 6, "upper": 6})


@query
def panel_fingerprint(spark, folder):
    return panels.fingerprint(fingerprints(spark, folder), GENRES)


@query
def panel_top_words(spark, folder):
    return panels.words(cut(spark, folder))


@query
def panel_top_words_genre(spark, folder):
    return panels.words(cut(spark, folder), GENRE)


@query
def panel_diversity(spark, folder):
    metrics = ["avg_type_token_ratio", "avg_vocab_size", "avg_total_words"]
    stored = saved(diversity(spark, folder), "diversity")
    return rounded(panels.diversity(stored), {m: 9 for m in metrics})


@query
def panel_dominant_genre(spark, folder):
    stored = saved(cells(spark, folder), "cells")
    return panels.dominant_genre(stored, D.places(spark, folder), D.countries(spark, folder))


@query
def panel_genre_share(spark, folder):
    stored = saved(cells(spark, folder), "cells")
    return panels.genre_share(
        stored, GENRE, D.places(spark, folder), D.countries(spark, folder)
    )


# Checks and profiles


@query
def check_not_null(spark, folder):
    return C.check_not_null(D.tracks(spark, folder), "year", "artist_latitude", "track_id")


@query
def check_unique(spark, folder):
    return C.check_unique(D.table(spark, folder, "orders"), "o_custkey")


@query
def check_composite_key(spark, folder):
    return C.check_unique(D.table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query
def check_report(spark, folder):
    raw = {name: getattr(D, f"raw_{name}")(spark, folder) for name in RAW}
    staged = {f"stg_{name}": getattr(D, name)(spark, folder) for name in RAW}
    built = {
        "features_by_year": by_year(spark, folder),
        "features_by_year_genre": by_year_genre(spark, folder),
        "genre_fingerprints": fingerprints(spark, folder),
        "top_words": ranked(spark, folder),
        "lyrical_diversity": diversity(spark, folder),
        "genre_by_location": cells(spark, folder),
    }
    rules = {**C.SOURCE_RULES, **C.STAGING_RULES, **C.MART_RULES}
    return C.run_checks({**raw, **staged, **built}, rules)


@query
def profile_tables(spark, folder):
    raw = {name: getattr(D, f"raw_{name}")(spark, folder) for name in RAW}
    return C.profile_tables(raw)


@query
def list_tables(spark, folder):
    prefix = table_name("list") + "_"
    for name in RAW:
        sinks.materialize_view(getattr(D, name)(spark, folder), prefix + name)
    listed = C.list_tables(spark, f"{prefix}*")
    # Which rows a preview shows is free; how many is not.
    listed = listed.withColumn("previewed", F.size("preview").cast("long")).drop("preview")
    return listed.withColumn("table", F.replace("table", F.lit(prefix), F.lit("")))
