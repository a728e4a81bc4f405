"""Music tables derived from the given tables, in Spark and as SQL common tables.

Every row of the source tables takes part. Both forms state the same rules:

* tracks: one per order, its artist the customer. An unspecified priority means
  an unknown year (0); a low priority, or a customer in debt, means NaN in the
  columns where NaN stands for missing.
* genres: one per order; the market segment is the genre. Labels of pending orders carry an id that no track has.
* lyrics: the words of each document with their counts.
* places: one per supplier. A supplier in debt has a code that no country has.
* countries: one per nation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cantogram.plans.staging import conform, stage_genres, stage_lyrics, stage_tracks
from cantogram.schemas import COUNTRIES, PLACES, RAW_GENRES, RAW_LYRICS, RAW_TRACKS
from cantogram.sources.buckets import bucket_count
from cantogram.sources.files import stored_bytes

# Stored bytes of texts per task: their words, one row each, take some ten times as much.
TEXT_BYTES_PER_TASK = 8 << 20


# Declared, so that no job reads a footer to find them out. Others are inferred.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read
    if name in _SCHEMAS:
        reader = reader.schema(_SCHEMAS[name])
    return reader.parquet(f"{folder}/{name}.parquet")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _nan_when(missing: Column, value: Column) -> Column:
    return F.when(missing, F.lit(float("nan"))).otherwise(value)


def raw_tracks(spark: SparkSession, folder: str) -> DataFrame:
    key, price, balance = F.col("o_orderkey"), F.col("o_totalprice"), F.col("c_acctbal")
    nation, indebted = F.col("c_nationkey"), F.col("c_acctbal") < 0
    year = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 0)
    rows = _orders(spark, folder).select(
        key.cast("string").alias("track_id"),
        F.concat(F.lit("Track "), key.cast("string")).alias("title"),
        F.col("c_name").alias("artist_name"),
        F.col("o_orderstatus").alias("release"),
        F.concat(F.lit("Nation "), nation.cast("string")).alias("artist_location"),
        year.otherwise(F.year("o_orderdate")).alias("year"),
        (price % 600).alias("duration"),
        (price / 1000).alias("tempo"),
        (-(key % 60)).alias("loudness"),
        (key % 12).alias("key"),
        (key % 2).alias("mode"),
        (key % 5 + 3).alias("time_signature"),
        (balance / 10000).alias("danceability"),
        (price / 1000000).alias("energy"),
        _nan_when(F.col("o_orderpriority") == "5-LOW", price % 100 / 100).alias(
            "song_hotttnesss"
        ),
        _nan_when(indebted, balance / 10000).alias("artist_hotttnesss"),
        _nan_when(indebted, nation * 37 % 140 - 70 + balance / 10000).alias("artist_latitude"),
        _nan_when(indebted, nation * 83 % 355 - 180 + price % 3).alias("artist_longitude"),
    )
    return conform(rows, RAW_TRACKS)


def raw_genres(spark: SparkSession, folder: str) -> DataFrame:
    minor = F.when(F.col("o_orderpriority") < "3", F.col("o_orderpriority"))
    key = F.col("o_orderkey").cast("string")
    unmatched = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("-"), key)).otherwise(key)
    rows = _orders(spark, folder).select(
        unmatched.alias("track_id"),
        F.col("c_mktsegment").alias("genre"),
        minor.alias("minority_genre"),
    )
    return conform(rows, RAW_GENRES)


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Track, text and split of each document, dealt by track.

    A table of few row groups is read by few tasks: the texts move once, and before they become words. What groups or joins their words by
    track finds them in place. The number of partitions is given, since merging them by the size of the texts would make them too large for the words.
    """
    count = max(bucket_count(spark), -(-stored_bytes(spark, f"{folder}/documents.parquet") // TEXT_BYTES_PER_TASK))
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("track_id"),
        "text",
        F.when(F.col("lang") == "en", 0).otherwise(1).alias("is_test"),
    ).repartition(count, "track_id")


def _words(texts: DataFrame, *kept: str) -> DataFrame:
    """The words of the texts, one row for each place, with the columns to keep."""
    return texts.select(*kept, F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).filter(F.col("word") != "")


def raw_lyrics(spark: SparkSession, folder: str) -> DataFrame:
    words = _words(_texts(spark, folder), "track_id")
    return conform(words.groupBy("track_id", "word").agg(F.count(F.lit(1)).alias("count")), RAW_LYRICS)


def _nation_code(nation: Column) -> Column:
    letters = [F.char((65 + (nation * step) % 26).cast("int")) for step in (1, 7)]
    return F.concat(*letters)


def places(spark: SparkSession, folder: str) -> DataFrame:
    key, code = F.col("s_suppkey"), _nation_code(F.col("s_nationkey"))
    rows = table(spark, folder, "supplier").select(
        key.alias("place_id"),
        (key * 37 % 140 - 70).alias("lat"),
        (key * 83 % 360 - 180).alias("lon"),
        F.when(F.col("s_acctbal") < 0, F.lower(code)).otherwise(code).alias("cc"),
    )
    return conform(rows, PLACES)


def countries(spark: SparkSession, folder: str) -> DataFrame:
    code = _nation_code(F.col("n_nationkey"))
    rows = table(spark, folder, "nation").select(
        code.alias("iso2"), F.concat(code, F.lit("X")).alias("iso3"), F.col("n_name").alias("name")
    )
    return conform(rows, COUNTRIES)


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    return stage_tracks(raw_tracks(spark, folder))


def genres(spark: SparkSession, folder: str) -> DataFrame:
    return stage_genres(raw_genres(spark, folder))


def lyrics(spark: SparkSession, folder: str) -> DataFrame:
    return stage_lyrics(raw_lyrics(spark, folder))


SQL = {
    "raw_tracks": """
        SELECT CAST(o_orderkey AS VARCHAR) AS track_id,
               'Track ' || CAST(o_orderkey AS VARCHAR) AS title,
               c_name AS artist_name,
               o_orderstatus AS release,
               'Nation ' || CAST(c_nationkey AS VARCHAR) AS artist_location,
               CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0
                         ELSE year(o_orderdate) END AS SMALLINT) AS year,
               CAST(o_totalprice % 600 AS FLOAT) AS duration,
               CAST(o_totalprice / 1000 AS FLOAT) AS tempo,
               CAST(-(o_orderkey % 60) AS FLOAT) AS loudness,
               CAST(o_orderkey % 12 AS TINYINT) AS key,
               CAST(o_orderkey % 2 AS TINYINT) AS mode,
               CAST(o_orderkey % 5 + 3 AS TINYINT) AS time_signature,
               CAST(c_acctbal / 10000 AS FLOAT) AS danceability,
               CAST(o_totalprice / 1000000 AS FLOAT) AS energy,
               CAST(CASE WHEN o_orderpriority = '5-LOW' THEN CAST('NaN' AS DOUBLE)
                         ELSE o_totalprice % 100 / 100 END AS FLOAT) AS song_hotttnesss,
               CAST(CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE)
                         ELSE c_acctbal / 10000 END AS FLOAT) AS artist_hotttnesss,
               CAST(CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE)
                         ELSE c_nationkey * 37 % 140 - 70 + c_acctbal / 10000
                         END AS FLOAT) AS artist_latitude,
               CAST(CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE)
                         ELSE c_nationkey * 83 % 355 - 180 + o_totalprice % 3
                         END AS FLOAT) AS artist_longitude
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "raw_genres": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN '-' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS track_id,
               c_mktsegment AS genre,
               CASE WHEN o_orderpriority < '3' THEN o_orderpriority END AS minority_genre
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "raw_lyrics": r"""
        SELECT CAST(doc_id AS VARCHAR) AS track_id, word, CAST(count(*) AS INTEGER) AS count
        FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS word
              FROM documents)
        WHERE word <> ''
        GROUP BY doc_id, word""",
    "places": """
        SELECT s_suppkey AS place_id,
               CAST(s_suppkey * 37 % 140 - 70 AS DOUBLE) AS lat,
               CAST(s_suppkey * 83 % 360 - 180 AS DOUBLE) AS lon,
               CASE WHEN s_acctbal < 0
                    THEN lower(chr(65 + s_nationkey % 26) || chr(65 + s_nationkey * 7 % 26))
                    ELSE chr(65 + s_nationkey % 26) || chr(65 + s_nationkey * 7 % 26)
                    END AS cc
        FROM supplier""",
    "countries": """
        SELECT chr(65 + n_nationkey % 26) || chr(65 + n_nationkey * 7 % 26) AS iso2,
               chr(65 + n_nationkey % 26) || chr(65 + n_nationkey * 7 % 26) || 'X' AS iso3,
               n_name AS name
        FROM nation""",
    "tracks": """
        SELECT track_id, title, artist_name, release, artist_location,
               CAST(nullif(year, 0) AS INTEGER) AS year,
               CAST(duration AS DOUBLE) AS duration,
               CAST(tempo AS DOUBLE) AS tempo,
               CAST(loudness AS DOUBLE) AS loudness,
               CAST(key AS INTEGER) AS key,
               CAST(mode AS INTEGER) AS mode,
               CAST(time_signature AS INTEGER) AS time_signature,
               CASE WHEN NOT isnan(song_hotttnesss)
                    THEN CAST(song_hotttnesss AS DOUBLE) END AS song_hotttnesss,
               CASE WHEN NOT isnan(artist_hotttnesss)
                    THEN CAST(artist_hotttnesss AS DOUBLE) END AS artist_hotttnesss,
               CASE WHEN NOT isnan(artist_latitude)
                    THEN CAST(artist_latitude AS DOUBLE) END AS artist_latitude,
               CASE WHEN NOT isnan(artist_longitude)
                    THEN CAST(artist_longitude AS DOUBLE) END AS artist_longitude
        FROM raw_tracks""",
    "genres": "SELECT track_id, genre, minority_genre FROM raw_genres",
    "lyrics": "SELECT track_id, word, count FROM raw_lyrics",
}

# Small helpers of the registered queries, in both forms.


def label_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Label rows as the lines of a label file, padded, with one comment per region."""
    fields = F.concat_ws("\t", "track_id", "genre", F.coalesce("minority_genre", F.lit("")))
    rows = raw_genres(spark, folder).select(F.concat(F.lit("  "), fields, F.lit(" ")).alias("value"))
    notes = table(spark, folder, "region").select(
        F.concat(F.lit(" # "), F.col("r_name"), F.lit("\tnote")).alias("value")
    )
    return rows.unionByName(notes)


def flagged_lyrics(spark: SparkSession, folder: str) -> DataFrame:
    """Lyrics with a split flag: documents that are not English are the test split.

    A word of a track comes once for every document of that track. Flags are counted per track beside the texts, so that
    the words, many more rows, need no join.
    """
    track = Window.partitionBy("track_id")
    flags = {f"_flag{flag}": F.count_if(F.col("is_test") == flag).over(track) for flag in (0, 1)}
    words = _words(_texts(spark, folder).filter("track_id IS NOT NULL").withColumns(flags), "track_id", *flags)
    counted = words.groupBy("track_id", "word").agg(F.count(F.lit(1)).alias("count"), *(F.first(n).alias(n) for n in flags))
    # Flags 0 and 1, each as often as the track has it.
    listed = F.concat(*(F.array_repeat(F.lit(flag), F.col(f"_flag{flag}").cast("int")) for flag in (0, 1)))
    flagged = counted.select("track_id", "word", "count", F.explode(listed).alias("is_test"))
    return conform(flagged, T.StructType([*RAW_LYRICS, T.StructField("is_test", T.IntegerType())]))


def listed_words(spark: SparkSession, folder: str) -> DataFrame:
    """The words of the benchmark texts, as a list to leave out."""
    words = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("listed")
    return table(spark, folder, "benchmark").select(words).distinct()


def country_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Artists per cell and genre, with the artist's nation as country."""
    from cantogram.operators.aggregates import distinct_per_cell
    from cantogram.operators.filters import located_only
    from cantogram.operators.joins import join_genres

    labelled = join_genres(located_only(tracks(spark, folder)), genres(spark, folder))
    cells = distinct_per_cell(labelled, keys=("artist_location", "genre"))
    return cells.select(
        "lat",
        "lon",
        F.col("artist_location").alias("country"),
        F.upper("artist_location").alias("country_name"),
        "genre",
        "artist_count",
    )


SQL |= {
    "label_lines": """
        SELECT '  ' || track_id || chr(9) || genre || chr(9) || coalesce(minority_genre, '')
               || ' ' AS value
        FROM raw_genres
        UNION ALL
        SELECT ' # ' || r_name || chr(9) || 'note' AS value FROM region""",
    "flagged_lyrics": """
        SELECT track_id, word, count, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS is_test
        FROM raw_lyrics JOIN documents ON track_id = CAST(doc_id AS VARCHAR)""",
    "listed_words": r"""
        SELECT DISTINCT unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS listed
        FROM benchmark""",
    "country_cells": """
        SELECT round(artist_latitude, 0) + 0.0 AS lat, round(artist_longitude, 0) + 0.0 AS lon,
               artist_location AS country, upper(artist_location) AS country_name, genre,
               count(DISTINCT artist_name) AS artist_count
        FROM tracks JOIN genres USING (track_id)
        WHERE artist_latitude IS NOT NULL AND artist_longitude IS NOT NULL
        GROUP BY ALL""",
}
