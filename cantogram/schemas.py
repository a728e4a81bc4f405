"""Declared schemas of the raw datasets and lookups."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


RAW_TRACKS = _struct(
    track_id=T.StringType(),
    title=T.StringType(),
    artist_name=T.StringType(),
    release=T.StringType(),
    artist_location=T.StringType(),
    year=T.ShortType(),
    duration=T.FloatType(),
    tempo=T.FloatType(),
    loudness=T.FloatType(),
    key=T.ByteType(),
    mode=T.ByteType(),
    time_signature=T.ByteType(),
    danceability=T.FloatType(),
    energy=T.FloatType(),
    song_hotttnesss=T.FloatType(),
    artist_hotttnesss=T.FloatType(),
    artist_latitude=T.FloatType(),
    artist_longitude=T.FloatType(),
)

RAW_GENRES = _struct(
    track_id=T.StringType(),
    genre=T.StringType(),
    minority_genre=T.StringType(),
)

RAW_LYRICS = T.StructType(
    [
        T.StructField("track_id", T.StringType(), True),
        T.StructField("word", T.StringType(), True),
        T.StructField("count", T.IntegerType(), True),
    ]
)

COUNTRIES = _struct(iso2=T.StringType(), iso3=T.StringType(), name=T.StringType())

PLACES = _struct(
    place_id=T.LongType(),
    lat=T.DoubleType(),
    lon=T.DoubleType(),
    cc=T.StringType(),
)

RAW = {"tracks": RAW_TRACKS, "genres": RAW_GENRES, "lyrics": RAW_LYRICS}

# How a row-aligned export splits the track columns over three tables.
TRACK_PARTS = {
    "analysis": [
        "track_id", "duration", "tempo", "loudness", "key", "mode", "time_signature",
        "danceability", "energy",
    ],
    "metadata": [
        "title", "artist_name", "release", "artist_location", "song_hotttnesss",
        "artist_hotttnesss", "artist_latitude", "artist_longitude",
    ],
    "musicbrainz": ["year"],
}
