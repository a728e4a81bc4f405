"""The whole run: raw files to datasets, to clustered tables, to checked models."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from cantogram.functions.fixed_values import (
    CLUSTER_COLUMNS,
    LYRICS_ROWS_PER_FILE,
    MODEL_THREADS,
)
from cantogram.operators.checks import (
    MART_RULES,
    SOURCE_RULES,
    STAGING_RULES,
    require_passed,
    run_checks,
)
from cantogram.operators.joins import zip_tables
from cantogram.plans import marts
from cantogram.plans.staging import conform, stage_genres, stage_lyrics, stage_tracks
from cantogram.schemas import RAW, RAW_TRACKS
from cantogram.session import checkpoint_dir
from cantogram.sources.buckets import SALT, bucket_count, hot_keys, per_salt, with_salt
from cantogram.sources.labels import read_labels
from cantogram.sources.sinks import (
    load_table,
    materialize_table,
    materialize_view,
    write_dataset,
)
from cantogram.sources.sqlite import read_lyrics
from cantogram.sources.tables import read_dataset, with_year_bucket

STAGES = {"tracks": stage_tracks, "genres": stage_genres, "lyrics": stage_lyrics}


def transform_raw(
    spark: SparkSession,
    folder: str,
    labels: str | None = None,
    track_parts: Mapping[str, DataFrame] | None = None,
    lyrics: str | None = None,
) -> dict[str, int]:
    """Turn raw inputs into typed Parquet datasets below ``folder``; returns rows written.

    ``labels`` is a label file or zip, ``track_parts`` the row-aligned track tables,
    ``lyrics`` a SQLite file. An input that is not given is left as it is.
    """
    written = {}
    if labels:
        written["genres"] = write_dataset(read_labels(spark, labels), f"{folder}/genres")
    if track_parts:
        tracks = conform(zip_tables(track_parts), RAW_TRACKS)
        written["tracks"] = write_dataset(tracks, f"{folder}/tracks")
    if lyrics:
        rows = read_lyrics(spark, lyrics)
        written["lyrics"] = write_dataset(rows, f"{folder}/lyrics", LYRICS_ROWS_PER_FILE)
    return written


def load_raw(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    prefix: str = "raw_",
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Replace the raw tables, tracks partitioned by decade, all clustered.

    Lyrics are stored in buckets by track, each sorted by track and word; a track of more rows than an even bucket
    is spread over several by a salt. ``lyric_labels`` holds the labels in the same buckets. Nulls in the columns
    that must have values raise, and leave the old table. All loads are complete when this returns.
    """
    loaded, count = {}, bucket_count(spark)
    checkpoint_dir(spark)
    hot = hot_keys(inputs["lyrics"], "track_id", count).checkpoint()
    tables = {
        "tracks": (with_year_bucket(inputs["tracks"]), {"partition_by": ["year_bucket"]}),
        "genres": (inputs["genres"], {}),
        "lyrics": (with_salt(inputs["lyrics"], hot, "track_id", ["word"]), {"buckets": (count, ["track_id", SALT])}),
        "lyric_labels": (per_salt(inputs["genres"].select("track_id", "genre"), hot, "track_id"), {"buckets": (count, ["track_id", SALT])}),
    }
    for name, (df, layout) in tables.items():
        path = f"{folder}/{prefix}{name}" if folder else None
        clustering = CLUSTER_COLUMNS.get(name, ["track_id"])
        not_null = SOURCE_RULES[name].not_null if name in SOURCE_RULES else ()
        load_table(df, prefix + name, path, clustering=clustering, not_null=not_null, **layout)
        loaded[name] = spark.table(prefix + name)
    return loaded


def build_all(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    prefix: str = "",
    folder: str | None = None,
    threads: int = MODEL_THREADS,
) -> dict[str, DataFrame]:
    """Build every model in dependency order and return it by name.

    ``inputs`` holds raw tracks, genres and lyrics, and may hold ``lyric_labels``, the labels by track and salt as
    :func:`load_raw` stores them, which then meet the lyrics where they are. Staging models become views,
    marts become saved tables, below ``folder`` when one is given. A failed check
    raises before anything that depends on it is built. Marts do not depend on one
    another: ``threads`` of them are submitted at a time, so that one fills the
    cluster while another's last tasks finish.
    """
    models = {
        f"stg_{name}": materialize_view(stage(inputs[name]).drop(SALT), f"{prefix}stg_{name}")
        for name, stage in STAGES.items()
    }
    # Views compute nothing by themselves: raw and staged checks run as one query,
    # and where both ask for the same key they share its shuffle. Null counts come with the keys.
    tracks, genres = (models[f"stg_{name}"] for name in ("tracks", "genres"))
    lyrics, labels = stage_lyrics(inputs["lyrics"]), inputs.get("lyric_labels", genres)
    checked = {**inputs, **models, "stg_lyrics": lyrics}
    rules = {**SOURCE_RULES, **STAGING_RULES}
    del rules["lyrics"]  # the staged rows have the same values under the same rules, and a key
    require_passed(run_checks(checked, rules))

    dated = stage_tracks(inputs["tracks"], known_year=True)
    plans = {
        "features_by_year": lambda: marts.features_by_year(dated),
        "features_by_year_genre": lambda: marts.features_by_year_genre(dated, genres),
        "genre_fingerprints": lambda: marts.genre_fingerprints(tracks, genres),
        "genre_by_location": lambda: marts.genre_by_location(tracks, genres),
        "lyrical_diversity": lambda: marts.lyrical_diversity(lyrics, genres),
        "top_words": lambda: marts.top_words(lyrics, labels),
    }

    def save(name: str) -> DataFrame:
        path = f"{folder}/{prefix}{name}" if folder else None
        return materialize_table(plans[name](), prefix + name, path, MART_RULES[name].not_null)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(spark)(save), name) for name in plans}
        models.update({name: job.result() for name, job in jobs.items()})
    # Nulls were counted as the marts were written.
    keys = {name: replace(rule, not_null=()) for name, rule in MART_RULES.items() if rule.unique}
    require_passed(run_checks(models, keys))
    return models


def run_pipeline(
    spark: SparkSession,
    folder: str,
    labels: str,
    track_parts: Mapping[str, DataFrame],
    lyrics: str,
    prefix: str = "",
) -> dict[str, DataFrame]:
    """Raw files to checked marts, everything stored below ``folder``."""
    transform_raw(spark, f"{folder}/processed", labels, track_parts, lyrics)
    inputs = {name: read_dataset(spark, f"{folder}/processed", name) for name in RAW}
    loaded = load_raw(spark, inputs, f"{prefix}raw_", f"{folder}/tables")
    return build_all(spark, loaded, prefix, f"{folder}/marts")
