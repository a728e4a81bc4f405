"""SQL that states each registered query's result on the given tables."""

from __future__ import annotations

import re

from cantogram.functions.fixed_values import COUNTRY_CODES, STOP_WORDS
from catalogue import domain

FEATURES = {
    "tempo": "tempo",
    "loudness": "loudness",
    "duration": "duration",
    "hotttnesss": "song_hotttnesss",
}
SCALED = list(FEATURES)
STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)


def _profile(keys: str, source: str, with_std: bool = True) -> str:
    stats = []
    for name, column in [*FEATURES.items(), ("mode", "mode")]:
        mean = "pct_major" if name == "mode" else f"avg_{name}"
        stats.append(f"avg({column}) AS {mean}")
        if with_std:
            stats.append(f"stddev_samp({column}) AS std_{name}")
    return f"SELECT {keys}, count(*) AS track_count, {', '.join(stats)} FROM {source} GROUP BY {keys}"


def _bounds(source: str) -> str:
    columns = [f"{f}(avg_{n}) AS {f}_avg_{n}" for f in ("min", "max") for n in SCALED]
    return f"SELECT {', '.join(columns)} FROM {source}"


def _normalized(source: str, with_std: bool = True) -> str:
    out = []
    for n in SCALED:
        width = f"nullif(max_avg_{n} - min_avg_{n}, 0)"
        out.append(f"(avg_{n} - min_avg_{n}) / {width} AS norm_{n}")
        if with_std:
            out.append(f"std_{n} / {width} AS norm_std_{n}")
    return f"SELECT p.*, {', '.join(out)} FROM {source} p CROSS JOIN ({_bounds(source)})"


_DATED = "(SELECT * FROM tracks WHERE year IS NOT NULL)"
_LABELLED = "tracks JOIN genres USING (track_id)"

# Distance along the sphere from the chord between unit vectors, to the millimetre.
_KM = """round(2 * 6371.0088 * asin(least(1.0, sqrt(
    power(cos(radians(c.lat)) * cos(radians(c.lon)) - cos(radians(p.lat)) * cos(radians(p.lon)), 2)
    + power(cos(radians(c.lat)) * sin(radians(c.lon)) - cos(radians(p.lat)) * sin(radians(p.lon)), 2)
    + power(sin(radians(c.lat)) - sin(radians(p.lat)), 2)) / 2)), 6)"""

TABLES = {
    **domain.SQL,
    "yearly": _profile("year", _DATED),
    "yearly_genre": _profile("year, genre", f"{_DATED} JOIN genres USING (track_id)"),
    "by_genre": _profile("genre", _LABELLED),
    "features_by_year": _normalized("yearly"),
    "features_by_year_genre": _normalized("yearly_genre"),
    "genre_fingerprints": f"""
        SELECT genre, track_count, avg_tempo, avg_loudness, avg_duration, avg_hotttnesss,
               norm_tempo, norm_loudness, norm_duration, norm_hotttnesss,
               pct_major AS norm_pct_major
        FROM ({_normalized('by_genre', with_std=False)})""",
    "genre_by_location": """
        SELECT round(artist_latitude, 0) + 0.0 AS lat, round(artist_longitude, 0) + 0.0 AS lon,
               genre, count(DISTINCT artist_name) AS artist_count
        FROM tracks JOIN genres USING (track_id)
        WHERE artist_latitude IS NOT NULL AND artist_longitude IS NOT NULL
        GROUP BY 1, 2, 3""",
    "track_vocab": """
        SELECT track_id, genre, count(DISTINCT word) AS vocab_size,
               CAST(sum(count) AS BIGINT) AS total_words
        FROM lyrics JOIN genres USING (track_id)
        GROUP BY track_id, genre""",
    "lyrical_diversity": """
        SELECT genre, count(*) AS track_count, avg(vocab_size) AS avg_vocab_size,
               avg(total_words) AS avg_total_words,
               avg(vocab_size / nullif(total_words, 0)) AS avg_type_token_ratio
        FROM track_vocab GROUP BY genre""",
    "top_words": f"""
        SELECT genre, word, CAST(sum(count) AS BIGINT) AS total_count,
               CAST(row_number() OVER (PARTITION BY genre ORDER BY sum(count) DESC, word)
                    AS BIGINT) AS word_rank
        FROM lyrics JOIN genres USING (track_id)
        WHERE word NOT IN ({STOPS})
        GROUP BY genre, word""",
    "nearest": f"""
        SELECT lat, lon, place_id, cc, distance_km
        FROM (SELECT c.lat, c.lon, p.place_id, p.cc, {_KM} AS distance_km,
                     row_number() OVER (PARTITION BY c.lat, c.lon
                                        ORDER BY {_KM}, p.place_id) AS position
              FROM (SELECT DISTINCT lat, lon FROM genre_by_location) c CROSS JOIN places p)
        WHERE position = 1""",
    "located": """
        SELECT lat, lon, genre, artist_count, coalesce(iso3, cc) AS country,
               coalesce(name, cc) AS country_name
        FROM genre_by_location JOIN nearest USING (lat, lon)
        LEFT JOIN countries ON cc = iso2""",
}


def with_tables(final: str) -> str:
    """The query behind the common tables it needs, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+\(*{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final
    head = ",\n".join(f"{name} AS ({TABLES[name]})" for name in needed)
    return f"WITH {head}\n{final}"


def _round(source: str, digits: dict[str, int]) -> str:
    changed = ", ".join(f"round({c}, {d}) AS {c}" for c, d in digits.items())
    return f"SELECT * REPLACE ({changed}) FROM {source}"


STD = {f"std_{n}": 6 for n in [*SCALED, "mode"]}
NORM_STD = {f"norm_std_{n}": 6 for n in SCALED}
RATIO = {"avg_type_token_ratio": 9}
WEIGHTED = {"avg_vocab_size": 9, "avg_total_words": 9, **RATIO}

_WIDE_RAW = """
    SELECT * REPLACE (CAST(year AS INTEGER) AS year, CAST(duration AS DOUBLE) AS duration,
        CAST(tempo AS DOUBLE) AS tempo, CAST(loudness AS DOUBLE) AS loudness,
        CAST(key AS INTEGER) AS key, CAST(mode AS INTEGER) AS mode,
        CAST(time_signature AS INTEGER) AS time_signature,
        CAST(danceability AS DOUBLE) AS danceability, CAST(energy AS DOUBLE) AS energy,
        CAST(song_hotttnesss AS DOUBLE) AS song_hotttnesss,
        CAST(artist_hotttnesss AS DOUBLE) AS artist_hotttnesss,
        CAST(artist_latitude AS DOUBLE) AS artist_latitude,
        CAST(artist_longitude AS DOUBLE) AS artist_longitude)
    FROM raw_tracks"""


def _trend_series(source: str, ids: str = "year") -> str:
    parts = []
    labels = ["Tempo", "Loudness", "Duration", "Hotttnesss"]
    units = ["BPM", "dB", "sec", ""]
    for i, (n, label, unit) in enumerate(zip(SCALED, labels, units)):
        parts.append(
            f"SELECT {ids}, track_count, {i} AS position, '{label}' AS feature,"
            f" norm_{n} AS value, avg_{n} AS raw_value, norm_std_{n} AS std, '{unit}' AS unit"
            f" FROM {source}"
        )
    parts.append(
        f"SELECT {ids}, track_count, 4 AS position, '% Major Key' AS feature, pct_major AS value,"
        f" pct_major AS raw_value, std_mode AS std, 'pct' AS unit FROM {source}"
    )
    return " UNION ALL ".join(parts)


def _band(source: str, keep_all: bool) -> str:
    known = "value IS NOT NULL AND std IS NOT NULL"
    lower = "greatest(least(value - 1.96 * std / sqrt(track_count), 1), 0)"
    upper = "value + 1.96 * std / sqrt(track_count)"
    return f"""
        SELECT * REPLACE (round(std, 6) AS std),
               round(CASE WHEN {known} THEN {lower} END, 6) AS lower,
               round(CASE WHEN {known} THEN {upper} END, 6) AS upper
        FROM ({source}) {'' if keep_all else 'WHERE ' + known}"""


_FINGERPRINT = " UNION ALL ".join(
    f"SELECT genre, {i} AS position, '{label}' AS feature, {value} AS value, {raw} AS raw_value,"
    f" '{unit}' AS unit FROM genre_fingerprints WHERE genre IN ('MACHINERY', 'FURNITURE')"
    for i, (label, value, raw, unit) in enumerate(
        [
            ("Tempo", "norm_tempo", "avg_tempo", "BPM"),
            ("Loudness", "norm_loudness", "avg_loudness", "dB"),
            ("Duration", "norm_duration", "avg_duration", "sec"),
            ("Hotttnesss", "norm_hotttnesss", "avg_hotttnesss", ""),
            ("% Major", "norm_pct_major", "norm_pct_major", "%"),
        ]
    )
)

_WEIGHTED_ALL = """
    SELECT 'All' AS genre, CAST(sum(track_count) AS BIGINT) AS track_count,
           round(sum(avg_type_token_ratio * track_count) / sum(track_count), 9)
               AS avg_type_token_ratio,
           round(sum(avg_vocab_size * track_count) / sum(track_count), 9) AS avg_vocab_size,
           round(sum(avg_total_words * track_count) / sum(track_count), 9) AS avg_total_words
    FROM lyrical_diversity"""
_WITH_TOTAL = f"""
    SELECT *, 0 AS section FROM ({_WEIGHTED_ALL})
    UNION ALL
    SELECT genre, track_count, round(avg_type_token_ratio, 9), round(avg_vocab_size, 9),
           round(avg_total_words, 9), 1 FROM lyrical_diversity"""

_FIELDS = r"string_split(regexp_replace(value, '^\s+|\s+$', '', 'g'), chr(9))"
_COUNTRY_GENRE = """
    SELECT country, genre, CAST(sum(artist_count) AS BIGINT) AS artist_count
    FROM {0} GROUP BY country, genre"""
_LARGEST = """
    SELECT country, genre, artist_count FROM (
        SELECT *, row_number() OVER (PARTITION BY country ORDER BY artist_count DESC, genre)
            AS position
        FROM ({0})) WHERE position = 1"""
_TOTALS = """
    SELECT country, CAST(sum(artist_count) AS BIGINT) AS {1} FROM {0} GROUP BY country"""


def _share(source: str) -> str:
    return f"""
        SELECT country, genre_artists, total_artists,
               genre_artists / total_artists * 100 AS pct
        FROM (SELECT country, CAST(sum(artist_count) AS BIGINT) AS genre_artists
              FROM {source} WHERE genre = 'MACHINERY' GROUP BY country)
        JOIN ({_TOTALS.format(source, 'total_artists')}) USING (country)"""


def _not_null(table: str, *columns: str) -> list[str]:
    return [
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", 'not_null' AS \"check\","
        f" count(*) FILTER ({c} IS NULL) AS failures FROM {{0}}"
        for c in columns
    ]


def _report() -> str:
    from cantogram.operators.checks import MART_RULES, SOURCE_RULES, STAGING_RULES

    parts = []
    for rules in (SOURCE_RULES, STAGING_RULES, MART_RULES):
        for name, rule in rules.items():
            source = f"raw_{name}" if name in SOURCE_RULES else name.removeprefix("stg_")
            parts += [q.format(source) for q in _not_null(name, *rule.not_null)]
            for key in rule.unique:
                known = " AND ".join(f"{c} IS NOT NULL" for c in key)
                parts.append(
                    f"SELECT '{name}' AS \"table\", '{', '.join(key)}' AS \"column\","
                    f" 'unique' AS \"check\", count(*) AS failures FROM (SELECT 1 FROM {source}"
                    f" WHERE {known} GROUP BY {', '.join(key)} HAVING count(*) > 1)"
                )
    return " UNION ALL ".join(parts)


def _table_profiles() -> str:
    from cantogram.schemas import RAW

    parts = []
    for name, schema in RAW.items():
        for i, field in enumerate(schema):
            parts.append(
                f"SELECT '{name}' AS \"table\", {i} AS position, '{field.name}' AS \"column\","
                f" '{field.dataType.simpleString()}' AS \"type\", count(*) AS row_count"
                f" FROM raw_{name}"
            )
    return " UNION ALL ".join(parts)


MODELS = {
    "stg_tracks": "tracks",
    "stg_genres": "genres",
    "stg_lyrics": "lyrics",
    **{
        name: name
        for name in (
            "features_by_year", "features_by_year_genre", "genre_fingerprints",
            "genre_by_location", "lyrical_diversity", "top_words",
        )
    },
}


def _counts(tables: dict[str, str], label: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"{label}\", count(*) AS {value} FROM {source}"
        for name, source in tables.items()
    )


_DATASETS = {"tracks": "raw_tracks", "genres": "raw_genres", "lyrics": "raw_lyrics"}

_QUERIES = {
    # Sources
    "read_label_file": "SELECT * FROM raw_genres",
    "read_zip_lines": "SELECT value FROM label_lines",
    "read_sqlite_table": "SELECT * FROM raw_lyrics",
    "zip_row_aligned": _WIDE_RAW,
    "scan_parquet": _WIDE_RAW,
    "scan_lookup_csv": "SELECT * FROM countries",
    "scan_mart": _round("features_by_year_genre", STD | NORM_STD)
    + " WHERE genre = 'MACHINERY' ORDER BY year",
    # Sinks
    "write_parquet": "SELECT * FROM raw_genres",
    "write_parquet_bounded": "SELECT * FROM raw_lyrics",
    "load_truncate": "SELECT * FROM raw_genres",
    "range_partition_by_year": """
        SELECT track_id, CAST(year AS INTEGER) AS year,
               CASE WHEN year >= 1920 AND year < 2030
                    THEN CAST(floor((year - 1920) / 10) * 10 + 1920 AS INTEGER) END AS year_bucket
        FROM raw_tracks""",
    "cluster_by": "SELECT * FROM raw_lyrics",
    "load_row_count": f"""
        SELECT dataset, rows_read, rows_read AS rows_written
        FROM ({_counts(_DATASETS, 'dataset', 'rows_read')})""",
    "materialize_view": "SELECT * FROM tracks",
    "materialize_table": "SELECT * FROM genre_fingerprints",
    "build_all": _counts(MODELS, "model", "row_count"),
    # Projections
    "stg_tracks": "SELECT * FROM tracks",
    "stg_genres": "SELECT * FROM genres",
    "stg_lyrics": "SELECT * FROM lyrics",
    "sentinel_to_null": "SELECT track_id, nullif(CAST(year AS INTEGER), 0) AS year FROM raw_tracks",
    "nan_to_null": "SELECT track_id, song_hotttnesss, artist_latitude FROM tracks",
    "decode_utf8": "SELECT doc_id, text FROM documents",
    "narrow_types": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
               CAST(l_linenumber AS INTEGER) AS l_linenumber,
               CAST(l_suppkey AS INTEGER) AS l_suppkey,
               CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS l_extendedprice
        FROM lineitem""",
    "trim_split": f"""
        SELECT {_FIELDS}[1] AS first_field, {_FIELDS}[2] AS second_field,
               CAST(len({_FIELDS}) AS INTEGER) AS n_fields
        FROM label_lines""",
    "optional_field": f"SELECT {_FIELDS}[1] AS track_id, {_FIELDS}[3] AS third_field FROM label_lines",
    "round_grid": """
        SELECT track_id, round(artist_latitude, 0) + 0.0 AS lat,
               round(artist_longitude, 0) + 0.0 AS lon
        FROM tracks""",
    "safe_divide": """
        SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS ratio
        FROM lineitem""",
    "confidence_band": _band(_trend_series("features_by_year_genre", "year, genre"), False),
    "opacity_scale": f"""
        SELECT country, total, total / max(total) OVER () AS norm_total,
               total / max(total) OVER () * 0.7 + 0.3 AS opacity
        FROM ({_TOTALS.format('country_cells', 'total')})""",
    "unnest_literal": f"""
        SELECT word, CAST(sum(count) AS BIGINT) AS total_count
        FROM lyrics JOIN (SELECT unnest([{STOPS}]) AS word) USING (word)
        GROUP BY word""",
    "rename_passthrough": """
        SELECT genre, track_count, avg_tempo, avg_loudness, avg_duration, avg_hotttnesss,
               pct_major AS norm_pct_major
        FROM by_genre""",
    "word_length": "SELECT track_id, word, CAST(length(word) AS INTEGER) AS letters FROM lyrics",
    "unpivot_features": "SELECT * REPLACE (round(std, 6) AS std) FROM ("
    + _trend_series("features_by_year") + ")",
    # Filters
    "year_known": "SELECT track_id, year FROM tracks WHERE year IS NOT NULL",
    "located_only": """
        SELECT track_id, artist_latitude, artist_longitude FROM tracks
        WHERE artist_latitude IS NOT NULL AND artist_longitude IS NOT NULL""",
    "skip_comments": r"""
        SELECT value FROM label_lines
        WHERE NOT starts_with(regexp_replace(value, '^\s+', ''), '#')""",
    "stoplist_filter": f"SELECT * FROM lyrics WHERE word NOT IN ({STOPS})",
    "train_split_only": "SELECT * FROM flagged_lyrics WHERE is_test = 0",
    "trend_support": _round("yearly_genre", STD) + " WHERE year >= 1920 AND track_count >= 50",
    "select_group": _round("yearly_genre", STD) + " WHERE genre = 'MACHINERY'",
    "rank_cut": "SELECT * FROM top_words WHERE word_rank <= 20",
    "min_word_length": "SELECT * FROM lyrics WHERE length(word) >= 3",
    "genres_in": "SELECT * FROM genre_fingerprints WHERE genre IN ('MACHINERY', 'FURNITURE')",
    "drop_null_rows": """
        SELECT track_id, year, song_hotttnesss FROM tracks
        WHERE year IS NOT NULL AND song_hotttnesss IS NOT NULL""",
    # Joins
    "join_tracks_genres": """
        SELECT track_id, artist_name, year, genre FROM tracks JOIN genres USING (track_id)""",
    "join_lyrics_genres": """
        SELECT track_id, word, count, genre FROM lyrics JOIN genres USING (track_id)""",
    "join_bounds": f"""
        SELECT year, track_count, avg_tempo, min_avg_tempo, max_avg_tempo
        FROM yearly CROSS JOIN ({_bounds('yearly')})""",
    "not_in_subquery": """
        SELECT * FROM lyrics WHERE word NOT IN (SELECT listed FROM listed_words)""",
    "lookup_with_fallback": """
        SELECT place_id, cc, coalesce(iso3, cc) AS country, coalesce(name, cc) AS country_name
        FROM places LEFT JOIN countries ON cc = iso2""",
    "nearest_place": "SELECT * FROM nearest",
    "join_totals": f"""
        SELECT country, genre, artist_count, total
        FROM ({_COUNTRY_GENRE.format('country_cells')})
        JOIN ({_TOTALS.format('country_cells', 'total')}) USING (country)""",
    "join_names": f"""
        SELECT country, total, country_name
        FROM ({_TOTALS.format('country_cells', 'total')})
        JOIN (SELECT DISTINCT country, country_name FROM country_cells) USING (country)""",
    # Aggregations
    "profile_by_key": _round("yearly", STD),
    "global_bounds": _bounds("yearly_genre"),
    "minmax_normalize": _round("(" + _normalized("by_genre") + ")", STD | NORM_STD),
    "vocab_per_track": "SELECT * FROM track_vocab",
    "avg_of_ratios": _round("lyrical_diversity", RATIO),
    "word_totals": """
        SELECT genre, word, CAST(sum(count) AS BIGINT) AS total_count
        FROM lyrics JOIN genres USING (track_id) GROUP BY genre, word""",
    "artists_per_cell": "SELECT * FROM genre_by_location",
    "word_totals_all": """
        SELECT word, CAST(sum(total_count) AS BIGINT) AS total_count
        FROM top_words WHERE word_rank <= 20 AND length(word) >= 3 GROUP BY word""",
    "artists_per_country_genre": _COUNTRY_GENRE.format("country_cells"),
    "argmax_per_group": _LARGEST.format(_COUNTRY_GENRE.format("country_cells")),
    "country_totals": _TOTALS.format("country_cells", "total"),
    "share_of_total": _share("country_cells"),
    "scale_by_max": f"""
        SELECT country, total, total / max(total) OVER () AS norm_total
        FROM ({_TOTALS.format('country_cells', 'total')})""",
    "weighted_total_row": _WEIGHTED_ALL,
    "count_and_distinct": """
        SELECT count(*) AS row_count, count(DISTINCT track_id) AS distinct_count FROM lyrics""",
    "distinct_values": "SELECT DISTINCT genre FROM genres ORDER BY genre",
    # Windows, sorts, sets
    "rank_words": """
        SELECT genre, word, CAST(sum(count) AS BIGINT) AS total_count,
               CAST(row_number() OVER (PARTITION BY genre ORDER BY sum(count) DESC, word)
                    AS BIGINT) AS word_rank
        FROM lyrics JOIN genres USING (track_id) GROUP BY genre, word""",
    "order_by_keys": _round("yearly_genre", STD) + " ORDER BY year, genre",
    "topk_words": """
        SELECT word, CAST(sum(count) AS BIGINT) AS total_count FROM lyrics
        GROUP BY word ORDER BY total_count DESC, word LIMIT 15""",
    "topk_by_rank": """
        SELECT * FROM top_words WHERE genre = 'MACHINERY' ORDER BY word_rank LIMIT 15""",
    "sort_by_metric": _round("lyrical_diversity", RATIO) + " ORDER BY avg_vocab_size DESC",
    "preview_rows": _round("features_by_year", STD | NORM_STD) + " ORDER BY year LIMIT 5",
    "union_total_row": _WITH_TOTAL,
    # Marts
    "mart_features_by_year": _round("features_by_year", STD | NORM_STD),
    "mart_features_by_year_genre": _round("features_by_year_genre", STD | NORM_STD),
    "mart_genre_fingerprints": "SELECT * FROM genre_fingerprints",
    "mart_genre_by_location": "SELECT * FROM genre_by_location",
    "mart_lyrical_diversity": _round("lyrical_diversity", RATIO),
    "mart_top_words": "SELECT * FROM top_words",
    "mart_top_words_cut": "SELECT * FROM top_words WHERE word_rank <= 20",
    # Panels
    "panel_trend": _band(
        _trend_series("features_by_year") , True
    ) + " WHERE year >= 1920 AND track_count >= 50",
    "panel_trend_genre": _band(
        _trend_series("features_by_year_genre", "year, genre"), True
    ).replace("SELECT * REPLACE", "SELECT * EXCLUDE (genre) REPLACE", 1)
    + " WHERE genre = 'MACHINERY' AND year >= 1920 AND track_count >= 50",
    "panel_fingerprint": _FINGERPRINT,
    "panel_top_words": """
        SELECT word, CAST(sum(total_count) AS BIGINT) AS total_count
        FROM top_words WHERE word_rank <= 20 AND length(word) >= 3
        GROUP BY word ORDER BY total_count DESC, word LIMIT 15""",
    "panel_top_words_genre": """
        SELECT word, total_count FROM top_words
        WHERE genre = 'MACHINERY' AND word_rank <= 20 AND length(word) >= 3
        ORDER BY word_rank LIMIT 15""",
    "panel_diversity": _WITH_TOTAL,
    "panel_dominant_genre": f"""
        SELECT country, country_name, genre, artist_count, total,
               total / max(total) OVER () AS norm_total,
               total / max(total) OVER () * 0.7 + 0.3 AS opacity
        FROM ({_LARGEST.format(_COUNTRY_GENRE.format('located'))})
        JOIN ({_TOTALS.format('located', 'total')}) USING (country)
        JOIN (SELECT DISTINCT country, country_name FROM located) USING (country)""",
    "panel_genre_share": f"""
        SELECT country, country_name, genre_artists, total_artists, pct
        FROM ({_share('located')})
        JOIN (SELECT DISTINCT country, country_name FROM located) USING (country)""",
    # Checks and profiles
    "check_not_null": """
        SELECT 'year' AS "column", count(*) FILTER (year IS NULL) AS failures FROM tracks
        UNION ALL
        SELECT 'artist_latitude', count(*) FILTER (artist_latitude IS NULL) FROM tracks
        UNION ALL
        SELECT 'track_id', count(*) FILTER (track_id IS NULL) FROM tracks""",
    "check_unique": """
        SELECT o_custkey, count(*) AS copies FROM orders
        WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1""",
    "check_composite_key": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_report": _report(),
    "profile_tables": _table_profiles(),
    "list_tables": """
        SELECT 'tracks' AS "table", count(*) AS row_count,
               count(DISTINCT track_id) AS distinct_count, least(5, count(*)) AS previewed FROM tracks
        UNION ALL
        SELECT 'genres', count(*), count(DISTINCT track_id), least(5, count(*)) FROM genres
        UNION ALL
        SELECT 'lyrics', count(*), count(DISTINCT track_id), least(5, count(*)) FROM lyrics""",
}

# Layouts: the same results from tables stored by year, in bounded files, and in buckets.
_BUCKET = """CASE WHEN year >= 1920 AND year < 2030
                    THEN CAST(floor((year - 1920) / 10) * 10 + 1920 AS INTEGER) END AS year_bucket"""
_CODES = ", ".join("('" + "', '".join(f.replace("'", "''") for f in line.split(",", 2)) + "')" for line in COUNTRY_CODES.splitlines())
_PLACED = """
          SELECT round(artist_latitude, 0) + 0.0 AS lat, round(artist_longitude, 0) + 0.0 AS lon, genre, artist_name
          FROM tracks JOIN genres USING (track_id)
          WHERE artist_latitude IS NOT NULL AND artist_longitude IS NOT NULL"""
_QUERIES |= {
    "filter_years": f"""
        SELECT track_id, CAST(year AS INTEGER) AS year, {_BUCKET}
        FROM raw_tracks WHERE year BETWEEN 1993 AND 1996""",
    "years_in": f"""
        SELECT track_id, CAST(year AS INTEGER) AS year, {_BUCKET}
        FROM raw_tracks WHERE year IN (SELECT year FROM features_by_year WHERE norm_tempo > 0.5)""",
    "bounded_files": 'SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS files_over, true AS enough_files FROM raw_lyrics',
    "bucketed_lyrics": "SELECT * FROM raw_lyrics",
    "bucketed_diversity": _round("lyrical_diversity", RATIO),
    "bucketed_top_words": "SELECT * FROM top_words",
    "bucketed_key_check": """
        SELECT track_id, word, CAST(2 AS BIGINT) AS copies FROM flagged_lyrics WHERE is_test = 1""",
    "country_table": f"""
        SELECT coalesce(iso2, n_name) AS cc, coalesce(iso3, n_name) AS country,
               coalesce(name, n_name) AS country_name, count(*) AS customers
        FROM nation JOIN customer ON c_nationkey = n_nationkey
        LEFT JOIN (VALUES {_CODES}) AS known(iso2, iso3, name) ON lower(name) = lower(n_name)
        GROUP BY n_nationkey, 1, 2, 3""",
    "distinct_levels": f"""
        SELECT 'cell' AS level, lat, lon, genre, count(DISTINCT artist_name) AS artist_count FROM ({_PLACED}) GROUP BY lat, lon, genre
        UNION ALL
        SELECT 'row', lat, NULL, genre, count(DISTINCT artist_name) FROM ({_PLACED}) GROUP BY lat, genre
        UNION ALL
        SELECT 'world', NULL, NULL, genre, count(DISTINCT artist_name) FROM ({_PLACED}) GROUP BY genre""",
}


def all_sql() -> dict[str, str]:
    return {name: with_tables(query) for name, query in _QUERIES.items()}
