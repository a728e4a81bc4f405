"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the given tables   (default /root/testdata/sf0.1)
BENCH_CPUS     local cores                  (default 8)
BENCH_RUNS     timed runs after a first one (default 2, the best counts)

As in a normal run, tracks, genres and lyrics are derived from the given tables,
stored, and loaded as clustered tables ("transform" and "load", once). Marts are
computed from the loaded tables, panels from the saved marts. Each query computes
its whole result. The first run of a query, which also compiles its code, is
reported under "first".
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from cantogram.operators import checks
    from cantogram.operators.nearest import nearest_join
    from cantogram.plans import marts, panels
    from cantogram.plans.pipeline import STAGES, build_all, load_raw
    from cantogram.plans.staging import stage_tracks
    from cantogram.session import build_session, scratch_path
    from cantogram.sources.sinks import write_dataset
    from cantogram.sources.tables import read_dataset
    from catalogue import domain

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "cantogram-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    store = scratch_path(spark, "bench")
    first, best = {}, {}

    def clock(run) -> float:
        start = time.perf_counter()
        df = run()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def note(name: str, cold: float, warm: float) -> None:
        first[name], best[name] = cold, warm
        print(f"{name:30s} {cold:8.3f} {warm:8.3f}", file=sys.stderr, flush=True)

    def measure(name: str, run) -> None:
        cold = clock(run)
        note(name, cold, min((clock(run) for _ in range(runs)), default=cold))

    def transform() -> None:
        for name in STAGES:
            write_dataset(getattr(domain, f"raw_{name}")(spark, folder), f"{store}/raw/{name}")

    def load() -> None:
        load_raw(spark, {n: read_dataset(spark, f"{store}/raw", n) for n in STAGES}, "bench_raw_", store)

    for name, step in (("transform", transform), ("load", load)):
        taken = clock(step)
        note(name, taken, taken)
    raw = {name: spark.table(f"bench_raw_{name}") for name in (*STAGES, "lyric_labels")}
    labels = raw["lyric_labels"]
    tracks, genres, lyrics = (stage(raw[name]) for name, stage in STAGES.items())
    dated = stage_tracks(raw["tracks"], known_year=True)

    measure("mart_features_by_year", lambda: marts.features_by_year(dated))
    measure("mart_features_by_year_genre", lambda: marts.features_by_year_genre(dated, genres))
    measure("mart_genre_fingerprints", lambda: marts.genre_fingerprints(tracks, genres))
    measure("mart_genre_by_location", lambda: marts.genre_by_location(tracks, genres))
    measure("mart_lyrical_diversity", lambda: marts.lyrical_diversity(lyrics, genres))
    measure("mart_top_words", lambda: marts.top_words(lyrics, labels))
    measure("mart_top_words_cut", lambda: marts.top_words_cut(lyrics, labels))
    built = {}

    def build() -> None:
        built.update(build_all(spark, raw, "bench_", store))

    measure("build_all", build)
    staged = {"stg_tracks": tracks, "stg_genres": genres, "stg_lyrics": lyrics}
    rules = {**checks.SOURCE_RULES, **checks.STAGING_RULES, **checks.MART_RULES}
    measure("check_report", lambda: checks.run_checks({**raw, **staged, **built}, rules))
    genre = "MACHINERY"
    by_year, by_year_genre = built["features_by_year"], built["features_by_year_genre"]
    words, cells = built["top_words"], built["genre_by_location"]
    places, countries = domain.places(spark, folder), domain.countries(spark, folder)
    measure("panel_trend", lambda: panels.trend(by_year, by_year_genre))
    measure("panel_trend_genre", lambda: panels.trend(by_year, by_year_genre, genre))
    measure("panel_fingerprint", lambda: panels.fingerprint(built["genre_fingerprints"], [genre]))
    measure("panel_top_words", lambda: panels.words(words))
    measure("panel_top_words_genre", lambda: panels.words(words, genre))
    measure("panel_diversity", lambda: panels.diversity(built["lyrical_diversity"]))
    measure("nearest_place", lambda: nearest_join(cells, places))
    measure("panel_dominant_genre", lambda: panels.dominant_genre(cells, places, countries))
    measure("panel_genre_share", lambda: panels.genre_share(cells, genre, places, countries))

    scale = re.search(r"sf([0-9.]+)/*$", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "first": first,
                "sf": float(scale.group(1)) if scale else folder,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
