import os
import sqlite3
import zipfile

import pytest
from pyspark.sql import Observation, functions as F

from cantogram.schemas import COUNTRIES, RAW_LYRICS
from cantogram.sources import archives, generations, labels, sinks, sqlite, tables
from catalogue import raw_files
from tests.conftest import rows

LINES = [
    "# a comment",
    "  # one after blanks",
    "TR1\tRock\tFolk",
    "TR2\tPop",
    " TR3\tJazz\t ",
    "TR4\tRap\tR&B\tmore",
]
WANT = [("TR1", "Rock", "Folk"), ("TR2", "Pop", None), ("TR3", "Jazz", None), ("TR4", "Rap", "R&B")]


def write_lines(path, lines):
    path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return str(path)


def test_label_file(spark, tmp_path):
    assert rows(labels.read_labels(spark, write_lines(tmp_path / "l.cls", LINES))) == WANT


@pytest.mark.parametrize("bad", ["TR9", ""])
def test_short_label_line_raises_or_is_counted(spark, tmp_path, bad):
    path = write_lines(tmp_path / "l.cls", [*LINES, bad])
    with pytest.raises(Exception, match="no field 2 in line"):
        labels.read_labels(spark, path).collect()
    seen = Observation()
    kept = labels.read_labels(spark, path, labels.DROPMALFORMED, seen)
    assert rows(kept) == WANT and seen.get["malformed"] == 1
    with pytest.raises(ValueError):
        labels.read_labels(spark, path, "PERMISSIVE")


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as archive:
        for name, text in members:
            archive.writestr(name, text)


def test_zip_reads_the_first_member_of_every_archive(spark, tmp_path):
    text = "".join(line + "\n" for line in LINES)
    make_zip(tmp_path / "one.zip", [("a.cls", text), ("b.cls", "other\tOther\n")])
    make_zip(tmp_path / "two.zip", [("c.cls", "TR7\tMétal")])
    make_zip(tmp_path / "three.zip", [])
    got = labels.read_labels(spark, f"{tmp_path}/*.zip")
    assert rows(got) == rows(spark.createDataFrame([*WANT, ("TR7", "Métal", None)], "a string, b string, c string"))


def test_zip_text_must_be_utf8(spark, tmp_path):
    make_zip(tmp_path / "bad.zip", [("a", b"TR1\t\xff\xfe\n")])
    with pytest.raises(Exception, match="utf-8"):
        archives.read_zip_text(spark, str(tmp_path / "bad.zip")).collect()


def test_zip_batches_keep_every_line(spark, tmp_path):
    n = archives.LINES_PER_BATCH * 2 + 7
    make_zip(tmp_path / "big.zip", [("a", "".join(f"{i}\n" for i in range(n)))])
    got = archives.read_zip_text(spark, str(tmp_path / "big.zip"))
    assert got.agg(F.count("*"), F.sum(F.col("value").cast("long"))).first() == (n, n * (n - 1) // 2)


# SQLite


def make_db(path, n=2000, extra="", without_rowid=False):
    db = sqlite3.connect(path)
    if without_rowid:
        db.execute(
            "CREATE TABLE lyrics (track_id TEXT, word TEXT, count INTEGER, is_test INTEGER,"
            " PRIMARY KEY (track_id, word)) WITHOUT ROWID"
        )
    else:
        db.execute("CREATE TABLE lyrics (track_id TEXT, word TEXT, count INTEGER, is_test INTEGER)")
    db.executemany(
        "INSERT INTO lyrics VALUES (?, ?, ?, ?)",
        [(f"TRK{i:06d}", f"word{i % 50}", i % 100 + 1, int(i % 4 == 0)) for i in range(n)],
    )
    if extra:
        db.execute(extra)
    db.commit()
    db.close()
    return str(path)


def expected(n=2000):
    return sorted((f"TRK{i:06d}", f"word{i % 50}", i % 100 + 1) for i in range(n))


@pytest.mark.parametrize("parts", [1, 4, 7, None])
@pytest.mark.parametrize("without_rowid", [False, True])
def test_sqlite_round_trip(spark, tmp_path, parts, without_rowid):
    path = make_db(tmp_path / "m.db", without_rowid=without_rowid)
    df = sqlite.read_lyrics(spark, path, partitions=parts)
    assert df.schema == RAW_LYRICS
    assert df.rdd.getNumPartitions() == (parts or 1)
    got = rows(df)
    assert got == expected() and ("TRK000042", "word42", 43) in got


def test_sqlite_split_and_projection(spark, tmp_path):
    path = make_db(tmp_path / "m.db", 100)
    train, test = (sqlite.read_lyrics(spark, path, split=s, partitions=3) for s in ("train", "test"))
    assert (train.count(), test.count()) == (75, 25)
    words = sqlite.read_sqlite(spark, path, "lyrics", "count long", where="count > 90")
    assert sorted(r[0] for r in words.collect()) == list(range(91, 101))
    with pytest.raises(ValueError):
        sqlite.read_lyrics(spark, path, split="all")


def test_sqlite_sparse_rowids_and_empty_table(spark, tmp_path):
    path = make_db(tmp_path / "m.db", extra="DELETE FROM lyrics WHERE count % 3 = 0 OR rowid < 500")
    want = [r for i, r in enumerate(expected()) if r[2] % 3 and i + 1 >= 500]
    assert rows(sqlite.read_lyrics(spark, path, partitions=4)) == sorted(want)
    empty = make_db(tmp_path / "e.db", 0)
    assert sqlite.read_lyrics(spark, empty, partitions=4).count() == 0


def test_sqlite_folder_of_files(spark, tmp_path):
    folder = str(tmp_path / "parts")
    df = spark.createDataFrame(expected(), RAW_LYRICS).repartition(3)
    assert raw_files.write_sqlite_parts(df, folder, "lyrics") == 2000
    assert len(os.listdir(folder)) == 3
    assert rows(sqlite.read_lyrics(spark, folder, partitions=6)) == expected()


def test_sqlite_counts_that_do_not_fit_raise(spark, tmp_path):
    path = make_db(tmp_path / "m.db", 1, extra=f"UPDATE lyrics SET count = {2**40}")
    with pytest.raises(Exception):
        sqlite.read_lyrics(spark, path).collect()


# Tables and sinks


def test_dataset_round_trip_and_counts(spark, tmp_path):
    df = spark.createDataFrame(expected(), RAW_LYRICS)
    assert sinks.write_dataset(df, f"{tmp_path}/lyrics") == 2000
    back = tables.read_dataset(spark, str(tmp_path), "lyrics")
    assert back.schema == RAW_LYRICS and rows(back) == expected()
    assert sinks.write_dataset(df.limit(5), f"{tmp_path}/lyrics") == 5  # replaced
    assert tables.read_dataset(spark, str(tmp_path), "lyrics").count() == 5


def test_empty_frames_are_written_and_counted(spark, tmp_path):
    empty = spark.createDataFrame([], RAW_LYRICS)
    assert sinks.write_dataset(empty, f"{tmp_path}/lyrics") == 0
    assert tables.read_dataset(spark, str(tmp_path), "lyrics").count() == 0
    none = spark.range(5).filter("id < 0").groupBy("id").count()
    assert sinks.load_table(none, "empty_table", f"{tmp_path}/t", clustering=["id"]) == 0


def test_bounded_files(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.createDataFrame(expected(), RAW_LYRICS).coalesce(1)
    sinks.write_dataset(df, f"{tmp_path}/lyrics", max_rows=300)
    sizes = [
        pq.ParquetFile(p).metadata.num_rows for p in (tmp_path / "lyrics").glob("*/*.parquet")
    ]
    assert max(sizes) <= 300 and sum(sizes) == 2000 and len(sizes) == 7


def test_year_ranges_are_partitions_and_prune(spark, tmp_path, plan_of):
    years = [0, 1919, 1920, 1987, 2029, 2030, None]
    df = spark.createDataFrame([(y, "a") for y in years], "year short, artist_name string")
    spread = sinks.cluster_by(tables.with_year_bucket(df), ["artist_name"], within=["year_bucket"])
    path = str(tmp_path / "t")
    assert sinks.write_dataset(spread, path, partition_by=["year_bucket"]) == 7
    names = {p for p in os.listdir(generations.current_path(spark, path)) if p.startswith("year_bucket")}
    assert names == {
        "year_bucket=__HIVE_DEFAULT_PARTITION__", "year_bucket=1920", "year_bucket=1980",
        "year_bucket=2020",
    }
    back = tables.open_dataset(spark, path)
    pruned = tables.filter_years(back, 1985, 1989)
    assert rows(pruned.select("year")) == [(1987,)]
    assert "PartitionFilters: [isnotnull(year_bucket" in plan_of(pruned)
    assert rows(tables.filter_years(back, 1900, 2029).select("year")) == [(1919,), (1920,), (1987,), (2029,)]
    assert rows(tables.filter_years(back, 2025, 2100).select("year")) == [(2029,), (2030,)]


def test_clustering_splits_a_hot_value_over_tasks(spark, tmp_path):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("genre"),
        F.col("id"),
    )
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        sinks.write_dataset(sinks.cluster_by(df, ["genre"]), str(tmp_path / "c"))
    finally:
        spark.conf.set(conf, "true")
    files = tables.open_dataset(spark, str(tmp_path / "c")).groupBy(F.input_file_name().alias("file"))
    stats = files.agg(
        F.count("*").alias("n"), F.count_if(F.col("genre") == "hot").alias("hot"),
        F.count_distinct("genre").alias("kinds"),
    ).collect()
    assert sum(s.n for s in stats) == 30000
    assert sum(s.hot > 0 for s in stats) >= 3  # a third of all rows, in several files
    assert max(s.kinds for s in stats) < 51  # every file holds a narrow range


def test_loading_replaces_a_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, w string")
    path = str(tmp_path / "t")
    assert sinks.load_table(df, "load_test", path, clustering=["w"]) == 2
    assert sinks.load_table(df.filter("v = 1"), "load_test", path) == 1
    assert rows(spark.table("load_test")) == [(1, "a")]
    got = tables.scan_mart(spark, "load_test", "v = 1", ["v"])
    assert rows(got) == [(1, "a")]


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    good = spark.range(10)
    last = F.when(F.col("id") == 99, F.raise_error("last row").cast("long")).otherwise(F.col("id"))
    bad = spark.range(100).select(last.alias("id"))
    path = str(tmp_path / "d")
    sinks.write_dataset(good, path)
    with pytest.raises(Exception, match="last row"):
        sinks.write_dataset(bad, path)
    assert tables.open_dataset(spark, path).count() == 10 and os.listdir(tmp_path) == ["d"]
    assert sum(n.startswith("_generation") for n in os.listdir(path)) == 1
    for name, where in (("safe_managed", None), ("safe_external", str(tmp_path / "t"))):
        sinks.load_table(good, name, where)
        with pytest.raises(Exception, match="last row"):
            sinks.load_table(bad, name, where)
        assert spark.table(name).count() == 10
        assert sinks.load_table(good.filter("id < 3"), name, where) == 3
        assert spark.table(name).count() == 3


def test_a_dataset_can_be_replaced_by_a_plan_that_reads_it(spark, tmp_path):
    path = str(tmp_path / "d")
    sinks.write_dataset(spark.range(10), path)
    assert sinks.write_dataset(tables.open_dataset(spark, path).filter("id > 5"), path) == 4
    assert tables.open_dataset(spark, path).count() == 4


def test_a_partitioned_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "01"), (2, "02"), (3, None)], "v int, part string")
    assert sinks.load_table(df, "parted", path, partition_by=["part"]) == 3
    assert rows(spark.table("parted")) == rows(df)
    assert sinks.load_table(df.filter("v = 2"), "parted", path, partition_by=["part"]) == 1
    assert rows(spark.table("parted")) == [(2, "02")]


def test_view_is_lazy_and_table_is_stored(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    assert rows(sinks.materialize_view(df, "view_test")) == [(1,)]
    assert rows(sinks.materialize_table(df, "table_test", str(tmp_path / "m"))) == [(1,)]
    assert any(name.endswith(".parquet") for name in os.listdir(generations.current_path(spark, str(tmp_path / "m"))))


class Broken(Exception):
    pass


def breaking(monkeypatch, step, before):
    """Let one step of a write break off, before or after it is done."""
    done = getattr(generations, step)

    def broken(*args):
        if not before:
            done(*args)
        raise Broken(step)

    monkeypatch.setattr(generations, step, broken)


@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("step", ["begin", "switch", "clear"])
def test_a_write_that_breaks_off_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step, before):
    path = str(tmp_path / "d")
    for n in (10, 20):
        sinks.write_dataset(spark.range(n), path)
    held = tables.open_dataset(spark, path)
    with monkeypatch.context() as patch:
        breaking(patch, step, before)
        with pytest.raises(Broken):
            sinks.write_dataset(spark.range(30), path)
    new = step == "clear" or (step == "switch" and not before)
    assert tables.open_dataset(spark, path).count() == (30 if new else 20) and held.count() == 20
    assert sinks.write_dataset(spark.range(5), path) == 5 and tables.open_dataset(spark, path).count() == 5
    names = os.listdir(path)
    assert sum(n.startswith("_generation") for n in names) == sum(n.startswith("_current") for n in names) == 2


@pytest.mark.parametrize("where", ["path", None])
@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("step", ["begin_table", "switch", "switch_table", "clear_table", "clear"])
def test_a_load_that_breaks_off_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, before, where):
    if where is None and step in ("switch", "clear"):
        pytest.skip("only datasets with a path have this step")
    path, name = where and str(tmp_path / "t"), f"broken_{step}_{before}_{where or 'managed'}"
    for n in (10, 20):
        sinks.load_table(spark.range(n), name, path)
    with monkeypatch.context() as patch:
        breaking(patch, step, before)
        with pytest.raises(Broken):
            sinks.load_table(spark.range(30).selectExpr("id", "id AS more"), name, path)
    new = step in ("clear_table", "clear") or (step == "switch_table" and not before)
    got = spark.table(name)
    assert got.columns == (["id", "more"] if new else ["id"]) and got.count() == (30 if new else 20)
    assert sinks.load_table(spark.range(5), name, path) == 5 and spark.table(name).count() == 5
    left = [t.name for t in spark.catalog.listTables(pattern=f"{name}*")]
    assert len(left) <= 3 and name.lower() in left
    generations.drop_table(spark, name)
    assert spark.catalog.listTables(pattern=f"{name}*") == []


def test_a_plain_folder_and_a_plain_table_become_generations(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(7).write.parquet(path)
    assert tables.open_dataset(spark, path).count() == 7
    sinks.write_dataset(tables.open_dataset(spark, path).filter("id < 3"), path)
    assert tables.open_dataset(spark, path).count() == 3
    sinks.write_dataset(spark.range(4), path)
    assert tables.open_dataset(spark, path).count() == 4 and not [n for n in os.listdir(path) if n.endswith(".parquet")]
    spark.range(7).write.saveAsTable("once_plain")
    assert sinks.load_table(spark.range(2), "once_plain") == 2 and spark.table("once_plain").count() == 2
    generations.drop_table(spark, "once_plain")


def test_bucketed_loads_are_read_without_an_exchange(spark, tmp_path, plan_of):
    df = spark.range(3000).selectExpr("id % 200 AS k", "id AS v", "cast(id AS string) AS w")
    for path in (None, str(tmp_path / "b")):
        name = "bucketed_plain" if path is None else "bucketed_path"
        assert sinks.load_table(df, name, path, clustering=["k", "w"], buckets=(4, ["k"])) == 3000
        assert sinks.load_table(df.filter("v < 2000"), name, path, clustering=["k", "w"], buckets=(4, ["k"])) == 2000
        got = spark.table(name)
        assert rows(got) == rows(df.filter("v < 2000"))
        assert "Exchange" not in plan_of(got.groupBy("k").count()) and "Exchange" not in plan_of(got.groupBy("k", "w").count())
        generations.drop_table(spark, name)


def test_lookup_keeps_the_text_na(spark, tmp_path):
    path = write_lines(tmp_path / "c.csv", ["iso2,iso3,name", "NA,NAM,Namibia", 'XK,XKX,"A, B"'])
    assert rows(tables.read_lookup(spark, path)) == [("NA", "NAM", "Namibia"), ("XK", "XKX", "A, B")]
    assert rows(tables.read_lookup(spark, path, null_value="NA"))[0][0] in (None, "XK")
    built_in = tables.country_lookup(spark)
    assert built_in.schema == COUNTRIES and built_in.count() == 197


def test_listed_years_prune_partitions_at_run_time(spark, tmp_path, plan_of):
    years = [0, 1919, 1920, 1955, 1987, 2029, 2030, None]
    df = spark.createDataFrame([(y, "a") for y in years for _ in range(2)], "year short, artist_name string")
    path = str(tmp_path / "t")
    sinks.write_dataset(tables.with_year_bucket(df), path, partition_by=["year_bucket"])
    stored = tables.open_dataset(spark, path)
    kept = spark.createDataFrame([(1955, 7), (1955, 8), (2030, 9), (None, 9), (1987, 1)], "year int, score int").filter("score > 5")
    found = tables.years_in(stored, kept)
    assert rows(found.select("year")) == [(1955,), (1955,), (2030,), (2030,)]
    assert "dynamicpruning" in plan_of(found)
