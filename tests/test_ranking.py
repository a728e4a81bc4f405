import random

import pytest
from pyspark.sql import Window, functions as F

from cantogram.operators import ranking as R
from tests.conftest import rows


def word_rows(seed, n):
    rng = random.Random(seed)
    genres = ["hot"] * 6 + ["b", "c", None]
    pairs = {(rng.choice(genres), f"w{rng.randrange(n)}") for _ in range(n)}
    return [(g, w, rng.choice([1, 1, 1, 2, 3, 50, rng.randrange(900)])) for g, w in pairs]


@pytest.mark.parametrize("seed,n", [(1, 4000), (2, 40), (3, 1)])
def test_ranks_equal_row_number(spark, seed, n):
    df = spark.createDataFrame(word_rows(seed, n), "genre string, word string, total long")
    order = Window.partitionBy("genre").orderBy(F.desc("total"), "word")
    want = df.withColumn("rank", F.row_number().over(order))
    got = R.rank_within(df, ["genre"], "total", "word")
    assert rows(got) == rows(want)
    assert got.schema["rank"].dataType.simpleString() == "bigint"


def test_a_hot_group_is_ranked_by_many_tasks(spark):
    df = spark.range(20000).select(
        F.lit("g").alias("genre"), F.col("id").cast("string").alias("word"), F.lit(1).alias("total")
    )
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        got = R.rank_within(df, ["genre"], "total", "word")
        assert got.select(F.spark_partition_id()).distinct().count() > 1
        assert got.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first() == (
            1, 20000, 20000
        )
    finally:
        spark.conf.set(conf, "true")


def test_the_ranked_rows_move_once(spark, plan_of):
    """One range exchange sorts them; ranks then come from one row per task, without another exchange of rows."""
    df = spark.range(5000).selectExpr("id % 3 AS genre", "cast(id AS string) AS word", "id % 7 AS total")
    got = R.rank_within(df, ["genre"], "total", "word")
    rows_side = plan_of(got).split("BroadcastExchange")[0]
    assert "Exchange" not in rows_side and "SortMergeJoin" not in plan_of(got)
    assert rows(got) == rows(got)


@pytest.mark.parametrize(
    "kind,values",
    [("double", [None, 1.0, float("nan"), 2.5]), ("string", ["", None, "a", "é"]), ("boolean", [None, True, False])],
)
def test_groups_of_any_value_over_many_tasks(spark, kind, values):
    """Groups that begin, end and go on at task borders; nulls are a group, and so is NaN."""
    data = [(values[i % len(values)] if i % 5 else values[0], str(i), i % 4) for i in range(700)]
    df = spark.createDataFrame(data, f"k {kind}, word string, total int")
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        order = Window.partitionBy("k").orderBy(F.desc("total"), "word")
        want = df.withColumn("rank", F.row_number().over(order).cast("long"))
        assert list(map(repr, rows(R.rank_within(df, ["k"], "total", "word")))) == list(map(repr, rows(want)))
        two = df.withColumn("g", F.col("total") % 2)
        order = Window.partitionBy("k", "g").orderBy(F.desc("total"), "word")
        want = two.withColumn("rank", F.row_number().over(order))
        assert list(map(repr, rows(R.rank_within(two, ["k", "g"], "total", "word")))) == list(map(repr, rows(want)))
    finally:
        spark.conf.set(conf, "true")


def test_ranks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "genre string, word string, total long")
    assert R.rank_within(df, ["genre"], "total", "word").collect() == []


def test_top_within_equals_the_cut_of_the_ranks(spark):
    df = spark.createDataFrame(word_rows(7, 500), "genre string, word string, total long")
    ranked = R.rank_within(df, ["genre"], "total", "word").filter("rank <= 5")
    assert rows(R.top_within(df, ["genre"], "total", "word", 5)) == rows(ranked)


def test_argmax_takes_the_first_of_equals(spark):
    df = spark.createDataFrame(
        [("A", "y", 5), ("A", "x", 5), ("A", "z", 1), ("B", "y", 2), ("C", "x", None)],
        "country string, genre string, n long",
    )
    assert rows(R.argmax_by(df, "country", "n", "genre")) == [("A", "x", 5), ("B", "y", 2)]


def test_limits_and_orders(spark):
    df = spark.createDataFrame([("b", 2, 1), ("a", 2, 2), ("c", 9, 3)], "w string, n long, r int")
    assert [r.w for r in R.top_k(df, "n", "w", 2).collect()] == ["c", "a"]
    assert [r.w for r in R.top_by_rank(df, "r", 2).collect()] == ["b", "a"]
    assert [r.w for r in R.order_by_keys(df, "n", "w").collect()] == ["a", "b", "c"]
    assert R.preview_rows(df, 2).count() == 2


def test_sorting_checks_the_metric(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "genre string, avg_vocab_size double")
    assert [r.genre for r in R.sort_by_metric(df, "avg_vocab_size").collect()] == ["b", "a"]
    with pytest.raises(ValueError):
        R.sort_by_metric(df, "genre")


def test_the_total_row_comes_first(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "genre string, m double")
    total = spark.createDataFrame([("All", 2.0)], "genre string, m double")
    got = R.union_total_row(total, df, "m").collect()
    assert [(r.genre, r.section) for r in got] == [("All", 0), ("b", 1), ("a", 1)]
