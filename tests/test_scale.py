"""Queries on rows of their own: large keys, repeated and missing ids, and how often rows move."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from cantogram.sources.buckets import hot_keys
from catalogue import domain as D
from tests.conftest import rows

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "lineitem": "l_orderkey long, l_suppkey long, l_linenumber int, l_extendedprice double",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with repeated and null ids, null texts and languages; suppliers beyond a short."""
    at = str(tmp_path_factory.mktemp("given"))
    documents = [(1, "Love the LOVE", "en"), (1, "the sea", "de"), (1, None, "en"), (2, "sea-sea 3 Écume", None), (3, "", "en"), (3, "...", "en")]
    documents += [(None, "lost words", "en"), (None, "lost", "fr"), (4, "alone", "en")]
    given = {
        "documents": [(i, text, lang, "web", len(text or "")) for i, text, lang in documents],
        "lineitem": [(2**40, 60_000, 7, 0.1), (1, 1, 1, 2.5)],
    }
    for name, found in given.items():
        spark.createDataFrame(found, SCHEMAS[name]).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


def test_supplier_keys_beyond_a_short(spark, folder):
    kept = queries()["narrow_types"](spark, folder)
    assert {(r.l_orderkey, r.l_linenumber, r.l_suppkey) for r in kept.collect()} == {(str(2**40), 7, 60_000), ("1", 1, 1)}


def exchanges(plan):
    """Exchanges of a plan as it was first made."""
    return plan.split("== Initial Plan ==")[-1].count("Exchange")


def plain_lyrics(spark, folder):
    """The same words grouped without a thought of where they are."""
    words = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    found = D.table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("track_id"), words).filter("word <> ''")
    return found.groupBy("track_id", "word").agg(F.count(F.lit(1)).cast("int").alias("count"))


def test_lyrics_move_once_as_texts(spark, folder, plan_of):
    lyrics = D.raw_lyrics(spark, folder)
    assert rows(lyrics) == rows(plain_lyrics(spark, folder))
    per_track = lyrics.groupBy("track_id").agg(F.count_distinct("word"), F.sum("count"))
    for found in (lyrics, per_track):
        assert exchanges(plan_of(found)) == 1


def test_split_flags_repeat_a_word_for_each_document_of_its_track(spark, folder, plan_of):
    flags = D.table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("track_id"), F.when(F.col("lang") == "en", 0).otherwise(1).alias("is_test")
    )
    flagged = D.flagged_lyrics(spark, folder)
    assert flagged.columns == ["track_id", "word", "count", "is_test"]
    assert rows(flagged) == rows(plain_lyrics(spark, folder).join(flags, "track_id"))
    assert exchanges(plan_of(flagged)) == 1 and "Join" not in plan_of(flagged)


def test_keys_are_counted_in_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    words = spark.range(600).selectExpr("if(id % 3 = 0, 'hot', if(id % 50 = 1, null, concat('t', id))) AS track_id").mapInArrow(noted, "track_id string")
    hot = hot_keys(words, "track_id", 8)
    assert rows(hot) == [("hot", 3)]
    assert seen.value == 600
