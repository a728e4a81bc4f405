"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cantogram.llm.bpe import encode_decode
from cantogram.llm.chat import chat_digest, format_chats
from cantogram.llm.decontaminate import find_contamination
from cantogram.llm.licenses import scan_licenses
from cantogram.llm.near_dedup import near_duplicates
from cantogram.llm.periods import periodic_runs, run_digest, wrapped
from cantogram.llm.personal import find_personal, personal_digest
from cantogram.llm.quality import judge
from cantogram.llm.repeats import drop_repeats
from cantogram.llm.spelling import frequent_words, letter_runs, misspelt, spelling_variants
from cantogram.llm.token_files import token_digest
from cantogram.llm.toxicity import score_toxicity
from cantogram.llm.urls import judge_urls
from cantogram.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
VOCABULARY = "byte_bpe_50k.json"


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle=4)


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeats(table(spark, folder, "documents"), texts=False)


@query
def op9_rank_array_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), outputs=False)


@query
def op2_token_records(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-records")
    return token_digest(table(spark, folder, "documents"), path, public_tokenizers.path(VOCABULARY), end_id=2)


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("byte_spans")


@query
def op4_quality_mcd(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@query
def op6_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).drop("detections")


@query
def op7_url_segments(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_urls(table(spark, folder, "pages"), table(spark, folder, "documents"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.array_join("tokens", " ").alias("tokens"))


@query
def op5_weak_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_chat_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    said = F.lit(r"\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digest(format_chats(rows.union(added)))


@query
def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_digest(find_personal(table(spark, folder, "documents")))


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(frequent_words(misspelt(letter_runs(table(spark, folder, "documents")))))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digest(periodic_runs(wrapped(table(spark, folder, "documents"))))
