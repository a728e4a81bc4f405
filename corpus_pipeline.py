"""The training-data pipeline: stages over ``documents``, each written as Parquet and read again.

A rejected row leaves for good. Rows that share an id are one document: near-dedup keeps or drops them together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cantogram.llm.bpe import encode_decode
from cantogram.llm.decontaminate import without_contamination
from cantogram.llm.near_dedup import near_duplicates
from cantogram.llm.quality import without_rejected
from cantogram.llm.repeats import without_repeats
from cantogram.llm.scratch import stored

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_rejected(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words, a similarity of 0.8: the document with the smallest id of each group stays."""
    gone = near_duplicates(docs, shingle=5, percent=80).filter("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated words go; a document of which nothing is left goes too."""
    kept = without_repeats(docs)
    changed = kept.withColumn("n_chars", F.char_length("text")) if "n_chars" in docs.columns else kept
    return changed.filter("text IS NULL OR text != ''").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return without_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs, public_tokenizers.path(VOCABULARY), outputs=False)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("token ids", token_ids),
]
#: Quality estimates and the tokenizer are outside SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
