"""Tables stored by the hash of a key, so that joins and aggregates on it need no exchange of their rows.

A key with more rows than an even bucket would make one task as large as itself. Its rows carry a
``salt``, a hash of further columns, and buckets go by (key, salt): every other key has salt 0. Partial results per
(key, salt) are small and meet in a second step; a table that is to be joined repeats the rows of such keys once per salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cantogram.session import checkpoint_dir

SALT = "salt"


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as a shuffle of the session has partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """(key, salts): keys with more rows than an even bucket, and how many buckets each fills. Fewer than ``buckets`` rows.

    ``df`` may be costly and is computed once: its keys are checkpointed with their numbers of rows.
    """
    checkpoint_dir(df.sparkSession)
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).checkpoint()
    share = counts.agg(F.greatest(F.sum("rows") / buckets, F.lit(1.0))).scalar()
    return counts.filter(F.col(key).isNotNull() & (F.col("rows") > share)).select(key, F.ceil(F.col("rows") / share).cast("int").alias("salts"))


def with_salt(df: DataFrame, hot: DataFrame, key: str, spread: Sequence[str]) -> DataFrame:
    """``df`` with the salt of each row: a hash of the ``spread`` columns for keys in ``hot``, else 0.

    Rows without a key are dealt by their hash like a hot key of any size.
    """
    hashed = F.xxhash64(*spread)
    salt = F.when(F.col(key).isNull(), F.pmod(hashed, F.lit(1 << 16))).otherwise(F.coalesce(F.pmod(hashed, F.col("salts")), F.lit(0)))
    # ``hot`` has fewer rows than there are buckets.
    return df.join(F.broadcast(hot), key, "left").withColumn(SALT, salt.cast("int")).select(*df.columns, SALT)


def per_salt(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``df`` once for every salt that rows of its key may carry, to be joined with them on (key, salt)."""
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    return df.join(F.broadcast(hot), key, "left").withColumn(SALT, salts).select(*df.columns, SALT)


def salted(key: str, *tables: DataFrame) -> list[str]:
    """The columns to join or group by for ``key``: with the salt, where all tables carry one."""
    return [key, SALT] if all(SALT in t.columns for t in tables) else [key]
