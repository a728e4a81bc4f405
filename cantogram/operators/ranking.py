"""Ranks, argmax, sorting and limits."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from cantogram.functions.fixed_values import DIVERSITY_METRICS, PANEL_WORDS
from cantogram.operators.filters import all_of
from cantogram.session import checkpoint_dir


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays agree; nulls agree with nulls and NaN with NaN, as in a group."""
    try:
        equal = pc.fill_null(pc.equal(a, b), False)
    except pa.ArrowNotImplementedError:  # nested values
        return np.array([x == y for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], dtype=bool)
    equal = pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(a.type):
        equal = pc.or_(equal, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return equal.to_numpy(zero_copy_only=False)


def _numbered(part: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to the sorted rows of a task its number, the row's, its place within the group, and whether that group is the task's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, before, rows, place, leads = TaskContext.get().partitionId(), None, 0, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            opens = np.zeros(n, dtype=bool)
            for i, name in enumerate(part):
                column = batch.column(name)
                opens[1:] |= ~_same(column.slice(1), column.slice(0, n - 1))
                if before is not None:
                    opens[0] |= not _same(column.slice(0, 1), before[i])[0]
            before = [batch.column(name).slice(n - 1) for name in part]
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(opens, at, -1))
            places = np.where(start < 0, place + at + 1, at - start + 1)
            lead = (start < 0) if leads else np.zeros(n, dtype=bool)
            leads, place = bool(lead[-1]), int(places[-1])
            added = [np.full(n, block, dtype=np.int64), rows + at, places, lead]
            rows += n
            yield pa.record_batch([*batch.columns, *map(pa.array, added)], names=[*batch.schema.names, "_block", "_row", "_place", "_lead"])

    return run


def rank_within(
    df: DataFrame, part: Sequence[str], value: str, tie: str, name: str = "rank"
) -> DataFrame:
    """Dense positions 1..n per group, by ``value`` descending, then ``tie`` ascending.

    A group may be far larger than a task should sort, so the whole table is
    range-sorted once and every task numbers its own rows by group. Only the group that a task
    begins with can have rows before them: what earlier tasks hold of it is one number per
    task, added where the rows are. The numbered rows are checkpointed: rows and
    numbers must come from the same partitions, also when a
    lost executor makes Spark compute some of them again.
    """
    checkpoint_dir(df.sparkSession)
    order = [*map(F.col, part), F.col(value).desc(), F.col(tie).asc()]
    fields = [("_block", T.LongType()), ("_row", T.LongType()), ("_place", T.LongType()), ("_lead", T.BooleanType())]
    schema = T.StructType([*df.schema, *(T.StructField(*f) for f in fields)])
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.mapInArrow(_numbered(part), schema).checkpoint()
    # The first and the last group of each task, with the rows that the task holds of them.
    group = F.struct(*part).alias("group")
    ends = placed.groupBy("_block").agg(
        F.min_by(group, "_row").alias("lead"), F.count_if("_lead").alias("leads"),
        F.max_by(group, "_row").alias("last"), F.max_by("_place", "_row").alias("lasts"),
        F.count(F.lit(1)).alias("rows"),
    )
    first = ends.select("_block", F.col("lead.*"), F.col("leads").alias("_rows"), F.lit(True).alias("_first"))
    final = ends.filter("leads < rows").select("_block", F.col("last.*"), F.col("lasts").alias("_rows"), F.lit(False).alias("_first"))
    earlier = Window.partitionBy(*part).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = first.unionByName(final).withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    # One row per task.
    shifts = F.broadcast(before.filter("_first").select("_block", "_before"))
    shift = F.when(F.col("_lead"), F.col("_before")).otherwise(0)
    return placed.join(shifts, "_block").select(*df.columns, (F.col("_place") + shift).alias(name))


def top_within(
    df: DataFrame, part: Sequence[str], value: str, tie: str, k: int, name: str = "rank"
) -> DataFrame:
    """The first ``k`` of each group in one plan.

    Rank and cut together let every task keep only its own first ``k`` per group
    before the shuffle, so a large group costs nothing.
    """
    order = Window.partitionBy(*part).orderBy(F.col(value).desc(), F.col(tie).asc())
    return df.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k).withColumn(name, F.col(name).cast("long"))


def argmax_by(df: DataFrame, group: str, value: str, tie: str) -> DataFrame:
    """The row with the largest value of each group; of equals, the first by ``tie``.

    Rows without a value never win, and a group of such rows gives none.
    """
    known = df.filter(F.col(value).isNotNull())
    return top_within(known, [group], value, tie, 1, "_rank").drop("_rank")


def order_by_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*keys)


def top_k(df: DataFrame, value: str, tie: str, k: int = PANEL_WORDS) -> DataFrame:
    """The ``k`` largest, of equals the first by ``tie``."""
    return df.orderBy(F.col(value).desc(), F.col(tie).asc()).limit(k)


def top_by_rank(df: DataFrame, rank: str = "word_rank", k: int = PANEL_WORDS) -> DataFrame:
    return df.orderBy(rank).limit(k)


def sort_by_metric(
    df: DataFrame, metric: str, tie: str = "genre", allowed: Sequence[str] = DIVERSITY_METRICS
) -> DataFrame:
    """Rows by one of the allowed metrics, largest first."""
    if metric not in allowed:
        raise ValueError(f"metric must be one of {list(allowed)}, not {metric!r}")
    return df.orderBy(F.col(metric).desc(), F.col(tie).asc())


def union_total_row(
    total: DataFrame, rows: DataFrame, metric: str, tie: str = "genre"
) -> DataFrame:
    """A total row, then the rows by metric; ``section`` 0 and 1 carry that order."""
    both = total.withColumn("section", F.lit(0)).unionByName(
        rows.withColumn("section", F.lit(1))
    )
    return both.orderBy("section", F.col(metric).desc(), F.col(tie).asc())


def preview_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
