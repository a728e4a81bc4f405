"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cantogram.llm.scratch import discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Every round each node takes the smallest label among its own and its neighbours', and then the
    label that this label's node has (pointer jumping), so rounds grow with the logarithm of a
    component's width. A hub meets its label in a join, which the adaptive skew join can split, and
    neighbours are reduced on the map side. Null ends and loops add nothing; repeated edges are one.
    """
    pairs = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a != b").select("a", "b")
    both = stored(
        pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        .distinct(),
        "edges",
    )
    labels = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, "u").select("u", F.least("label", "near").alias("next"), "label")
        target = step.select(F.col("u").alias("next"), F.col("next").alias("jump"))
        moved = stored(
            step.join(target, "next", "left").select("u", F.least("next", F.coalesce("jump", "next")).alias("label"), F.col("label").alias("before")),
            "labels",
        )
        discard(labels)
        labels = moved
        if moved.filter("label != before").isEmpty():
            break
    discard(both)
    out = labels.select(F.col("u").alias("node"), F.col("label").alias("component"))
    return out
