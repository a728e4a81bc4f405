"""Near-duplicate groups: one-permutation MinHash, banded buckets, star-shaped candidates, exact confirmation.

1. Each text becomes a set of hashed word shingles. Equal sets are one class from here on, so a group
   of exact copies costs one row, however large it is.
2. One permutation splits the hash space into BINS bins; a bin keeps the smallest hash that falls in
   it. An empty bin copies a bin found by hashing (bin, attempt) until a filled one is met (optimal
   densification). ROWS consecutive bins make a band key.
3. Classes that share a band key form a bucket. Each bucket offers only the pairs of its smallest
   member with the others (a star); pairs are confirmed on the full sets.
4. A star can miss a link between two members. Buckets that still hold several components are
   finished exactly: shingles that occur in one component only cannot count for a link to another,
   so classes with too few others are dropped, again until nothing changes; those left meet on the rarest
   shingles, of which any linked pair shares one. Stars over these shingles join components first, as one link
   is as good as many, so that only components that stay apart meet in all pairs, which are confirmed too.
5. Components of the confirmed links are found by joins.

At a similarity of 0.8 a pair misses all 32 bands of 4 bins with probability (1 - 0.8^4)^32 = 5e-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cantogram.llm.components import connected_components
from cantogram.llm.scratch import discard, stored
from cantogram.llm.words import SPACE, hashed_rows, mix, separators, windows

BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
ATTEMPTS = 4096
PEELS = 3
TURNS = 3
_U = np.uint64


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of one text; a shorter text is one shingle, an empty one has none."""
    return np.unique(windows(words, min(size, len(words)))) if len(words) else words


def class_digest(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    odd = _U(2 * len(shingles) + 1)
    return mix(shingles + odd).sum().tobytes() + mix((shingles ^ _U(0x9E3779B97F4A7C15)) + odd).sum().tobytes()


def _walks() -> np.ndarray:
    """The bins that an empty bin tries, in order: a hash of (bin, attempt)."""
    steps = np.arange(ATTEMPTS, dtype=np.uint64)[:, None] * _U(BINS) + np.arange(BINS, dtype=np.uint64)[None, :]
    return (mix(steps + _U(0x5BF03635)) % _U(BINS)).astype(np.int64)


def signature(shingles: np.ndarray, walks: np.ndarray) -> np.ndarray:
    """The densified smallest hash of each bin, for a set that is sorted and not empty."""
    bins = np.arange(BINS)
    edges = (bins.astype(np.uint64)) << _U(64 - BINS.bit_length() + 1)
    first = np.minimum(np.searchsorted(shingles, edges), len(shingles) - 1)
    value = shingles[first]
    filled = (value >> _U(64 - BINS.bit_length() + 1)).astype(np.int64) == bins
    empty = np.flatnonzero(~filled)
    source = bins.copy()
    for attempt in range(ATTEMPTS):
        if not len(empty):
            break
        source[empty] = walks[attempt, empty]
        empty = empty[~filled[source[empty]]]
    if len(empty):
        source[empty] = np.flatnonzero(filled)[0]
    return value[source]


def _signed(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks, table = _walks(), separators(SPACE)
        lane = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            sizes, classes, bands = [], [], []
            for _, hashes, at in hashed_rows(batch.column("text"), table, lower=True):
                for i in range(len(at) - 1):
                    own = shingle_set(hashes[at[i] : at[i + 1]], shingle)
                    sizes.append(len(own))
                    if not len(own):
                        classes.append(None)
                        bands.append(None)
                        continue
                    classes.append(class_digest(own))
                    slots = signature(own, walks).reshape(BANDS, ROWS)
                    key = lane.copy()
                    for r in range(ROWS):
                        key = mix(key * _U(0x9E3779B97F4A7C15) + slots[:, r])
                    bands.append(key.view(np.int64))
            yield pa.record_batch(
                [batch.column("row_id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["row_id", "n", "class", "bands"],
            )

    return run


def _sets(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = separators(SPACE)
        for batch in batches:
            for _, hashes, at in hashed_rows(batch.column("text"), table, lower=True):
                own = [shingle_set(hashes[at[i] : at[i + 1]], shingle) for i in range(len(at) - 1)]
                own = [x for x in own if len(x)]
                yield pa.record_batch(
                    [pa.array([class_digest(x) for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())], names=["class", "shingles"]
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        common = [
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            for x, y in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist(), strict=True)
        ]
        yield pa.record_batch(
            [batch.column(c) for c in ("a", "b", "a_n", "b_n")] + [pa.array(common, pa.int64())], names=["a", "b", "a_n", "b_n", "common"]
        )


def _alike(percent: int, common: Column, a_n: Column, b_n: Column) -> Column:
    return F.lit(100) * common >= F.lit(percent) * (a_n + b_n - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, a_n, b_n) whose full sets are alike."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set"))
    counted = pairs.join(one, "a").join(two, "b").mapInArrow(_shared, "a long, b long, a_n long, b_n long, common long")
    return counted.filter(_alike(percent, F.col("common"), F.col("a_n"), F.col("b_n"))).select("a", "b")


def _star(heads: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of each kind's best holder, or in later turns another one, with those of other components."""
    order = F.col("rest") if turn == 0 else F.xxhash64("node", F.lit(turn))
    center = F.max(F.struct(order.alias("first"), *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "label", "rest")])).alias("c")
    centers = heads.groupBy("kind").agg(center, F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("kind", "c.*")
    near = heads.join(centers, "kind").filter("label != a_label").filter(_alike(percent, F.least("rest", "a_rest"), F.col("n"), F.col("a_n")))
    return near.select(F.col("a_node").alias("a"), F.col("node").alias("b"), "a_n", F.col("n").alias("b_n")).distinct()


def _merged(heads: DataFrame, links: DataFrame) -> DataFrame:
    """``heads`` with the labels that components have after ``links``."""
    names = heads.select("node", "label").distinct()
    one, two = (names.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")) for c in "ab")
    tied = links.join(one, "a").join(two, "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))
    moved = connected_components(tied).withColumnRenamed("node", "label")
    return stored(heads.join(moved, "label", "left").select("kind", "node", "n", F.coalesce("component", "label").alias("label"), "rest"), "heads")


def _across(heads: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that meet and may be alike. Components meet first, so the nodes of one never face each other."""
    sides = ({c: f"{side}_{c}" for c in ("node", "n", "label", "rest")} for side in "ab")
    x, y = (heads.withColumnsRenamed(names) for names in sides)
    groups = heads.groupBy("kind", "label").agg(F.max("rest").alias("rest"), F.min("n").alias("n"))
    one, two = (groups.select("kind", *[F.col(c).alias(f"{side}_{c}") for c in ("label", "rest", "n")]) for side in "ab")

    def alike() -> Column:
        return _alike(percent, F.least("a_rest", "b_rest"), F.col("a_n"), F.col("b_n"))

    # The largest rest and the smallest n of a component bound those of its nodes.
    met = one.join(two, "kind").filter("a_label < b_label").filter(alike())
    half = met.drop("a_rest", "a_n").join(x, ["kind", "a_label"]).filter(alike())
    pairs = half.drop("b_rest", "b_n").join(y, ["kind", "b_label"]).filter(alike())
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), "a_n", "b_n").distinct()


def _rest(entries: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> list[DataFrame]:
    """Tables of links that join all components that are still apart, for buckets with more than one."""
    labels = connected_components(links)
    named = entries.join(labels, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("label"))
    mixed = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("bucket")
    open_nodes = stored(named.join(mixed, "bucket", "left_semi").select("node", "n", "label").distinct(), "open")
    discard(labels)
    need = F.ceil(F.lit(percent) * F.col("n") / 100)
    rows = stored(sets.join(open_nodes, "node").mapInArrow(_exploded, "node long, n long, label long, shingle long"), "shingles")
    for _ in range(PEELS):
        between = rows.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("shingle")
        foreign = rows.drop("m").join(between, "shingle")
        enough = foreign.groupBy("node").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n")).filter(F.col("m") >= need).select("node", "m")
        left = stored(foreign.join(enough, "node"), "shingles")
        discard(rows)
        rows = left
    if rows.isEmpty():
        discard(open_nodes, rows)
        return []
    # A linked pair shares one of the m - need + 1 rarest of either side. Shingles that the very same nodes hold stand
    # together in the order, and nodes meet on them once, not on each.
    rarity = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.bit_xor(F.xxhash64("node")).alias("holders"))
    ranked = rows.join(rarity, "shingle").groupBy("node", "n", "label", "m").agg(F.array_sort(F.collect_list(F.struct("df", "holders"))).alias("by_df"))
    prefix = F.slice("by_df", 1, F.greatest(F.lit(0), F.size("by_df") - need + 1).cast("int"))
    kinds = F.filter(F.transform("prefix", lambda x, i: F.struct(x.alias("kind"), i.alias("place"))), lambda x: (x["place"] == 0) | (F.get("prefix", x["place"] - 1) != x["kind"]))
    # What stands before the first shared shingle is not shared: the least ``rest`` bounds what two nodes can have in common.
    heads = stored(
        ranked.withColumn("prefix", prefix).select("node", "n", "label", "m", F.inline(kinds)).select("kind", "node", "n", "label", (F.col("m") - F.col("place")).alias("rest")),
        "heads",
    )
    discard(open_nodes, rows)
    found = []
    for turn in range(TURNS):
        found.append(stored(_confirmed(_star(heads, percent, turn), sets, percent), "links"))
        if found[-1].isEmpty():
            break
        before, heads = heads, _merged(heads, found[-1])
        discard(before)
    found.append(stored(_confirmed(_across(heads, percent), sets, percent), "links"))
    discard(heads)
    return found


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column("shingles").to_pylist()]
        times = [len(x) for x in sets]
        if sets:
            names = ["node", "n", "label"]
            yield pa.record_batch(
                [pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), times)) for c in names] + [pa.array(np.concatenate(sets))], names=[*names, "shingle"]
            )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(row id, n_shingles, component_id, kept) for each row of ``docs``.

    Two rows are linked when 100 * |A and B| >= ``percent`` * |A or B| for their sets of ``shingle``
    words, words being runs of non-blank characters with A-Z lower-cased. A text of fewer words is
    one shingle. A null, empty or blank text has no shingles and is linked with nothing. Repeated
    ids are rows of their own: each has the smallest id of its component. A row without an id is
    linked with nothing, gets a null component and is kept. Other columns are ignored. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_column).cast("long").alias("row_id"), F.col(text_column).cast("string").alias("text"))
    signed = stored(source.mapInArrow(_signed(shingle), "row_id long, n long, class binary, bands array<long>"), "signatures")
    filled = signed.filter("row_id IS NOT NULL AND class IS NOT NULL")
    classes = stored(
        filled.groupBy("class").agg(F.min("row_id").alias("first_id")).withColumn("node", F.monotonically_increasing_id()), "classes"
    )
    # One row of each class carries its bands on.
    entries = stored(
        filled.join(classes, "class").filter("row_id = first_id").dropDuplicates(["class"]).select("node", "n", "first_id", F.explode("bands").alias("bucket")),
        "buckets",
    )
    centers = entries.groupBy("bucket").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("members")).filter("members > 1").select("bucket", "a")
    met = stored(entries.join(centers, "bucket").select("bucket", "a", F.col("node").alias("b"), F.col("n").alias("b_n"), "first_id"), "stars")
    discard(entries)
    nodes = met.select(F.col("b").alias("node"), F.col("b_n").alias("n"), "first_id").distinct()
    # The rows of a class have one set; the text of the first id's row stands for it.
    ids = nodes.select(F.col("first_id").alias("row_id")).distinct()
    picked = source.join(ids, "row_id", "left_semi").mapInArrow(_sets(shingle), "class binary, shingles binary")
    sets = stored(picked.join(classes, "class").select("node", "shingles").dropDuplicates(["node"]), "sets")
    stars = (
        met.filter("a != b").select("a", "b", "b_n").distinct()
        .join(nodes.select(F.col("node").alias("a"), F.col("n").alias("a_n")), "a")
        .filter(F.lit(100) * F.least("a_n", "b_n") >= F.lit(percent) * F.greatest("a_n", "b_n"))
    )
    links = stored(_confirmed(stars, sets, percent), "links")
    more = _rest(met.select("bucket", F.col("b").alias("node"), F.col("b_n").alias("n")), sets, links, percent)
    every = links
    for table in more:
        every = every.unionByName(table)
    discard(met, sets)
    found = stored(connected_components(every).join(classes, "node"), "linked")
    discard(links, *more)
    least = found.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = found.join(least, "component").select("class", "component_id")
    named = classes.join(linked, "class", "left").select("class", F.coalesce("component_id", "first_id").alias("component_id"))
    component = F.when(F.col("row_id").isNotNull(), F.coalesce("component_id", "row_id"))
    return signed.join(named, "class", "left").select(
        F.col("row_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("row_id") == component, F.lit(True)).alias("kept"),
    )
