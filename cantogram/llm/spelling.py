"""Spelling variants: words one insertion, deletion or replacement apart, met as pairs of trie nodes.

1. Words are sorted over the cluster, and each task numbers the nodes of the trie of its words: a word takes the nodes of
   the prefix it shares with the word before it, and new numbers for the rest. Where a prefix reaches over
   the border of two tasks, a table of the tasks' first and last words gives it one number. Reversed words get
   their own trie in the same way.
2. A word without its letter i is the pair (node of the letters before i, reversed node of those after i);
   a word cut before letter i is such a pair too. Equal pairs stand for equal strings, so
   * two words with an equal skip at i differ in letter i alone,
   * a word whose skip at i equals another one's cut at i has one letter more.
   A skip inside a run of one letter is the same word as the skip at the run's first letter, which alone counts
   for insertions, so each neighbour is met once.
3. A pair can meet another one only where both of its nodes have two words below; from the shared prefix
   of sorted neighbours a word knows how deep that holds, and pairs beyond it are never written.
4. Pairs meet in groups. A group holds one cut and one skip for each letter of the alphabet at most; each
   member gets the count and the first of its neighbours, so that no pairs of words are written.

Words are numbered by falling count, then by the word, so that the best neighbour is the least number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from cantogram.llm.scratch import discard, stored

LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_LETTERS = "[^a-zÀ-ÿ]+"
CUT, SKIP, FIRST_SKIP = 0, 1, 2
Batches = Iterator[pa.RecordBatch]


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def _numbered(batches: Batches) -> Batches:
    """Adds the task, the trie nodes of ``key`` from the root on, and how many letters of it another word may share.

    Words at the border of a task or a batch may share all their letters.
    """
    part = TaskContext.get().partitionId()
    fresh, before, above = (part << 40) + 1, "", [0]
    first = True
    for batch in batches:
        keys = batch.column("key").to_pylist()
        nodes, ends, common = [], [0], []
        for key in keys:
            c = shared_prefix(before, key)
            above = above[: c + 1] + list(range(fresh, fresh + len(key) - c))
            fresh += len(key) - c
            before = key
            common.append(c)
            nodes += above
            ends.append(len(nodes))
        depth = [max(a, b) for a, b in zip(common, [*common[1:], 0], strict=True)]
        if keys:
            depth[-1] = len(keys[-1])
            if first:
                depth[0] = len(keys[0])
            first = False
        columns = [c for c in batch.schema.names if c != "key"]
        result = [batch.column(c) for c in columns]
        result += [pa.array([part] * len(keys), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(nodes, pa.int64())), pa.array(depth, pa.int32())]
        yield pa.record_batch(result, names=[*columns, "part", "nodes", "depth"])


def _borders(rows: list) -> list[tuple[int, list[int], list[int]]]:
    """(task, its numbers, the numbers they stand for) of the prefixes that a task shares with the task before it.

    ``rows`` has one row per task that holds words, in order: task, first and last word, and their nodes.
    """
    out, word, nodes = [], "", [0]
    for row in rows:
        c = shared_prefix(word, row["first"]["key"])
        own = row["first"]["nodes"][: c + 1]
        meant = nodes[: c + 1]
        if c:
            out.append((row["part"], own, meant))
        word, nodes = row["last"]["key"], list(row["last"]["nodes"])
        for i in range(min(c + 1, len(nodes))):
            if nodes[i] == own[i]:
                nodes[i] = meant[i]
    return out


def with_trie_nodes(words: DataFrame, key: Column, name: str) -> DataFrame:
    """``words`` with the trie nodes of the distinct strings ``key``, root first, and ``<name>_depth``, stored.

    The driver sees two words of each task.
    """
    spark = words.sparkSession
    sorted_words = words.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key")
    schema = StructType([*words.schema, StructField("part", LongType()), StructField("nodes", ArrayType(LongType())), StructField("depth", IntegerType())])
    placed = stored(sorted_words.mapInArrow(_numbered, schema), f"trie-{name}")
    ends = F.struct(key.alias("key"), "nodes")
    rows = placed.groupBy("part").agg(F.min_by(ends, key).alias("first"), F.max_by(ends, key).alias("last")).orderBy("part").collect()
    borders = spark.createDataFrame(_borders(rows), "part long, own array<long>, meant array<long>")
    renamed = F.transform("nodes", lambda x, i: F.when((i < F.size("own")) & (F.get("own", i) == x), F.get("meant", i)).otherwise(x))
    # One row per task at most.
    out = placed.join(F.broadcast(borders), "part", "left").select(
        *words.columns, F.when(F.col("own").isNull(), F.col("nodes")).otherwise(renamed).alias(name), F.col("depth").alias(f"{name}_depth")
    )
    out._scratch = placed._scratch
    return out


def _pairs(letters: Column, kind: int) -> Column:
    """The skips or cuts of a word whose two nodes both have other words below, as (before, after, kind)."""
    n = F.size("ahead") - 1 - (0 if kind == CUT else 1)
    low, high = F.greatest(F.lit(0), n - F.col("back_depth")), F.least(n, F.col("ahead_depth"))

    def pair(i: Column) -> Column:
        which = F.lit(CUT) if kind == CUT else F.when((i > 0) & (F.get(letters, i) == F.get(letters, i - 1)), SKIP).otherwise(FIRST_SKIP)
        return F.struct(F.get("ahead", i).alias("before"), F.get("back", n - i).alias("after"), which.alias("kind"))

    none = F.array().cast("array<struct<before:long,after:long,kind:int>>")
    return F.when(low <= high, F.transform(F.sequence(low, high), pair)).otherwise(none)


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best): for each of ``words`` (id long, word string) with neighbours, their number and least id.

    Neighbours differ by exactly one inserted, deleted or replaced code point. Ids and words are distinct.
    """
    ahead = with_trie_nodes(words.select("id", "word"), F.col("word"), "ahead")
    both = with_trie_nodes(ahead, F.reverse("word"), "back")
    discard(ahead)
    listed = both.withColumn("letters", F.split("word", "")).select("id", F.explode(F.concat(_pairs(F.col("letters"), SKIP), _pairs(F.col("letters"), CUT))).alias("pair"))
    pairs = listed.select("id", "pair.*")
    group = Window.partitionBy("before", "after")
    skip, first_skip, cut = (F.when(x, F.col("id")) for x in (F.col("kind") != CUT, F.col("kind") == FIRST_SKIP, F.col("kind") == CUT))
    met = pairs.select(
        "id", "kind",
        F.count(skip).over(group).alias("skips"), F.min(skip).over(group).alias("skip"),
        F.count(first_skip).over(group).alias("longer"), F.min(first_skip).over(group).alias("least_longer"),
        F.min(cut).over(group).alias("cut"),
        F.lead(skip).over(group.orderBy(F.col("kind") == CUT, "id")).alias("next"),
    )
    other = F.when(F.col("skip") == F.col("id"), F.col("next")).otherwise(F.col("skip"))
    shorter = F.when(F.col("kind") == FIRST_SKIP, F.col("cut"))
    near = met.select(
        "id",
        F.when(F.col("kind") == CUT, F.col("longer")).otherwise(F.col("skips") - 1 + shorter.isNotNull().cast("int")).alias("near"),
        F.when(F.col("kind") == CUT, F.col("least_longer")).otherwise(F.least(other, shorter)).alias("best"),
    ).filter("near > 0")
    out = stored(near.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")), "near-words")
    discard(both)
    return out


def last_forms(forms: DataFrame) -> DataFrame:
    """(id, root): where the links (id, form) of ``forms`` lead in the end; every round doubles the steps taken."""
    steps = stored(forms.select("id", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not steps.filter("moved").isEmpty():
        further = steps.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = stored(steps.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        discard(steps)
        steps = moved
    out = steps.select("id", "root")
    out._scratch = steps._scratch
    return out


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each distinct word of ``words`` (word string, n long).

    Two words are near if they differ by exactly one inserted, deleted or replaced code point; ``n_near`` counts a
    word's near words. ``form`` is the near word of largest ``n`` (of equals the first in code-point
    order) if its n is ``ratio`` times the word's n at least, else null; ``root`` is where following
    forms ends, the word itself if it has none. Rows that repeat a word are one word with the sum of their n; a null word
    or n is left out; the empty word is near every word of one letter. Other columns are ignored, and an empty table
    gives an empty result. ``ratio`` is above 1, so that forms have no cycles.
    """
    if ratio <= 1:
        raise ValueError("a form occurs more often than its word: ratio must be above 1")
    summed = words.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum(F.col("n").cast("long")).alias("n"))
    order = [F.col("n").desc(), F.col("word")]
    known = stored(summed.repartitionByRange(*order).sortWithinPartitions(*order).select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = near_words(known)
    best = known.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    fits = F.col("form_n") >= F.lit(ratio) * F.col("n")
    named = stored(
        known.join(near, "id", "left").join(best, "best", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            *[F.when(fits, F.col(c)).alias(c) for c in ("best", "form", "form_n")],
        ),
        "forms",
    )
    discard(near)
    roots = last_forms(named.filter("best IS NOT NULL").select("id", F.col("best").alias("form")))
    root_words = roots.join(known.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return named.join(root_words, "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def letter_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every maximal run of A-Z, a-z and U+00C0 to U+00FF in the texts, with A-Z lower-cased. A null text has none."""
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    return docs.select("doc_id", F.explode(F.split(lowered, NOT_LETTERS)).alias("run")).filter("run != ''")


def misspelt(runs: DataFrame) -> DataFrame:
    """(word): the runs, where every 97th by the checksum of ``<doc_id>:<run>`` loses a letter. A run without an id keeps all."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))


def frequent_words(words: DataFrame, letters: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of ``letters`` code points that occur ``count`` times at least."""
    return words.filter(F.char_length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)
