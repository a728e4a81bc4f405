"""Repeated passages: a de Bruijn graph of word k-mers, its nonbranching paths compacted, spans checked at their source.

An edge is a window (k-mer) of ``size`` consecutive words, a node the ``size`` - 1 words that two successive edges share.
Consecutive edges with the same least ``SEED``-word hash form a piece, a short path: where the
text is the same, pieces begin and end at the same words, so a piece stands for all its edges.

1. Equal word sequences are one text: its smallest id stands for it, later copies go as a whole.
2. Seeds of the pieces are counted. A window that occurs twice has a seed that occurs twice, so texts
   and pieces without a repeated seed leave here, before any window is written out.
3. Pieces are grouped by content. Repeated ones are the graph: nodes are the words at their two ends, and in- and
   out-degrees are counted. Two pieces that meet in a node without another way in or out are joined, and checked at their source:
   the first occurrence of the second must follow that of the first in the same text. What is joined
   forms long paths, and the later occurrences of a path become spans as long as they follow it.
4. Where a seed has pieces of different content, paths branch inside a piece: the edges of those pieces' first occurrences
   are grouped one by one, again by their first source coordinate.
5. Spans return to their texts by joins. Coordinates (id, start) decide what came first; contents are
   compared by 128 bits from two independent word hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from cantogram.llm.scratch import discard, stored
from cantogram.llm.words import SPACE, hashed_rows, mix, separators, windows

SEED = 6
_U = np.uint64
_PLACE = _U((1 << 26) - 1)
_ODD = _U(0xD6E8FEB86659FD93)
Batches = Iterator[pa.RecordBatch]


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray, salt: np.uint64 = _U(1)) -> np.ndarray:
    """One hash for each stretch of ``values``, by its values and their places in it."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mix(values * _ODD + mix(place + salt)), out=sums[1:])
    return mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64) * salt)


def sequence_digests(lanes: list[np.ndarray], at: np.ndarray) -> list[bytes]:
    """128 bits for the word sequence of each row."""
    place = np.arange(at[-1], dtype=np.uint64) - np.repeat(at[:-1], np.diff(at)).astype(np.uint64)
    one, two = (_sums(lane[: at[-1]], at[:-1], at[1:], place) for lane in lanes)
    return [a.tobytes() + b.tobytes() for a, b in zip(one, two, strict=True)]


def contents(lane: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the windows of each piece, and all those windows, piece by piece; ``lane`` has the hash of each window."""
    ends = np.cumsum(count)
    begins = ends - count
    at = np.repeat(start - begins, count) + np.arange(ends[-1] if len(ends) else 0)
    place = (np.arange(len(at)) - np.repeat(begins, count)).astype(np.uint64)
    return _sums(lane[at], begins, ends, place), at


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _placed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values with their place in the low bits, so that a minimum tells its first (or its last) place."""
    place = np.arange(len(values), dtype=np.uint64) & _PLACE
    return (values & ~_PLACE) | place, (values & ~_PLACE) | (_PLACE - place)


def pieces(hashes: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per piece: its seed, row, first window and number of windows. Windows count from the first word of the array."""
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < size:
        return none.astype(np.uint64), none, none, none
    least = _least(windows(hashes, SEED), size - SEED + 1)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(least)]
    valid = np.flatnonzero(np.arange(len(least)) + size <= at[row + 1])
    if not len(valid):
        return none.astype(np.uint64), none, none, none
    seed, row = least[valid], row[valid]
    begin = np.flatnonzero(np.concatenate([[True], (seed[1:] != seed[:-1]) | (row[1:] != row[:-1])]))
    return seed[begin], row[begin], valid[begin], np.diff(np.append(begin, len(valid)))


def _surveyed(size: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table = separators(SPACE)
        for batch in batches:
            for first, one, two, at in hashed_rows(batch.column("text"), table, lanes=2):
                n = len(at) - 1
                seed, row, start, count = pieces(one, at, size)
                whole = np.zeros(0, dtype=np.uint64)
                if len(seed):
                    whole, _ = contents(windows(one, size), start, count)
                    # A piece that holds its seed at two places may repeat a window within itself: it counts again, as another content.
                    left, right = (_least(x, size - SEED + 1) & _PLACE for x in _placed(windows(one, SEED)))
                    again = left[start] != _PLACE - right[start + count - 1]
                    times = 1 + again
                    seed, row, whole = np.repeat(seed, times), np.repeat(row, times), np.repeat(whole, times)
                    second = np.cumsum(times)[again] - 1
                    whole[second] = ~whole[second]
                ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.view(np.int64))) for x in (seed, whole)]
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, n), pa.array(np.diff(at).astype(np.int64)), pa.array(sequence_digests([one, two], at), pa.binary()), *lists],
                    names=["doc_id", "n_words", "digest", "seeds", "contents"],
                )

    return run


_PIECES = "doc_id long, node long, start int, count int, seed long, p1 long, p2 long, head long, tail long, w1 array<long>, w2 array<long>"


def _pieced(size: int) -> Callable[[Batches], Batches]:
    """The pieces with a repeated seed: their content, the nodes at their ends, and, where the seed has several contents, their edges."""

    def run(batches: Batches) -> Batches:
        table = separators(SPACE)
        for batch in batches:
            wanted = batch.column("digest").to_pylist()
            for first, one, two, at in hashed_rows(batch.column("text"), table, lanes=2):
                n = len(at) - 1
                own = np.array([d == w for d, w in zip(sequence_digests([one, two], at), wanted[first : first + n], strict=True)], dtype=bool)
                seed, row, start, count = pieces(one, at, size)
                # A (row, seed) pair as one number; rows of one piece are few, so the mix keeps pairs apart.
                key = lambda r, s: mix(s + mix(r.astype(np.uint64) + _ODD))
                asked = []
                for name in ("again", "branching"):
                    listed = batch.column(name).slice(first, n)
                    asked.append(key(np.repeat(np.arange(n), np.diff(listed.offsets.to_numpy())), listed.flatten().to_numpy().view(np.uint64)))
                use = np.isin(key(row, seed), asked[0]) & own[row]
                seed, row, start, count = seed[use], row[use], start[use], count[use]
                branching = np.isin(key(row, seed), asked[1])
                lanes, nodes = [windows(x, size) for x in (one, two)], windows(one, size - 1)
                whole = [contents(lane, start, count)[0] for lane in lanes] if len(start) else [seed, seed]
                listed, at_edge = np.where(branching, count, 0), contents(lanes[0], start[branching], count[branching])[1]
                offsets = np.concatenate([[0], np.cumsum(listed)]).astype(np.int32)
                take = pa.array(row + first)
                yield pa.record_batch(
                    [batch.column("doc_id").take(take), batch.column("node").take(take), pa.array((start - at[row]).astype(np.int32)), pa.array(count.astype(np.int32))]
                    + [pa.array(x.view(np.int64)) for x in (seed, *whole, nodes[start], nodes[start + count])]
                    + [pa.ListArray.from_arrays(pa.array(offsets), pa.array(lane[at_edge].view(np.int64))) for lane in lanes],
                    names=[f.split(" ")[0] for f in _PIECES.split(", ")],
                )

    return run


def compacted(paths: DataFrame) -> DataFrame:
    """(p1, p2, path, offset): repeated pieces with the path that they are part of, and their place in it.

    ``paths`` has one row per piece content: (p1, p2, head, tail, count, times, first). A node is passed through if one
    repeated piece ends in it and one begins in it; a piece continues the other's path if it also follows it at its source.
    """
    repeated = paths.filter("times > 1").select("p1", "p2", "head", "tail", "count", "first")
    piece = F.struct("p1", "p2", "count", "first").alias("piece")
    into = repeated.groupBy(F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("ways"), F.min(piece).alias("before")).filter("ways = 1")
    out = repeated.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("ways"), F.min(piece).alias("after")).filter("ways = 1")
    follows = (F.col("before.first.node") == F.col("after.first.node")) & (F.col("before.first.start") + F.col("before.count") == F.col("after.first.start"))
    joined = into.drop("ways").join(out.drop("ways"), "node").filter(follows).select(F.col("after.p1").alias("p1"), F.col("after.p2").alias("p2"), F.lit(1).alias("goes_on"))
    source = Window.partitionBy("first.node").orderBy("first.start", "p1", "p2")
    placed = repeated.join(joined, ["p1", "p2"], "left").withColumn("opens", F.sum(F.when(F.col("goes_on").isNull(), 1).otherwise(0)).over(source))
    path = Window.partitionBy("first.node", "opens")
    return placed.select("p1", "p2", F.struct("first.node", "opens").alias("path"), (F.col("first.start") - F.min("first.start").over(path)).alias("offset"))


def repeated_spans(docs: DataFrame, size: int = 20) -> DataFrame:
    """(doc_id, digest, spans): for each text with repeated words, the (start, count) of windows that also start earlier.

    ``docs`` has doc_id (long) and text (string). Earlier means a smaller id, or the same id and an earlier start.
    ``digest`` tells texts apart where an id is repeated. A row without an id takes no part; neither
    does a text of fewer than ``size`` words. A span (s, c) covers the words s to s + c + size - 2.
    """
    source = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    base = stored(
        source.mapInArrow(_surveyed(size), "doc_id long, n_words long, digest binary, seeds array<long>, contents array<long>").filter(F.col("n_words") >= size), "survey"
    )
    firsts = stored(base.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("node", F.monotonically_increasing_id()), "firsts")
    copies = base.select("doc_id", "digest", "n_words").join(firsts.select("digest", F.col("doc_id").alias("first_id")), "digest").filter("doc_id > first_id")
    everything = F.array(F.struct(F.lit(0).alias("start"), (F.col("n_words") - size + 1).cast("int").alias("count"))).alias("spans")
    whole = stored(copies.dropDuplicates(["doc_id", "digest"]).select("doc_id", "digest", everything), "copies")

    # One row of each text; rows that repeat an id and its text are alike.
    own = base.join(firsts, ["digest", "doc_id"]).dropDuplicates(["node"])
    seeds = stored(own.select("node", F.inline(F.arrays_zip("seeds", "contents"))).toDF("node", "seed", "content"), "seeds")
    discard(base)
    counted = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("times"), (F.min("content") < F.max("content")).alias("branches"))
    again = seeds.join(counted.filter("times > 1").select("seed", "branches"), "seed").groupBy("node").agg(
        F.collect_set("seed").alias("again"), F.collect_set(F.when(F.col("branches"), F.col("seed"))).alias("branching")
    )
    asked = stored(firsts.join(again, "node"), "asked")
    discard(seeds)
    found = stored(source.join(asked, "doc_id").select("doc_id", "text", "node", "digest", "again", "branching").mapInArrow(_pieced(size), _PIECES), "pieces")
    discard(asked)
    place = F.struct("doc_id", "start", "node")
    ends = [F.min(c).alias(c) for c in ("head", "tail", "count", "seed")]
    paths = stored(found.groupBy("p1", "p2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"), *ends), "paths")
    # Later occurrences: pieces that follow one path without a gap are one span.
    later = (
        found.select("doc_id", "node", "start", "count", "p1", "p2")
        .join(paths.filter("times > 1").select("p1", "p2", "first"), ["p1", "p2"])
        .filter("doc_id > first.doc_id OR (doc_id = first.doc_id AND start > first.start)")
        .join(compacted(paths), ["p1", "p2"])
    )
    same = Window.partitionBy("node", "path", F.col("start") - F.col("offset")).orderBy("start")
    opens = F.coalesce(F.lag(F.col("start") + F.col("count")).over(same) != F.col("start"), F.lit(True))
    runs = later.withColumn("opens", F.when(opens, F.col("start"))).withColumn("begin", F.max("opens").over(same))
    spans = runs.groupBy("node", "path", "begin").agg(F.sum("count").cast("int").alias("count")).select("node", F.col("begin").alias("start"), "count")
    long_spans = stored(spans, "long-spans")
    # Branching pieces: the edges of first occurrences.
    heads = found.filter(F.size("w1") > 0).join(paths.select("p1", "p2", "first"), ["p1", "p2"]).filter("doc_id = first.doc_id AND start = first.start AND node = first.node")
    edges = stored(
        heads.select("doc_id", "node", "start", F.posexplode(F.arrays_zip("w1", "w2")).alias("i", "w")).select("doc_id", "node", (F.col("start") + F.col("i")).alias("start"), "w.w1", "w.w2"),
        "edges",
    )
    discard(found, paths)
    first_edge = edges.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    single = edges.join(first_edge, ["w1", "w2"]).filter("doc_id > first.doc_id OR (doc_id = first.doc_id AND start > first.start)").select("node", "start", F.lit(1).alias("count"))
    listed = long_spans.unionByName(single).groupBy("node").agg(F.collect_list(F.struct("start", "count")).alias("spans"))
    out = stored(listed.join(firsts, "node").select("doc_id", "digest", "spans").unionByName(whole), "spans")
    discard(edges, long_spans, whole, firsts)
    return out


def _dropped(size: int, texts: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table = separators(SPACE)
        for batch in batches:
            content, marks = batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("marks").to_pylist()
            sizes, removed, shas, kept = [], [], [], []
            for first, one, two, at in hashed_rows(batch.column("text"), table, lanes=2):
                digests = None
                for i in range(len(at) - 1):
                    words, spans = (content[first + i] or b"").split(), []
                    if marks[first + i]:
                        digests = digests or sequence_digests([one, two], at)
                        spans = next((m["spans"] for m in marks[first + i] if m["digest"] == digests[i]), [])
                    sizes.append(len(words))
                    if spans:
                        steps = np.zeros(len(words) + 1, dtype=np.int64)
                        for s in spans:
                            steps[s["start"]] += 1
                            steps[s["start"] + s["count"] + size - 1] -= 1
                        stay = np.cumsum(steps[:-1]) == 0
                        words = [w for w, k in zip(words, stay.tolist(), strict=True) if k]
                    removed.append(sizes[-1] - len(words))
                    joined = b" ".join(words)
                    shas.append(hashlib.sha256(joined).hexdigest())
                    kept.append(joined if removed[-1] else content[first + i])
            columns = [c for c in batch.schema.names if c not in ("text", "marks")]
            result = [batch.column(c) for c in columns] + [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())]
            names = [*columns, "n_words", "n_removed", "kept_sha256"]
            if texts:
                result.append(pa.array(kept, pa.binary()).cast(pa.string()))
                names.append("kept_text")
            yield pa.record_batch(result, names=names)

    return run


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 20, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for each row of ``docs``.

    A word is a run of non-blank characters. A word goes if a window of ``size`` words covers it whose words also
    start at a smaller id, or earlier in the same document. ``kept_text`` is the text itself where nothing
    goes, else the kept words joined by one space. A null or blank text has no words (and stays as it is); a row without an
    id keeps all its words; rows that repeat an id and its text get one result each, the same. Other columns
    are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return _applied(source, source, size, texts)


def without_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """``docs`` with the kept words as ``text``, by the rules of :func:`drop_repeats`; all its columns stay."""
    columns = docs.columns
    source = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    packed = source.select("doc_id", "text", F.struct(*[c for c in columns if c not in ("doc_id", "text")], F.lit(0).alias("_")).alias("others"))
    done = _applied(packed, source.select("doc_id", "text"), size, True)
    return done.select(*[F.col("kept_text").alias(c) if c == "text" else F.col(c) if c == "doc_id" else F.col(f"others.`{c}`").alias(c) for c in columns])


def _applied(rows: DataFrame, source: DataFrame, size: int, texts: bool) -> DataFrame:
    marks = repeated_spans(source, size).groupBy("doc_id").agg(F.collect_list(F.struct("digest", "spans")).alias("marks"))
    schema = StructType([f for f in rows.schema.fields if f.name != "text"])
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string"), *([("kept_text", "string")] * texts)):
        schema = schema.add(name, kind)
    return rows.join(marks, "doc_id", "left").mapInArrow(_dropped(size, texts), schema)
