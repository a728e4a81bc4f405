"""Benchmark decontamination: one Aho-Corasick automaton over the windows of the normalised test items.

A text is normalised byte by byte: A-Z become small, ASCII other than letters and digits becomes a space,
runs of spaces become one. Each window of item words, between spaces, is a pattern; the automaton reads a
text once. Offsets in the normalised text lead to word numbers, and word numbers to offsets of the original.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from cantogram.llm.words import LOWER, NOT_ALNUM
from cantogram.llm.workers import kept_with

#: Bytes of item texts in one automaton. The items are dealt to as many automata as this takes, one after the other.
ITEM_BYTES = 4 << 20
Batches = Iterator[pa.RecordBatch]
_NORMAL = bytes(0x20 if b in NOT_ALNUM else b for b in LOWER)



def clean(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return [w for w in raw.translate(_NORMAL).split(b" ") if w]


def window_automaton(items: tuple[tuple[int | None, str | None], ...], size: int) -> ahocorasick.Automaton | None:
    """Pattern to (its number of words, the ids of its items); None without any pattern."""
    owners: dict[bytes, set] = {}
    for item, text in items:
        words = clean(text)
        for i in range(max(len(words) - size + 1, 1) if words else 0):
            owners.setdefault(b" ".join(words[i : i + size]), set()).add(item)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        # Bytes as Latin-1 characters: one character a byte, so that offsets are bytes.
        automaton.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, tuple(i for i in ids if i is not None)))
    automaton.make_automaton()
    return automaton


def _matched(held: Broadcast, size: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        automaton = kept_with(held, window_automaton, size)
        for batch in batches:
            spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for i, text in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
                if automaton is None or not text:
                    continue
                normal = b" ".join([b"", *clean(text), b""]).decode("latin-1")
                hits = list(automaton.iter(normal))
                if not hits:
                    continue
                breaks = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), dtype=np.uint8) == 0x20)
                ends = np.searchsorted(breaks, [end for end, _ in hits])
                spans[i] = [*(spans[i] or []), *[{"start": int(e) - n, "count": n} for e, (_, (n, _)) in zip(ends, hits, strict=True)]]
                items[i] = sorted({*(items[i] or []), *[x for _, (_, ids) in hits for x in ids]})
            rest = [c for c in batch.schema.names if c not in ("spans", "items")]
            yield pa.record_batch(
                [batch.column(c) for c in rest] + [pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.int64()))], names=[*rest, "spans", "items"]
            )

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("count", pa.int32())]))


def _counted(batches: Batches) -> Batches:
    for batch in batches:
        words, hit, original, shas = [], [], [], []
        for text, spans, items in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
            normal = (text or b"").translate(_NORMAL)
            words.append(len([w for w in normal.split(b" ") if w]))
            marks = np.zeros(words[-1] + 1, dtype=np.int64)
            for s in spans or []:
                marks[s["start"]] += 1
                marks[s["start"] + s["count"]] -= 1
            covered = np.cumsum(marks[:-1]) > 0
            hit.append(int(covered.sum()))
            places = []
            if hit[-1]:
                edge = np.concatenate([[True], np.frombuffer(normal, dtype=np.uint8) == 0x20, [True]])
                flips = np.flatnonzero(edge[1:] != edge[:-1])
                turns = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                places = [{"start": int(flips[2 * a]), "end": int(flips[2 * b - 1])} for a, b in zip(turns[0::2], turns[1::2], strict=True)]
            original.append(places)
            shas.append(hashlib.sha256(",".join(sorted(map(str, items or []))).encode()).hexdigest())
        counts = [len(x or []) for x in batch.column("items").to_pylist()]
        rest = [c for c in batch.schema.names if c not in ("text", "spans", "items")]
        yield pa.record_batch(
            [*[batch.column(c) for c in rest], pa.array(words, pa.int64()), pa.array(hit, pa.int64()), pa.array(counts, pa.int64()), pa.array(shas), pa.array([h > 0 for h in hit], pa.bool_())]
            + [pa.array(original, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=[*rest, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "byte_spans"],
        )


def _found(held: list[Broadcast], size: int) -> Callable[[Batches], Batches]:
    """All blocks of items one after the other, then the counts, in one Python worker per task."""

    def run(batches: Batches) -> Batches:
        for block in held:
            batches = _matched(block, size)(batches)
        yield from _counted(batches)

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, byte_spans) for each row of ``docs``.

    A window is ``size`` consecutive words of an item of ``benchmark`` (item_id, text), or the whole item if it has
    fewer; a document word inside any occurrence is hit. ``byte_spans`` are the hit stretches as byte offsets
    of the original UTF-8 text. Null and wordless texts have no words and no windows. An item without an id hits words but
    is not counted; repeated items are one. Rows stand for themselves. Other columns are ignored; an empty
    table on either side is allowed. The items are the query set: they are read in blocks of ITEM_BYTES.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return _searched(source, benchmark, size)


def without_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` without a hit word, by the rules of :func:`find_contamination`; all columns stay."""
    packed = docs.select(F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    return _searched(packed, benchmark, size).filter("NOT contaminated").select("row.*")


def _searched(source: DataFrame, benchmark: DataFrame, size: int) -> DataFrame:
    context = source.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = 1 + 2 * total // ITEM_BYTES if total > ITEM_BYTES else 1
    out = source.withColumn("spans", F.lit(None).cast("array<struct<start:int,count:int>>")).withColumn("items", F.lit(None).cast("array<bigint>"))
    held = []
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        held.append(context.broadcast(tuple((r["item_id"], r["text"]) for r in own)))
    schema = StructType([f for f in source.schema.fields if f.name != "text"])
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("n_items", "long"), ("items_sha256", "string"), ("contaminated", "boolean")):
        schema = schema.add(name, kind)
    schema = schema.add("byte_spans", ArrayType(StructType().add("start", "long").add("end", "long")))
    return out.mapInArrow(_found(held, size), schema)
