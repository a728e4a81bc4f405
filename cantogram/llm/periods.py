"""Periodic runs of words: seeds on diagonals, extended once per lag.

A run of smallest period q and at least max(LEAST, TIMES * q) words agrees with itself, moved by q words, over
max(LEAST - q, (TIMES - 1) * q) words at least: that stretch lies on the diagonal of lag q. Lags are
taken in bands, each with the longest k-gram that every run of the band is sure to hold on its diagonal:

* The first band has the lags 1 to k for the largest k that suits them all (16 words for LEAST = 24, TIMES = 3); each
  further band doubles lags and k.
* k-grams are numbered exactly, by pairs of numbered half-grams, and indexed per document. As k is not below the lag, a
  k-gram holds a whole period, so within a run its next occurrence lies one smallest period on: only pairs of consecutive
  occurrences are enumerated, at most one per word and band, whatever repeats.
* Pairs of one lag are taken in order of position. The table of furthest covered positions per lag tells which pair
  starts a new diagonal stretch; pairs inside what is covered extend it and start nothing.

So a document costs a sort per band, and bands grow with the logarithm of its words; a document without a
repeated first-band gram ends after one sort.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAST, TIMES = 24, 3
Batches = Iterator[pa.RecordBatch]
RUNS = "array<struct<start:long,length:long,period:long>>"


def first_gram(least: int, times: int) -> int:
    """The largest k such that each lag of 1 to k shares k words at least with a run of that period.

    A lag q shares max(least - q, (times - 1) * q) words, the least of which over all q bounds k.
    """
    shared = [max(least - q, (times - 1) * q) for q in range(1, max(2, least))]
    return max(1, min(shared))


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, different words different ones."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)


def _numbered(pairs: np.ndarray) -> tuple[np.ndarray, int]:
    values, numbers = np.unique(pairs, return_inverse=True)
    return numbers.astype(np.int64), len(values)


def _longer(grams: np.ndarray, step: int) -> tuple[np.ndarray, int]:
    """Numbers of the grams that are ``step`` words longer: a gram joined to the one ``step`` words on."""
    base = int(grams.max()) + 1
    return _numbered(grams[:-step] * base + grams[step:])


def consecutive_pairs(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and lags of each gram and its next occurrence."""
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    return order[:-1][same], (order[1:] - order[:-1])[same]


def furthest_covered(position: np.ndarray, lag: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, lag) of the stretches that the seeds of each lag cover.

    A seed that begins one word after the last seed of its lag only moves that lag's furthest position on.
    """
    order = np.lexsort((position, lag))
    position, lag = position[order], lag[order]
    opens = np.ones(len(position), dtype=bool)
    opens[1:] = (lag[1:] != lag[:-1]) | (position[1:] != position[:-1] + 1)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(position)) - 1
    return position[first], position[last] + k + lag[first] - position[first], lag[first]


def runs_of(numbers: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """The rows (start, length, period) of all runs, by start and period."""
    k = first_gram(least, times)
    found, low = [], 0
    if len(numbers) >= least:
        # Grams of k words: powers of two of words are joined, the last join overlaps.
        grams, size, distinct = numbers, 1, 0
        while size < k:
            step = min(size, k - size)
            grams, distinct = _longer(grams, step)
            size += step
            if distinct == len(grams):
                break
        while len(grams) > 1:
            if distinct == len(grams):  # then no longer gram repeats either
                break
            position, lag = consecutive_pairs(grams)
            use = (lag > low) & (lag <= size)
            if use.any():
                start, length, period = furthest_covered(position[use], lag[use], size)
                whole = length >= np.maximum(least, times * period)
                found.append(np.stack([start[whole], length[whole], period[whole]], axis=1))
            low = size
            if times * (low + 1) > len(numbers):
                break
            # A gram of the next band must not be longer than (times - 1) times its smallest lag.
            step = min(size, (times - 1) * (low + 1) - size, len(grams) - 1)
            if step < 1:
                break
            grams, distinct = _longer(grams, step)
            size += step
    runs = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def repeated_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words some run holds after its first period."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0


def _ran(least: int, times: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns = [c for c in batch.schema.names if c != "text"]
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                sizes, ends, flat, kept = [], [0], [], []
                for text in part.column("text").cast(pa.large_binary()):
                    words = (text.as_py() or b"").split()
                    runs = runs_of(word_numbers(words), least, times)
                    if len(runs):
                        gone = repeated_words(runs, len(words)).tolist()
                        words, n = [w for w, out in zip(words, gone, strict=True) if not out], len(words)
                    else:
                        n = len(words)
                    sizes.append(n)
                    ends.append(ends[-1] + len(runs))
                    flat.append(runs)
                    kept.append(b" ".join(words))
                every = np.concatenate(flat)
                struct = pa.StructArray.from_arrays([pa.array(every[:, i]) for i in range(3)], names=["start", "length", "period"])
                result = [part.column(c) for c in columns] + [
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ]
                yield pa.record_batch(result, names=[*columns, "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of ``docs``.

    A word is a run of non-blank characters. ``runs`` holds every (start, length, period): a stretch of
    words with that smallest period, of max(``least``, ``times`` * period) words at least, that neither
    neighbour extends; sorted by start, then period. ``collapsed`` is the words, joined by one space, without
    those that a run holds after its first period. A null, empty or blank text has no words, no runs and
    an empty ``collapsed``. Rows stand for themselves: repeated rows give repeated results, null ids stay null.
    Other columns are ignored; an empty table gives an empty result.
    """
    if times < 3 or least < 2 * times:
        raise ValueError("runs need three periods and two words a period at least")
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return source.mapInArrow(_ran(least, times), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def wrapped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the checksum of its id, repeats a passage up to its end.

    With h = crc32(id), n words, g = h div 10: where 10 divides h, word i >= a becomes word a + (i - a) mod p, for
    a = g mod n and p = 1 + (n - a) div (3 + g mod 8). A document without an id or words stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    turned = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    listed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("words", F.when(h % 10 == 0, words))
    placed = listed.withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, p)})
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """Counts and checksums of :func:`periodic_runs`, and the run of the greatest exact length / period.

    Of equal ratios the smallest start wins, then the smallest period, which is the order of the runs.
    """
    better = lambda best, run: F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    best = found.withColumn("best", F.aggregate("runs", none, better))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
