"""Quality rules and robust multivariate outliers: a minimum covariance determinant per language and source.

Each row gives a vector of transformed statistics. Per group, the estimate starts from medians and quartile
ranges and takes concentration steps: distances to the present estimate, then mean and covariance of the
nearest ``SHARE`` of the rows, which never enlarges the determinant. A step is one aggregation: rows meet in
(group, distance bin) cells of moments, combined on the map side, so a hot group costs no more than its
bins; only estimates, one row per group, are solved with numpy. All rows take part in every step.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from cantogram.llm.scratch import discard, stored
from cantogram.llm.words import SPACE, hashed_rows, separators, text_pieces, windows

#: The transformed statistics, and for each the least deviation that is held against a row (a ridge on the covariance).
FLOORS = {"x_length": 0.15, "x_symbols": 0.5, "x_dup_lines": 0.9, "x_repeats": 0.9, "x_upper": 0.4, "x_digits": 0.6}
STATS = tuple(FLOORS)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARE = 0.75
STEPS = 6
#: Rows whose squared distance a normal vector exceeds with this probability are rejected.
TAIL = 1e-6
#: Groups of fewer judged rows are judged by the estimate of all rows of their language, or of all rows.
LEAST_ROWS = 100
#: Distance bins per e-fold of the squared distance; histogram cells per unit of a statistic.
FINE, CELLS = 100, 50
_PAIRS = tuple(combinations_with_replacement(range(len(STATS)), 2))
_MOMENTS = ("n", *[f"s{i}" for i in range(len(STATS))], *[f"c{i}_{j}" for i, j in _PAIRS])
_PARAMS = ("scale", *[f"m{i}" for i in range(len(STATS))], *[f"p{i}_{j}" for i, j in _PAIRS])
Batches = Iterator[pa.RecordBatch]


def chi2_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for k in range(1, degrees // 2):
        term *= half / k
        total += term
    return 1 - math.exp(-half) * total


def chi2_quantile(q: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, degrees) < q else (low, middle)
    return high


def _ranges(data: np.ndarray, offsets: np.ndarray, chosen: bytes) -> np.ndarray:
    """Per row, the bytes that are among ``chosen``."""
    table = separators(chosen)
    sums = np.concatenate([[0], np.cumsum(table[data])])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_words(words: np.ndarray, size: int = 8) -> int:
    """Words inside windows of ``size`` words that are found twice or more."""
    own = windows(words, size)
    if len(own) < 2:
        return 0
    _, inverse, times = np.unique(own, return_inverse=True, return_counts=True)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(times[inverse] > 1)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    seen, again = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip(SPACE):
            seen.add(line)
    return again


def _measured(text_column: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table = separators(SPACE)
        for batch in batches:
            column = batch.column(text_column)
            texts = column.cast(pa.large_binary()).to_pylist()
            parts: list[list[np.ndarray]] = []
            for first, end, data, offsets in text_pieces(column):
                characters = _ranges(data, offsets, bytes([*range(0x80), *range(0xC0, 0x100)]))
                blanks = _ranges(data, offsets, SPACE)
                lines = np.array([duplicate_lines(t or b"") for t in texts[first:end]], dtype=np.int64)
                parts.append([characters - blanks, _ranges(data, offsets, b"#*$%&|<>"), lines, _ranges(data, offsets, bytes(range(0x41, 0x5B))), _ranges(data, offsets, bytes(range(0x30, 0x3A)))])
            chars, symbols, lines, upper, digits = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, dtype=np.int64)] * 5
            words, repeats = [], []
            for _, hashes, at in hashed_rows(column, table):
                words.append(np.diff(at))
                repeats.append([repeated_words(hashes[at[i] : at[i + 1]]) for i in range(len(at) - 1)])
            words = np.concatenate(words).astype(np.int64) if words else np.zeros(0, dtype=np.int64)
            repeats = np.concatenate(repeats).astype(np.int64) if repeats else np.zeros(0, dtype=np.int64)
            n, c = np.maximum(words, 1), np.maximum(chars, 1)
            share = lambda part, whole: np.log1p(100 * part / whole)
            stats = [np.log(c / n), share(symbols, c), share(lines, lines + 5), share(repeats, n), share(upper, c), share(digits, c)]
            yield pa.record_batch(
                [*batch.columns, *[pa.array(x) for x in (words, chars, symbols, lines, repeats)], *[pa.array(x) for x in stats]],
                names=[*batch.schema.names, *COUNTS, *STATS],
            )

    return run


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the counts and transformed statistics of each whole text; a null text has no words."""
    schema = StructType(list(docs.schema.fields))
    for name in COUNTS:
        schema = schema.add(name, "long")
    for name in STATS:
        schema = schema.add(name, "double")
    return docs.mapInArrow(_measured(text_column), schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words"))


def _solved(start: bool) -> Callable[[Batches], Batches]:
    """Estimates from moments: the mean, and the inverse of the covariance with the floors on its diagonal."""
    size = len(STATS)
    ridge = np.diag(np.square(list(FLOORS.values())))
    # The nearest SHARE of normal rows spread less than all of them.
    inner = chi2_quantile(SHARE, size)
    factor = SHARE / chi2_cdf(inner, size + 2)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "unit"}
            out = np.zeros((batch.num_rows, len(_PARAMS)))
            for k in range(batch.num_rows):
                if start:
                    mean = np.array([rows[f"s{i}"][k] for i in range(size)])
                    cov = np.diag([rows[f"c{i}_{i}"][k] for i in range(size)])
                else:
                    n = rows["n"][k]
                    mean = np.array([rows[f"s{i}"][k] for i in range(size)]) / n
                    cov = np.zeros((size, size))
                    for i, j in _PAIRS:
                        cov[i, j] = cov[j, i] = rows[f"c{i}_{j}"][k] / n - mean[i] * mean[j]
                    cov *= factor
                inverse = np.linalg.inv(cov + ridge)
                out[k] = [1.0, *mean, *[inverse[i, j] for i, j in _PAIRS]]
            yield pa.record_batch([batch.column("unit"), *[pa.array(out[:, i].copy()) for i in range(len(_PARAMS))]], names=["unit", *_PARAMS])

    return run


_PARAM_SCHEMA = "unit string, " + ", ".join(f"{c} double" for c in _PARAMS)


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its group's estimate."""
    gap = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(STATS)]
    terms = [gap[i] * gap[j] * F.col(f"p{i}_{j}") * (1 if i == j else 2) for i, j in _PAIRS]
    return sum(terms[1:], terms[0])


def _units(judged: DataFrame) -> DataFrame:
    """(k_lang, k_source, unit, members): the estimate that judges a group, and all estimates that its rows are part of.

    A small group is judged by its whole language, or by all rows, and not by itself; so those
    estimates take in the rows of large groups too, where any group needs them.
    """
    sizes = judged.groupBy(*_keys("lang", "source")).agg(F.count(F.lit(1)).alias("rows"))
    langs = sizes.groupBy("k_lang").agg(F.sum("rows").alias("lang_rows"))
    unit = (
        F.when(F.col("rows") >= LEAST_ROWS, F.concat_ws("\x01", F.lit("source"), "k_lang", "k_source"))
        .when(F.col("lang_rows") >= LEAST_ROWS, F.concat_ws("\x01", F.lit("lang"), "k_lang"))
        .otherwise(F.lit("all"))
    )
    named = stored(sizes.join(langs, "k_lang").select("k_lang", "k_source", unit.alias("unit")), "units")
    wide = named.select("unit").distinct().withColumnRenamed("unit", "used")
    ways = F.array(F.concat_ws("\x01", F.lit("source"), "k_lang", "k_source"), F.concat_ws("\x01", F.lit("lang"), "k_lang"), F.lit("all"))
    members = named.withColumn("used", F.explode(ways)).join(wide, "used").groupBy("k_lang", "k_source").agg(F.collect_set("used").alias("members"))
    return stored(named.join(members, ["k_lang", "k_source"]), "units")


def _keys(lang: str, source: str) -> list[Column]:
    """Language and source as text; a null is a value of its own, apart from the empty text."""
    return [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(k) for c, k in ((lang, "k_lang"), (source, "k_source"))]


def _attached(df: DataFrame, units: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    return df.select("*", *_keys(lang, source)).join(units, ["k_lang", "k_source"], "left").drop("k_lang", "k_source")


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges, from histograms of the statistics."""
    cells = rows.select("unit", F.posexplode(F.array(*[F.floor(F.col(x) * CELLS) for x in STATS])).alias("stat", "cell"))
    counts = cells.groupBy("unit", "stat", "cell").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("unit", "stat")
    run = counts.withColumn("upto", F.sum("n").over(own.orderBy("cell"))).withColumn("total", F.sum("n").over(own))
    at = lambda q: (F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("cell"))) + 0.5) / CELLS
    quartiles = run.groupBy("unit", "stat").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    spread = F.pow((F.col("q3") - F.col("q1")) / 1.349, 2)
    pick = lambda c, k: F.max(F.when(F.col("stat") == k, c))
    aggs = [pick(F.col("q2"), i).alias(f"s{i}") for i in range(len(STATS))] + [pick(spread, i).alias(f"c{i}_{i}") for i in range(len(STATS))]
    return quartiles.groupBy("unit").agg(*aggs).mapInArrow(_solved(True), _PARAM_SCHEMA)


def _concentrated(rows: DataFrame, params: DataFrame) -> DataFrame:
    near = rows.join(params, "unit").withColumn("bin", F.floor(F.log(_distance() + 1e-9) * FINE))
    sums = [F.count(F.lit(1)).cast("double").alias("n")] + [F.sum(x).alias(f"s{i}") for i, x in enumerate(STATS)]
    sums += [F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"c{i}_{j}") for i, j in _PAIRS]
    cells = near.groupBy("unit", "bin").agg(*sums)
    own = Window.partitionBy("unit")
    before = F.coalesce(F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    kept = cells.withColumn("before", before).withColumn("total", F.sum("n").over(own)).filter(F.col("before") < F.col("total") * SHARE)
    return kept.groupBy("unit").agg(*[F.sum(c).alias(c) for c in _MOMENTS]).mapInArrow(_solved(False), _PARAM_SCHEMA)


def judge(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """All columns of ``docs``, the counts, ``base_failed``, ``distance`` (squared) and ``kept`` for each row.

    A row is kept if it passes the base rules (20 words, at most 30 % of the words in repeated windows) and its
    distance is within the chi-square bound. Failed rows have no distance and take no part in the estimates. A
    null language or source is a value of its own. Null and empty texts fail. Rows stand for themselves,
    so repeated rows get equal verdicts. Columns of ``docs`` that bear the name of an output are replaced, those of a
    working column are left out (:func:`without_rejected` keeps all). An empty table gives an empty result.
    """
    taken = {*COUNTS, *STATS, *_PARAMS, "unit", "base_failed", "distance", "kept", "k_lang", "k_source"}
    docs = docs.drop(*[c for c in docs.columns if c in taken])
    narrow = docs.select(F.col(lang_column).alias("lang"), F.col(source_column).alias("source"), F.col(text_column).cast("string").alias("text"))
    judged = stored(measure(narrow).filter(~base_failed()).drop("text", *COUNTS[1:]), "statistics")
    units = _units(judged)
    rows = stored(_attached(judged, units).select(F.explode("members").alias("unit"), *STATS), "vectors")
    discard(judged)
    params = stored(_start(rows), "estimate")
    for _ in range(STEPS):
        before, params = params, stored(_concentrated(rows, params), "estimate")
        discard(before)
    discard(rows)
    bound = chi2_quantile(1 - TAIL, len(STATS))
    measured = measure(docs.withColumn(text_column, F.col(text_column).cast("string")), text_column)
    with_unit = _attached(measured, units.drop("members"), lang_column, source_column)
    out = with_unit.join(params, "unit", "left").withColumn("base_failed", base_failed())
    out = out.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    out = out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= bound, F.lit(True)))
    return out.select(*docs.columns, *COUNTS, "base_failed", "distance", "kept")


def without_rejected(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns as they are."""
    read = ("text", "lang", "source")
    others = F.struct(*[c for c in docs.columns if c not in read], F.lit(0).alias("_")).alias("others")
    kept = judge(docs.select(*read, others)).filter("kept")
    return kept.select(*[F.col(c) if c in read else F.col(f"others.`{c}`").alias(c) for c in docs.columns])
