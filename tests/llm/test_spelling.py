"""Spelling variants against a brute-force version, and odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from __spark_entry__ import queries
from cantogram.llm.spelling import frequent_words, letter_runs, misspelt, shared_prefix, spelling_variants
from tests.llm.test_queries import FOLDER, lower

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    i = shared_prefix(short, long)
    return short[i:] == long[i + 1 :]


def brute(counts):
    blocks = defaultdict(set)
    for w in counts:
        for part in {w, *[w[:i] + w[i + 1 :] for i in range(len(w))]}:
            blocks[part].add(w)
    near = {w: set() for w in counts}
    for block in blocks.values():
        for a in block:
            near[a] |= {b for b in block if one_apart(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def contract_counts(docs):
    counts = Counter()
    for d, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def rows_of(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()]
    expected = brute(contract_counts(docs))
    assert len(expected) > 1000 and any(r[1] for r in expected)
    assert rows_of(queries()["op12_spelling_variants"](spark, FOLDER)) == expected


@pytest.mark.parametrize("parts", [1, 7])
def test_dense_words_over_task_borders(spark, parts):
    """All strings of few letters, so that prefixes reach over every border, with letters doubled."""
    rng = random.Random(parts)
    counts = {"".join(rng.choice("aabé😀") for _ in range(rng.randint(0, 6))): rng.randint(1, 40) for _ in range(900)}
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = rows_of(spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == brute(counts)


def test_chain_of_forms(spark):
    """Each word is the form of the one before: the root of all is the last."""
    counts = {"a" * (i + 5): 3 << i for i in range(20)}
    assert rows_of(spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == brute(counts)


def test_odd_rows(spark):
    schema = "doc_id long, text string, word string, n string, id string"
    texts = [(1, None), (2, ""), (3, "123 \n"), (None, "Straße STRAßE straße"), (4, "x" * 2_000 + " straßen " * 6), (4, "x" * 2_000), (5, "x" * 2_000)]
    docs = spark.createDataFrame([(*t, "a", "b", "c") for t in texts], schema)
    counts = contract_counts([t for t in texts if t[0] is not None])
    counts["straße"] = 3  # of the row without an id, which loses no letter
    assert rows_of(spelling_variants(frequent_words(misspelt(letter_runs(docs))))) == brute(counts)
    none = docs.limit(0)
    assert spelling_variants(frequent_words(misspelt(letter_runs(none)))).collect() == []
    words = spark.createDataFrame([("abcde", 2, 1), ("abcde", 2, 1), (None, 5, 1), ("abcd", None, 1), ("abcdf", 8, 1)], "word string, n int, best int")
    assert rows_of(spelling_variants(words)) == {("abcde", "abcdf", "abcdf", 4, 1, 8), ("abcdf", None, "abcdf", 8, 1, None)}
    long = "x" * 100_000
    far = spark.createDataFrame([(long, 5), (long + "x", 20), ("y" + long[1:], 3)], "word string, n int")
    assert rows_of(spelling_variants(far)) == {(long, long + "x", long + "x", 5, 2, 20), (long + "x", None, long + "x", 20, 1, None), ("y" + long[1:], None, "y" + long[1:], 3, 1, None)}
    with pytest.raises(ValueError):
        spelling_variants(words, ratio=1)
