"""Periodic runs against a brute-force version, and odd rows."""

import hashlib
import random
import zlib

import pyarrow.parquet as pq
import pytest
from hypothesis import given as cases, settings, strategies as st

from __spark_entry__ import queries
from cantogram.llm.periods import first_gram, periodic_runs, run_digest, runs_of, word_numbers, wrapped
from tests.llm.test_queries import FOLDER, blank_words, sha


def smallest_period(words):
    border = [0] * len(words)
    for i in range(1, len(words)):
        k = border[i - 1]
        while k and words[i] != words[k]:
            k = border[k - 1]
        border[i] = k + (words[i] == words[k])
    return len(words) - border[-1]


def brute_runs(words, least=24, times=3):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        start = 0
        while start < n - q:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(least, times * q) and smallest_period(words[start : start + length]) == q:
                out.append((start, length, q))
            start = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def own_runs(words, **limits):
    return [tuple(r) for r in runs_of(word_numbers([w.encode() for w in words]), **limits).tolist()]


def contract_words(doc_id, text):
    words = blank_words(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digest(doc_id, text):
    words = contract_words(doc_id, text)
    runs, gone = brute_runs(words), [False] * len(words)
    for s, length, q in runs:
        gone[s + q : s + length] = [True] * (length - q)
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *head, sha(listed.encode()), sha(" ".join(w for w, g in zip(words, gone, strict=True) if not g).encode()))


def test_query_equals_brute_force(spark):
    rows = [r for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()]
    found = {r["doc_id"]: tuple(r)[1:] for r in queries()["op13_periodic_runs"](spark, FOLDER).collect()}
    small = [r for r in rows if len(r["text"] or "") < 6000]
    assert len(found) == len(rows) and sum(zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in small) > 5
    assert {r["doc_id"]: found[r["doc_id"]] for r in small} == {r["doc_id"]: digest(r["doc_id"], r["text"]) for r in small}


@settings(max_examples=300, deadline=None)
@cases(st.integers(0, 1 << 30))
def test_random_words_equal_brute_force(seed):
    rng = random.Random(seed)
    words = []
    while len(words) < rng.randint(0, 260):
        part = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 33, 40]))]
        words += (part * rng.randint(1, 9))[: rng.randint(1, 130)]
    assert own_runs(words) == brute_runs(words)
    assert own_runs(words, least=6, times=3) == brute_runs(words, 6, 3)
    assert own_runs(words, least=8, times=4) == brute_runs(words, 8, 4)


def test_least_gram():
    assert first_gram(24, 3) == 16 and first_gram(6, 3) == 4 and first_gram(8, 4) == 6


def test_long_texts_stay_cheap():
    """A million equal words, and a Fibonacci word with runs of every scale."""
    assert own_runs(["x"] * 1_000_000) == [(0, 1_000_000, 1)]
    a, b = ["a"], ["a", "b"]
    while len(b) < 3000:
        a, b = b, b + a
    assert own_runs(b) == brute_runs(b)


def test_odd_rows(spark):
    schema = "doc_id long, text string, runs string, n_words string"
    loop = "a b c " * 20
    given = [(1, None), (2, ""), (3, " \n\t "), (None, loop), (4, loop), (4, loop), (5, "one " * 23), (6, "ä ö " * 24)]
    df = spark.createDataFrame([(*r, "x", "y") for r in given], schema)
    rows = sorted((r["doc_id"] or -1, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(df).collect())
    assert rows == [
        (-1, 60, [(0, 60, 3)], "a b c"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 60, [(0, 60, 3)], "a b c"), (4, 60, [(0, 60, 3)], "a b c"),
        (5, 23, [], " ".join(["one"] * 23)), (6, 24, [(0, 24, 1)], "ä ö"),
    ]
    assert periodic_runs(df.limit(0)).collect() == []
    blank = run_digest(periodic_runs(df.filter("doc_id = 1"))).collect()[0]
    assert blank["n_runs"] == 0 and blank["start"] is None and blank["runs_sha256"] == blank["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    assert {r["doc_id"]: r["text"] for r in wrapped(df).collect() if r["doc_id"] in (None, 1, 2)} == {None: loop, 1: None, 2: ""}
    with pytest.raises(ValueError):
        periodic_runs(df, times=2)
