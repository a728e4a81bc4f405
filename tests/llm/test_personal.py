"""Personal data: base spans against the plain patterns, the tagger by gradients, held-out spans and planted cases."""

import hashlib
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from __spark_entry__ import queries
from cantogram.llm.personal import (
    KINDS, STRIDE, WINDOW, base_matches, best_set, cut_windows, decoded, find_personal, fit, joined_parts, labelled_windows, passes_luhn, personal_digest,
    reconciled,
)
from cantogram.llm.tagger import characters, fresh_weights, loss_and_gradients
from tests.llm.test_queries import FOLDER

CORPUS = "/root/testdata/sf0.1/documents.parquet"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".") if p.isdigit()), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def good(text):
    return [m[:3] for m in base_matches(text) if m[3]]


def test_patterns():
    texts = [
        "a@b.c@d.e x@y z@@q.r .@a.b a@b.c.", "1.2.3.4.5.6.7.8.9 256.1.1.1 0001.02.3.4 1..2.3.4 1.2.3.", "+1 (017) 555-7713 +12345678 +1 2 +1-2-3-4-5-6-7-8.", "4539 1488 0343 6467, 4539148803436467 1234567812345678",
        "x" * 50 + "@" + "y." * 5 + "é@a.b", "+1 (826) 555-4081 190.137.223.204", "", "++1  2 +3()4", "1 2  3-4--5",
    ]
    for text in texts:
        assert good(text) == plain_base(text), text
    assert passes_luhn("4539148803436467") == luhn("4539148803436467") and passes_luhn("123") == luhn("123")


def test_long_texts_are_read_once():
    """Half a million characters of one kind, each of which a backtracking pattern would read again and again."""
    for unit in ("a", "1", "1.", "a@", "+1", "1 ", "(", "@", "é1"):
        base_matches(unit * (500_000 // len(unit)))


def test_query_base_equals_patterns(spark):
    rows = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    found = {r["doc_id"]: r for r in queries()["op11_personal_data"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    for row in rows:
        base, got = plain_base(row["text"]), found[row["doc_id"]]
        listed = [f"{k}:{s}:{e}" for k, s, e in base]
        assert [got[f"n_{k}"] for k in KINDS] == [sum(x[0] == k for x in base) for k in KINDS]
        assert got["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = [x for x in got["spans"].split(",") if x]
        assert set(listed) <= set(spans) and len(set(spans)) == len(spans)
        assert spans == sorted(spans, key=lambda x: (KINDS.index(x.split(":")[0]), *map(int, x.split(":")[1:])))


def test_gradients():
    rng = np.random.default_rng(1)
    weights = {k: v.astype(np.float64) for k, v in fresh_weights(2, rng, embedding=3, hidden=4).items()}
    windows, tags = rng.integers(0, 131, (3, 7)), np.array([[0, 1, 2, 2, 0, 3, 4], [1, 1, 2, 0, 0, 0, 0], [0, 0, 3, 4, 4, 1, 2]], np.int8)
    _, grads = loss_and_gradients(weights, windows, tags)
    for name, value in weights.items():
        for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(4)]:
            if name == "embedding":
                at = (windows[at[0] % 3, at[1] % 7], at[1])
            old, losses = value[at], []
            for step in (1e-3, -1e-3):
                value[at] = old + step
                losses.append(loss_and_gradients(weights, windows, tags)[0])
            value[at] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - grads[name][at]) < 2e-2 * max(1, abs(grads[name][at])), name


@pytest.fixture(scope="module")
def weights(spark):
    """Learnt from the documents whose number does not end in 0."""
    return fit(spark.read.parquet(CORPUS).filter("doc_id % 10 != 0"))


def added(weights, text):
    base = good(text)
    return sorted(set(reconciled(text, base, decoded(weights, [characters(text)])[0])) - set(base))


def test_held_out_spans(weights):
    """The tagger alone, on documents that it was not trained on."""
    texts = [r["text"] for r in pq.read_table(CORPUS).to_pylist() if r["doc_id"] % 10 == 0 and re.search("[0-9@]", r["text"] or "")]
    right = wrong = missed = 0
    for text, spans in zip(texts, decoded(weights, [characters(t) for t in texts]), strict=True):
        own, expected = set(reconciled(text, [], spans)), set(good(text))
        right, wrong, missed = right + len(own & expected), wrong + len(own - expected), missed + len(expected - own)
    assert right > 30 and right >= 0.95 * (right + missed) and right >= 0.95 * (right + wrong), (right, wrong, missed)


def test_added_spans(weights):
    """Values that the patterns run together or cannot read are separated; plain prose and failing numbers are left alone."""
    start = "the ones of that. "
    phone, card = "+1 (826) 555-4081", "4539148803436467"
    assert added(weights, f"{start}{phone} 190.137.223.204 and so on") == [("phone", 18, 18 + len(phone))]
    assert ("card", 18, 34) in added(weights, f"{start}{card} 4539148803436467 and so on")
    for text in (start * 40, "Version 2.0. BY-NC 4.0, version 3.", start + "1234567812345678 of", 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"'):
        assert added(weights, text) == []


def test_windows_and_reconciling():
    text = "x" * 100 + "5" + "x" * 200
    starts = cut_windows(characters(text))
    assert starts.tolist() == [64, 96] and WINDOW == 2 * STRIDE
    assert cut_windows(characters("")).tolist() == [] and cut_windows(characters("@")).tolist() == [0]
    parts = [(0, 10, 64, 50.0, True), (0, 32, 70, 38.0, True), (0, 90, 95, 5.0, False), (1, 60, 64, 4.0, True)]
    assert sorted(joined_parts(parts)) == [(0, 10, 70, 56.0), (0, 90, 95, 5.0), (1, 60, 64, 4.0)]
    assert best_set([("a", 0, 10, 5.0), ("b", 5, 12, 6.0), ("c", 12, 14, 1.0), ("d", 0, 5, 0.5)])[::-1] == [("d", 0, 5), ("b", 5, 12), ("c", 12, 14)]


def test_odd_rows(spark):
    schema = "doc_id long, text string, spans string, kind string"
    mail = "write to a.b@mail.example.com now"
    given = [(1, None), (2, ""), (3, " \n"), (None, mail), (4, mail), (4, mail), (5, "😀 " + mail), (6, "7" * 100_000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in given], schema)
    rows = find_personal(df, steps=5).collect()
    assert len(rows) == len(given)
    base = {(r["doc_id"], tuple(tuple(x) for x in r["base"])) for r in rows}
    assert base == {(i, ()) for i in (1, 2, 3, 6)} | {(None, (("email", 9, 29),)), (4, (("email", 9, 29),)), (5, (("email", 11, 31),))}
    assert labelled_windows(df, limit=2).groupBy("kind").count().filter("count > 2").isEmpty()
    assert find_personal(df.limit(0)).collect() == [] and fit(df.filter("doc_id < 4")) is None
    digest = personal_digest(find_personal(df.filter("doc_id < 4"))).collect()
    assert {(r["n_email"], r["spans"]) for r in digest} == {(0, "")}
