"""Personal data: exact patterns, and a learnt tagger for what they cannot separate.

1. Base spans are the matches of four patterns whose values pass a check (email, ip, card, phone).
2. Windows around base spans, and around other digits, are the labelled examples; of each kind a bounded number of
   distinct windows, chosen by a hash, trains a bidirectional LSTM with CRF transitions. Windows
   that hold a match whose value failed its check are not used: nobody knows their labels.
   Training adds variants of them: neighbouring spans, which the patterns run together, and letters beyond ASCII.
3. Whole texts are cut in windows that overlap by half. A span holds a digit or an at sign, so windows without
   either have none and are not decoded.
4. Windows agree globally per text: parts of one kind that meet at the windows' edges are joined, candidates whose
   values fail the checks leave, base spans stay, and of the rest the set without overlaps that has the greatest
   sum of tag probabilities is added.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from cantogram.llm.tagger import PAD, Weights, characters, emissions, marginals, train, viterbi
from cantogram.operators.ranking import top_within

KINDS = ("email", "ip", "card", "phone")
#: Distinct labelled windows of each kind, and of other digits, that the tagger is trained on: the documented bound of its sample.
SAMPLE_WINDOWS = 500
WINDOW, STRIDE = 64, 32
#: Batches that training takes, whatever the sample's size.
STEPS = 300
#: Mean probability of its tags from which a span is believed.
LEAST_CHANCE = 0.5
#: Windows that are decoded together.
BLOCK = 1024
#: Characters before the at sign of a base email.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
Span = tuple[str, int, int]
Batches = Iterator[pa.RecordBatch]
SPANS = "array<struct<kind:string,start:long,end:long>>"


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(digits: str) -> bool:
    twice = [2 * int(c) for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(x - 9 if x > 9 else x for x in twice)) % 10 == 0


def small_parts(text: str) -> bool:
    """Whether all numbers between the dots are 255 at most; they may have any number of leading zeros."""
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def is_card(text: str) -> bool:
    return 16 <= len(d := digits_of(text)) <= 19 and passes_luhn(d)


def is_phone(text: str) -> bool:
    return 8 <= len(digits_of(text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign to both sides, so that a long run of letters is read once."""
    domain, end = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), 0
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > max(end, low) and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (rest := domain.match(text, at + 1)):
            end = rest.end()
            yield start, end
        low, at = at + 1, text.find("@", at + 1)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Chains of numbers and dots, four numbers at a time."""
    for chain in re.finditer(r"[0-9]+(?:\.[0-9]+)*", text):
        parts = list(re.finditer("[0-9]+", chain[0]))
        for k in range(0, len(parts) - 3, 4):
            yield chain.start() + parts[k].start(), chain.start() + parts[k + 3].end()


def _found(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in re.finditer(pattern, text))


def base_matches(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, whether its value passes): leftmost matches that do not overlap, by kind, then start."""
    finders = (
        ("email", emails, lambda x: True),
        ("ip", addresses, small_parts),
        ("card", _found(r"[0-9](?:[\x20-]?[0-9])+"), is_card),
        ("phone", _found(r"\+[0-9][\x20().0-9-]+[0-9]"), is_phone),
    )
    return [(kind, s, e, check(text[s:e])) for kind, find, check in finders for s, e in find(text)]


def plausible(kind: str, text: str, start: int, end: int) -> bool:
    """Whether a span that the tagger found can be a whole value of its kind."""
    value = text[start:end]
    if kind == "email":
        return re.fullmatch(r"[^\s@<>(),;:\"]+@[^\s@.]+(\.[^\s@.]+)+", value) is not None
    if text[max(0, start - 1) : start].isdigit() or text[end : end + 1].isdigit():
        return False
    if kind == "ip":
        return re.fullmatch(r"[0-9]+(\.[0-9]+){3}", value) is not None and small_parts(value)
    if kind == "card":
        return re.fullmatch(r"[0-9]([\x20-]?[0-9])+", value) is not None and is_card(value)
    return re.fullmatch(r"\+[0-9][\x20().0-9-]+[0-9]", value) is not None and is_phone(value)


# Examples


def examples(text: str) -> Iterator[tuple[str, str, str]]:
    """(kind, window, tags) around each base span, and around other digits as kind "none"; tags are one figure a character."""
    matches = base_matches(text)
    spans = [m for m in matches if m[3]]
    doubtful = np.zeros(len(text) + 1, dtype=np.int64)
    tags = np.zeros(len(text), dtype=np.int8)
    for kind, s, e, _ in sorted(spans, key=lambda m: (m[1], -m[2]), reverse=True):
        k = KINDS.index(kind)
        tags[s:e], tags[s] = 2 * k + 2, 2 * k + 1
    for _, s, e, passed in matches:  # digits of a failed match; those inside a span, as of a phone number, are that span's
        if not passed and len(digits_of(text[s:e])) > 3 and not tags[s:e].all():
            doubtful[s + 1 : e + 1] = 1
    doubtful = np.cumsum(doubtful)
    plain = [("none", m.start(), m.end()) for m in re.finditer(r"\S+", text) if re.search("[0-9@]", m[0]) and not tags[m.start() : m.end()].any()]
    for n, (kind, s, e) in enumerate([m[:3] for m in spans] + plain):
        left = max(0, s - (7 * n + 5 * (e - s)) % (WINDOW - 16))
        right = min(len(text), left + WINDOW)
        if e <= right and doubtful[right] == doubtful[left]:
            cut = tags[left:right].copy()
            while len(cut) and cut[0] and cut[0] % 2 == 0:  # the end of a span that began before the window
                whole = np.flatnonzero(cut != cut[0])
                cut[: whole[0] if len(whole) else len(cut)] = 0
            yield kind, text[left:right], "".join(map(str, cut.tolist()))


def _examples(batches: Batches) -> Batches:
    for batch in batches:
        rows = [x for text in batch.column("text").to_pylist() for x in examples(text)]
        columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]
        yield pa.record_batch(columns, names=["kind", "window", "tags"])


def labelled_windows(docs: DataFrame, limit: int = SAMPLE_WINDOWS) -> DataFrame:
    """(kind, window, tags): of each kind at most ``limit`` distinct windows, by the least hash."""
    with_digits = docs.select(F.col("text").cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]"))
    found = with_digits.mapInArrow(_examples, "kind string, window string, tags string").distinct()
    return top_within(found.withColumn("hash", F.xxhash64("window")), ["kind"], "hash", "window", limit, "_place").drop("_place", "hash")


def varied(rows: list[tuple[str, str, str]], rng: np.random.Generator) -> list[tuple[str, str]]:
    """The windows and their tags, with variants: two spans side by side, and letters beyond ASCII in addresses."""
    out = [(w, t) for _, w, t in rows]
    pieces = []
    for kind, window, tags in rows:
        if kind != "none":
            k = 2 * KINDS.index(kind) + 1
            for m in re.finditer(f"{k}{k + 1}*", tags):
                pieces.append((kind, window[m.start() : m.end()], m[0]))
    for kind, window, tags in rows:
        if kind == "none" or not pieces:
            continue
        k = 2 * KINDS.index(kind) + 1
        own = re.search(f"{k}{k + 1}*", tags)
        _, value, marks = pieces[int(rng.integers(len(pieces)))]
        if own:
            gap = " " if rng.random() < 0.8 else ", "
            both = window[max(0, own.start() - 12) : own.end()] + gap + value + window[own.end() : own.end() + 10]
            labels = tags[max(0, own.start() - 12) : own.end()] + "0" * len(gap) + marks + tags[own.end() : own.end() + 10]
            if len(both) <= WINDOW and not re.match("[2468]", labels):
                out.append((both, labels))
            if kind == "email":
                at = [i for i in range(own.start(), own.end()) if window[i].isalpha()]
                swapped = list(window)
                for i in at:
                    if rng.random() < 0.2:
                        swapped[i] = "é"
                out.append(("".join(swapped), tags))
    return out


def fit(docs: DataFrame, limit: int = SAMPLE_WINDOWS, steps: int = STEPS) -> Weights | None:
    """The tagger of a corpus; None where no base span is found."""
    rows = sorted(tuple(r) for r in labelled_windows(docs, limit).collect())
    if all(kind == "none" for kind, *_ in rows):
        return None
    examples_ = varied(rows, np.random.default_rng(11))
    windows = np.full((len(examples_), WINDOW), PAD, dtype=np.int64)
    tags = np.zeros((len(examples_), WINDOW), dtype=np.int8)
    for i, (window, marks) in enumerate(examples_):
        windows[i, : len(window)] = characters(window)
        tags[i, : len(marks)] = list(map(int, marks))
    return train(windows, tags, len(KINDS), steps)


# Decoding


def cut_windows(numbers: np.ndarray) -> np.ndarray:
    """Starts of the windows of a text that hold a digit or an at sign; together they reach over all of those."""
    count = max(1, -(-(len(numbers) - WINDOW) // STRIDE) + 1)
    telling = np.concatenate([[0], np.cumsum(((numbers >= 48) & (numbers <= 57)) | (numbers == 64))])
    starts = np.arange(count) * STRIDE
    return starts[telling[np.minimum(starts + WINDOW, len(numbers))] > telling[np.minimum(starts, len(numbers))]]


def spans_in(tags: np.ndarray, chance: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, sum of probabilities) of the spans of one window."""
    out = []
    for s in np.flatnonzero(tags % 2 == 1).tolist():
        e = s + 1
        while e < len(tags) and tags[e] == tags[s] + 1:
            e += 1
        out.append((int(tags[s]) // 2, s, e, float(chance[np.arange(s, e), tags[s:e]].sum())))
    return out


def decoded(weights: Weights, texts: list[np.ndarray]) -> list[list[tuple[int, int, int, float, bool]]]:
    """For each text (kind, start, end, weight, cut): spans of its windows; ``cut`` where one ends at an edge inside the text."""
    places = [(i, int(s)) for i, numbers in enumerate(texts) for s in cut_windows(numbers)]
    out: list[list] = [[] for _ in texts]
    for k in range(0, len(places), BLOCK):
        block = places[k : k + BLOCK]
        windows = np.full((len(block), WINDOW), PAD, dtype=np.int64)
        for row, (i, s) in enumerate(block):
            part = texts[i][s : s + WINDOW]
            windows[row, : len(part)] = part
        scores = emissions(weights, windows)
        tags = viterbi(weights, scores)
        chance, _, _ = marginals(weights, scores)
        for row in np.flatnonzero(tags.any(axis=1)).tolist():
            i, s = block[row]
            for kind, a, b, weight in spans_in(tags[row], chance[:, row]):
                if s + a < len(texts[i]):
                    cut = (a == 0 and s > 0) or (b == WINDOW and s + WINDOW < len(texts[i]))
                    out[i].append((kind, s + a, min(s + b, len(texts[i])), weight, cut))
    return out


def joined_parts(spans: list[tuple[int, int, int, float, bool]]) -> list[tuple[int, int, int, float]]:
    """All spans, and in place of those that an edge cuts, the unions of cut ones of one kind that meet."""
    out = [s[:4] for s in spans if not s[4]]
    group: list = []
    for span in [*sorted(s for s in spans if s[4]), (None, -1, -1, 0.0, True)]:
        if group and (span[0] != group[0] or span[1] > group[2]):
            out.append(tuple(group))
            group = []
        if not group:
            group = list(span[:4])
        else:
            new = max(0, span[2] - group[2])
            group[2], group[3] = max(group[2], span[2]), group[3] + span[3] * new / max(1, span[2] - span[1])
    return out


def best_set(spans: list[tuple[str, int, int, float]]) -> list[Span]:
    """The spans without overlaps of greatest total weight; of equal totals, the one that ends first."""
    spans = sorted(set(spans), key=lambda s: (s[2], s[1], s[0]))
    ends, best, take = [s[2] for s in spans], [0.0], []
    for i, (_, start, _, weight) in enumerate(spans):
        rest = bisect_right(ends, start, 0, i)
        take.append(rest if best[rest] + weight > best[i] else None)
        best.append(max(best[i], best[rest] + weight))
    out, i = [], len(spans)
    while i:
        if take[i - 1] is None:
            i -= 1
        else:
            out.append(spans[i - 1][:3])
            i = take[i - 1]
    return out


def reconciled(text: str, base: list[Span], spans: list[tuple[int, int, int, float, bool]]) -> list[Span]:
    """Base spans, and the best set of believed spans that overlap none of them; by kind, then start."""
    edges = sorted((s, e) for _, s, e in base)
    starts, reach = [s for s, _ in edges], []
    for _, e in edges:
        reach.append(max(e, reach[-1] if reach else 0))

    def free(s: int, e: int) -> bool:
        i = bisect_right(starts, e - 1)
        return not i or reach[i - 1] <= s

    new = [(KINDS[k], s, e, w) for k, s, e, w in joined_parts(spans) if w >= LEAST_CHANCE * (e - s) and free(s, e) and plausible(KINDS[k], text, s, e)]
    return sorted([*base, *best_set(new)], key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def _tagged(held: Broadcast) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        weights = held.value
        for batch in batches:
            columns = [c for c in batch.schema.names if c != "text"]
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts = [t or "" for t in part.column("text").to_pylist()]
                told = [i for i, t in enumerate(texts) if re.search("[0-9@]", t)]
                base = {i: [m[:3] for m in base_matches(texts[i]) if m[3]] for i in told}
                found = decoded(weights, [characters(texts[i]) for i in told]) if weights else [[] for _ in told]
                every = {i: reconciled(texts[i], base[i], spans) for i, spans in zip(told, found, strict=True)}
                rows = [[[{"kind": a, "start": s, "end": e} for a, s, e in of.get(i, [])] for i in range(len(texts))] for of in (base, every)]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.record_batch([part.column(c) for c in columns] + [pa.array(r, kind) for r in rows], names=[*columns, "base", "spans"])

    return run


def find_personal(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = SAMPLE_WINDOWS, steps: int = STEPS) -> DataFrame:
    """(doc_id, base, spans) for each row of ``docs``: lists of (kind, start, end), in code points, end exclusive.

    ``base`` holds the matches of the patterns whose values pass, by kind (email, ip, card, phone), then start; ``spans``
    those and what a tagger adds that was trained on ``limit`` distinct windows of each kind from ``docs`` itself. An added span passes
    the checks of its kind and overlaps no other span. A null text is empty and has none. Rows stand for
    themselves: repeated rows give repeated results, null ids stay null. Other columns are ignored. A table without base spans gets no tagger,
    so nothing is added; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(fit(source, limit, steps))
    return source.mapInArrow(_tagged(held), f"doc_id long, base {SPANS}, spans {SPANS}")


def personal_digest(found: DataFrame) -> DataFrame:
    """Counts, and the lists of :func:`find_personal` as ``kind:start:end`` joined by commas."""
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: lambda s: s["kind"] == k
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
