"""License scans: ordered signature rules with a keyword gate, over normalised words.

Words are runs of letters, digits and non-ASCII of the lower-cased text, joined by single spaces. A rule
is a regular expression over that text with keywords one of which a match holds, a label, a priority and a weight. Rules run
only on texts that hold one of their keywords. Of overlapping detections, one that lies within another of higher or equal priority is suppressed.
The rules come from families times versions times phrasings, so that the table is generated, not listed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cantogram.llm.decontaminate import clean

Batches = Iterator[pa.RecordBatch]

# The phrases that always count, with their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Name patterns, keywords (a match holds one of them), label stem and the versions that the label may take; a version is "" where the family has one text.
FAMILIES: tuple[tuple[str, tuple[str, ...], str, tuple[str, ...]], ...] = (
    ("mit", ("mit",), "mit", ("",)),
    ("apache(?: software)?", ("apache",), "apache", ("1 0", "1 1", "2 0", "2")),
    ("(?:gnu )?(?:general public|gpl)", ("general public", "gpl"), "gpl", ("1", "2", "3", "2 0", "3 0")),
    ("(?:gnu )?(?:lesser general public|library general public|lgpl)", ("lesser general", "library general", "lgpl"), "lgpl", ("2", "2 1", "3", "3 0")),
    ("(?:gnu )?(?:affero general public|agpl)", ("affero", "agpl"), "agpl", ("1", "3", "3 0")),
    ("(?:mozilla public|mpl)", ("mozilla", "mpl"), "mpl", ("1 0", "1 1", "2 0")),
    ("(?:eclipse public|epl)", ("eclipse", "epl"), "epl", ("1 0", "2 0")),
    ("(?:common development and distribution|cddl)", ("common development", "cddl"), "cddl", ("1 0", "1 1")),
    ("(?:boost software|bsl)", ("boost software", "bsl"), "bsl", ("1 0",)),
    ("(?:european union public|eupl)", ("european union", "eupl"), "eupl", ("1 0", "1 1", "1 2")),
    ("(?:artistic|perl artistic)", ("artistic",), "artistic", ("1 0", "2 0")),
    ("(?:academic free|afl)", ("academic free", "afl"), "afl", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("(?:open software|osl)", ("open software", "osl"), "osl", ("1 0", "2 0", "2 1", "3 0")),
    ("(?:bsd|berkeley software distribution)", ("bsd", "berkeley"), "bsd", ("2 clause", "3 clause", "4 clause", "0 clause")),
    ("(?:python software foundation|psf)", ("python software", "psf"), "psf", ("2", "2 0")),
    ("(?:zope public|zpl)", ("zope", "zpl"), "zpl", ("1 1", "2 0", "2 1")),
    ("isc", ("isc",), "isc", ("",)),
    ("zlib", ("zlib",), "zlib", ("",)),
    ("unlicense", ("unlicense",), "unlicense", ("",)),
)
#: How a text names a license; {name} and {version} are filled in. With priority and weight.
PHRASINGS: tuple[tuple[str, int, float], ...] = (
    (r"spdx license identifier {spdx}", 90, 1.0),
    (r"(?:licen[sc]ed|released|distributed|available|provided) under (?:the )?(?:terms of (?:the )?)?{name} (?:licen[sc]e )?(?:version |v)?{version}", 70, 0.95),
    (r"under (?:the )?(?:terms of (?:the )?)?{name} licen[sc]e (?:version |v)?{version}", 60, 0.9),
    (r"under (?:the )?(?:terms of (?:the )?)?{name} {version} licen[sc]e", 60, 0.9),
    (r"{name} licen[sc]e (?:version |v)?{version}", 40, 0.8),
    (r"{name} {version} licen[sc]e", 40, 0.8),
    (r"{name} (?:version |v){version}", 30, 0.6),
    (r"{stem} v?{version}(?: only| or later)?", 25, 0.5),
)
CC_PARTS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
CC_VERSIONS = ("", "1 0", "2 0", "2 5", "3 0", "4 0")
#: Signs without a named license: pattern, keywords, label, priority, weight.
NOTICES = (
    (r"all rights reserved", ("reserved",), "proprietary-notice", 20, 0.5),
    (r"copyright (?:c )?(?:19|20)\d\d", ("copyright",), "copyright-notice", 10, 0.3),
    (r"permission is hereby granted free of charge to any person obtaining a copy", ("hereby granted",), "mit", 80, 1.0),
    (r"redistribution and use in source and binary forms", ("redistribution",), "bsd", 80, 1.0),
    (r"(?:dedicated to|placed in|in) the public domain", ("public domain",), "public-domain", 50, 0.7),
    (r"see (?:the )?licen[sc]e file|licen[sc]e terms|terms of (?:the |this )?licen[sc]e", ("license", "licence"), "unknown-reference", 15, 0.4),
)


@dataclass(frozen=True)
class Rule:
    pattern: re.Pattern
    keywords: tuple[str, ...]
    label: str
    priority: int
    weight: float


def _bounded(pattern: str) -> re.Pattern:
    return re.compile(f"(?<= )(?:{pattern})(?= )")


def signature_rules() -> tuple[Rule, ...]:
    """All rules, highest priority first; the order among equals is the order of the tables."""
    rules = []
    for name, keywords, stem, versions in FAMILIES:
        for version in versions:
            label = "-".join([stem, *version.split()]) if version else stem
            # Versions of one text: "2 0" and "2" are one label.
            label = label[:-2] if label.endswith("-0") else label
            for phrasing, priority, weight in PHRASINGS:
                # A family without versions has only the phrasings that read on without one.
                if not version and "{version}" in phrasing.replace(" (?:version |v)?{version}", ""):
                    continue
                spdx = " ".join([stem, *version.split()]) + "(?: only| or later)?"
                body = phrasing.replace("{spdx}", spdx).replace("{name}", name).replace("{stem}", stem)
                body = body.replace(" (?:version |v)?{version}", "") if not version else body.replace("{version}", version)
                own = ("spdx",) if "{spdx}" in phrasing else (stem,) if "{stem}" in phrasing else keywords
                rules.append(Rule(_bounded(body), own, label, priority + bool(version), weight))
    for parts in CC_PARTS:
        for version in CC_VERSIONS:
            tail = f" {version}" if version else ""
            label = f"cc-{parts} {version}".strip().replace(" ", "-")
            rules.append(Rule(_bounded(f"(?:cc|creative commons) {parts}{tail}"), ("cc ", "creative commons"), label, 40 + 2 * len(parts.split()) + bool(version), 0.8))
    rules += [Rule(_bounded(p), k, label, priority, weight) for p, k, label, priority, weight in NOTICES]
    return tuple(sorted(rules, key=lambda r: -r.priority))


def by_keyword(rules: tuple[Rule, ...]) -> dict[str, list[int]]:
    """Each keyword, as it begins a word, with the numbers of the rules that it lets run."""
    out: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        for keyword in rule.keywords:
            out.setdefault(f" {keyword}", []).append(i)
    return out


def detections(text: str, rules: tuple[Rule, ...], keyed: dict[str, list[int]] | None = None) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) of what is left after containment; ``text`` is normalised and has a space at both ends."""
    keyed = by_keyword(rules) if keyed is None else keyed
    run = sorted({i for keyword, own in keyed.items() if keyword in text for i in own})
    found = [(m.start(), m.end(), rules[i]) for i in run for m in rules[i].pattern.finditer(text)]
    return outermost(found)


def outermost(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """The detections that lie within no other of higher or equal priority, by start and end.

    In order of priority, longer ones first, each asks for the furthest end among those that begin no later: a
    tree of prefix maxima over the starts answers, so that many detections in one text cost little each.
    """
    starts = sorted({start for start, _, _ in found})
    furthest = [-1] * (len(starts) + 1)
    kept = []
    for start, end, rule in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0])):
        i = at = bisect_left(starts, start) + 1
        reach = -1
        while i:
            reach = max(reach, furthest[i])
            i &= i - 1
        if reach < end:
            kept.append((start, end, rule))
            while at < len(furthest):
                furthest[at] = max(furthest[at], end)
                at += at & -at
    return sorted(kept, key=lambda d: d[:2])


def word_numbers(text: str, places: list[int]) -> list[int]:
    """The number of the word that begins after the space at each place, from 0; the spaces are counted once for all."""
    out, at, n = {}, 0, 0
    for place in sorted(set(places)):
        n += text.count(" ", at, place)
        at = place
        out[place] = n
    return [out[p] for p in places]


def _base_places(text: str) -> list[tuple[int, str]]:
    places = []
    for phrase, label in BASE_PHRASES.items():
        at = text.find(f" {phrase} ")
        while at >= 0:
            places.append((at, label))
            at = text.find(f" {phrase} ", at + 1)
    return list(zip(word_numbers(text, [at for at, _ in places]), [label for _, label in places], strict=True))


def _scanned(batches: Batches) -> Batches:
    rules = signature_rules()
    keyed = by_keyword(rules)
    for batch in batches:
        rows = []
        for raw in batch.column("text").cast(pa.large_binary()).to_pylist():
            words = clean(raw)
            text = b" ".join([b"", *words, b""]).decode() if words else ""
            places = _base_places(text)
            base = {label for _, label in places}
            left = detections(text, rules, keyed)
            miss = 1.0
            for weight in [0.95] * len(places) + [r.weight for _, _, r in left]:
                miss *= 1 - min(weight, 0.99)
            starts = [at for at, _ in places]
            rows.append(
                (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {r.label for _, _, r in left})), 1 - miss)
                + ([{"first_word": n - 1, "label": r.label, "priority": r.priority} for n, (_, _, r) in zip(word_numbers(text, [a for a, _, _ in left]), left, strict=True)],)
            )
        spans = pa.list_(pa.struct([("first_word", pa.int64()), ("label", pa.string()), ("priority", pa.int32())]))
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), spans]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.record_batch([batch.column("doc_id"), *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]], names=["doc_id", *names])


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) for each row of ``docs``.

    ``n_base`` counts all places of the base phrases, overlapping ones too. ``score`` is the chance that at least one
    sign holds, from the rules' weights. Null and empty texts have no words, null places, empty labels and score 0. Rows
    stand for themselves. Other columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return source.mapInArrow(_scanned, schema + ", detections array<struct<first_word:bigint,label:string,priority:int>>")
