"""License rules: phrasings that texts use, keywords, containment against all pairs, and long texts."""

import random
import time

import pytest

from cantogram.llm.licenses import Rule, detections, outermost, scan_licenses, signature_rules

RULES = signature_rules()


@pytest.mark.parametrize(
    "text,label",
    [
        ("bsd 3 clause license", "bsd-3-clause"), ("gpl 3", "gpl-3"), ("released under the mit licence", "mit"), ("under the terms of the gnu general public license version 2", "gpl-2"),
        ("spdx license identifier mpl 2 0", "mpl-2"), ("licensed under the apache license version 2 0", "apache-2"), ("creative commons by nc sa 4 0", "cc-by-nc-sa-4-0"), ("lgpl v2 1 or later", "lgpl-2-1"),
    ],
)
def test_phrasings(text, label):
    assert label in {r.label for _, _, r in detections(f" {text} ", RULES)}


def test_plain_words_are_no_license():
    for text in ("the licence to print money", "copyright law", "a limited version 3 of it", "the boost", "we commit to it under the terms"):
        assert not {r.label for _, _, r in detections(f" {text} ", RULES)} - {"unknown-reference"}


def test_every_match_holds_a_keyword():
    """The prefilter loses nothing: rules run without it find the same."""
    texts = ["bsd 2 clause license", "gnu lesser general public license v3", "eclipse public license 2 0", "zpl 2 1", "mit license", "cc by sa 3 0", "python software foundation license 2", "afl 3 0"]
    for text in (f" {t} and {u} " for t in texts for u in texts):
        every = [(m.start(), m.end(), r) for r in RULES for m in r.pattern.finditer(text)]
        assert outermost(every) == detections(text, RULES)
    assert len(RULES) > 200


def test_containment_equals_all_pairs():
    rng = random.Random(2)
    for _ in range(200):
        found = [(a := rng.randrange(30), a + rng.randrange(1, 12), Rule(None, (), str(i), rng.randrange(4), 0.5)) for i in range(rng.randrange(25))]
        kept = []
        for d in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0])):
            if not any(a <= d[0] and d[1] <= b for a, b, _ in kept):
                kept.append(d)
        assert sorted(outermost(found), key=lambda d: (d[:2], d[2].label)) == sorted(kept, key=lambda d: (d[:2], d[2].label))


def test_long_texts_of_licenses(spark):
    unit = "copyright 2001 cc by nc "
    df = spark.createDataFrame([(1, unit * 60_000)], "doc_id long, text string")
    began = time.time()
    row = scan_licenses(df).first()
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (300_000, 60_000, 2, 299_997) and time.time() - began < 60
    assert [d["first_word"] for d in row["detections"][:4]] == [0, 2, 5, 7] and row["base_labels"] == "cc-by-nc"
