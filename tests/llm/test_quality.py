"""Robust outliers: small groups are judged by their language, a group's own junk does not hide itself."""

import random

from cantogram.llm.quality import judge

PLAIN = "the quick brown fox jumps over a lazy dog while rain falls on quiet green hills near our old stone house".split()


def plain_text(rng):
    return " ".join(rng.choice(PLAIN) for _ in range(rng.randint(60, 200)))


def junk(rng):
    return " ".join(rng.choice(["#%%$|", "<>&*#", "$$$%", "||&&"]) + str(rng.randrange(10**6)) for _ in range(80))


def test_junk_of_a_small_source_is_rejected(spark):
    rng = random.Random(4)
    rows = [(i, plain_text(rng), "en", "big") for i in range(400)]
    rows += [(1000 + i, junk(rng), "en", "small") for i in range(3)] + [(1100 + i, plain_text(rng), "en", "small") for i in range(3)]
    rows += [(2000 + i, junk(rng), "en", "big") for i in range(3)]
    rows += [(3000 + i, plain_text(rng), "xx", "tiny") for i in range(4)] + [(3100, junk(rng), "xx", "tiny"), (3200, junk(rng), None, None), (3201, junk(rng), "", "")]
    found = {r["doc_id"]: r["kept"] for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(kept for d, kept in found.items() if d in (*range(1000, 1003), *range(2000, 2003), 3100, 3200, 3201))
    assert all(kept for d, kept in found.items() if 1100 <= d < 1200 or 3000 <= d < 3100)
    assert sum(found[d] for d in range(400)) >= 396
