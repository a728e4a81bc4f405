"""Executors without the package, scratch tables, words made to collide, and links that stars miss."""

import os
import random
import subprocess
import sys
import time

import numpy as np
import pytest

from cantogram.llm import near_dedup
from cantogram.llm.near_dedup import near_duplicates
from cantogram.llm.quality import measure
from cantogram.llm.repeats import drop_repeats
from cantogram.llm.scratch import discard, stored
from cantogram.llm.toxicity import vote_patterns
from cantogram.llm.words import SPACE, hash_spans, separators, windows, word_bounds
from cantogram.session import checkpoint_dir
from tests.conftest import ROOT
from tests.llm.test_queries import blank_words, components, removed_words

BARE = """
import sys
sys.path.insert(0, {root!r})
import public_tokenizers
from cantogram.session import build_session, scratch_path
from cantogram.llm import bpe, chat, decontaminate, licenses, near_dedup, periods, personal, quality, repeats, spelling, token_files, toxicity, urls
spark = build_session(master="local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
spark.sparkContext.setLogLevel("OFF")
path = public_tokenizers.path("byte_bpe_50k.json")
text = "under the mit license one two three four five six seven eight nine ten a@b.example.com " * 3
docs = spark.createDataFrame([(i, text + str(i), "en", "a") for i in range(4)], "doc_id long, text string, lang string, source string")
items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
pages = spark.createDataFrame([(1, "http://example.com/a")], "page_id long, url string")
results = [
    near_dedup.near_duplicates(docs), token_files.token_digest(docs, scratch_path(spark, "t"), path, 2), quality.judge(docs), toxicity.score_toxicity(docs, labels),
    licenses.scan_licenses(docs), urls.judge_urls(pages, docs), repeats.drop_repeats(docs), bpe.encode_decode(docs, path), decontaminate.find_contamination(docs, items),
    personal.find_personal(docs, steps=2), spelling.spelling_variants(spelling.frequent_words(spelling.misspelt(spelling.letter_runs(docs)))),
    periods.run_digest(periods.periodic_runs(periods.wrapped(docs))),
]
assert all(df.count() == len(df.collect()) > 0 for df in results)
folder = spark.sparkContext.getCheckpointDir()
spark.stop()
print("FOLDER", folder)
"""


def test_operators_run_where_executors_lack_the_package(tmp_path):
    """Workers start in an empty folder and find nothing of this repository; their scratch tables go with the session."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", BARE.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    folder = done.stdout.split("FOLDER ")[1].strip().removeprefix("file:")
    above, left = os.path.dirname(folder), ["?"]
    for _ in range(120):  # the JVM ends a little later than the driver's Python
        # Record files are an output and stay.
        left = [n for n in os.listdir(above) if n.startswith("cantogram-") and "-t-" not in n] if os.path.isdir(above) else []
        if not left:
            break
        time.sleep(0.5)
    assert left == []


def test_discarded_tables_go_at_once(spark):
    df = stored(spark.range(5), "probe")
    path = df._scratch.removeprefix("file:")
    assert df.count() == 5 and os.path.isdir(path) and path.startswith(checkpoint_dir(spark).removeprefix("file:"))
    discard(df)
    assert not os.path.exists(path)


def twins(n):
    """Two words of a and b by the Thue-Morse pattern, one the other with its letters swapped: equal under any polynomial modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_made_to_collide_stay_apart(spark, n):
    a, b = twins(n)
    plain = [f"w{i}" for i in range(12)]
    rng = random.Random(n)
    texts = {1: [rng.choice((a, b)) for _ in range(30)], 2: [rng.choice((a, b)) for _ in range(30)], 3: [a] + plain, 4: [b] + plain}
    docs = {d: " ".join(w) for d, w in texts.items()}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(df, shingle=13).collect()} == components(docs, 13)
    assert {r["doc_id"]: r["n_removed"] for r in drop_repeats(df).collect()} == {d: sum(g) for d, (_, g) in removed_words(docs).items()}
    words = " ".join([*[a, b] * 8])
    data = np.frombuffer(words.encode(), dtype=np.uint8)
    hashes = hash_spans(data, *word_bounds(data, separators(SPACE)))
    assert len(set(hashes.tolist())) == 2 and len(set(windows(hashes, 8).tolist())) == 2
    line = spark.createDataFrame([(" ".join([a] * 8 + [b] * 8),)], "text string")
    assert measure(line).first()["n_repeat_words"] == 0


def chain(rng, size, links, edits):
    """Texts each a few words from the one before, so that far ones are linked only through others."""
    words = [f"u{rng.randrange(10**9)}" for _ in range(size)]
    out = [list(words)]
    for _ in range(links):
        words = list(words)
        for _ in range(edits):
            words[rng.randrange(size)] = f"u{rng.randrange(10**9)}"
        out.append(words)
    return out


def test_links_that_no_star_offers_are_found(spark):
    """Long chains and dense families just above and below the bound: every link counts, and no other."""
    rng = random.Random(5)
    texts = [w for _ in range(4) for w in chain(rng, 120, 9, 2)]
    base = [f"b{i}" for i in range(150)]
    for _ in range(40):  # a family around one text, members mostly just unlike each other
        own = list(base)
        for i in rng.sample(range(150), rng.choice([2, 3, 4, 5])):
            own[i] = f"e{rng.randrange(60)}"
        texts.append(own)
    rng.shuffle(texts)
    docs = {d: " ".join(w) for d, w in enumerate(texts)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()}
    expected = components(docs)
    assert found == expected and 4 < len(set(expected.values())) < len(docs)


def test_halves_of_a_family_are_joined_by_few_pairs(spark, monkeypatch):
    """Two large components whose members are all alike: one link joins them, so the pairs that are confirmed grow with the nodes, not with their square."""
    size, rng = 120, np.random.default_rng(3)
    base = rng.integers(1, 2**62, 100)
    rows = [(i, np.sort(np.concatenate([base, rng.integers(1, 2**62, 2)])).astype(np.int64).tobytes()) for i in range(2 * size)]
    sets = spark.createDataFrame(rows, "node long, shingles binary")
    entries = spark.createDataFrame([(7, i, 102) for i in range(2 * size)], "bucket long, node long, n long")
    links = spark.createDataFrame([(i % 2, i) for i in range(2, 2 * size)], "a long, b long")
    offered, confirmed = [], near_dedup._confirmed
    monkeypatch.setattr(near_dedup, "_confirmed", lambda pairs, *rest: offered.append(pairs.count()) or confirmed(pairs, *rest))
    found = {tuple(r) for table in near_dedup._rest(entries, sets, links, 80) for r in table.collect()}
    assert offered[0] == len(found) == size and not any(offered[1:])
    assert all((a + b) % 2 for a, b in found)


def test_few_pairs_lose_no_link(spark):
    """One word of a rare few swapped in and out of one text: members far from every star still come together."""
    rng = random.Random(11)
    base, texts = [f"b{i}" for i in range(140)], []
    for _ in range(150):
        own = list(base)
        for i in rng.sample(range(140), rng.choice([1, 3, 4, 5, 6])):
            own[i] = f"e{rng.randrange(12)}"
        texts.append(" ".join(own))
    docs = dict(enumerate(texts))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(df, shingle=4).collect()}
    assert found == components(docs, 4) and len(set(found.values())) > 2


def test_repeats_that_branch_and_turn(spark):
    """Passages with several ways in and out, a text that repeats itself in a circle, and one shared by many texts."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(90)]
    ring = [f"r{i}" for i in range(33)]
    docs = {}
    for d in range(60):
        words = [f"x{rng.randrange(10**6)}" for _ in range(30)]
        a = rng.randrange(60)
        words[10:10] = passage[a : a + rng.randrange(21, 80)]
        if d % 5 == 0:
            words += (ring * 4)[rng.randrange(33) :][: rng.randrange(40, 100)]
        if d % 7 == 0:
            words[25:25] = passage[:45] + passage[20:70]
        docs[d] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in drop_repeats(df).collect()}
    for d, (words, gone) in removed_words(docs).items():
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        assert found[d] == (sum(gone), kept if any(gone) else docs[d])
    assert sum(n > 0 for n, _ in found.values()) > 40 and blank_words(docs[0])


def test_rare_vote_patterns_are_merged(spark):
    rows = [("000", 50), ("100", 9), ("010", 3), ("001", 2), ("110", 2), ("011", 1), ("111", 1)]
    votes = spark.createDataFrame(rows, "votes string, n long")
    patterns, counts = vote_patterns(votes, limit=2)
    assert counts.tolist() == [50, 9, 5, 3, 1]
    assert np.allclose(patterns, [[0, 0, 0], [1, 0, 0], [0, 0.6, 0.4], [2 / 3, 1, 1 / 3], [1, 1, 1]])
    whole, every = vote_patterns(votes)
    assert every.sum() == counts.sum() and np.allclose((whole * every[:, None]).sum(axis=0), (patterns * counts[:, None]).sum(axis=0))
    assert vote_patterns(votes.limit(0))[1].tolist() == []


def test_blocks_of_items_give_the_same(spark, monkeypatch, plan_of):
    from cantogram.llm import decontaminate

    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for i in range(60)] + [(99, None), (None, "w1 w2 w3")]
    docs = [(d, " ".join(rng.choice(words) for _ in range(80)) + " " + (items[d % 60][1] or "")) for d in range(80)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(repr, decontaminate.find_contamination(df, bench).collect()))
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 500)
    parts = decontaminate.find_contamination(df, bench)
    assert sorted(map(repr, parts.collect())) == whole and plan_of(parts).count("MapInArrow") == 1
