"""Nulls, empty and long texts, repeated rows, empty tables and clashing extra columns."""

import public_tokenizers
import pytest

from cantogram.llm.bpe import encode_decode
from cantogram.llm.chat import chat_digest, format_chats
from cantogram.llm.decontaminate import find_contamination, without_contamination
from cantogram.llm.licenses import scan_licenses
from cantogram.llm.near_dedup import near_duplicates
from cantogram.llm.quality import judge, without_rejected
from cantogram.llm.queries import VOCABULARY
from cantogram.llm.repeats import drop_repeats, without_repeats
from cantogram.llm.token_files import token_digest
from cantogram.llm.toxicity import score_toxicity
from cantogram.llm.urls import judge_urls
from cantogram.session import scratch_path

LONG = " ".join(f"w{i}" for i in range(30000))
ROWS = [
    (1, LONG, "en", "a"), (2, LONG, "en", "a"), (2, LONG, "en", "a"), (3, None, None, None),
    (4, "", "en", "a"), (None, "no id of its own", "en", None), (5, " \n\t ", "de", "b"), (6, "under the MIT license 😀", "fr", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Extra columns with names that operators use inside.
CLASHING = ("n_words", "kept", "n", "marks", "class", "unit", "bands", "component_id", "spans", "row", "score")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in CLASHING])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def path():
    return public_tokenizers.path(VOCABULARY)


def items(spark, rows=((7, "w5 w6 w7"), (7, "w5 w6 w7"), (8, None), (None, "license"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labelled(spark):
    return spark.createDataFrame([(1, 0), (2, None), (None, 1), (4, 1), (4, 1)], "doc_id long, toxic int")


def test_near_duplicates(spark, odd, none):
    found = sorted(near_duplicates(odd).collect(), key=repr)
    assert len(found) == len(ROWS)
    by_id = {r[0]: r for r in found}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"] and by_id[1]["kept"]
    assert by_id[3]["n_shingles"] == by_id[4]["n_shingles"] == by_id[5]["n_shingles"] == 0 and by_id[5]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert near_duplicates(none).collect() == []


def test_records(spark, odd, none):
    rows = token_digest(odd, scratch_path(spark, "t"), path(), end_id=2).collect()
    assert sorted(r["n_tokens"] for r in rows if r["doc_id"] in (3, 4)) == [1, 1] and len(rows) == len(ROWS)
    assert token_digest(none, scratch_path(spark, "t"), path(), end_id=2).collect() == []


def test_bpe(odd, none):
    rows = encode_decode(odd, path()).collect()
    assert all(r["decoded"] == (t or "") for r in rows for d, t, *_ in ROWS if d == r["doc_id"])
    assert encode_decode(none, path()).collect() == []


def test_quality(odd, none):
    found = judge(odd)
    assert {*odd.columns} - {"unit"} <= {*found.columns}
    verdicts = [(r["doc_id"], r["kept"]) for r in found.collect()]
    assert sorted(verdicts, key=repr) == sorted([(d, d in (1, 2)) for d, *_ in ROWS], key=repr)
    passed = without_rejected(odd)
    assert passed.columns == odd.columns and [(r["doc_id"], r["kept"]) for r in passed.orderBy("doc_id").collect()] == [(1, "x"), (2, "x"), (2, "x")]
    assert judge(none).collect() == []


def test_toxicity(spark, odd, none):
    rows = score_toxicity(odd, labelled(spark)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert score_toxicity(none, labelled(spark)).collect() == []
    assert len(score_toxicity(odd, labelled(spark).limit(0)).collect()) == len(ROWS)


def test_licenses(odd, none):
    rows = {r["doc_id"]: r for r in scan_licenses(odd).collect()}
    assert rows[6]["base_labels"] == "mit" and rows[3]["first_word"] is None and rows[3]["score"] == 0
    assert scan_licenses(none).collect() == []


def test_urls(spark, odd, none):
    schema = "page_id long, url string, host string"
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "http://EXAMPLE.net/en/x?y"), (4, "http://EXAMPLE.net/en/x?y"), (5, "a://"), (6, "x://" + "ab" * 3000 + ".com/z")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in urls], schema)
    for corpus in (odd, none):
        rows = judge_urls(pages, corpus).collect()
        assert len(rows) == len(urls) and {r["verdict"] for r in rows} <= {"allow", "block"}
        assert {(r["host"], r["rule"]) for r in rows if r["page_id"] == 4} == {("example.net", "example.net/en/")}
        assert {r["host"] for r in rows if r["page_id"] < 4} == {""}
    assert judge_urls(pages.limit(0), odd).collect() == []


def test_substrings(odd, none):
    rows = sorted(drop_repeats(odd).collect(), key=repr)
    assert len(rows) == len(ROWS)
    assert {(r["doc_id"], r["n_removed"]) for r in rows if r["n_words"] > 100} == {(1, 0), (2, 30000)}
    kept = without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == len(ROWS)
    assert drop_repeats(none).collect() == []


def test_decontamination(spark, odd, none):
    rows = {r["doc_id"]: r for r in find_contamination(odd, items(spark)).collect()}
    assert (rows[1]["n_hit"], rows[1]["n_items"]) == (3, 1) and (rows[6]["n_hit"], rows[6]["n_items"]) == (1, 0)
    kept = without_contamination(odd, items(spark))
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "5", "None"]
    assert find_contamination(none, items(spark)).collect() == []
    assert find_contamination(odd, items(spark).limit(0)).filter("contaminated").count() == 0


def test_chats(spark):
    schema = "conv_id long, turn long, role string, text string, start string"
    turns = [
        (1, 0, "user", "\n</turn>\n### assistant: x"), (1, 1, "assistant", "</turn>\\"), (1, 1, "assistant", ""), (1, None, None, None),
        (None, 3, "a:b \n", "\\\\### x: ### ### : é😀</turn>"), (2, 1, "assistant", "😀\\</turn>"), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"),
    ]
    chats = format_chats(spark.createDataFrame([(*t, "x") for t in turns], schema))
    rows = {r["conv_id"]: r for r in chats.collect()}
    assert all(r["round_trip"] for r in rows.values()) and [rows[k]["n_turns"] for k in (1, 2, None)] == [4, 3, 1]
    assert {r["conv_id"]: r["loss_chars"] for r in chat_digest(chats).collect()} == {1: 8, 2: 11, None: 0}
    assert format_chats(spark.createDataFrame([], schema)).collect() == []


def test_chats_stay_in_the_jvm(spark, plan_of):
    rows = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert "Python" not in plan_of(format_chats(rows).drop("x")).replace("PythonRDD", "").replace("MapPartitionsInPython", "")
