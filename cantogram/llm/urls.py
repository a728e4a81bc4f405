"""URL filters: rules by host and path, else naive Bayes over words that a unigram Viterbi finds in host and path.

The unigram model is the word counts of a corpus. Only candidate words reach it: the substrings of the distinct
host labels are joined with the counts, so no dictionary is collected or broadcast. Each distinct label is then
split once. The classes are learnt from the pages themselves: a page is seen as blocked if its words hold a seed
word, as allowed if it holds none and no rule blocks it; token counts per class are a grouped sum over all pages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cantogram.llm.scratch import stored

# The rules, host and path to verdict.
RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}
#: Words that mark an address as one to block, for the classes to learn from.
SEEDS = (
    "spam", "farm", "cheap", "pills", "pill", "casino", "bet", "betting", "poker", "porn", "xxx", "adult", "viagra", "loan", "loans", "replica",
    "free", "win", "winner", "prize", "click", "hack", "crack", "warez", "torrent", "malware", "phish", "scam", "escort", "dating",
)
LONGEST = 20
#: Counts are held against this many occurrences of anything else; a letter outside a word costs as one in a thousand.
_SMOOTH = 1.0


def address(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    lower = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(has, lower(host)).otherwise(""), F.when(has, path).otherwise("")


def rule_of(host: Column, path: Column, rules: dict[tuple[str, str], str]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for (own, start), decision in sorted(rules.items(), key=lambda r: (len(r[0][0] + r[0][1]), r[0])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(own + start)).otherwise(name), F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def segment(label: str, counts: dict[str, float], total: float) -> list[str]:
    """The likeliest split of ``label`` into words of ``counts``; other stretches cost by their length."""
    best, back = [0.0] + [-math.inf] * len(label), [0] * (len(label) + 1)
    for end in range(1, len(label) + 1):
        for start in range(max(0, end - LONGEST), end):
            word = label[start:end]
            seen = counts.get(word, 0.0)
            value = math.log((seen + (0.0 if seen else _SMOOTH * 10.0 ** (-3 * len(word)))) / (total + _SMOOTH))
            if best[start] + value > best[end]:
                best[end], back[end] = best[start] + value, start
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def _segmented(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        held = zip(frame["label"], frame["words"], frame["times"], frame["total"], strict=True)
        split = [segment(x, {} if w is None else dict(zip(w, n, strict=True)), t) for x, w, n, t in held]
        yield pd.DataFrame({"label": frame["label"], "split": split})


def segmented_labels(labels: DataFrame, corpus: DataFrame) -> DataFrame:
    """(label, split): each distinct host label as words, by the word counts of ``corpus`` (text) and the seeds."""
    word = F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    counted = corpus.select(word.alias("word")).filter("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    counts = stored(counted, "unigrams")
    total = counts.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("total")).first()["total"]
    distinct = stored(labels.filter("label != ''").distinct(), "labels")
    n = F.length("label")
    pieces = distinct.select(
        "label",
        F.explode(F.flatten(F.transform(F.sequence(F.lit(1), n), lambda a: F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), n - a + 1)), lambda k: F.substring(F.col("label"), a, k))))).alias("word"),
    ).distinct()
    seeds = F.when(F.col("word").isin(*SEEDS), F.greatest(F.lit(1), F.lit(total) / 10_000)).otherwise(0)
    known = pieces.join(counts, "word", "left").withColumn("times", F.coalesce("times", F.lit(0)) + seeds).filter("times > 0")
    held = known.groupBy("label").agg(F.collect_list("word").alias("words"), F.collect_list(F.col("times").cast("double")).alias("times"))
    ready = distinct.join(held, "label", "left").withColumn("total", F.lit(float(max(total, 1))))
    return ready.mapInPandas(_segmented, "label string, split array<string>")


def judge_urls(pages: DataFrame, corpus: DataFrame, rules: dict[tuple[str, str], str] = RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, tokens, log_odds) for each row of ``pages``.

    A rule fits its host and all subdomains if the path starts with its path; the longest wins, else the classifier decides:
    block if its log odds are above 0. A null URL or one without ``://`` has an empty host and path and no
    words, so the classes' shares alone decide, and equal shares allow. Rows stand for themselves; other columns are ignored; empty tables are allowed.
    """
    host, path = address(F.col("url"))
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    # Pages of one address are one row with a count, so a hot host or address costs no more than others.
    rule, decided = rule_of(F.col("host"), F.col("path"), rules)
    addresses = stored(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages")).select("*", rule.alias("rule"), decided.alias("decided")), "addresses")
    split = stored(segmented_labels(addresses.select(F.explode(F.split("host", r"[.\-_]+")).alias("label")), corpus.select("text")), "splits")
    cut = F.split("host", r"[.\-_]+")
    parts = addresses.select("host").distinct().select("host", F.size(cut).alias("labels"), F.posexplode(cut).alias("at", "label"))
    # The last label is a registry's, not a name made of words.
    own = F.when(F.col("at") == F.col("labels") - 1, F.array("label")).otherwise(F.col("split"))
    found = F.transform(F.array_sort(F.collect_list(F.struct("at", own.alias("split")))), lambda x: x["split"])
    hosts = parts.join(split, "label").groupBy("host").agg(found.alias("found"))
    tokens = F.concat(F.coalesce(F.flatten("found"), F.array().cast("array<string>")), F.filter(F.split(F.lower("path"), r"[^\p{L}]+"), lambda t: t != ""))
    named = stored(addresses.join(hosts, "host", "left").withColumn("tokens", tokens).drop("found"), "tokens")
    seen = F.arrays_overlap("tokens", F.array(*[F.lit(s) for s in SEEDS]))
    kind = F.when(seen, F.lit("block")).when(F.coalesce(F.col("decided"), F.lit("allow")) == "allow", F.lit("allow"))
    learnt = named.withColumn("kind", kind).filter("kind IS NOT NULL")
    both = lambda c: [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col(c))), F.lit(0)).cast("double").alias(k) for k in ("block", "allow")]
    counts = stored(learnt.select("kind", "pages", F.explode("tokens").alias("token")).groupBy("token").agg(*both("pages")), "token-counts")
    sums = counts.agg(F.coalesce(F.sum("block"), F.lit(0.0)).alias("b"), F.coalesce(F.sum("allow"), F.lit(0.0)).alias("a"), F.count(F.lit(1)).alias("v")).first()
    prior = learnt.agg(*both("pages")).first()
    odds = F.log((F.col("block") + 1) / (sums["b"] + sums["v"] + 1)) - F.log((F.col("allow") + 1) / (sums["a"] + sums["v"] + 1))
    scored = named.select("host", "path", F.explode("tokens").alias("token")).join(counts.select("token", odds.alias("odds")), "token").groupBy("host", "path").agg(F.sum("odds").alias("odds"))
    base = math.log((prior["block"] + 1) / (prior["allow"] + 1))
    told = named.join(scored, ["host", "path"], "left").withColumn("log_odds", F.coalesce("odds", F.lit(0.0)) + base)
    verdict = F.coalesce("decided", F.when(F.col("log_odds") > 0, F.lit("block")).otherwise("allow"))
    judged = told.select("host", "path", "rule", verdict.alias("verdict"), "tokens", "log_odds")
    return rows.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "tokens", "log_odds")
