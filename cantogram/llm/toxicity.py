"""Toxicity by weak supervision: voters, a label model of their accuracies and correlations, a linear classifier.

1. Voters are terms: a fixed lexicon, text patterns, and the words and word beginnings that, found so many
   times, part toxic from other texts in a bounded sample of labelled rows. A voter says "toxic" where it fires and abstains elsewhere.
2. One pass over the learning rows counts how often voters fire and fire together; only a matrix of
   voters by voters comes back. The generative model holds a class share and, per voter, how often it
   fires in either class; expectation maximisation fits it on the distinct vote patterns' counts. Voters that
   fire together more than their accuracies explain are correlated: a group of such voters votes as one.
3. The posterior of each learning row is its soft label; a logistic regression on word features and
   counts learns from the soft labels of the sample and scores every row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cantogram.llm.scratch import stored
from cantogram.llm.words import LOWER

#: Labelled rows that terms and the classifier learn from; more are thinned by a hash of the id, not by place.
SAMPLE_ROWS = 8_000
#: Terms taken from the sample as voters, and texts of the sample that a term must fire in.
MINED, LEAST_TEXTS = 40, 5
#: Lengths of word beginnings, and how often a term must be found for a voter to fire.
STEMS, TIMES = (4, 5, 6, 7, 8), (1, 2, 3)
# A general lexicon of insults in four languages.
LEXICON = (
    "idiot idiots moron morons scum clown clowns pathetic worthless disgusting stupid loser losers trash garbage vermin "
    "dumb fool fools imbecile hate kill die ugly filthy parasite parasites idiota imbécil basura asqueroso estúpido "
    "débile crétin ordure dégoûtant minable abruti dummkopf abschaum widerlich wertlos trottel dreck"
).split()
PATTERNS = {
    "you_are": re.compile(rb"\byou (?:are|re) (?:an? )?(?:idiot|moron|clown|scum|loser)"),
    "get_lost": re.compile(rb"\b(?:get lost|shut up|go away)\b"),
    "stars": re.compile(rb"\b[a-z]\*{2,}[a-z]*\b"),
}
Batches = Iterator[pa.RecordBatch]
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.translate(LOWER))


def posteriors(votes: np.ndarray, share: float, fires: np.ndarray) -> np.ndarray:
    """P(toxic | votes) for rows of 0/1 votes; ``fires[c]`` is how often each voter fires in class c."""
    odds = np.log(share / (1 - share))
    gain = np.log(fires[1] / fires[0]), np.log((1 - fires[1]) / (1 - fires[0]))
    value = odds + votes @ gain[0] + (1 - votes) @ gain[1]
    return 1 / (1 + np.exp(-np.clip(value, -40, 40)))


@dataclass
class LabelModel:
    """Voters that fire as groups, the class share, and how often each group fires in either class."""

    groups: list[list[int]] = field(default_factory=list)
    share: float = 0.1
    fires: np.ndarray | None = None

    def fit(self, patterns: np.ndarray, counts: np.ndarray, taught: np.ndarray, toxic: np.ndarray, rounds: int = 30) -> LabelModel:
        """``patterns``: distinct rows of 0/1 votes with their counts. ``taught``: votes of labelled rows, where the estimates start."""
        n = counts.sum()
        mean = (patterns * counts[:, None]).sum(axis=0) / n
        soft = self._step(patterns, counts, taught, toxic, rounds)
        # What the classes leave unexplained of voters firing together is correlation.
        left = np.zeros((patterns.shape[1],) * 2)
        for part in (soft, 1 - soft):
            weight = counts * part
            total = max(weight.sum(), 1e-9)
            own = (patterns * weight[:, None]).sum(axis=0) / total
            left += (patterns.T @ (patterns * weight[:, None]) / total - np.outer(own, own)) * total / n
        scale = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
        linked = left / np.outer(scale, scale) > 0.5
        seen: set[int] = set()
        self.groups = []
        for i in range(len(mean)):
            if i not in seen:
                group = [i] + [j for j in np.flatnonzero(linked[i]).tolist() if j > i and j not in seen]
                seen.update(group)
                self.groups.append(group)
        self._step(self.grouped(patterns), counts, self.grouped(taught), toxic, rounds)
        return self

    def grouped(self, votes: np.ndarray) -> np.ndarray:
        return np.stack([votes[:, g].max(axis=1) for g in self.groups], axis=1) if self.groups else votes

    def _step(self, votes: np.ndarray, counts: np.ndarray, taught: np.ndarray, toxic: np.ndarray, rounds: int) -> np.ndarray:
        votes = votes.astype(float)
        n = counts.sum()
        if 0 < toxic.sum() < len(toxic):
            self.share = float(np.clip(toxic.mean(), 1e-3, 0.5))
            rate = lambda part: (taught[part].sum(axis=0) + 0.1) / (part.sum() + 1)
            self.fires = np.clip(np.stack([rate(toxic == 0), rate(toxic == 1)]), 1e-4, 1 - 1e-4)
            soft = posteriors(votes, self.share, self.fires)
        else:
            soft = np.where(votes.any(axis=1), 0.9, 0.02)
        for _ in range(rounds):
            weight = counts * soft
            self.share = float(np.clip(weight.sum() / n, 1e-4, 0.5))
            toxic = ((votes * weight[:, None]).sum(axis=0) + 0.5) / (weight.sum() + 2)
            other = ((votes * (counts - weight)[:, None]).sum(axis=0) + 0.05) / ((counts - weight).sum() + 2)
            self.fires = np.clip(np.stack([other, toxic]), 1e-6, 1 - 1e-6)
            soft = posteriors(votes, self.share, self.fires)
        return soft

    def predict(self, votes: np.ndarray) -> np.ndarray:
        return posteriors(self.grouped(votes).astype(float), self.share, self.fires)


@dataclass(frozen=True)
class Voters:
    """Terms (a trailing * marks a word beginning) and voters: a term's number and how often it must be found."""

    terms: tuple[str, ...]
    rules: tuple[tuple[int, int], ...]

    def found(self, text: bytes) -> tuple[np.ndarray, int, bytes]:
        """How often each term stands in the text, the number of words, and the lower-cased text."""
        lower = text.translate(LOWER)
        words = [w.decode() for w in _WORD.findall(lower)]
        at = {t: i for i, t in enumerate(self.terms)}
        lengths = sorted({len(t) - 1 for t in self.terms if t.endswith("*")})
        out = np.zeros(len(self.terms))
        for word in words:
            if (k := at.get(word)) is not None:
                out[k] += 1
            for n in lengths:
                if (k := at.get(word[:n] + "*")) is not None and len(word) >= n:
                    out[k] += 1
        return out, len(words), lower

    def votes(self, found: np.ndarray, lower: bytes) -> list[bool]:
        return [bool(found[t] >= k) for t, k in self.rules] + [bool(p.search(lower)) for p in PATTERNS.values()]

    def features(self, found: np.ndarray, words: int, lower: bytes) -> np.ndarray:
        rate = np.log1p(100 * found / max(words, 1))
        signs = [bool(p.search(lower)) for p in PATTERNS.values()]
        return np.concatenate([found > 0, np.log1p(found), rate, signs, [np.log1p(found.sum()), np.log1p(words) / 10]])


def mined_voters(texts: list[bytes], toxic: np.ndarray) -> Voters:
    """The lexicon, then the terms and times that part toxic from other texts best and fire mostly in toxic ones."""
    fired: dict[tuple[str, int], list[int]] = {}
    for text, label in zip(texts, toxic, strict=True):
        counts: dict[str, int] = {}
        for raw in words_of(text):
            word = raw.decode()
            counts[word] = counts.get(word, 0) + 1
            for n in STEMS:
                if len(word) >= n:
                    stem = word[:n] + "*"
                    counts[stem] = counts.get(stem, 0) + 1
        for term, n in counts.items():
            for k in TIMES:
                if n >= k:
                    fired.setdefault((term, k), [0, 0])[int(label)] += 1
    n1, n0 = max(toxic.sum(), 1), max(len(toxic) - toxic.sum(), 1)
    good = {v: t / n1 - o / n0 for v, (o, t) in fired.items() if t >= LEAST_TEXTS and t > o and (t / n1) > 8 * (o / n0)}
    chosen: list[tuple[str, int]] = []
    for term, k in sorted(good, key=lambda v: (-good[v], -len(v[0]), v)):
        near = [c for c, _ in chosen if (c.rstrip("*").startswith(term.rstrip("*")) or term.rstrip("*").startswith(c.rstrip("*")))]
        if not near:
            chosen.append((term, k))
        if len(chosen) == MINED:
            break
    terms = tuple(dict.fromkeys([*LEXICON, *(t for t, _ in chosen)]))
    at = {t: i for i, t in enumerate(terms)}
    return Voters(terms, tuple(dict.fromkeys([*((at[t], 1) for t in LEXICON), *((at[t], k) for t, k in chosen)])))


def logistic(x: np.ndarray, soft: np.ndarray, weight: np.ndarray, ridge: float = 0.02, rounds: int = 40) -> np.ndarray:
    """Weights (the last is the intercept) by Newton steps on soft labels."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * weight.sum() / 100)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - soft)) + penalty * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _voted(voters: Voters) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                found, _, lower = voters.found(text or b"")
                rows.append("".join("1" if v else "0" for v in voters.votes(found, lower)))
            yield pa.record_batch([pa.array(rows, pa.string())], names=["votes"])

    return run


def _scored(voters: Voters, weights: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            x = np.stack([voters.features(*voters.found(t or b"")) for t in texts]) if texts else np.zeros((0, len(weights) - 1))
            score = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


#: Distinct vote patterns that the label model reads one by one; most texts fire no voter. Rarer ones are merged by their number of votes.
PATTERN_ROWS = 20_000


def vote_patterns(votes: DataFrame, limit: int = PATTERN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The vote patterns (a row each) and their counts, from (votes, n).

    The ``limit`` most frequent patterns stand for themselves. All others become one row for each number of votes: the
    share of those texts in which each voter fires, with their count, so that no text and no vote is lost.
    """
    top = votes.orderBy(F.desc("n"), "votes").limit(limit)
    rows = top.collect()
    if not rows:
        return np.zeros((0, 0)), np.zeros(0)
    width = len(rows[0]["votes"])
    fired = [F.sum(F.when(F.substring("votes", i + 1, 1) == "1", F.col("n")).otherwise(0)) for i in range(width)]
    rest = votes.join(top.select("votes"), "votes", "left_anti").withColumn("fires", F.length(F.replace("votes", F.lit("0"), F.lit(""))))
    merged = rest.groupBy("fires").agg(F.sum("n").alias("n"), F.array(*fired).alias("sums")).orderBy("fires").collect() if len(rows) == limit else []
    patterns = [[float(c == "1") for c in r["votes"]] for r in rows] + [[s / r["n"] for s in r["sums"]] for r in merged]
    return np.array(patterns), np.array([float(r["n"]) for r in [*rows, *merged]])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; ``labels`` has doc_id and toxic.

    Only rows that are not held out teach anything: labels choose terms and calibrate, texts without labels
    count votes. A null or empty text is scored by the lengths and absence of terms. A null id is never held out and never labelled; repeated
    rows get equal scores. Labels that are null, neither 0 nor 1, or repeated teach once or not at all. Without
    any label the score is that of the lexicon. Other columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = known.count()
    thin = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, SAMPLE_ROWS / max(rows, 1))))
    # Of rows that repeat an id the least text teaches.
    sample = source.join(known.filter(thin), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    taught = sorted(sample.select("doc_id", "text", "toxic").collect(), key=lambda r: r["doc_id"])
    texts = [(r["text"] or "").encode() for r in taught]
    toxic = np.array([r["toxic"] for r in taught], dtype=float)
    voters = mined_voters(texts, toxic)

    votes = source.filter(~held_out()).select("text").mapInArrow(_voted(voters), "votes string").groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    patterns, counts = vote_patterns(stored(votes, "votes"))
    if len(texts) and len(counts):
        found = [voters.found(t) for t in texts]
        own = np.array([voters.votes(f, lower) for f, _, lower in found], dtype=np.int8)
        model = LabelModel().fit(patterns, counts, own, toxic)
        x = np.stack([voters.features(*f) for f in found])
        weights = logistic(x, model.predict(own), np.ones(len(x)))
    else:
        n = len(voters.terms)
        weights = np.concatenate([np.full(n, 4.0), np.zeros(2 * n + len(PATTERNS) + 2), [-2.0]])
    scored = source.select("doc_id", "text").mapInArrow(_scored(voters, weights), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
