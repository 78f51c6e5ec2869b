"""Toxicity by weak supervision.

Many voters vote on a bounded sample of the rows that may be learned from: given lexicons and patterns, and lexicon entries (words
and word beginnings) proposed from labelled rows. A generative model of the votes estimates each voter's accuracy and the correlations
among voters by EM; it sees votes, never a row's label. Labels propose voters, set the prior of the classes and of each
voter's rates, and calibrate the final score (two numbers), as a development set does. A linear classifier over words and word beginnings learns the posteriors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen_rows, crc_mod, stage, with_columns

#: Labelled rows, at most, that the models are fitted on, chosen by a hash of the row.
MAX_SAMPLE = 12_000
#: Significant features kept, at most (the most significant first): bounds what the driver holds and sends. At MAX_SAMPLE rows of
#: the test tables some 2,000 pass the test of significance.
MAX_FEATURES = 40_000
#: Sample documents a feature must be in, and standard errors by which its shares in the two classes must differ.
MIN_DOCS, MIN_Z = 4, 3.5
#: A feature becomes a voter if it is in so many toxic rows for each row that has it.
PROPOSED = 0.9
#: Voters whose votes correlate above this within classes share their weight.
CORRELATED = 0.3
#: How many times the labelled rows count in the prior of a voter's rates.
PRIOR_WEIGHT = 5.0
THRESHOLD = 0.7
#: Features that a task counts before it passes the counts on.
HELD_FEATURES = 200_000
STEMS = (4, 5, 6)

LEXICONS = {
    "insult": "idiot moron stupid dumb imbecile fool loser clown jerk dimwit halfwit",
    "contempt": "pathetic worthless useless disgusting trash garbage scum vermin filth",
    "threat": "kill hurt destroy die punish beat smash",
    "obscene": "crap damn hell bastard bloody arse",
}
_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = {"shout": re.compile(r"(?:\b[A-Z]{3,}\b[\s!]*){4}"), "address": re.compile(r"\b(?:you|your|u) (?:are|r)\b", re.I), "bangs": re.compile(r"!{3,}")}
_LEXICONS = {n: frozenset(x.split()) for n, x in LEXICONS.items()}


def features(text: str | None) -> set[str]:
    """Distinct lower-case words (w:) and word beginnings by how many distinct words have them (1:, 2:, 3: and more)."""
    words = set(_WORD.findall((text or "").lower()))
    stems = Counter(w[:n] for w in words for n in STEMS if len(w) > n)
    return {"w:" + w for w in words} | {f"{k}:{s}" for s, n in stems.items() for k in range(1, min(n, 3) + 1)}


def pattern_votes(text: str | None) -> list[str]:
    """Names of the patterns and lexicons that match."""
    text = text or ""
    words = set(_WORD.findall(text.lower()))
    return [n for n, p in _PATTERNS.items() if p.search(text)] + [n for n, x in _LEXICONS.items() if not words.isdisjoint(x)]


def label_model(votes: np.ndarray, prior: float, rates: np.ndarray | None = None, weight: tuple[float, float] = (0.0, 0.0), rounds: int = 60) -> tuple[np.ndarray, dict]:
    """Posterior of class 1 for rows of votes, and the model.

    votes: 1 where a voter fires, 0 where it abstains. Each voter fires with one rate in class 0 and one in class 1; that none fires is a vote
    too, the last. rates (2 x voters + 1) are the means of the rates' priors, which count as weight rows of either class. Without them
    the prior is that a voter is right four times in five, and counts as much as the votes: else the strongest correlation, not
    the class, would be what is learnt. The E step sums the log ratios of the voters that
    fired, each divided by one plus the sum of its correlations above CORRELATED within classes, so that voters that repeat each other count about
    once. The M step estimates rates and, every tenth round, correlations.
    """
    whole = np.column_stack([votes, votes.sum(axis=1) == 0]).astype(np.float64)
    n, k = whole.shape
    if rates is None:
        share = whole.mean(axis=0) + 1e-4
        rates = np.clip(np.array([0.2 * share / (1 - prior), 0.8 * share / prior]), 1e-5, 0.95)
        rates[:, -1] = 0.9 * share[-1] + 0.05, 0.1  # a toxic row on which nobody fires is rare
        weight = (n * (1 - prior), n * prior)
    first, now, post = rates, rates, np.full(n, prior)
    spread = np.ones(k)
    for step in range(rounds):
        if step % 10 == 0:
            z = whole[:, :-1] - (post[:, None] * now[1, :-1] + (1 - post[:, None]) * now[0, :-1])
            z /= np.sqrt((z * z).mean(axis=0) + 1e-6)
            corr = z.T @ z / max(n, 1)
            np.fill_diagonal(corr, 0)
            spread[:-1] = 1 / (1 + np.where(corr > CORRELATED, corr, 0).sum(axis=1))
        logit = math.log(prior / (1 - prior)) + whole @ (spread * np.log(now[1] / now[0]))
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        moved, post = np.abs(new - post).max(initial=0), new
        both = np.array([1 - post, post])
        mass = both.sum(axis=1)
        now = np.array([(both[c] @ whole + weight[c] * first[c] + 0.05 * first[c]) / (mass[c] + weight[c] + 0.05) for c in (0, 1)])
        now = np.clip(now, 1e-6, 1 - 1e-6)
        if moved < 1e-5 and step % 10:
            break
    fired = np.maximum(whole.sum(axis=0), 1e-9)
    return post, {"rates": now, "share": spread, "accuracy": post @ whole / fired}


def _lists(column) -> list[np.ndarray]:
    """An Arrow column of lists of whole numbers as arrays."""
    out = []
    for c in column.chunks:
        flat, at = c.values.to_numpy(), c.offsets.to_numpy()
        out += [flat[a:b].astype(np.int64) for a, b in zip(at, at[1:], strict=False)]
    return out


def linear(rows: list[np.ndarray], target: np.ndarray, n_features: int, epochs: int = 12, rate: float = 0.5, l2: float = 1e-5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features by AdaGrad over mini-batches, with soft targets."""
    w, bias, gw, gb = np.zeros(n_features), -2.0, np.full(n_features, 1e-2), 1.0
    rng = np.random.default_rng(seed)
    lens = np.array([len(r) for r in rows])
    flat, at = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), np.concatenate(([0], np.cumsum(lens)))
    # a rare class counts as much as the other
    weight = np.where(target > 0.5, max(1.0, 0.5 * (len(target) - target.sum()) / max(target.sum(), 1)), 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), 64):
            b = order[i : i + 64]
            idx = np.concatenate([flat[at[j] : at[j + 1]] for j in b]) if len(b) else flat[:0]
            who = np.repeat(np.arange(len(b)), lens[b])
            z = np.bincount(who, w[idx], minlength=len(b)) + bias
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[b]) * weight[b] / len(b)
            g = np.bincount(idx, d[who], minlength=n_features)
            on = np.flatnonzero(g)
            g = g[on] + l2 * w[on]
            gw[on] += g * g
            w[on] -= rate * g / np.sqrt(gw[on])
            gb += d.sum() ** 2
            bias -= rate * d.sum() / math.sqrt(gb)
    return w, bias


def calibrate(rows: list[np.ndarray], target: np.ndarray, marks: np.ndarray, n_features: int, folds: int = 3, seed: int = 3) -> tuple[float, float]:
    """Scale and shift that turn raw scores into probabilities of the marks, from scores of rows that the weights were not fitted on."""
    fold = np.random.default_rng(seed).integers(0, folds, len(rows))
    raw = np.zeros(len(rows))
    for f in range(folds):
        on, off = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        w, bias = linear([rows[i] for i in on], target[on], n_features)
        raw[off] = [w[rows[i]].sum() + bias for i in off]
    scale, shift = 1.0, 0.0
    for _ in range(50):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(scale * raw + shift, -30, 30)))
        g, h = p - marks, p * (1 - p) + 1e-9
        step = np.linalg.solve([[(h * raw * raw).sum() + 1e-3, (h * raw).sum()], [(h * raw).sum(), h.sum() + 1e-3]], [(g * raw).sum(), g.sum()])
        scale, shift = scale - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return (float(scale), float(shift)) if scale > 0 and math.isfinite(scale + shift) else (1.0, 0.0)


class Scorer:
    """Weights of words and stems; picklable. score() depends on the text alone."""

    def __init__(self, weights: dict[str, float], bias: float, scale: float = 1.0, shift: float = 0.0, report: dict | None = None):
        self.weights, self.bias, self.scale, self.shift, self.report, self._memo = weights, bias, scale, shift, report or {}, {}

    def raw(self, text: str | None) -> float:
        memo, weights, total, stems = self._memo, self.weights, self.bias, {}
        for t in sorted(set(_WORD.findall((text or "").lower()))):
            known = memo.get(t)
            if known is None:
                known = (weights.get("w:" + t, 0.0), tuple(t[:n] for n in STEMS if len(t) > n and any(f"{k}:{t[:n]}" in weights for k in (1, 2, 3))))
                if len(memo) < 200_000:
                    memo[t] = known
            total += known[0]
            for x in known[1]:
                k = stems[x] = stems.get(x, 0) + 1
                if k <= 3:
                    total += weights.get(f"{k}:{x}", 0.0)
        return total

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.scale * self.raw(text) + self.shift))))

    def __getstate__(self):
        return self.__dict__ | {"_memo": {}}


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_SAMPLE) -> DataFrame:
    """(o, text, toxic) of at most max_rows distinct rows that may be learned from: labelled, and not held out.

    Rows are chosen by hashes of doc_id and text, so an id that repeats cannot pass the bound. Marks that differ for one doc_id count as toxic.
    """
    may = F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(False))
    marks = labels.where("toxic IS NOT NULL").where(may).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    marked = stage(docs.where(may).select("doc_id", key.alias("row")).join(marks, "doc_id").select("row", "toxic"))
    chosen = chosen_rows(marked, max_rows).select("o", "row", "toxic")  # at most max_rows rows of numbers, so broadcast
    texts = docs.where(may).select("text", key.alias("row")).join(F.broadcast(chosen), "row")
    return texts.groupBy("o").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_SAMPLE) -> Scorer:
    """Voters, label model and classifier on the bounded sample. Without labelled rows of both classes, the given lexicons alone
    decide. The scorer's report has the number of voters and how often the posteriors agree with the labels."""

    found = stage(sample(docs, labels, max_rows))
    n_all, n_toxic = found.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_all or not 0 < n_toxic < n_all:
        return Scorer({f"w:{w}": 4.0 for x in LEXICONS.values() for w in x.split()}, -2.0)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # counts combine here, so that a feature is one row for some documents and not one for each
        n, t = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array(list(n.values()), pa.int64()), pa.array([t[f] for f in n], pa.int64())], names=["f", "n", "t"])

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                f = features(text)
                n.update(f)
                if toxic:
                    t.update(f)
                if len(n) >= HELD_FEATURES:
                    yield rows()
                    n.clear()
                    t.clear()
        if n:
            yield rows()

    seen = found.mapInArrow(tally, "f string, n long, t long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where(F.col("n") >= MIN_DOCS)
    n, t, clean = F.col("n"), F.col("t"), n_all - n_toxic
    apart = (t / n_toxic - (n - t) / clean) / F.sqrt(n / n_all * (1 - n / n_all) * (1 / n_toxic + 1 / clean) + 1e-12)
    kept = seen.withColumn("z", apart).where(F.abs("z") >= MIN_Z).orderBy(F.desc(F.abs("z")), "f").limit(MAX_FEATURES).collect()
    index = {r.f: i for i, r in enumerate(kept)}
    proposed = [r.f for r in kept if r.z > 0 and r.t >= PROPOSED * r.n]
    names = {n: i for i, n in enumerate([*_PATTERNS, *LEXICONS])}
    del kept
    sent = docs.sparkSession.sparkContext.broadcast((index, names))  # at most MAX_FEATURES strings

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, named = sent.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [sorted(number[f] for f in features(x) if f in number) for x in texts]
            marks = [[named[v] for v in pattern_votes(x)] for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("toxic"), pa.array(ids, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.int32()))], names=["o", "toxic", "f", "p"])

    # numbers of at most MAX_FEATURES features for max_rows rows
    table = found.mapInArrow(encode, "o long, toxic int, f array<int>, p array<int>").orderBy("o").toArrow()
    toxic, rows = table["toxic"].to_numpy(), _lists(table["f"])
    spot = np.full(len(index), -1, dtype=np.int64)
    spot[[index[f] for f in proposed]] = np.arange(len(proposed))
    votes = np.zeros((len(rows), len(proposed) + len(names)), dtype=np.float32)
    for v, f, p in zip(votes, rows, _lists(table["p"]), strict=True):
        on = spot[f]
        v[on[on >= 0]] = 1
        v[p + len(proposed)] = 1
    prior = n_toxic / n_all
    none = votes.sum(axis=1) == 0
    rates = np.array([(np.append(votes[toxic == c].sum(axis=0), none[toxic == c].sum()) + 0.25) / ((toxic == c).sum() + 1) for c in (0, 1)])
    post, model = label_model(votes, prior, rates, (PRIOR_WEIGHT * clean, PRIOR_WEIGHT * n_toxic))
    w, bias = linear(rows, post, len(index))
    scale, shift = calibrate(rows, post, toxic, len(index))
    weights = {f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-3}
    agree = float(((post > 0.5) == toxic).mean())
    return Scorer(weights, float(bias), scale, shift, {"rows": len(rows), "voters": votes.shape[1], "agreement": agree, "correlated": int((model["share"] < 1).sum())})


def score(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 at the threshold or above); columns of these names are replaced.

    Null and empty texts score what a text without words scores. Long texts count whole. Equal texts have equal scores; repeated rows and null
    doc_ids stay as they are; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(scorer)  # at most MAX_FEATURES weights

    def run(texts: list[str | None]) -> dict[str, list]:
        scores = [sent.value.score(t) for t in texts]
        return {names[0]: scores, names[1]: [int(x >= threshold) for x in scores]}

    return with_columns(docs, {names[0]: "double", names[1]: "int"}, run)


def drop_toxic(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """docs without those that score() predicts to be toxic; all columns as before. Edge cases are those of score()."""
    return score(docs, scorer, names=("_docrel_score", "_docrel_toxic")).where("_docrel_toxic = 0").select(*docs.columns)
