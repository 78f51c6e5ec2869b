"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent.

Subwords are byte n-grams of lower-cased words with their boundaries. Embeddings are averaged, so after training the
softmax layer folds into one row of logits per bucket, and a prediction is a mean of table rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen_rows, crc_mod, with_columns

#: Labelled documents, at most, that the model is fitted on, chosen by a hash of the row; a third of them calibrates. Each comes to the
#: driver as whole counts of its subwords: 6 bytes a bucket, so 200 KB at most however long its text.
MAX_SAMPLE = 2_400
BUCKETS, DIMS, NGRAMS = 1 << 15, 16, (2, 3, 4)
#: Documents of a step of gradient descent.
BATCH = 16
UND = "und"

_LETTER = re.compile(r"[^\W\d_]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def subwords(text: str, block: int = 1 << 20) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the text's letters, in blocks of bounded size."""
    data = np.frombuffer(f" {_NOT_LETTERS.sub(' ', text.lower())} ".encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint64)
    widest = max(NGRAMS)
    for i in range(0, max(1, len(data)), block):
        part = data[i : i + block + widest - 1]
        for n in NGRAMS:
            m = min(block, len(part) - n + 1)
            if m <= 0:
                continue
            x = np.full(m, n, dtype=np.uint64)
            for j in range(n):
                x = x * np.uint64(257) + part[j : j + m]
            yield ((x * _MULT) >> np.uint64(64 - 15)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the whole text's subwords, ascending, and how often each occurs."""
    total = np.zeros(BUCKETS, np.int64)
    for idx in subwords(text):
        total += np.bincount(idx, minlength=BUCKETS)
    on = np.flatnonzero(total)
    return on, total[on]


class Model:
    """A table of logits by bucket, the languages, a temperature and a rejection threshold. Picklable."""

    def __init__(self, table: np.ndarray, langs: list[str], temperature: float = 1.0, reject: float = 0.0):
        self.table, self.langs, self.temperature, self.reject = table.astype(np.float32), langs, temperature, reject

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.langs)), 0
        for idx in subwords(text):
            many = np.bincount(idx, minlength=BUCKETS) if len(idx) > BUCKETS else None
            total += many @ self.table if many is not None else self.table[idx].sum(axis=0, dtype=np.float64)
            n += len(idx)
        return total / max(n, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UND, 0.0
        p = _softmax(self.logits(text)[None, :] / self.temperature)[0]
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[tuple[np.ndarray, np.ndarray]], langs: list[str], epochs: int = 8, rate: float = 4.0, seed: int = 11) -> Model:
    """SGD over batches of documents, given as counts(), on the cross-entropy; then a temperature and a rejection threshold on the
    part held back.

    The threshold is the score below which held-back documents are wrong more often than right.
    """
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    back, fit = order[: len(order) // 3], order[len(order) // 3 :]
    emb = rng.normal(0, 0.1, (BUCKETS, DIMS)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIMS, len(names))).astype(np.float32)
    share = [(c / c.sum()).astype(np.float32) for _, c in texts]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        shuffled = rng.permutation(fit)
        for i in range(0, len(shuffled), BATCH):
            b = shuffled[i : i + BATCH]
            idx, part = np.concatenate([texts[j][0] for j in b]), np.concatenate([share[j] for j in b])
            sizes = np.array([len(texts[j][0]) for j in b])
            who, begin = np.repeat(np.arange(len(b)), sizes), np.concatenate(([0], np.cumsum(sizes[:-1])))
            mean = np.add.reduceat(emb[idx] * part[:, None], begin)
            d = _softmax(mean @ soft)
            d[np.arange(len(b)), y[b]] -= 1
            grad = d @ soft.T
            soft -= step * 0.05 * (mean.T @ d)
            by = np.argsort(idx, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], idx[by][1:] != idx[by][:-1])))
            emb[idx[by][first]] -= step * 4 * np.add.reduceat((part[:, None] * grad[who])[by], first)
    model = Model(emb @ soft, names)
    if len(back):
        z = np.array([share[i] @ model.table[texts[i][0]] for i in back])
        grid = np.geomspace(0.02, 4, 40)
        loss = [-np.log(_softmax(z / t)[np.arange(len(back)), y[back]] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(z / model.temperature)
        top, right = p.max(axis=1), p.argmax(axis=1) == y[back]
        by = np.argsort(top)
        net = np.cumsum(np.where(right[by], 1, -1))
        k = int(np.argmin(net))
        model.reject = float(top[by][k]) if net[k] < 0 else 0.0
    return model


def fit(docs: DataFrame, max_rows: int = MAX_SAMPLE) -> Model:
    """Train on at most max_rows distinct documents with a lang and a letter that are not held out, whole.

    Rows are chosen by a hash of doc_id, lang and text, so an id that repeats cannot pass the bound. Their subwords are counted where
    the rows are, and only the counts come to the driver. Without such rows the model knows no language.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").where(F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(False)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(o, lang, *counts(t)) for o, lang, t in zip(pdf["o"], pdf["lang"], pdf["text"], strict=True) if has_letter(t)]
            yield pd.DataFrame([(o, lang, b.astype(np.uint16).tobytes(), n.astype(np.uint32).tobytes()) for o, lang, b, n in found], columns=["o", "lang", "b", "n"])

    chosen = chosen_rows(known.select("doc_id", "lang", "text"), max_rows)
    rows = sorted(chosen.mapInPandas(count, "o long, lang string, b binary, n binary").collect())  # bounded: see MAX_SAMPLE
    if not rows:
        return Model(np.zeros((BUCKETS, 0)), [])
    return train([(np.frombuffer(r.b, np.uint16).astype(np.int64), np.frombuffer(r.n, np.uint32).astype(np.int64)) for r in rows], [r.lang for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score (calibrated probability, 0 to 1) and rejected (score at or below the model's threshold).

    Null texts and texts without a letter are 'und' with score 0 and rejected; so is everything if there was nothing
    to learn from. Texts count whole. Columns with the new names are replaced; others pass untouched. Equal texts have equal
    answers (ties go to the first language by name); repeated rows and null doc_ids stay; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of one number a language

    def run(texts: list[str | None]) -> dict[str, list]:
        m = sent.value
        found = [m.predict(t) for t in texts]
        return {"lang_pred": [x for x, _ in found], "score": [s for _, s in found], "rejected": [x == UND or s <= m.reject for x, s in found]}

    return with_columns(docs, {"lang_pred": "string", "score": "double", "rejected": "boolean"}, run)
