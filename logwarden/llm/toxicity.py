"""Toxicity: a factorization machine over hashed terms.

score(x) = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), with
x_i = 1 if a lower-cased word, or a stem of one, hashes to i.  The pairwise part learns what a
sum of word weights misses, such as an insult that counts only beside a
mention of a group.

Training reads a bounded sample of labelled rows (``SAMPLE_ROWS``, the rows
of the smallest id hash, so the same rows however the table is split) in one
task: a lasso pass chooses the terms, then weights and factors of the chosen
terms are fitted together.  Rows that look like copies share one row's
weight, so a copied page with a wrong label does not teach its vocabulary.
Scoring runs over every whole text, by partition, with the small model.

Cases: null and empty texts have no terms and score the prior.  A document
with several labels counts as toxic if one says so; null labels and labels
without a document teach nothing.  Without two classes in the sample the
model is the smoothed prior alone.  A null id is never held out and never
taught from.  Repeated rows are scored each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, whole_text

#: labelled rows the model is fitted on, at most
SAMPLE_ROWS = 16_000
#: sampled rows that must hold a term, lasso strength in rows, factors per term, passes
MIN_ROWS, LASSO_ROWS, FACTORS, PASSES = 6, 10.0, 8, 400
#: word beginnings, in characters, that are terms beside the whole word: insults are inflected and compounded
STEMS = (4, 5, 6, 7)
#: words whose looked-up terms a scoring task keeps
CACHE_WORDS = 500_000
#: a score from which a document counts as toxic
THRESHOLD = 0.3
SEED = 11

_WORD = re.compile(r"\w+")


def word_terms(word: str) -> list[int]:
    """32-bit hashes of a lower-cased word and of its stems."""
    out = [zlib.crc32(word.encode("utf-8", "replace"))]
    for n in STEMS:
        if len(word) > n:
            out.append(zlib.crc32(f"^{word[:n]}".encode("utf-8", "replace")))
    return out


def term_hashes(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct terms of a text."""
    words = set(_WORD.findall(text.lower())) if text else ()
    return np.array(sorted({h for w in words for h in word_terms(w)}), np.uint32)


def _hash_batches(batches):
    for b in batches:
        yield pd.DataFrame({"label": b["label"].to_numpy(), "order": b["order"].to_numpy(),
                            "terms": [term_hashes(t).tobytes() for t in b["__text"]]})


def _copy_weights(rows: list[np.ndarray]) -> np.ndarray:
    """1 / size of the largest group of rows that a row looks like a copy of.

    Eight groupings by four min-hashes each: rows that share most terms meet
    in one of them, rows that share common words alone hardly ever.
    """
    mix = np.random.default_rng(SEED).integers(1, 1 << 63, (32, 1), dtype=np.uint64) | np.uint64(1)
    keys = np.zeros((len(rows), 32), np.uint64)
    for i, h in enumerate(rows):
        if len(h):
            keys[i] = ((h.astype(np.uint64) + np.uint64(1)) * mix >> np.uint64(16)).min(1)
    size = np.ones(len(rows))
    for band in range(8):
        _, at, n = np.unique(keys[:, 4 * band:4 * band + 4], axis=0, return_inverse=True, return_counts=True)
        size = np.maximum(size, n[at.ravel()])
    return 1.0 / size


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class _Rows:
    """Binary rows in compressed form."""

    def __init__(self, rows: list[np.ndarray], n_cols: int):
        self.n, self.m = len(rows), n_cols
        self.col = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def dot(self, v):
        return np.bincount(self.row, v[self.col], minlength=self.n)

    def t_dot(self, r):
        return np.bincount(self.col, r[self.row], minlength=self.m)


def _lasso(x: _Rows, y, weight, strength, rounds):
    """Proximal gradient with momentum on the weighted log loss; returns bias and weights."""
    per_col = x.t_dot(weight)
    # a diagonal bound on the curvature, scaled by the longest row's share
    step = 1.0 / (0.25 * per_col * np.sqrt(max(1.0, np.bincount(x.row, minlength=x.n).mean())) + 1.0)
    w, b, prev = np.zeros(x.m), np.log((weight @ y + .5) / (weight @ (1 - y) + .5)), np.zeros(x.m)
    for k in range(rounds):
        z = w + (k / (k + 3)) * (w - prev)
        prev = w
        g = weight * (_sigmoid(b + x.dot(z)) - y)
        b -= g.sum() / (0.25 * weight.sum())
        w = z - step * x.t_dot(g)
        w = np.sign(w) * np.maximum(np.abs(w) - step * strength, 0)
    return b, w


def _fit_fm(x: _Rows, y, weight, b, w, factors, rounds, seed):
    """Weights and factors of the chosen terms, fitted together by Adam with a light ridge."""
    v = np.random.default_rng(seed).normal(0, 0.05, (x.m, factors))
    params = [np.array([b]), w.copy(), v]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    total = weight.sum()
    for k in range(1, rounds + 1):
        b, w, v = params
        sums = np.stack([x.dot(v[:, f]) for f in range(factors)], 1)
        squares = np.stack([x.dot(v[:, f] ** 2) for f in range(factors)], 1)
        z = b[0] + x.dot(w) + 0.5 * (sums ** 2 - squares).sum(1)
        g = weight * (_sigmoid(z) - y) / total
        per = x.t_dot(g)
        gv = np.stack([x.t_dot(g * sums[:, f]) for f in range(factors)], 1) - v * per[:, None]
        grads = [np.array([g.sum()]), per + 2e-5 * w, gv + 2e-4 * v]
        for i, gr in enumerate(grads):
            m1[i] = 0.9 * m1[i] + 0.1 * gr
            m2[i] = 0.999 * m2[i] + 0.001 * gr ** 2
            params[i] = params[i] - 0.03 * (m1[i] / (1 - 0.9 ** k)) / (np.sqrt(m2[i] / (1 - 0.999 ** k)) + 1e-9)
    return params[0][0], params[1], params[2]


def fit(rows: list[np.ndarray], labels: np.ndarray) -> dict:
    """Model of binary-labelled hashed rows: bias, sorted term hashes, weights, factors."""
    y = np.asarray(labels, float)
    weight = _copy_weights(rows) if rows else np.zeros(0)
    pos, neg = float(weight @ y), float(weight @ (1 - y))
    model = {"bias": float(np.log((pos + .5) / (neg + .5))), "terms": np.zeros(0, np.uint32),
             "w": np.zeros(0), "v": np.zeros((0, FACTORS))}
    if not pos or not neg:
        return model if rows else model | {"bias": -20.0}
    terms, n = np.unique(np.concatenate(rows), return_counts=True)
    terms = terms[n >= min(MIN_ROWS, max(1, len(rows) // 10))]

    def indexed(t):
        out = []
        for r in rows:
            at = np.searchsorted(t, r)
            at[at == len(t)] = 0
            out.append(at[t[at] == r] if len(t) else np.zeros(0, np.int64))
        return _Rows(out, len(t))

    strength = min(LASSO_ROWS, 0.02 * (pos + neg) + 0.5)
    _, w = _lasso(indexed(terms), y, weight, strength, 150)
    keep = np.abs(w) > 1e-6
    if not keep.any():
        return model
    b, w, v = _fit_fm(indexed(terms[keep]), y, weight, model["bias"], w[keep], FACTORS, PASSES, SEED)
    return model | {"bias": float(b), "terms": terms[keep], "w": w, "v": v}


def _fit_batches(batches):
    b = pd.concat(list(batches) or [pd.DataFrame({"label": [], "order": [], "terms": []})])
    b = b.sort_values(["order", "label", "terms"], kind="stable")
    model = fit([np.frombuffer(t, np.uint32) for t in b["terms"]], b["label"].to_numpy(float))
    yield pd.DataFrame({"bias": [model["bias"]], "terms": [model["terms"].tobytes()],
                        "w": [model["w"].tobytes()], "v": [np.ascontiguousarray(model["v"]).tobytes()]})


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> dict:
    """Fit the model on at most ``SAMPLE_ROWS`` labelled documents outside the held-out fold."""
    lab = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
    lab = lab.where("__id IS NOT NULL AND __label IS NOT NULL").where(~held_out("__id"))
    lab = lab.groupBy("__id").agg(F.max((F.col("__label") > 0).cast("double")).alias("label"))
    # the sample is bounded, and so is what is broadcast
    lab = lab.withColumn("order", F.xxhash64(F.col("__id").cast("string"))).orderBy("order", "__id").limit(SAMPLE_ROWS)
    d = docs.select(F.col(id_col).alias("__doc"), whole_text(text_col).alias("__text"))
    t = d.join(F.broadcast(lab), F.col("__doc") == F.col("__id")).select("label", "order", "__text")
    t = t.mapInPandas(_hash_batches, "label double, order long, terms binary")
    # rows with repeated ids come on top of the sample; it stays bounded
    t = t.orderBy("order", "label", "terms").limit(SAMPLE_ROWS).coalesce(1)
    r = t.mapInPandas(_fit_batches, "bias double, terms binary, w binary, v binary").first()
    if r is None:
        return fit([], np.zeros(0))
    w = np.frombuffer(r["w"])
    return {"bias": r["bias"], "terms": np.frombuffer(r["terms"], np.uint32), "w": w,
            "v": np.frombuffer(r["v"]).reshape(len(w), FACTORS)}


class _Scorer:
    def __init__(self, model: dict):
        self.model, self.index, self.seen = model, {int(h): i for i, h in enumerate(model["terms"])}, {}

    def __call__(self, text: str | None) -> float:
        m, seen, at = self.model, self.seen, set()
        for w in set(_WORD.findall(text.lower())) if text else ():
            known = seen.get(w)
            if known is None:
                if len(seen) >= CACHE_WORDS:
                    seen.clear()
                known = seen[w] = tuple(self.index[h] for h in word_terms(w) if h in self.index)
            at.update(known)
        z, at = m["bias"], sorted(at)
        if at:
            v = m["v"][at]
            z += m["w"][at].sum() + 0.5 * float((v.sum(0) ** 2 - (v ** 2).sum(0)).sum())
        return float(_sigmoid(z))


def score_text(text: str | None, model: dict) -> float:
    return _Scorer(model)(text)


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text", to: str = "score") -> DataFrame:
    """Add the score of every whole text; the model is sent to the tasks once (size: the chosen terms)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _Scorer(sent.value)
        for texts in batches:
            yield pd.Series([scorer(t) for t in texts], dtype="float64")

    return docs.withColumn(to, F.pandas_udf(score, "double")(whole_text(text_col)))


def query(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, read(spark, sf_dir, "labels"))
    t = score_toxicity(docs, model)
    return t.select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
