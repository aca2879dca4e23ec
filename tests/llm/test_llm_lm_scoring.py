"""The n-gram trie and its scores against a plain dictionary model."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logwarden.llm import elias_fano as EF
from logwarden.llm import lm_scoring as LM

SCHEMA = "doc_id long, text string"


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0D]+", lower(text or "")), None]  # None is the end


class Plain:
    """The same model in dictionaries, without quantisation."""

    def __init__(self, texts):
        self.n = [Counter() for _ in range(3)]
        for t in texts:
            w = tokens(t)
            for k in range(3):
                self.n[k].update(tuple(w[j:j + k + 1]) for j in range(len(w) - k))
        self.total, self.words = sum(self.n[0].values()), len(self.n[0])
        self.kids = [defaultdict(int) for _ in range(3)]
        self.d = [0.0] * 3
        for k in (1, 2):
            for g in self.n[k]:
                self.kids[k][g[:-1]] += 1
            n1, n2 = (sum(1 for c in self.n[k].values() if c == x) for x in (1, 2))
            self.d[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    def prob(self, g):
        if len(g) == 1:
            return (self.n[0][g] + 1) / (self.total + self.words + 1)
        k, total = len(g) - 1, self.n[len(g) - 2][g[:-1]]
        if not self.kids[k][g[:-1]]:
            return self.prob(g[1:])
        own = max(self.n[k][g] - self.d[k], 0) / total
        return own + self.d[k] * self.kids[k][g[:-1]] / total * self.prob(g[1:])

    def row(self, text):
        w = tokens(text)
        base = sum(math.log10(self.prob((x,))) for x in w)
        score = sum(math.log10(self.prob(tuple(w[max(0, j - 2):j + 1]))) for j in range(len(w)))
        return len(w), sum(1 for x in w if self.n[0][(x,)]), self.total, base, score


def compare(rows, model, text_of):
    assert len(rows) == len(text_of)
    for r in rows:
        n, known, total, base, score = model.row(text_of[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-7)
        # a byte on a scale of up to 4: some hundredths a token
        assert abs(r.score - score) <= 0.03 * n + 1e-6, (r.doc_id, r.score, score)


def test_query_equals_the_plain_model(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in docs}
    rows = LM.query(spark, sf).collect()
    compare(rows, Plain([t for k, t in docs.items() if not out[k]]), docs)
    assert {r.doc_id: r.held_out for r in rows} == out
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.fixture(scope="module")
def skewed():
    """A pair with a third of all tokens and many successors, rare words, repeats."""
    rng = random.Random(3)
    out = []
    for k in range(240):
        w = []
        for _ in range(rng.randrange(60)):
            w += ["The", "same", f"w{int(rng.paretovariate(.6)) % 300}"] if rng.random() < .7 else [rng.choice("abcdé")]
        out.append((k, rng.choice([" ", "\n", "\t "]).join(w)))
    return out


def test_parts_and_split_contexts(spark, monkeypatch, skewed):
    """Files of some hundred n-grams, and contexts whose children lie in several, give the same trie."""
    monkeypatch.setattr(LM, "PART_TOKENS", 300)
    docs = spark.createDataFrame(skewed, SCHEMA).repartition(5)
    model, plain = LM.train(docs, F.lit(True)), Plain([t for _, t in skewed])
    two, three = model.level(2), model.level(3)
    assert len(two.parts) > 5 and two.split and three.split
    names = list(plain.n[0])
    number = dict(zip(names, model.level1().numbers(pa.array([LM.END if g[0] is None else g[0].encode() for g in names], pa.binary())).tolist(), strict=True))
    assert sorted(number.values()) == list(range(len(names)))
    pairs = list(plain.n[1])
    x, y = (np.array([number[(g[k],)] for g in pairs]) for k in (0, 1))
    place = two.find(x, y)
    assert sorted(place.tolist()) == list(range(len(pairs)))
    assert {int(a): two.kids(int(a)) for a in np.unique(x)} == {number[g]: n for g, n in plain.kids[1].items()}
    at = dict(zip(pairs, place.tolist(), strict=True))
    triples = list(plain.n[2])
    p = np.array([at[g[:2]] for g in triples])
    rank = np.array([at[g[1:]] for g in triples]) - two.first_place(np.array([number[g[1:2]] for g in triples]))
    assert (rank >= 0).all()
    assert sorted(three.find(p, rank).tolist()) == list(range(len(triples)))
    # n-grams that do not occur
    absent = [(a, b) for a in range(0, len(names), 3) for b in range(0, len(names), 5)]
    absent = [g for g in absent if g not in set(zip(x.tolist(), y.tolist(), strict=True))]
    assert (two.find(*np.array(absent).T) == -1).all()
    compare(LM.score(docs, model).collect(), plain, dict(skewed))


def test_probabilities_add_up(spark, skewed):
    """Over all words and the unknown one, whatever the context, up to quantisation."""
    plain = Plain([t for _, t in skewed])
    for context in ((), ("the",), ("the", "same"), ("same", "w1"), ("nowhere", "the"), ("a", "nowhere")):
        assert sum(plain.prob((*context, *g)) for g in [*plain.n[0], ("unknown",)]) == pytest.approx(1)
    docs = spark.createDataFrame(skewed, SCHEMA)
    words = [g[0] for g in plain.n[0] if g[0] is not None]
    rows = spark.createDataFrame([(k, f"the same {w}") for k, w in enumerate([*words, "unknown"])] + [(-1, "the same")], SCHEMA)
    model = LM.train(docs, F.lit(True))
    got = {r.doc_id: r.score for r in LM.score(rows, model).collect()}
    end = {w: math.log10(plain.prob(("same", w, None))) for w in [*words, "unknown"]}
    context = got[-1] - math.log10(plain.prob(("the", "same", None)))
    assert sum(10 ** (got[k] - context - end[w]) for k, w in enumerate([*words, "unknown"])) == pytest.approx(1, abs=0.1)


def test_messy_rows_and_names(spark, messy):
    rows = messy.select("doc_id", "text").collect()
    model = LM.train(messy, F.col("doc_id") != 6)  # null for null ids
    plain = Plain([r.text for r in rows if r.doc_id is not None and r.doc_id != 6])
    tagged = messy.withColumnsRenamed({"a": "n_tokens", "b": "word", "fp": "blob"})
    got = sorted(LM.score(tagged, model).collect(), key=str)
    assert len(got) == len(rows)
    want = {r.doc_id: [x.text for x in rows if x.doc_id == r.doc_id] for r in rows}
    for r in got:
        options = [plain.row(t) for t in want[r.doc_id]]
        assert any((r.n_tokens, r.n_known) == o[:2] and abs(r.score - o[4]) <= 0.03 * o[0] for o in options)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    assert LM.score(none, LM.train(some, F.lit(True))).collect() == []
    rows = LM.score(some, LM.train(none, F.lit(True))).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows) == [
        (1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


@pytest.mark.parametrize(("n", "bound"), [(0, 10), (1, 1), (1000, 1000), (1000, 10 ** 9), (1000, 1 << 60), (40_000, 10 ** 6)])
def test_elias_fano(n, bound):
    rng = np.random.default_rng(n)
    for x in (np.sort(rng.integers(0, bound, n)), np.sort(np.append(rng.integers(0, bound, n // 2), rng.integers(0, min(bound, 700), n - n // 2)))):
        x = x.astype(np.uint64)
        ef = EF.EliasFano(EF.encode(x, bound), len(x), bound)
        assert (ef.all() == x).all()
        at = rng.integers(0, max(n, 1), 300 * (n > 0))
        assert (ef[at] == x[at]).all()
        q = np.sort(np.append(rng.integers(0, bound, 300).astype(np.uint64), x[:200]))
        place, same = ef.successor(q)
        assert (place == np.searchsorted(x, q)).all()
        assert same.tolist() == np.isin(q, x).tolist()
