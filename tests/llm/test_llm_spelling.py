"""Spelling variants against brute force, and the gram index's bound by exhaustive edits."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from logwarden.llm import spelling as SP
from logwarden.llm import word_arrays as WA


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute_variants(words):
    """word -> (form, root, n, n_near, form_n), by the words that share a one-character deletion."""
    by = {}
    for w in words:
        for v in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}:
            by.setdefault(v, []).append(w)
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def got(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute_variants(brute_words([(r.doc_id, r.text) for r in docs]))
    assert got(SP.query(spark, sf)) == want
    assert any(x[0] for x in want.values())


def typos(rng, count):
    """Words of few letters, so that they are near each other, of many lengths."""
    out = {}
    for _ in range(count):
        w = "".join(rng.choice("abé") for _ in range(rng.choice([2, 3, 5, 6, 7, 9, 12, 20])))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(w) + 1)
            w = rng.choice([w[:k] + rng.choice("abé") + w[k:], w[:k] + w[k + 1:], w[:k] + "b" + w[k + 1:]])
        if len(w) >= 2:
            out[w] = rng.choice([1, 2, 2, 4, 4, 9])
    return out


@pytest.mark.parametrize(("few", "share"), [(3, 8192), (0, 20)])
def test_dictionaries_do_not_change_the_result(spark, monkeypatch, few, share):
    """Whatever the dictionary extends, the pairs are the same; ties in counts go to the smaller word."""
    monkeypatch.setattr(SP, "MIN_FREQ", few)
    monkeypatch.setattr(SP, "GRAM_SHARE", share)
    words = typos(random.Random(5), 1500)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(SP.variants(df, min_length=2)) == brute_variants(words)


@pytest.mark.parametrize("extended", [set(), {"ab", "ba", "aa"}, {"ab", "ba", "aa", "bb", "^a", "^b", "aba", "bab", "abb"}])
def test_an_edit_changes_no_more_grams_than_the_bound(extended):
    """All edits of all words: near words share a signature gram beside which one whole side is equal."""
    rng = random.Random(8)
    for _ in range(300):
        w = "".join(rng.choice("ab") for _ in range(rng.randrange(2, 14)))
        edits = {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in "abc"}
        edits |= {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in "abc"}
        for v in edits - {w}:
            short = min(len(w), len(v))
            most = SP.longest(short)
            sides = []
            for x in (f"^{w}$", f"^{v}$"):
                grams = SP.decompose(x, extended, most)
                assert SP.affected(grams, most) < len(grams)
                known = dict.fromkeys(extended, 1)
                sides.append({s for p, e in SP.signature(x, known, most) for s in ((0, p, x[:e]), (1, e - p, x[p:]))})
            assert sides[0] & sides[1], (w, v)


def test_gram_dictionary(spark, monkeypatch):
    monkeypatch.setattr(SP, "MIN_FREQ", 3)
    words = typos(random.Random(6), 400)
    n = Counter(f"^{w}$"[p:p + q] for w in words for q in (2, 3, 4) for p in range(len(w) + 3 - q))
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert SP.frequent_grams(df) == {g: c for g, c in n.items() if c > 3}
    monkeypatch.setattr(SP, "GRAM_SHARE", 10)
    total = Counter(len(g) for g in n.elements())
    found = SP.frequent_grams(df)
    assert found == {g: c for g, c in n.items() if c > max(3, total[len(g)] // 10)}
    assert max(Counter(map(len, found)).values()) <= 10


def test_words_of_messy_documents(spark, messy):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    rows += [(50 + k, "Colour colours ÉTÉS étés×÷ colour_colour") for k in range(4)]
    docs = messy.unionByName(spark.createDataFrame(rows[-4:], "doc_id long, text string"), allowMissingColumns=True)
    counts = {r.word: r.n for r in SP.word_counts(docs, change=SP.lossy).collect()}
    assert counts == brute_words(rows)
    tagged = docs.withColumnsRenamed({"a": "word", "b": "n", "fp": "id"})
    assert got(SP.variants(SP.word_counts(tagged, change=SP.lossy))) == brute_variants(counts)


def test_empty_table(spark):
    assert got(SP.variants(SP.word_counts(spark.createDataFrame([], "doc_id long, text string")))) == {}


def test_chain_of_forms(spark):
    """Each word's form has twice its count; the root is at the end of a chain of 20.  A lone word is its own root."""
    words = {"x" * (k + 5): 2 ** k for k in range(20)} | {"solitary": 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(SP.variants(df)) == brute_variants(words)


def test_very_long_words(spark):
    words = {"ab" * 3000: 4, "ab" * 2999 + "b": 9, "ab" * 2999 + "aab": 2}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = got(SP.variants(df))
    assert want["ab" * 3000][:2] == ("ab" * 2999 + "b",) * 2 and want["ab" * 3000][3] == 2


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_word_arrays(monkeypatch, size):
    texts = ["One two\tTHREE", "", "ÀÉ ×÷ß", " \n\x0b", "漢字 ab cd", "end", "ſtop ÿ" + "é" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(1)
    for inside, rule in ((WA.not_blank, "[^\x20\x09-\x0D]+"), (WA.latin_letters, "[a-zÀ-ÿ]+")):
        found, first = [], 0
        for b in WA.blocks(batch, "text", size):
            w, row = WA.words(b.column(0), inside)
            found += zip((row + first).tolist(), [x.decode() for x in w.to_pylist()], strict=True)
            first += b.num_rows
        assert found == [(k, x) for k, t in enumerate(texts[1:]) for x in re.findall(rule, lower(t))]
