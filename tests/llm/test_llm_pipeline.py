"""The corpus pipeline against a plain version of its stages, and on messy documents.

What the toxicity machine scores, and which runs the Markov models call
random, is taken from those models; every decision on it is made again here.
"""

import re

import corpus_pipeline as CP
import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.llm import decontaminate as DC
from logwarden.llm import secrets as SE
from logwarden.llm import sentencepiece_sampling as SP
from logwarden.llm import simhash as SH
from logwarden.llm import toxicity as TX

from .helpers import SHARED
from .test_llm_joins import plain_fingerprint, union_find, words
from .test_llm_text_ops import brute_spans


def stage(name):
    return dict(CP.STAGES)[name]


def test_stages_in_order():
    assert [n for n, _ in CP.STAGES] == ["toxicity", "near_duplicates", "decontaminate", "secrets", "pieces"]
    assert CP.ORACLE_SQL is None


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory, messy, labels):
    d = str(tmp_path_factory.mktemp("planted"))
    messy.write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, item


def test_every_stage_on_messy_documents(spark, planted, messy):
    d, item = planted
    docs = spark.read.parquet(f"{d}/documents.parquet")
    leak = docs.where("doc_id = 9").withColumn("doc_id", F.lit(99).cast("long")).withColumn("text", F.lit("so " + item + " it goes"))
    docs = docs.unionAll(leak)
    for name, f in CP.STAGES:
        assert f(spark, docs.limit(0), d).count() == 0, name
    assert stage("toxicity")(spark, docs, d).columns == docs.columns
    near = stage("near_duplicates")(spark, docs, d)
    assert near.columns == docs.columns
    assert near.where(F.col("text") == SHARED).count() == 1 and near.where("doc_id = 1").count() == 1
    clean = stage("decontaminate")(spark, docs, d)
    assert clean.columns == docs.columns
    assert clean.count() == docs.count() - 1 and clean.where("doc_id = 99").count() == 0
    red = stage("secrets")(spark, docs, d)
    assert red.columns == docs.columns and red.count() == docs.count()
    assert [(r.text, r.n_chars) for r in red.where("doc_id = 8").collect()] == [('[SECRET]" and more', 18)]
    assert red.where("doc_id = 9 AND n_chars = 1").count() == 1  # untouched rows keep their columns as they were
    ids = stage("pieces")(spark, docs, d)
    assert ids.columns == [*docs.columns, "ids", "n_pieces"] and ids.count() == docs.count()
    out = CP.run(spark, d)
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}


def test_stages_decide_like_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tox = {r.doc_id for r in stage("toxicity")(spark, docs, sf).collect()}
    assert tox == {r.doc_id for r in TX.query(spark, sf).where("predicted = 0").collect()}
    near = {r.doc_id for r in stage("near_duplicates")(spark, docs, sf).collect()}
    assert near == {r.doc_id for r in SH.query(spark, sf).where("doc_id = component_id").collect()}
    left = {r.doc_id for r in stage("decontaminate")(spark, docs, sf).collect()}
    bad = {r.doc_id for r in DC.query(spark, sf).collect()}
    assert left == {r.doc_id for r in docs.collect()} - bad and bad
    out = CP.run(spark, sf)
    assert 0 < out.count() < docs.count()
    assert out.where("ids IS NULL").count() == out.where("text IS NULL").count()


def plain_near_duplicates(docs):
    docs = sorted(docs.items())
    fps = [plain_fingerprint(t or "") for _, t in docs]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
    root = union_find(len(fps), pairs)
    return {k: t for n, (k, t) in enumerate(docs) if root[n] == n}  # the smallest of each component


def leaks(text, items):
    """Whether 11 of some 13 words agree with an item's: then 4 in a row do, which give the shifts to look at."""
    w = words(text)
    at = {}
    for k in range(len(w) - 3):
        at.setdefault(tuple(w[k:k + 4]), []).append(k)
    for v in items:
        for shift in {p - k for k in range(len(v) - 3) for p in at.get(tuple(v[k:k + 4]), ())}:
            lo, hi = max(0, shift), min(len(w), shift + len(v))
            eq = np.array([w[q] == v[q - shift] for q in range(lo, hi)], int)
            if len(eq) >= 13 and np.convolve(eq, np.ones(13, int), "valid").max() >= 11:
                return True
    return False


def plain_redaction(text, table):
    """Spans, merged where they overlap, become marks."""
    if text is None:
        return None
    spans = sorted([(s, e) for s, e, _ in brute_spans(text)] + [(s, e) for s, e, k in SE.secret_spans(text, table) if k == "markov"])
    out, at = "", 0
    for s, e in spans:
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:] if spans else text


def plain_text(sp, ids):
    """Pieces put together by their names alone."""
    raw = b"".join(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and sp.is_byte(i) else p.replace("\u2581", " ").encode()
                   for i, p in ((i, sp.id_to_piece(i)) for i in ids))
    return raw.decode()[1:]


def test_run_equals_a_plain_version(spark, sf, tmp_path):
    import sentencepiece

    own, sf = sf, str(tmp_path)
    item = next(r.text for r in spark.read.parquet(f"{own}/benchmark.parquet").collect() if len(words(r.text)) >= 15)
    prose = "a plain note about rivers and hills that nobody else has written down in quite this way, "
    secret = f'{prose} with password = "hunter2xyz" and the key Zq8vT3mXw9LrB5nKd7Jc in it\n'
    more = spark.createDataFrame([(900001, secret), (900002, f"{prose} then {item} and no more of it"), (900003, secret), (900004, None)],
                                 "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars")
    spark.read.parquet(f"{own}/documents.parquet").unionByName(more).write.parquet(f"{sf}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{own}/{t}.parquet").write.parquet(f"{sf}/{t}.parquet")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    toxic = {r.doc_id for r in TX.query(spark, sf).where("predicted = 1").collect()}
    left = plain_near_duplicates({k: t for k, t in docs.items() if k not in toxic})
    items = [words(r.text or "") for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = {k: t for k, t in left.items() if not leaks(t or "", items)}
    kept = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("doc_id").isin(list(left)))
    table = np.array(SE.train_markov(kept)).reshape(128, 128)
    want = {k: plain_redaction(t, table) for k, t in left.items()}
    assert want[900001].count("[SECRET]") == 2 and 900002 not in want and 900003 not in want
    rows = CP.run(spark, sf).collect()
    assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want)
    sp = sentencepiece.SentencePieceProcessor(model_file=SP.model_path())
    for r in rows:
        assert (r.ids is None and r.text is None) or (plain_text(sp, r.ids) == r.text and r.n_pieces == len(r.ids))
        assert r.text == docs[r.doc_id] or r.n_chars == len(r.text)
