"""Toxicity, secret scans, piece sampling and token files against direct computation."""

import re
import zlib

import numpy as np
import pytest

from logwarden.llm import secrets as SE
from logwarden.llm import sentencepiece_sampling as SP
from logwarden.llm import token_files as TF
from logwarden.llm import toxicity as TX


# ---- toxicity

def test_machine_learns_a_pair_that_sums_cannot():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1200):
        insult, group = rng.random(2) < 0.5
        words = [f"w{k}" for k in rng.integers(0, 200, 12)] + ["slur"] * int(insult) + ["people"] * int(group)
        rows.append(TX.term_hashes(" ".join(words)))
        y.append(float(insult and group))
    m = TX.fit(rows, np.array(y))
    s = {t: TX.score_text(t, m) for t in ("slur people", "slur", "people", "w1 w2", "")}
    assert s["slur people"] > 0.9 and max(s["slur"], s["people"], s["w1 w2"], s[""]) < 0.3


def test_toxicity_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    rows = TX.query(spark, sf).toPandas()
    lab = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]).all()
    j = rows[rows.held_out].merge(lab, on="doc_id")
    hit = ((j.predicted == 1) & (j.toxic == 1)).sum()
    assert hit / (j.toxic == 1).sum() > 0.85 and hit / (j.predicted == 1).sum() > 0.85


def test_toxicity_never_reads_held_out_labels(spark, sf):
    docs, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lied = lab.withColumn("toxic", (TX.held_out().cast("int") * (1 - 2 * lab.toxic) + lab.toxic).cast("int"))
    a, b = TX.train_toxicity(docs, lab), TX.train_toxicity(docs.repartition(5), lied)
    assert a["bias"] == b["bias"] and (a["terms"] == b["terms"]).all() and np.allclose(a["w"], b["w"])


def test_toxicity_edges(spark, messy, labels):
    m = TX.train_toxicity(messy, labels)
    out = TX.score_toxicity(messy, m, to="__s").select("doc_id", "text", "__s").collect()
    assert len(out) == 12 and all(0 <= r["__s"] <= 1 for r in out)
    empty = TX.train_toxicity(messy.limit(0), labels)
    assert TX.score_text("any text", empty) < 0.3
    assert TX.score_toxicity(messy.limit(0), empty).count() == 0
    assert TX.score_text("x", TX.train_toxicity(messy, labels.limit(0))) < 0.3


# ---- secrets

def brute_spans(text):
    out = []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6 and m.group(1).isascii():
            out.append((m.start(), m.end(), "assign"))
    for k, pat, least in (("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)):
        out += [(m.start(), m.end(), k) for m in re.finditer(pat, text) if m.end() - m.start() >= least]
    return sorted(out, key=lambda x: (x[0], ("assign", "access", "hex").index(x[2])))


CASES = [
    'PassWord : "hunter2x" rest', "api_key=abc", "apikey = 'ABC.def-123/4'", "token=token=abcdef", "secret:  x=1234567",
    "AKIA" + "A1" * 9, "AKIA" + "Z" * 15, "f" * 24, "F" * 30, "é 漢 token = " + "ab12" * 10, "", "tokentokentoken=aaaaaa",
]


def test_base_spans_match_the_rules():
    for text in CASES:
        assert [x[:3] for x in sorted(SE.base_spans(text), key=lambda x: (x[0], SE.KINDS.index(x[2])))] == brute_spans(text), text


def test_markov_spans_random_strings_only(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    t = np.array(SE.train_markov(docs)).reshape(128, 128)
    rng = np.random.default_rng(1)
    for alphabet in SE.KEY_ALPHABETS[1:]:
        found = sum(any(k == "markov" for *_, k in SE.secret_spans("the " + "".join(rng.choice(list(alphabet), 28)) + " of", t))
                    for _ in range(200))
        assert found > 185, alphabet
    for plain in ("thntintionreonststshandtherof", "max_connection_pool_size", "4242424242424242", "HTTPResponseHeaders",
                  "Theandthering_oferandthe", "getTheseOneandThere2", "com/theread/en/Ander12", "reloadThinTheother"):
        assert SE.secret_spans(plain, t) == [], plain


def test_markov_spans_random_strings_of_one_case(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    t = np.array(SE.train_markov(docs)).reshape(128, 128)
    rng = np.random.default_rng(2)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        for size in (16, 32):
            made = ["".join(rng.choice(list(alphabet), size)) for _ in range(200)]
            joined = ["-".join(x[k:k + size // 4] for k in range(0, size, size // 4)) for x in made]
            for least, runs in ((190, made), (150, joined)):
                found = sum(SE.secret_spans(f"the {x} of", t) == [(4, 4 + len(x), "markov")] for x in runs)
                assert found > least, (alphabet, size, least)
    for plain in ("internationalization", "INTERNATIONALIZATION", "CONFIGURATIONERROR", "Donaudampfschifffahrt", "aaaaaaaaaaaaaaaaaaaa",
                  "DEFAULT_CONNECTION_TIMEOUT", "-" * 20, "=" * 20, "path/to/some/file/name", "5927243074273351"):
        assert SE.secret_spans(plain, t) == [], plain


def test_secret_query_is_whole_and_consistent(spark, sf):
    import hashlib

    rows = {r.doc_id: r for r in SE.query(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = brute_spans(d.text or "")
        r = rows[d.doc_id]
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for *_, k in want) for x in ("assign", "access", "hex"))
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == [s for s in joined.split(",") if s]


def test_secrets_edges(spark, messy):
    t = SE.train_markov(messy)
    out = SE.redact_secrets(messy, t).select("doc_id", "text").collect()
    assert len(out) == 12
    assert [r.text for r in out if r.doc_id == 8] == ['[SECRET]" and more']
    assert [r.text for r in out if r.doc_id == 3] == [None]
    assert SE.find_secrets(messy, t).where("size(secret_spans) > 0").count() == 1
    assert SE.find_secrets(messy.limit(0)).count() == 0


# ---- piece sampling

WEIRD = ["", " ", "  a", "▁", "a▁b ▁", "<unk> <s> </s> <0x0A>", "\n\n \n", "é漢字\U0001f600\x00\x01", "x" * 300, " " * 70 + "y",
         "tab\tand\r\nline", "ﬁ ligature", "nachträglich  ünd", "a" * 5000 + " b", "\u2028\u00a0"]


@pytest.fixture(scope="module")
def sampler():
    return SP.Sampler(SP.model_path())


def test_pieces_are_lossless_and_known_to_the_model(sampler):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=SP.model_path())
    ids = sampler.encode(WEIRD, [str(i) for i in range(len(WEIRD))])
    for x, t in zip(ids, WEIRD, strict=True):
        assert sampler.decode(x.tolist()) == t
        assert all(0 <= i < sp.get_piece_size() for i in x.tolist())
        if "▁" not in t:
            assert sp.decode(x.tolist()) == t


def test_pieces_depend_on_row_key_alone(sampler):
    texts = ["the same words in every row of this batch"] * 6
    a = sampler.encode(texts, list("aabbcd"))
    assert (a[0].tolist() == a[1].tolist()) and (a[2].tolist() == a[3].tolist())
    assert len({tuple(x.tolist()) for x in a}) > 1
    b = sampler.encode(["other text first", texts[0]], ["z", "a"])
    assert b[1].tolist() == a[0].tolist()


def _segmentations(s, word, at=0):
    if at == len(word):
        yield (), 1.0
        return
    for n in range(1, len(word) - at + 1):
        p = s["pieces"].get(word[at:at + n])
        if p is not None:
            for rest, w in _segmentations(s, word, at + n):
                yield (p[0], *rest), w * p[1]


def test_sampled_shares_equal_enumerated_weights(sampler):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=SP.model_path())
    pieces, rank = {}, 0
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[sp.id_to_piece(i)] = (i, (rank + 1) ** -SP.ALPHA)
            rank += 1
    want = dict(_segmentations({"pieces": pieces}, "▁there"))
    total = sum(want.values())
    n = 40_000
    got: dict = {}
    for x in sampler.encode(["there"] * n, [str(i) for i in range(n)]):
        got[tuple(x.tolist())] = got.get(tuple(x.tolist()), 0) + 1
    assert set(got) <= set(want)
    for seg, w in want.items():
        p = w / total
        assert abs(got.get(seg, 0) / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-4


def test_long_words_filter_like_short_ones(sampler):
    # the log form (long words) and the product form give the same shares
    share, piece = sampler._filter(["ab cd".replace(" ", "") * 3])
    old = SP._LINEAR
    try:
        SP._LINEAR = 0
        share2, piece2 = sampler._filter(["abcd" * 3])
    finally:
        SP._LINEAR = old
    assert np.allclose(share, share2, atol=1e-5) and (piece == piece2).all()


def test_pieces_edges(spark, messy):
    path = SP.model_path()
    enc = SP.encode_sampled(messy.repartition(3), path)
    out = SP.decode_ids(enc, path).select("doc_id", "text", "ids", "decoded").collect()
    assert len(out) == 12
    assert all(r.decoded == r.text and (r.ids is None) == (r.text is None) for r in out)
    a = {(r.doc_id, r.text): r.ids for r in out}
    b = {(r.doc_id, r.text): r.ids for r in SP.encode_sampled(messy.coalesce(1), path).collect()}
    assert a == b
    assert SP.round_trip(messy, path).where("NOT lossless").count() == 0
    assert SP.encode_sampled(messy.limit(0), path).count() == 0


# ---- token files

def test_token_files_equal_the_tokenizer(spark, messy, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TF.tokenizer_path())
    path = f"file://{tmp_path}/out"
    parts = TF.write_token_files(messy.repartition(4), path, TF.tokenizer_path())
    got = TF.read_token_files(spark, path, with_ids=True).orderBy("doc_no").collect()
    rows = sorted(((r.doc_id, r.text or "") for r in messy.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in rows] and [r.doc_no for r in got] == list(range(len(rows)))
    at = 0
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(tok.encode(t, add_special_tokens=False).ids + [1])
    for r in got:
        assert r.ids in want[r.doc_id]
        want[r.doc_id].remove(r.ids)
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += len(r.ids)
    assert parts.agg({"ids": "sum"}).first()[0] == at
    # unsigned 16-bit integers: the vocabulary fits
    assert {p.width for p in parts.collect()} == {2}


def test_token_files_pieces_equal_whole_texts(spark, sf):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TF.tokenizer_path())
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + WEIRD + [
        "<|endoftext|>glued<|startoftext|> a", "Don't WE'LL I'm x's", "A\u0301 e\u0301 \u1e9e İ", "12 345 ½ ²", "ª º ß ÿ Ÿ ŉ", "\x1c\x85a\xa0b", "''s 'tis ''"]
    enc = TF._Encoder(TF.tokenizer_path())
    for t, x in zip(texts, enc.batches(texts), strict=True):
        assert x.tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_split_rule_on_random_strings():
    import random

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TF.tokenizer_path())
    enc = TF._Encoder(TF.tokenizer_path())
    rng = random.Random(8)
    parts = ["'", "'s", "'re", "'ve", "'ll", "'d", "'m", "'t", "'l", "'r", "a", "S", "E", "é", "Ÿ", "7", "½", " ", "\n", "\t", ".", "-", '"', "''",
             "ſ", "ª", "\xad", "<", "|", "漢", "re", "ll"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(4000)]
    for t, x in zip(texts, enc.batches(texts), strict=True):
        assert x.tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_token_files_of_nothing(spark, messy, tmp_path):
    path = f"file://{tmp_path}/none"
    TF.write_token_files(messy.limit(0), path, TF.tokenizer_path())
    assert TF.read_token_files(spark, path).count() == 0


def thue_morse(k, a, b):
    """A word of 2**k letters and its complement: equal under every polynomial hash modulo 2**64 of odd base."""
    bits = [0]
    for _ in range(k):
        bits += [1 - x for x in bits]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_pieces_of_one_hash_keep_their_own_ids():
    """Colliding words in one text, in one batch, and across batches of one worker; and one hash for all pieces."""
    import random

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TF.tokenizer_path())
    want = lambda t: tok.encode(t, add_special_tokens=False).ids
    texts = ["plain words", ""]
    for k in (10, 11, 12):
        x, y = thue_morse(k, "a", "b")
        texts += [x, f"before {y} after", f"{x} {y}"]
    enc = TF._Encoder(TF.tokenizer_path())
    for batch in (texts, texts[::-1], texts * 2):
        assert [x.tolist() for x in enc.batches(batch)] == [want(t) for t in batch]
    enc.code[:] = 1  # pieces of equal length share a hash
    rng = random.Random(1)
    batch = [" ".join(rng.choices("one two neo owt eerht three it's don't 12 21 a b".split(), k=9)) for _ in range(60)]
    for b in (batch, batch[::-1]):
        assert [x.tolist() for x in enc.batches(b)] == [want(t) for t in b]
