"""Secret scans: fixed patterns plus two character Markov models.

Base spans come from three fixed patterns (assignments, access keys, long
hex runs).  Further spans (kind ``markov``) come from two first-order
character models, one of random strings and one of ordinary identifiers: a
run of identifier characters is a secret if its log-likelihood ratio is
large both in total and per character.  Where a run's case tells nothing (one
case, a capitalised word, digits alone) it is folded, only steps between
letters and digits count, and more is asked per step.  Digits alone never
reach it: the models know no difference between a random and another number.

The models are trained from labelled samples.  Random: the values that the
base patterns find in the corpus, and generated strings over the usual key
alphabets.  Ordinary: every identifier run of the corpus outside base spans,
with a share of steps kept for joints (camelCase, digits, separators), which
prose hardly shows.
Both are transition counts over all documents, added up by Spark; only two
128 x 128 count tables reach the driver, whatever the corpus size.

Cases: a null text is an empty text and holds no span.  Texts are scanned
whole; every pattern is linear in the text.  Repeated rows stay rows.  An
empty table trains on the generated strings alone and gives no rows.  Spans
are code points, end exclusive.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, whole_text

# --- fixed values: base patterns, in listing order, and the length their value needs ---
KINDS = ("assign", "access", "hex", "markov")
BASE_PATTERNS = (
    ("assign", r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
KEY_ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
# --- end of fixed values ---

#: shortest run the models judge, and what the log-likelihood ratio (nats) must reach
MIN_RUN, MIN_TOTAL, MIN_PER_CHAR = 12, 12.0, 0.6
#: per step of a run without mixed case or digits among letters: one word, and words with separators
MIN_PER_STEP, MIN_PER_JOINED_STEP = 1.0, 2.0
#: share of an ordinary identifier's steps that join two words (camelCase, digits, separators)
JOINT = 0.05
#: generated strings of each key alphabet in the random sample, their length and seed
GENERATED, GENERATED_LEN, GENERATED_SEED = 2000, 32, 7

_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
_N = 128


def _compiled():
    out = []
    for kind, pattern, group, least in BASE_PATTERNS:
        if kind == "hex":  # greedy runs, so asking for the length in the pattern drops the same matches
            pattern = r"[0-9a-f]{%d,}" % least
        out.append((kind, re.compile(pattern), group, least))
    return out


def base_spans(text: str, patterns=None) -> list[tuple[int, int, str, int, int]]:
    """``(start, end, kind, value_start, value_end)`` of every base span."""
    found = []
    for kind, pattern, group, least in patterns or _compiled():
        for m in pattern.finditer(text):
            s, e = m.span(group)
            if e - s >= least:
                found.append((m.start(), m.end(), kind, s, e))
    return found


def _transitions(text: str) -> np.ndarray:
    """Counts of character pairs inside identifier runs, as a flat 128 x 128 table."""
    a = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
    ok = _IDENT[a]
    both = ok[:-1] & ok[1:]
    return np.bincount(a[:-1][both].astype(np.int32) * _N + a[1:][both], minlength=_N * _N)


_IDENT = np.zeros(256, bool)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-":
    _IDENT[_c] = True
_WORD = _IDENT.copy()
_WORD[list(b"+/_=-")] = False


def _count_batches(batches):
    patterns = _compiled()
    random_, plain = np.zeros(_N * _N, np.int64), np.zeros(_N * _N, np.int64)
    for b in batches:
        for text in b["__text"]:
            spans = sorted(base_spans(text, patterns))
            at, rest = 0, []
            for s, e, _, vs, ve in spans:
                random_ += _transitions(text[vs:ve])
                if s > at:
                    rest.append(text[at:s])
                at = max(at, e)
            rest.append(text[at:])
            plain += _transitions("\n".join(rest))
    at = np.nonzero(random_ + plain)[0]
    yield pd.DataFrame({"pair": at.astype("int32"), "random": random_[at], "plain": plain[at]})


def _generated() -> np.ndarray:
    rng = np.random.default_rng(GENERATED_SEED)
    out = np.zeros(_N * _N, np.int64)
    for alphabet in KEY_ALPHABETS:
        chars = np.array(list(alphabet))
        out += _transitions("\n".join("".join(row) for row in rng.choice(chars, (GENERATED, GENERATED_LEN))))
    return out


def train_markov(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Log-likelihood ratio of every character pair: random against ordinary, flat 128 x 128."""
    counts = docs.select(whole_text(text_col).alias("__text")).mapInPandas(
        _count_batches, "pair int, random long, plain long").groupBy("pair").agg(
        F.sum("random").alias("random"), F.sum("plain").alias("plain")).collect()  # at most 16,384 rows
    found, plain = np.zeros(_N * _N), np.zeros(_N * _N)
    for r in counts:
        found[r["pair"]], plain[r["pair"]] = r["random"], r["plain"]
    made = _generated().astype(float)
    # the two sources of random strings weigh the same, however many values the corpus holds
    random_ = made + found * (made.sum() / max(found.sum(), made.sum()))
    ident = np.nonzero(_IDENT[:_N])[0]
    table = np.zeros((_N, _N))
    for name, c in (("random", random_), ("plain", plain)):
        # back off to the class's plain character frequencies
        m = c.reshape(_N, _N)[np.ix_(ident, ident)]
        one = (m.sum(0) + 1) / (m.sum() + len(ident))
        p = (m + 20 * one) / (m.sum(1, keepdims=True) + 20)
        if name == "plain":
            p = (1 - JOINT) * p + JOINT * _joints(ident, one)
        table[np.ix_(ident, ident)] += np.log(p) * (1 if name == "random" else -1)
    return [round(float(x), 9) for x in table.ravel()]


def _joints(ident: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """What follows where an identifier joins words: half upper case, else digits and separators."""
    upper, digit = (ident >= 65) & (ident <= 90), (ident >= 48) & (ident <= 57)
    out = np.zeros(len(ident))
    # words begin with capitals as often as they hold the letter at all
    lower = np.array([frequency[np.nonzero(ident == c + 32)[0][0]] for c in ident[upper]])
    out[upper] = 0.5 * lower / lower.sum()
    out[digit] = 0.25 / digit.sum()
    rest = ~upper & ~digit & ~((ident >= 97) & (ident <= 122))
    out[rest] = 0.25 / rest.sum()
    return out


def _has_mix(run: str) -> bool:
    """Letters of both cases, or letters and digits: what plain words and plain numbers lack."""
    digit = any(c.isdigit() for c in run)
    return (digit and any(c.isalpha() for c in run)) or (run != run.lower() and not run[1:].islower() and run != run.upper())


def _is_random(run: str, table: np.ndarray) -> bool:
    """Whether the models call the run random."""
    if _has_mix(run):
        a = np.frombuffer(run.encode("ascii"), np.uint8)
        llr = float(table[a[:-1], a[1:]].sum())
        return llr >= MIN_TOTAL and llr >= MIN_PER_CHAR * (len(run) - 1)
    a = np.frombuffer(run.lower().encode("ascii"), np.uint8)
    inner = _WORD[a[:-1]] & _WORD[a[1:]]
    llr = float(table[a[:-1], a[1:]][inner].sum())
    return llr >= MIN_TOTAL and llr >= (MIN_PER_STEP if inner.all() else MIN_PER_JOINED_STEP) * inner.sum()


def secret_spans(text: str, table: np.ndarray, patterns=None, runs=None) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind in listing order."""
    spans = [x[:3] for x in base_spans(text, patterns)]
    base = list(spans)
    for m in (runs or re.compile(_RUN % MIN_RUN)).finditer(text):
        run = m.group()
        if any(s <= m.start() and m.end() <= e for s, e, _ in base):
            continue
        if _is_random(run, table):
            spans.append((m.start(), m.end(), "markov"))
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))


def _scanner(table: list[float]):
    """A Pandas UDF ``text -> array of kind:start:end``."""
    def scan(texts: pd.Series) -> pd.Series:
        t = np.array(table).reshape(_N, _N)
        patterns, runs = _compiled(), re.compile(_RUN % MIN_RUN)
        return pd.Series([[f"{k}:{s}:{e}" for s, e, k in secret_spans(x, t, patterns, runs)] for x in texts], dtype=object)

    return F.pandas_udf(scan, "array<string>")


def find_secrets(docs: DataFrame, table: list[float] | None = None, text_col: str = "text",
                 to: str = "secret_spans") -> DataFrame:
    """Add the spans of every whole text as an array of ``kind:start:end``."""
    table = table or train_markov(docs, text_col)
    return docs.withColumn(to, _scanner(table)(whole_text(text_col)))


def redact_secrets(docs: DataFrame, table: list[float] | None = None, text_col: str = "text",
                   mark: str = "[SECRET]") -> DataFrame:
    """Replace every span by ``mark``; overlapping spans become one mark.  Other columns stay."""
    table = table or train_markov(docs, text_col)

    def redact(texts: pd.Series) -> pd.Series:
        t = np.array(table).reshape(_N, _N)
        patterns, runs = _compiled(), re.compile(_RUN % MIN_RUN)
        out = []
        for x in texts:
            at, parts = 0, []
            for s, e, _ in secret_spans(x, t, patterns, runs) if x is not None else ():
                if s >= at:
                    parts += [x[at:s], mark]
                at = max(at, e)
            out.append("".join(parts) + x[at:] if parts else x)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, F.pandas_udf(redact, "string")(F.col(text_col).cast("string")))


def query(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    t = find_secrets(docs).drop("text")
    count = lambda k: F.size(F.filter("secret_spans", lambda x: x.startswith(f"{k}:"))).cast("long")
    base = F.filter("secret_spans", lambda x: ~x.startswith("markov:"))
    return t.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                    count("hex").alias("n_hex"), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                    F.array_join("secret_spans", ",").alias("spans"), count("markov").alias("n_markov"))
