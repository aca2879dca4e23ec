"""Spelling variants: words one edit apart, found by a variable-length gram index.

``word_counts`` counts the words of whole texts.  ``near_words`` finds all
pairs of words that differ by one inserted, deleted or replaced character:

1. *Gram dictionary*, pruned by frequency: the grams of two to ``GRAM_MAX``
   characters of all words are counted, and only a gram in more than
   ``MIN_FREQ`` places, and more than a ``GRAM_SHARE``-th of all of its
   length, is extended.  So at most ``GRAM_SHARE`` grams of a length are in
   it, however many words there are, and it can be sent to every task.
2. *Decomposition*: from each place of a word (with a mark at either end)
   the gram grows while the dictionary extends it; a gram that ends no later
   than an earlier one is dropped.  Rare letters give short grams, common
   ones long grams.
3. *Affected grams*: an edit can change only grams that span it, and grams
   right of it that a changed one may newly cover.  The largest number, over
   all places of an edit, is a word's bound; two near words share all but
   that many of either's grams.  So of the rarest bound + 1 grams of each
   word, in one common order, at least one is shared and unchanged.
4. *List merging*: the lists of those grams are joined.  The edit lies to the
   left or to the right of an unchanged gram, so a gram is listed under the
   whole of the word's other side with it.  Lists are kept by the length of
   the shorter word of a pair: a word is in those of its own length and of
   one less.
5. *Verification*: edit distance of each candidate pair, inside the join.

``variants`` chooses each word's form and follows forms to the root by
doubling pointers.

Cases: null texts have no words; a null id counts as an empty one where ids
take part.  Repeated rows count each.  Words may be of any length.  Forms at
least double the count, so following them ends.  An empty table, or one
without words that are frequent enough, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import word_arrays as WA
from .common import delete_stored, read, stored, whole_text

MIN_LENGTH, MIN_COUNT = 5, 3
#: lengths of grams; a gram of a pair whose shorter word has n characters has at most (n + 2) / 2, for step 3 to leave one
GRAM_MIN, GRAM_MAX = 2, 4
#: a gram is extended if it is in more places than this, and than this share of all places
MIN_FREQ, GRAM_SHARE = 200, 8192
#: a word's form has at least so many times its count
TIMES = 2
#: a run of the registered query loses a character if this divides its checksum
LOSS = 97


def lossy(names: list[bytes], crc: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Which runs lose a character by their checksum, and what those become."""
    hit = np.flatnonzero(crc % LOSS == 0)
    out = []
    for k in hit.tolist():
        w = names[k].decode()
        at = int(crc[k]) % len(w)
        out.append(w[:at] + w[at + 1:])
    return hit, out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, change: Callable | None = None) -> DataFrame:
    """``(word, n)`` of all letter runs, A-Z lower-cased, long and frequent enough.

    ``change(names, crc)`` may alter runs by the CRC-32 of ``<id>:<run>``:
    it returns places and new words.  It sees each distinct run of a text
    once, since repeats in one text have one checksum.
    """
    def count(batches):
        for batch in batches:
            for b in WA.blocks(batch, "text"):
                found, row = WA.words(b.column(1), WA.latin_letters)
                if not len(found):
                    continue
                enc = found.dictionary_encode()
                distinct, n = np.unique(row << 32 | enc.indices.to_numpy(), return_counts=True)
                k = (distinct & 0xFFFFFFFF).astype(np.int64)
                parts = []
                if change is not None:
                    names = enc.dictionary.to_pylist()
                    ids = [crc32(f"{'' if i is None else i}:".encode()) for i in b.column(0).to_pylist()]
                    own, at = [names[j] for j in k.tolist()], (distinct >> 32).tolist()
                    crc = np.fromiter((crc32(w, ids[i]) for w, i in zip(own, at, strict=True)), np.uint32, len(own))
                    hit, new = change(own, crc)
                    parts.append((pa.array(new, pa.string()), n[hit]))
                    n[hit] = 0
                total = np.bincount(k, n, len(enc.dictionary)).astype(np.int64)
                parts.append((enc.dictionary.cast(pa.string()), total))
                for word, n in parts:
                    keep = pc.and_(pc.greater_equal(pc.utf8_length(word), min_length), pa.array(n > 0))
                    yield pa.RecordBatch.from_arrays([word.filter(keep), pa.array(n).filter(keep)], ["word", "n"])

    t = docs.select(F.col(id_col).cast("string").alias("id"), whole_text(text_col).alias("text"))
    t = t.mapInArrow(count, "word string, n long")
    return t.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _marked() -> F.Column:
    return F.concat(F.lit("^"), F.col("word"), F.lit("$"))


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The gram dictionary: frequent grams and their counts, at most ``GRAM_SHARE`` of each length."""
    x = F.col("x")

    def grams_of(q: int) -> F.Column:
        starts = F.sequence(F.lit(1), F.length(x) - (q - 1))
        # a short word has no grams of the greater lengths
        return F.when(F.length(x) >= q, F.transform(starts, lambda i: F.substring(x, i, F.lit(q)))).otherwise(
            F.array().cast("array<string>"))

    of = [grams_of(q) for q in range(GRAM_MIN, GRAM_MAX + 1)]
    grams = words.select(_marked().alias("x")).select(F.explode(F.concat(*of)).alias("gram"))
    counts = stored(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram-counts")
    total = counts.groupBy(F.length("gram").alias("q")).agg(F.sum("n").alias("n"))  # one row for each length
    bound = {r.q: max(MIN_FREQ, r.n // GRAM_SHARE) for r in total.collect()}
    keep = F.lit(False)
    for q, least in bound.items():
        keep = keep | ((F.length("gram") == q) & (F.col("n") > least))
    out = {r.gram: r.n for r in counts.where(keep).collect()}
    delete_stored(counts)
    return out


def longest(short: int) -> int:
    """Longest gram for pairs whose shorter word has ``short`` characters."""
    return max(GRAM_MIN, min(GRAM_MAX, (short + 2) // 2))


def decompose(x: str, extended: dict | set, most: int) -> list[tuple[int, int]]:
    """Places (start, end) of the grams of a marked word."""
    out, done, m = [], 0, len(x)
    for p in range(m - GRAM_MIN + 1):
        e = p + GRAM_MIN
        while e < m and e - p < most and x[p:e] in extended:
            e += 1
        if e > done:
            out.append((p, e))
            done = e
    return out


def affected(grams: list[tuple[int, int]], most: int) -> int:
    """The most grams that one edit can change.

    A gram is found from its own characters alone, so one that does not span
    the edit is found again.  A new gram at or before an edit of place i ends
    at i + ``most`` at the latest, so it can cover grams that end there, not
    others.  So the grams that may change end in (i, i + most].
    """
    ends, worst, first = [e for _, e in grams], 0, 0
    for k, e in enumerate(ends):
        while ends[first] <= e - most:
            first += 1
        worst = max(worst, k - first + 1)
    return worst


def signature(x: str, known: dict[str, int], most: int) -> list[tuple[int, int]]:
    """The rarest grams of a marked word, one more than an edit can change, with all their places."""
    grams = decompose(x, known, most)
    order = sorted((known.get(x[p:e], 0), x[p:e], p, e) for p, e in grams)
    last = order[affected(grams, most)][:2]
    return [(p, e) for n, g, p, e in order if (n, g) <= last]


def postings(words: DataFrame, known: dict[str, int], min_length: int) -> DataFrame:
    """``(key, longer, word, n)``: each word under the grams of its signatures."""
    def emit(batches):
        for b in batches:
            for at in range(0, len(b), 4096):
                t = b.iloc[at:at + 4096]
                short, side, place, piece, own = [], [], [], [], []
                for k, w in enumerate(t["word"].tolist()):
                    x, found = f"^{w}$", {}
                    for ln in (len(w), len(w) - 1):
                        if ln < min_length:
                            continue
                        most = longest(ln)
                        if most not in found:
                            found[most] = signature(x, known, most)
                        for p, e in found[most]:
                            short += (ln, ln)
                            side += (0, 1)
                            place += (p, e - p)
                            piece += (x[:e], x[p:])  # the word up to the gram's end, and from its start on
                            own += (k, k)
                own = np.array(own, np.int64)
                yield pd.DataFrame({"short": short, "side": side, "place": place, "piece": piece,
                                    "word": t["word"].to_numpy()[own], "n": t["n"].to_numpy()[own]})

    t = words.select("word", "n").mapInPandas(
        emit, "short int, side int, place int, piece string, word string, n long")
    return t.select(F.xxhash64("short", "side", "place", "piece").alias("key"),
                    (F.length("word") > F.col("short")).alias("longer"), "word", "n")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``words(word, n)`` distinct -> ``(word, n, near, near_n)``, each pair once in either direction."""
    if min_length < GRAM_MIN:
        raise ValueError(f"words need {GRAM_MIN} characters at least")
    lists = stored(postings(words, frequent_grams(words), min_length), "gram-lists")
    a = lists.where("NOT longer").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = lists.select("key", "longer", F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = a.join(b, "key").where((F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    # a pair that shares several grams is found under each
    pairs = pairs.select("a", "a_n", "b", "b_n").distinct()
    both = F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    return pairs.select(F.inline(both))


def roots(links: DataFrame) -> DataFrame:
    """``links(word, form)`` without cycles -> ``(word, root)``: the last of each chain, by doubling."""
    cur = stored(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = cur.select(F.col("word").alias("__via"), F.col("root").alias("__next"))
        new = stored(cur.join(on, F.col("root") == F.col("__via"), "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("__moved")), "variant-roots")
        delete_stored(cur)
        cur = new.drop("__moved")
        if not new.where("__moved").take(1):
            return cur


def variants(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``words(word, n)`` distinct -> ``(word, n, n_near, form, form_n, root)``."""
    words = stored(words.select("word", "n"), "spelling-words")
    best = near_words(words, min_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best"))
    t = words.join(best, "word", "left")
    far = F.coalesce(-F.col("best.down") >= F.col("n") * TIMES, F.lit(False))
    t = stored(t.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                        F.when(far, F.col("best.near")).alias("form"),
                        F.when(far, -F.col("best.down")).alias("form_n")), "spelling-forms")
    r = roots(t.where("form IS NOT NULL"))
    return t.join(r, "word", "left").withColumn("root", F.coalesce("root", "word"))


def query(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(word_counts(docs, change=lossy)).select("word", "form", "root", "n", "n_near", "form_n")
