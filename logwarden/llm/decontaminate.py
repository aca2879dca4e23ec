"""Benchmark decontamination: spaced-seed hashing, verified around each hit.

A document is contaminated by a benchmark item if, on some alignment of the
two word sequences, a window of ``WINDOW`` words agrees in at least 80 % of
its places: ``WINDOW - MAX_SUBSTITUTIONS`` equal words.

Seeds are fixed masks over word positions that ignore some places.  The
masks are chosen so that whichever ``MAX_SUBSTITUTIONS`` places of a window
differ, one mask lies inside the window and avoids them (a test checks every
placement).  So every contaminated window yields a seed hit, and the result
is exact, not a sample.

Plan, all DataFrame expressions: words -> 64-bit word hashes -> for every
mask the hash of every position.  A Bloom bitmap of the benchmark's seed
hashes (a constant of the query, of bounded size) lets almost no other
position through; what passes is joined with the benchmark's seeds on the
hash, carrying the word hashes around the position, so a hit is verified
where it is and no text is shuffled or read twice.

Words are runs of letters and digits, lower-cased.  Cases: null and empty
texts, and texts and items of fewer than ``WINDOW`` words, match nothing.
Items with the same words count as one, under their smallest id.  Items
without an id are benchmark texts like any other: a document that overlaps
some is reported once with a null item, and ``drop_contaminated`` drops it.
Documents that agree in the key columns are one.  Empty tables give no rows.
A passage that many items and many documents share is reported for each pair
of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, read, row_key, stored, whole_text

#: words of a window, and how many of them may differ (80 % agree)
WINDOW, MAX_SUBSTITUTIONS = 13, 2
# --- fixed values: the masks, 1 = the word counts ---
MASKS = ("11101011", "110100111")
# --- end of fixed values ---

WORD_PATTERN = r"[\p{L}\p{N}]+"
#: 64-bit words of the Bloom bitmap per benchmark seed, and at most in all (8 MB)
BITMAP_WORDS_PER_SEED, MAX_BITMAP_WORDS = 2, 1 << 20
#: benchmark seeds (each with some 300 bytes around it) sent to every task at most; beyond, the join shuffles
BROADCAST_SEEDS = 500_000


def offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def covers_all(masks, window: int, substitutions: int) -> bool:
    """Whether every placement of the substitutions leaves some mask a clean place in the window."""
    from itertools import combinations

    for bad in combinations(range(window), substitutions):
        if not any(not any(s + o in bad for o in offsets(m)) for m in masks for s in range(window - len(m) + 1)):
            return False
    return True


def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0)), lambda w: F.xxhash64(w))


def _seed_hash(k: int, mask: str, words: Column, i: Column) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, i + F.lit(o)) for o in offsets(mask)])


def _around(words: Column, i: Column, mask: str) -> tuple[Column, Column]:
    """The word hashes a window over the seed can reach, and the seed's place among them."""
    reach = WINDOW - len(mask)
    start = F.greatest(i - F.lit(reach), F.lit(0))
    return F.slice(words, start + 1, F.lit(WINDOW + reach)), i - start


def _positions(words: Column, mask: str) -> Column:
    last = F.size(words) - F.lit(len(mask))
    return F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _seeds(t: DataFrame, id_cols: list[str], passes=None) -> DataFrame:
    """One row per seed: ``seed, mask, pos, at, words`` beside the id columns."""
    w, arms = F.col("__words"), []
    for k, mask in enumerate(MASKS):
        at = _positions(w, mask)
        if passes is not None:
            # the one-element array binds the hash, so it is computed once per position
            at = F.filter(at, lambda i: F.exists(F.array(_seed_hash(k, mask, w, i)), passes))

        def one(i):
            words, place = _around(w, i, mask)
            return F.struct(_seed_hash(k, mask, w, i).alias("seed"), F.lit(k).alias("mask"), i.alias("pos"),
                            place.alias("at"), words.alias("words"))

        arms.append(F.transform(at, one))
    return t.select(*id_cols, F.inline(F.concat(*arms)))


def _bitmap(seeds: DataFrame, n: int) -> tuple[Column, int]:
    """A constant array of 64-bit words with the bits of all seed hashes set, and its size."""
    words = min(MAX_BITMAP_WORDS, 1 << max(4, (n * BITMAP_WORDS_PER_SEED - 1).bit_length()))
    rows = seeds.select(_slot("seed", words).alias("slot"), _bit(F.col("seed")).alias("bit")).groupBy("slot").agg(
        F.bit_or("bit").alias("bits")).collect()  # at most MAX_BITMAP_WORDS small rows
    flat = [0] * words
    for r in rows:
        flat[r["slot"]] = r["bits"]
    # parsed once, when the plan is optimized
    return F.from_json(F.lit("[" + ",".join(map(str, flat)) + "]"), "array<bigint>"), words


def _slot(seed, words: int) -> Column:
    c = F.col(seed) if isinstance(seed, str) else seed
    return F.shiftrightunsigned(c, 12).bitwiseAND(F.lit(words - 1).cast("long")).cast("int")


def _bit(seed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), seed.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def benchmark_seeds(bench: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Seeds of the distinct items: ``item, seed, mask, ipos, iat, iwords``."""
    b = bench.select(F.col(id_col).alias("__item"), word_hashes(whole_text(text_col)).alias("__words"))
    b = b.groupBy("__words").agg(F.min("__item").alias("__item"))
    t = _seeds(fenced(b.select("__item", F.col("__words").alias("__w")), __words=F.col("__w")).drop("__w"), ["__item"])
    return t.select(F.col("__item").alias("item"), "seed", "mask", F.col("pos").alias("ipos"),
                    F.col("at").alias("iat"), F.col("words").alias("iwords"))


def overlaps(docs: DataFrame, bench: DataFrame, keys: dict[str, Column], text_col: str = "text") -> DataFrame:
    """``keys..., item, best_matches, first_word`` of every contaminated (document, item).

    ``best_matches`` is the largest number of equal words in a window,
    ``first_word`` the first document word of a window that qualifies.
    """
    seeds = stored(benchmark_seeds(bench), "benchmark-seeds")
    n = seeds.count()
    d = docs.select(*[c.alias(k) for k, c in keys.items()], whole_text(text_col).alias("__text"))
    if n:
        bitmap, words = _bitmap(seeds, n)

        def passes(h):
            return F.call_function("shiftright", F.get(bitmap, _slot(h, words)),
                                   h.bitwiseAND(F.lit(63).cast("long")).cast("int")).bitwiseAND(
                F.lit(1).cast("long")) == 1
    else:
        def passes(h):
            return F.lit(False)
    t = fenced(d, __words=word_hashes(F.col("__text"))).drop("__text")
    t = _seeds(t, list(keys), passes)
    seeds = F.broadcast(seeds) if n <= BROADCAST_SEEDS else seeds
    hits = t.join(seeds, ["seed", "mask"])
    # places relative to the seed: equal words, and the range that both sides have
    right = F.least(F.size("words") - F.col("at"), F.size("iwords") - F.col("iat")) - 1
    left = F.least("at", "iat")
    equal = F.transform(F.sequence(-left, right), lambda o: F.when(
        F.get("words", F.col("at") + o) == F.get("iwords", F.col("iat") + o), 1).otherwise(0))
    hits = fenced(hits, left=left, equal=equal).select(*keys, "item", "pos", "left", "equal")
    starts = F.when(F.size("equal") >= WINDOW, F.sequence(F.lit(0), F.size("equal") - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    windows = F.transform(starts, lambda s: F.struct(
        F.aggregate(F.slice("equal", s + 1, WINDOW), F.lit(0), lambda a, x: a + x).alias("n"), s.alias("s")))
    need = WINDOW - MAX_SUBSTITUTIONS
    good = F.filter(windows, lambda x: x["n"] >= need)
    out = fenced(hits, good=good).where(F.size("good") > 0)
    return out.groupBy(*keys, "item").agg(
        F.max(F.array_max(F.transform("good", lambda x: x["n"]))).alias("best_matches"),
        F.min(F.col("pos") - F.col("left") + F.array_min(F.transform("good", lambda x: x["s"]))).alias("first_word"))


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, item_id, best_matches, first_word`` of every contaminated document."""
    t = overlaps(docs, bench, {"__id": F.col(id_col)}, text_col)
    return t.select(F.col("__id").alias(id_col), F.col("item").alias("item_id"), "best_matches", "first_word")


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that overlap no benchmark item, with all their columns."""
    bad = overlaps(docs, bench, {"__key": row_key(id_col, text_col)}, text_col).select("__key").distinct()
    return docs.withColumn("__key", row_key(id_col, text_col)).join(bad, "__key", "left_anti").drop("__key")


def _windows_sql() -> str:
    # another method on purpose: a window with so few substitutions holds 4 equal words in a row
    need, w = WINDOW - MAX_SUBSTITUTIONS, WINDOW
    return f"""
WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+'), lambda x: hash(x)) AS w FROM documents),
b AS (SELECT min(item_id) AS item_id, row_number() OVER () AS k, w FROM (SELECT item_id, list_transform(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+'), lambda x: hash(x)) AS w
      FROM benchmark) GROUP BY w),
dg AS (SELECT doc_id, unnest(range(1, len(w) - 2)) AS p, w FROM d WHERE len(w) >= {w}),
bg AS (SELECT k, unnest(range(1, len(w) - 2)) AS p, w FROM b WHERE len(w) >= {w}),
dk AS (SELECT doc_id, p, hash(w[p], w[p+1], w[p+2], w[p+3]) AS g FROM dg),
bk AS (SELECT k, p, hash(w[p], w[p+1], w[p+2], w[p+3]) AS g FROM bg),
diag AS (SELECT DISTINCT dk.doc_id, bk.k, dk.p - bk.p AS shift FROM dk JOIN bk ON dk.g = bk.g),
al AS (SELECT x.doc_id, b.item_id, x.shift, greatest(1, 1 + x.shift) AS lo, least(len(d.w), len(b.w) + x.shift) AS hi, d.w AS dw, b.w AS bw
       FROM diag x JOIN d ON d.doc_id = x.doc_id JOIN b ON b.k = x.k),
eq AS (SELECT doc_id, item_id, lo, list_transform(range(lo, hi + 1), lambda q: CASE WHEN dw[q] = bw[q - shift] THEN 1 ELSE 0 END) AS e FROM al WHERE hi - lo + 1 >= {w}),
win AS (SELECT doc_id, item_id, lo + s - 2 AS first_word, list_sum(e[s:s + {w - 1}]) AS n
        FROM (SELECT doc_id, item_id, lo, e, unnest(range(1, len(e) - {w - 2})) AS s FROM eq))
SELECT doc_id, item_id, CAST(max(n) AS INTEGER) AS best_matches, CAST(min(first_word) AS INTEGER) AS first_word
FROM win WHERE n >= {need} GROUP BY doc_id, item_id
"""


ORACLE = _windows_sql()


def query(spark, sf_dir) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
