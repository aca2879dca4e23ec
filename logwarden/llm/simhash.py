"""SimHash near-duplicates: generalised pigeonhole over unequal bit partitions.

A document's 64-bit SimHash sums the bits of XXH64 (seed 42) over its 4-word
shingles.  Two fingerprints within ``MAX_BITS`` bits are linked; documents
that reach each other over links form a component.

Candidate search.  The 64 bits are grouped into partitions, correlated bits
together.  If every partition i gets a threshold T_i and the T_i + 1 add up
to MAX_BITS + 1, any linked pair differs in at most T_i bits of some
partition i.  Dynamic programming picks the thresholds (-1 skips a
partition) with the least estimated cost in probe rows and candidate pairs;
the number of partitions with the least total is taken, so more documents
lead to fewer, wider partitions.  The estimates read bit statistics of all
distinct fingerprints and the agreement of a bounded, documented number of
them; they steer cost only, never the result.

A fingerprint probes each partition's values within T_i bits.  All that
share (partition, value) are verified together, by blocks of numbers.  Of
the links found in a bucket only a spanning forest is written: connectivity
is whole, rows never exceed the bucket's size.  Buckets above ``HOT_BUCKET``
are split again by the plain pigeonhole on the other bits, which again loses
no pair.

Cases: null and empty texts, and texts of white space, have fingerprint
zero and link like any other.  A null id takes no part in the smallest id;
a component of null ids alone has none.  Repeated rows stay rows.  An empty
table gives no rows.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, read, row_key, stored, whole_text

#: words of a shingle, bits that linked fingerprints may differ in
SHINGLE, MAX_BITS = 4, 4
#: fingerprints (smallest hashes) whose pairs estimate how often partitions agree
ESTIMATE_SAMPLE = 4096
#: cost of one probe row in candidate comparisons
PROBE_COST = 40.0
#: values a fingerprint may probe in one partition; a threshold that needs more is not considered
MAX_PROBES = 2000
#: fingerprints in one bucket above which it is split by further bits
HOT_BUCKET = 50_000
_ONE = np.uint64(1)


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    import xxhash

    w = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(w) - words + 1)
    last = ends[words - 1:] if len(w) >= words else ends[-1:]
    h64 = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    pairs = zip(starts[:n].tolist(), last.tolist(), strict=True)
    while True:  # a bounded number of shingles at a time, whatever the text's length
        block = [h64(joined[s:e], 42) for s, e in islice(pairs, 1 << 16)]
        if not block:
            break
        bits = np.unpackbits(np.array(block, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(0, dtype=np.int64)
        if len(block) < 1 << 16:
            break
    on = np.nonzero(2 * set_bits > n)[0].astype(np.uint64)
    return int((_ONE << on).sum(dtype=np.uint64)) if len(on) else 0


def with_fingerprint(docs: DataFrame, text_col: str = "text", to: str = "__fp", words: int = SHINGLE) -> DataFrame:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(to, F.pandas_udf(run, "long")(whole_text(text_col)))


# --- partitions and thresholds -------------------------------------------------

def _bit_counts(batches):
    both = np.zeros((64, 64), np.int64)
    for b in batches:
        bits = np.unpackbits(b["fp"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little").astype(np.float64)
        both += (bits.T @ bits).astype(np.int64)
    i, j = np.nonzero(both)
    yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "n": both[i, j]})


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """Partitions of near-equal width; each grows by the bit most correlated with it."""
    left, groups = set(range(64)), []
    for g in range(m):
        width = 64 // m + (g < 64 % m)
        rest = sorted(left)
        sub = corr[np.ix_(rest, rest)]
        group = [rest[int(sub.sum(1).argmax())]]
        while len(group) < width:
            rest = sorted(left - set(group))
            group.append(rest[int(corr[np.ix_(rest, group)].sum(1).argmax())])
        left -= set(group)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _agreement(group: list[int], p: np.ndarray, sample: np.ndarray, top: int) -> np.ndarray:
    """P(two fingerprints differ in at most t bits of the group), t = 0..top."""
    dist = np.zeros(len(group) + 1)
    dist[0] = 1.0
    for b in group:  # bits as if independent
        q = 2 * p[b] * (1 - p[b])
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    model = np.cumsum(dist)[: top + 1]
    if len(sample) < 2:
        return model
    s = sample & np.uint64(_mask(group))
    seen = np.zeros(top + 1)
    for k in range(0, len(s), 256):
        d = np.bitwise_count(s[k:k + 256, None] ^ s[None, :])
        seen += [(d <= t).sum() for t in range(top + 1)]
    pairs = len(s) * (len(s) - 1)
    return np.maximum(model, (seen - len(s)) / pairs)


def _ball(width: int, t: int) -> float:
    from math import comb

    # for one bit only fingerprints with the bit unset probe
    return 0.0 if t < 0 else 1.0 + (0 if t < 1 else width / 2) + sum(comb(width, k) for k in range(2, t + 1))


def allocate(n: int, p: np.ndarray, corr: np.ndarray, sample: np.ndarray,
             max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of each probed partition, of least estimated cost."""
    best = None
    for m in range(2, max_bits + 3):
        groups = group_bits(corr, m)
        costs = []
        for g in groups:
            agree = _agreement(g, p, sample, max_bits)
            balls = [_ball(len(g), t) for t in range(max_bits + 1)]
            costs.append([0.0] + [np.inf if balls[t] > MAX_PROBES else PROBE_COST * n * balls[t] + 0.5 * n * n * agree[t] * (1 + t)
                                  for t in range(max_bits + 1)])
        # least[b]: cheapest way to spend b = sum of (T_i + 1) on the partitions so far
        least = [(0.0, [])] + [(np.inf, [])] * (max_bits + 1)
        for c in costs:
            least = [min(((least[b - s][0] + c[s], [*least[b - s][1], s - 1]) for s in range(b + 1)),
                         key=lambda x: x[0]) for b in range(max_bits + 2)]
        cost, ts = least[max_bits + 1]
        if best is None or cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, ts, strict=True) if t >= 0])
    return best[1]


def plan_partitions(fps: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """Bit statistics of all distinct fingerprints (4,096 sums at most), then the allocation."""
    c = fps.mapInPandas(_bit_counts, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((64, 64))
    for r in c:
        both[r["i"], r["j"]] = r["n"]
    n = max(fps.count(), 1)
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / n - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    rows = fps.orderBy(F.xxhash64("fp"), "fp").limit(ESTIMATE_SAMPLE).collect()
    sample = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
    return allocate(n, p, corr, sample, max_bits)


# --- probing and verifying -----------------------------------------------------

def _flips(bits: list[int], t: int):
    from itertools import combinations

    return [_mask(list(c)) for k in range(2, t + 1) for c in combinations(bits, k)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def probes(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """``(part, value, fp)``: each fingerprint under its own value and under those it probes."""
    fp, out = F.col("fp"), []
    for i, (bits, t) in enumerate(parts):
        mask = F.lit(_signed(_mask(bits)))
        # -1 marks "no probe": a pair differing in one bit meets where the unset side sets it
        one = [F.when(fp.bitwiseAND(F.lit(_signed(1 << b))) == 0, fp.bitwiseXOR(F.lit(_signed(1 << b))).bitwiseAND(mask))
               for b in bits] if t >= 1 else []
        more = [fp.bitwiseXOR(F.lit(_signed(f))).bitwiseAND(mask) for f in _flips(bits, t)]
        values = F.filter(F.array(fp.bitwiseAND(mask), *one, *more), lambda v: v.isNotNull())
        out.append(F.transform(values, lambda v: F.struct(F.lit(i).alias("part"), v.alias("value"))))
    return fps.select("fp", F.inline(F.concat(*out))).select("part", "value", "fp")


def _split_hot(rows: DataFrame, parts, max_bits: int) -> DataFrame:
    """Rows of over-full buckets, each under max_bits + 1 keys of the bits outside its partition."""
    arms = None
    for i, (bits, _) in enumerate(parts):
        rest = [b for b in range(64) if b not in set(bits)]
        cut = [rest[k::max_bits + 1] for k in range(max_bits + 1)]  # agree on one of these at least
        keys = F.array(*[F.struct(F.lit(k + 1).alias("sub"), F.col("fp").bitwiseAND(
            F.lit(_signed(_mask(c)))).alias("subvalue")) for k, c in enumerate(cut)])
        arms = F.when(F.col("part") == i, keys) if arms is None else arms.when(F.col("part") == i, keys)
    return rows.select("part", "value", F.inline(arms), "fp")


def _forest(g: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints, breadth first."""
    left, out = np.ones(len(g), bool), []
    order = np.arange(len(g))
    for start in range(len(g)):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            at = queue.pop()
            rest = order[left]
            if not len(rest):
                return out
            near = rest[np.bitwise_count(g[rest] ^ g[at]) <= max_bits]
            left[near] = False
            out += [(at, k) for k in near.tolist()]
            queue += near.tolist()
    return out


def _links(max_bits: int):
    def emit(g: np.ndarray):
        g = np.unique(g)
        if len(g) < 2:
            return np.zeros((0, 2), np.uint64)
        if len(g) <= 2048 and not (np.bitwise_count(g[:, None] ^ g[None, :]) <= max_bits).sum() > len(g):
            return np.zeros((0, 2), np.uint64)
        e = np.array(_forest(g, max_bits), np.int64).reshape(-1, 2)
        return g[e]

    def run(batches):
        held, key = [], None
        for b in batches:
            k = np.stack([b[c].to_numpy() for c in ("part", "value", "sub", "subvalue")], 1)
            fp = b["fp"].to_numpy().astype(np.int64).view(np.uint64)
            cuts = np.concatenate([[0], np.nonzero((k[1:] != k[:-1]).any(1))[0] + 1, [len(fp)]])
            found = []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if s == e:
                    continue
                if key is not None and (k[s] == key).all():
                    held.append(fp[s:e])
                    continue
                if key is not None and (len(held) > 1 or len(held[0]) > 1):
                    found.append(emit(np.concatenate(held)))
                held, key = [fp[s:e]], k[s]
            if found:
                yield _frame(found)
        if key is not None:
            yield _frame([emit(np.concatenate(held))])

    def _frame(found):
        e = np.concatenate(found).view(np.int64)
        return pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})

    return run


def fingerprint_links(fps: DataFrame, parts, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """``fps(fp)`` distinct -> links ``(a, b)`` that connect all within ``max_bits`` bits."""
    rows = probes(fps, parts)
    full = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
    full = stored(full.select("part", "value", F.lit(True).alias("hot")), "hot-buckets")
    rows = rows.join(full, ["part", "value"], "left")
    cold = rows.where("hot IS NULL").select("part", "value", F.lit(0).alias("sub"), F.lit(0).cast("long").alias("subvalue"), "fp")
    rows = cold.unionAll(_split_hot(rows.where("hot"), parts, max_bits))
    key = ["part", "value", "sub", "subvalue"]
    return rows.repartition(*key).sortWithinPartitions(*key).mapInPandas(_links(max_bits), "a long, b long").distinct()


def components(fp_rows: DataFrame, id_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp_rows(id, __fp)`` -> ``(fp, component)``: the smallest id reachable from each fingerprint."""
    ids = stored(fp_rows.groupBy(F.col("__fp").alias("fp")).agg(F.min(id_col).alias("least")), "fingerprints")
    fps = ids.select("fp")
    links = fingerprint_links(fps, plan_partitions(fps, max_bits), max_bits)
    roots = connected_components(links)
    ids = ids.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    low = ids.groupBy("root").agg(F.min("least").alias("component"))
    return ids.join(low, "root").select("fp", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document row: ``id, fingerprint, component_id``."""
    t = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    t = stored(with_fingerprint(t, "__text", words=words).drop("__text"), "doc-fingerprints")
    c = components(t, "__id", max_bits)
    # a plain left join: where one fingerprint holds a large share of the rows, AQE splits that partition
    out = t.join(c, F.col("__fp") == F.col("fp"), "left")
    return out.select(F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: that of the smallest id (nulls last), then of the smallest row key."""
    t = docs.select(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                             row_key(id_col, text_col).alias("key")).alias("__row"), F.col(text_col).alias("__text"))
    t = stored(with_fingerprint(t, "__text", words=words).drop("__text"), "doc-fingerprints")
    keep = components(t, "__row", max_bits).select(F.col("component.key").alias("__key")).distinct()
    out = docs.withColumn("__key", row_key(id_col, text_col)).join(keep, "__key", "left_semi")
    return out.dropDuplicates(["__key"]).drop("__key")  # same partitioning as the join: no further shuffle


def query(spark, sf_dir) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
