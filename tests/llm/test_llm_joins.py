"""SimHash, decontamination, neighbours, URL filters, audit and chat views against brute force."""

import hashlib
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.llm import ann as AN
from logwarden.llm import chat_perspectives as CH
from logwarden.llm import decontaminate as DC
from logwarden.llm import simhash as SH
from logwarden.llm import url_filter as UF
from logwarden.llm import warc_audit as WA
from logwarden.llm.common import connected_components, ordered_positions, stored

from .helpers import oracle_equal


@pytest.mark.parametrize("name", ["op2_warc_audit", "op3_chat_perspectives", "op9_url_filter", "op10_decontaminate"])
def test_queries_equal_their_sql(spark, sf, name):
    assert oracle_equal(spark, sf, name)


# ---- shared helpers

def test_positions_number_every_row_in_order(spark):
    rows = [(k % 3 or None, k % 2) for k in range(500)]
    t = ordered_positions(spark.createDataFrame(rows, "k int, v int"), ["k", "v"], "t").collect()
    t.sort(key=lambda r: r["__pos"])
    assert [r["__pos"] for r in t] == list(range(500))
    key = lambda r: (r.k is not None, r.k or 0, r.v)
    assert [key(r) for r in t] == sorted(key(r) for r in t)


def union_find(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(300, 360)] + [
        (400, k) for k in range(401, 440)]
    want = union_find(440, pairs)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: want[x] for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- SimHash

def plain_fingerprint(text):
    import xxhash

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints(messy):
    texts = [r.text for r in messy.collect()] + ["one", "a b", "É A Z", "x\x0by\x0cz w v", "w " * 70_000]
    assert [SH.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_thresholds_cover_every_pair():
    rng = np.random.default_rng(0)
    p, corr = np.full(64, 0.5), np.zeros((64, 64))
    for n in (10, 10_000, 10**7, 10**10):
        parts = SH.allocate(n, p, corr, rng.integers(0, 1 << 63, 64, dtype=np.uint64))
        assert sum(t + 1 for _, t in parts) == SH.MAX_BITS + 1
        bits = [b for g, _ in parts for b in g]
        assert len(bits) == len(set(bits))
    # more fingerprints: fewer, wider partitions
    width = [min(len(g) for g, _ in SH.allocate(n, p, corr, np.zeros(0, np.uint64))) for n in (10**4, 10**10)]
    assert width[0] < width[1]


@pytest.mark.parametrize("hot,parts", [(10**9, None), (4, None), (10**9, [(range(32), 1), (range(32, 64), 2)]),
                                       (3, [(range(20), 0), (range(20, 42), 1), (range(42, 64), 1)])])
def test_links_connect_all_near_fingerprints(spark, hot, parts):
    rng = random.Random(5)
    fps = set()
    for _ in range(40):  # families that spread a few bits at a time, and lone ones
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 8])):
            fps.add(f)
            for b in rng.sample(range(64), rng.randrange(6)):
                f ^= 1 << b
    fps = sorted(fps)
    a = np.array(fps, np.uint64)
    df = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long")
    parts = [(list(g), t) for g, t in parts] if parts else SH.plan_partitions(df)
    got = SH.fingerprint_links(df, parts, hot=hot).collect()
    place = {int(x): i for i, x in enumerate(a.view(np.int64))}
    near = [(i, j) for i in range(len(a)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
    assert all(bin(fps[place[r.a]] ^ fps[place[r.b]]).count("1") <= 4 for r in got)
    assert union_find(len(a), [(place[r.a], place[r.b]) for r in got]) == union_find(len(a), near)


def brute_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    uf = union_find(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4])
    ids: dict = {}
    for r, (i, _) in zip(uf, rows, strict=True):
        if i is not None:
            ids[r] = min(ids.get(r, i), i)
    return sorted(((i, f"{f:016x}", ids.get(r)) for r, (i, _), f in zip(uf, rows, fps, strict=True)), key=str)


def test_near_duplicates_equal_brute_force(spark, messy, sf):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    got = SH.near_duplicates(messy).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in SH.query(spark, sf).collect()), key=str) == brute_components(rows)
    assert SH.near_duplicates(messy.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark, messy):
    kept = SH.keep_one(messy)
    assert kept.columns == messy.columns
    rows = kept.collect()
    groups = brute_components([(r.doc_id, r.text) for r in messy.collect()])
    with_id = {c for _, _, c in groups if c is not None}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(with_id)
    # of a group without any id one row stays as well
    assert sum(r.doc_id is None for r in rows) == len({f for i, f, c in groups if c is None})
    assert SH.keep_one(messy.limit(0)).count() == 0


# ---- decontamination

def test_masks_catch_every_placement():
    assert DC.covers_all(DC.MASKS, DC.WINDOW, DC.MAX_SUBSTITUTIONS)
    assert not DC.covers_all(("1" * 13,), 13, 1)
    assert max(len(m) for m in DC.MASKS) <= DC.WINDOW


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_overlaps(docs, bench):
    items: dict = {}
    for i, t in bench:
        w = tuple(words(t))
        if i is not None:
            items[w] = min(items.get(w, i), i)
    out = {}
    for d, t in docs:
        w = words(t)
        for v, item in items.items():
            for shift in range(-len(v), len(w)):
                lo, hi = max(0, shift), min(len(w), shift + len(v))
                eq = [w[q] == v[q - shift] for q in range(lo, hi)]
                for s in range(len(eq) - 12):
                    n = sum(eq[s:s + 13])
                    if n >= 11:
                        a, b = out.get((d, item), (0, 1 << 60))
                        out[d, item] = (max(a, n), min(b, lo + s))
    return {(d, i, n, f) for (d, i), (n, f) in out.items()}


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([5, 12, 13, 14, 30])))) for k in range(14)]
    items += [(50, items[6][1]), (None, items[7][1]), (51, None), (52, "")]
    docs = [(k, " ".join(rng.choices(vocab, k=rng.randrange(0, 60)))) for k in range(40)]
    for k in range(60):  # passages with some words replaced, at either end or inside
        w = rng.choice(items)[1]
        w = (w or "").split()
        for at in rng.sample(range(len(w)), min(len(w), rng.randrange(5))):
            w[at] = rng.choice(vocab)
        docs.append((100 + k, " ".join(rng.choices(vocab, k=rng.randrange(4)) + w[rng.randrange(3):] + rng.choices(vocab, k=2))))
    docs += [(300, None), (301, ""), (302, docs[45][1]), (302, docs[45][1]), (None, docs[46][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)).withColumn("pos", F.lit(2))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in DC.contaminated(d, b).collect()}
    assert got == brute_overlaps(docs, items) and len(got) > 20
    clean = DC.drop_contaminated(d, b)
    bad = {(x[0]) for x in got}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, _ in docs if i not in bad)
    assert clean.columns == d.columns
    assert DC.contaminated(d.limit(0), b).count() == 0 and DC.contaminated(d, b.limit(0)).count() == 0
    assert DC.drop_contaminated(d, b.limit(0)).count() == len(docs)


def test_items_without_id_are_benchmark_texts(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(15)) for c in "xy")
    items = spark.createDataFrame([(None, one), (None, one + " more"), (7, two)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {one} b"), (2, f"{two} {one}"), (3, "clean " * 20), (4, two)], "doc_id long, text string")
    got = sorted((tuple(r) for r in DC.contaminated(docs, items).collect()), key=str)
    assert got == sorted([(1, None, 13, 1), (2, 7, 13, 0), (2, None, 13, 15), (4, 7, 13, 0)], key=str)
    assert [r.doc_id for r in DC.drop_contaminated(docs, items).collect()] == [3]


def test_query_reports_items_without_id(spark, tmp_path):
    """Only an item without id matches document 1; the query and its SQL report it."""
    import duckdb

    passage = " ".join(f"p{k}" for k in range(20))
    spark.createDataFrame([(None, passage), (None, passage + " q"), (3, " ".join(f"z{k}" for k in range(14)))],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, f"so {passage} on"), (2, "nothing of the kind")],
                          "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for t in ("benchmark", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    rows = [tuple(r) for r in DC.query(spark, str(tmp_path)).collect()]
    assert rows == [(1, None, 13, 1)] == con.sql(DC.ORACLE).fetchall()


def test_native_operators_run_no_python(spark, sf):
    for make in (lambda: DC.query(spark, sf), lambda: UF.query(spark, sf), lambda: CH.query(spark, sf)):
        plan = make()._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|ArrowEval", plan)


# ---- neighbours

def brute_nearest(rows, is_query, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v
          and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = {}
    for q, v in ok:
        if is_query(q):
            c = sorted(((-float(v @ w), i) for i, w in ok if i != q))
            out[q] = [(i, -s) for s, i in c[:k]]
    return out


def test_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((3000, 24))
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    got: dict = {}
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in AN.nearest(t, lambda i: i % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_nearest(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want)
    hits = [len({x[1] for x in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.95
    for q, x in got.items():
        assert [r for r, *_ in sorted(x)] == list(range(1, 21))
        assert all(abs(s - float(v[q] @ v[i])) < 1e-12 for _, i, s in x)


def test_descent_runs_until_the_lists_settle(spark):
    rng = np.random.default_rng(8)
    v = rng.standard_normal((12_000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    t = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "node long, vec array<double>")
    nodes = stored(t.mapInPandas(AN._coded(v.mean(0)), AN.NODES), "nodes")
    got = {r.node: {x.b for x in r.nbrs} for r in AN.nn_descent(nodes, 64).collect()}
    some = range(0, 12_000, 40)
    sims = v[some] @ v.T
    sims[np.arange(len(some)), some] = -np.inf
    true = np.argpartition(-sims, 31, axis=1)[:, :32]
    assert np.mean([len(got[i] & set(w.tolist())) / 32 for i, w in zip(some, true, strict=True)]) > 0.82


@pytest.mark.parametrize("unit", [True, False])
def test_neighbours_within_a_group_of_near_copies(spark, unit):
    rng = np.random.default_rng(9)
    v = np.concatenate([rng.standard_normal((1000, 32)), rng.standard_normal(32) * (1 + 0.003 * rng.standard_normal((4000, 32)))])
    v = (v / np.linalg.norm(v, axis=1)[:, None] if unit else v).astype(np.float32)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    got: dict = {}
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for r in AN.nearest(t, lambda i: i % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_nearest(rows, lambda i: i % 50 == 0, 20)
    assert set(got) == set(want)
    assert np.mean([len(got[q] & {i for i, _ in x}) / 20 for q, x in want.items() if q >= 1000]) >= 0.9


def test_no_round_leaves_shuffle_files_behind(spark, monkeypatch):
    rng = np.random.default_rng(11)
    t = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rng.standard_normal((1500, 16)))],
                              "vec_id long, embedding array<double>")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in disk.getAllFiles().mkString("\n").splitlines() if f.endswith(".data")}
    before, left = shuffled(), []

    def held():
        return sum(os.path.getsize(f) for f in shuffled() - before if os.path.exists(f))

    def watched(df, name):
        out = stored(df, name)
        # the search keeps the adjacency, which its first hop makes
        most = 1000 + max((n for x, n in left if x == "search"), default=0)
        for _ in range(30):  # executors delete files soon after a step, not within it
            if held() <= most:
                break
            time.sleep(0.1)
        left.append((name, held()))
        return out

    monkeypatch.setattr(AN, "stored", watched)
    conf = {name: spark.conf.get(name, None) for name in AN.SETTINGS}
    found = AN.nearest(t, lambda i: i % 20 == 0)
    assert {name: spark.conf.get(name, None) for name in AN.SETTINGS} == conf
    assert sum(name.startswith("graph") for name, _ in left) > 2
    assert all(n <= 1000 for name, n in left if name != "search")
    hops = [n for name, n in left if name == "search"]
    # every list of 33 vectors once, and little else
    assert len(hops) > 3 and hops[0] <= 1000 and max(hops) <= hops[1] + 10_000 < 1.5 * 1500 * 33 * 16 * 8
    assert found.count() == 75 * 20


def test_no_entry_of_a_list_becomes_a_row(spark, monkeypatch):
    rng = np.random.default_rng(12)
    t = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rng.standard_normal((1500, 16)))],
                              "vec_id long, embedding array<double>")
    rounds = []

    def watched(df, name):
        if re.match(r"graph-[1-9]|search", name):
            rounds.append((name, df.count(), df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(AN, "stored", watched)
    assert AN.nearest(t, lambda i: i % 20 == 0).count() == 75 * 20
    assert {name for name, *_ in rounds} > {"graph-1", "graph-2", "search"}
    rounds.remove(next(x for x in rounds if x[0] == "search"))  # what the search begins with
    # joining, ranking or collecting entries as rows took most of the time
    assert not any(re.search("Join|Window|Generate|Aggregate|Pandas", plan) for *_, plan in rounds)
    assert all(rows <= 75 if name == "search" else rows <= 8 for name, rows, _ in rounds)


def test_best_entries_of_a_place():
    rng = np.random.default_rng(13)
    for low, high in ((0, 50), (-1 << 62, 1 << 62), (0, 1 << 48)):  # ids that fit into one number with their place, and others
        n = 3000
        a, old = rng.integers(0, 40, n), rng.integers(0, 2, n).astype(np.uint8)
        b, sim = rng.integers(low, high, 300)[rng.integers(0, 300, n)], np.round(rng.random(n), 2)
        best: dict = {}
        for i, j, s, o in zip(a.tolist(), b.tolist(), sim.tolist(), old.tolist(), strict=True):
            x = best.setdefault(i, {}).get(j, (-1, 0))
            best[i][j] = max(x[0], s), max(x[1], o)
        want = [(i, j, s, o) for i in range(40) for j, (s, o) in sorted(best[i].items(), key=lambda x: (-x[1][0], x[0]))[:5]]
        assert [tuple(x) for x in zip(*[x.tolist() for x in AN._best_entries(a, b, sim, 5, old)], strict=True)] == want


def test_neighbours_of_any_ids(spark):
    rng = np.random.default_rng(14)
    ids = [int(x) for x in rng.integers(-1 << 62, 1 << 62, 600)] + [-1, 0, (1 << 63) - 1, -1 << 63]
    rows = [(i, [float(x) for x in r]) for i, r in zip(ids, rng.standard_normal((len(ids), 12)), strict=True)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute_nearest(rows, lambda i: i % 20 == 0, 20)
    got: dict = {}
    for r in AN.nearest(t, lambda i: F.pmod(i, F.lit(20)) == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    assert got == {q: [(i, round(s, 9)) for i, s in x] for q, x in want.items()}


def test_neighbours_edges(spark):
    rng = np.random.default_rng(6)
    base = [[float(x) for x in r] for r in rng.standard_normal((60, 8))]
    rows = list(enumerate(base)) + [(100 + k, base[0]) for k in range(60)]  # one vector that half of the rows share
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] + base[1][1:]), (260, [float("inf")] + base[1][1:]),
             (280, [None] + base[1][1:]), (300, [1.0]), (None, base[2]), (40, base[40])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("x"))
    seen = list(dict.fromkeys((i, tuple(v) if v else None) for i, v in rows if v is None or len(v) == 8))
    want = brute_nearest(seen, lambda i: i % 20 == 0, 20)
    got: dict = {}
    for r in AN.nearest(t, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    assert got == {q: [(i, round(s, 9)) for i, s in x] for q, x in want.items()}
    few = AN.nearest(t.where("vec_id < 5"), lambda i: i % 20 == 0).collect()
    assert len(few) == 4
    assert AN.nearest(t.limit(0), lambda i: i % 20 == 0).count() == 0


# ---- URL filters

def test_url_edges(spark):
    urls = [None, "", "no scheme/en/", "http://", "HTTP://WWW.Example.COM/en/x?q=/", "http://example.com/en", "http://a.b.example.com/en/#f",
            "https://x.net/es/a", "https://net/fr/", "ftp://notexample.com/en/", "http://www.example.com?x://y/", "x://com/\n/z",
            "http://" + "a." * 2000 + "net" + "/es" + "/p" * 3000, "http://example.com//en/", "http://.com/", "http://example.com./en/"]
    t = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(1, ""), (None, urls[4])], "page_id long, url string")
    t = t.withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    got = UF.judge_urls(t, UF.rules_frame(spark)).collect()

    def plain(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [(len(h + p), h + p, v) for h, p, v in UF.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    want = sorted(str((r.page_id, *plain(r.url))) for r in t.collect())
    assert sorted(str(tuple(r)) for r in got) == want
    none = UF.judge_urls(t, UF.rules_frame(spark).limit(0)).collect()
    assert len(none) == len(want) and {r.verdict for r in none} == {"allow"}
    assert UF.judge_urls(t.limit(0), UF.rules_frame(spark)).count() == 0


def test_url_rules_may_end_anywhere(spark):
    rules = UF.rules_frame(spark, (("a.com", "/x/ab", "block"), ("a.com", "", "allow"), ("a.com", "/x/ab", "allow"), ("B.org", "/", "block")))
    t = spark.createDataFrame([(1, "h://a.com/x/abc"), (2, "h://a.com/x/a"), (3, "h://a.com"), (4, "h://s.b.org/"), (5, "h://b.org")],
                              "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in UF.judge_urls(t, rules).collect()}
    assert got == {1: ("a.com/x/ab", "block"), 2: ("a.com", "allow"), 3: ("a.com", "allow"), 4: ("b.org/", "block"), 5: (None, "allow")}


# ---- audit

def test_merkle_roots_equal_a_plain_tree(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "é" * (i % 7)) for i in range(40)] + [(None, None, None), (3, "http://x/3", "é" * 3)],
                                  "page_id long, url string, html string").withColumn("hash", F.lit("x"))
    cat = WA.warc_records(pages)
    leaves = cat.orderBy("volume", "record").collect()
    assert [r.record for r in leaves] == list(range(42)) and leaves[0].page_id is None
    assert all(a.end == b.start for a, b in zip(leaves, leaves[1:], strict=False))
    hashes = [r.leaf for r in leaves]
    body = "é" * 3
    rec = (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/3\r\nContent-Type: text/html\r\n"
           f"Content-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n").encode()
    assert hashlib.sha256(b"\0" + rec).hexdigest() in hashes
    nodes = [(r.start, r.end, r.leaf) for r in leaves]
    for _ in range(WA.LEVELS):
        runs = [nodes[k:k + WA.FANOUT] for k in range(0, len(nodes), WA.FANOUT)]
        nodes = [(run[0][0], run[-1][1], hashlib.sha256(b"\1" + ",".join(
            f"{n * WA.FANOUT + j}:{s}:{e}:{h}" for j, (s, e, h) in enumerate(run)).encode()).hexdigest()) for n, run in enumerate(runs)]
    roots = WA.merkle_tree(cat).where(F.col("level") == WA.LEVELS).collect()
    assert [(r.start, r.end, r.hash) for r in roots] == nodes


def test_moved_and_extra_records_change_the_root_and_are_found(spark):
    """By descent alone: the trees differ, and no record is looked for outside them."""
    pages = spark.createDataFrame([(i, f"u{i}", "b" * i) for i in range(70)], "page_id long, url string, html string")
    cat = WA.warc_records(pages)
    good = cat.select("volume", "record", "start", "end", "leaf")
    root = lambda r: [x.hash for x in WA.merkle_tree(cat, r).where(F.col("level") == WA.LEVELS).orderBy("volume", "node").collect()]
    want = root(None)
    assert root(good) == want and root(good.select("volume", "record", "leaf")) == want
    shift = lambda cond: good.withColumns({c: F.when(cond, F.col(c) + 100).otherwise(F.col(c)) for c in ("start", "end")})
    new = spark.sql("SELECT 0L AS volume, 70 AS record, 9000L AS start, 9100L AS end, 'new' AS leaf")
    far = spark.sql("SELECT 0L AS volume, 5000 AS record, 9000L AS start, 9100L AS end, 'new' AS leaf")
    other = spark.sql("SELECT 7L AS volume, 0 AS record, 0L AS start, 10L AS end, 'new' AS leaf")
    for replica, found in ((shift(F.lit(True)), {(0, r, "moved") for r in range(70)}), (shift(F.col("record") == 33), {(0, 33, "moved")}),
                           (good.unionAll(new), {(0, 70, "extra")}), (good.unionAll(far), {(0, 5000, "extra")}),
                           (good.unionAll(other), {(7, 0, "extra")}), (good.where("record <> 69"), {(0, 69, "missing")})):
        assert root(replica) != want
        a, b = WA.merkle_tree(cat), WA.merkle_tree(cat, replica)
        assert {(r.volume, r.record) for r in WA.audit(a, b).collect()} == {x[:2] for x in found}
        assert {(r.volume, r.record, r.damage) for r in WA.fixity_report(cat, replica).collect()} == found


def test_audit_finds_every_kind_of_damage(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "b" * i) for i in range(50)], "page_id long, url string, html string")
    cat = WA.warc_records(pages)
    good = cat.select("volume", "record", "leaf")
    assert WA.fixity_report(cat, good).count() == 0
    bad = good.where("record <> 7").withColumn("leaf", F.when(F.col("record") == 21, "corrupt").otherwise(F.col("leaf")))
    bad = bad.unionAll(good.where("record = 30").withColumn("leaf", F.lit("other"))).unionAll(good.where("record = 31"))
    bad = bad.unionAll(spark.sql("SELECT 0L AS volume, 999 AS record, 'new' AS leaf"))
    got = {(r.record, r.damage) for r in WA.fixity_report(cat, bad).collect()}
    assert got == {(7, "missing"), (21, "corrupt"), (30, "conflict"), (999, "extra")}
    none = WA.warc_records(pages.limit(0))
    assert WA.fixity_report(none, none.select("volume", "record", "leaf")).count() == 0


# ---- chat

def render(turns, me):
    out, mask = "", []
    for speaker, text in turns:
        name = "".join({" ": "_"}.get(c, f"%{ord(c):02X}" if c in "%_\t\n\x0b\f\r" else c) for c in speaker).replace("<|", "< |")
        head = "assistant" if speaker == me else "system" if speaker == "system" else f"user name={name}" if speaker else "user"
        out += f"<|im_start|>{head}\n"
        at = len(out)
        out += text.replace("<|", "< |") + "<|im_end|>"
        if speaker == me:
            mask.append((at, len(out)))
        out += "\n"
    return out, mask


def test_different_speakers_have_different_names(spark):
    names = ["a b", "a_b", "a  b", "a\tb", "a%5Fb", "a%b", "unknown", "user", "a<|b", "a< |b", "a\nb", None]
    t = spark.createDataFrame([(1, k, s, "hi") for k, s in enumerate(["me", *names])], "conv_id long, turn long, role string, text string")
    view = CH.perspectives(t).where("perspective = 'me'").first().text
    heads = re.findall(r"<\|im_start\|>(.*)\n", view)
    assert heads[0] == "assistant" and heads[-1] == "user"
    assert len(set(heads)) == len(heads) == len(names) + 1


def test_views_of_long_and_odd_dialogues(spark):
    rng = random.Random(1)
    talk = [(1, k, rng.choice(["ann", "bob", "system"]), f"turn {k} é <|im_start|>") for k in range(150)]
    odd = [(2, 0, "ann lee", "x"), (2, 0, "ann lee", "x"), (2, None, None, None), (2, 1, " ", "anonymous"), (3, 0, "system", "alone"),
           (None, 0, "zoe", "no conversation")]
    t = spark.createDataFrame(talk + odd, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(9))
    got: dict = {}
    for r in CH.perspectives(t).orderBy("part").collect():
        got.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(got) == {(1, "ann"), (1, "bob"), (2, "ann lee"), (None, "zoe")}
    for me in ("ann", "bob"):
        parts = got[1, me]
        assert [p.n_turns for p in parts] == [64, 64, 22]
        turns = [(s, x) for _, _, s, x in talk]
        assert "".join(p.text for p in parts) == render(turns, me)[0]
        for k, p in enumerate(parts):
            text, mask = render(turns[64 * k:64 * k + 64], me)
            assert (p.text, [tuple(m) for m in p.mask], p.n_masked) == (text, mask, sum(e - s for s, e in mask))
    assert got[2, "ann lee"][0].text == render([("", ""), ("ann lee", "x"), ("ann lee", "x"), ("", "anonymous")], "ann lee")[0]
    assert CH.perspectives(t.limit(0)).count() == 0
