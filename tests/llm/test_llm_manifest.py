"""The Merkle manifest against a plain recursive tree and its SQL."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from logwarden.llm import merkle_manifest as MM

from .helpers import oracle_equal

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(x):
    return sha256(x.encode()).hexdigest()


def leaf(r, text):
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Root of the nodes, and for every node its siblings on the way up as (left, right)."""
    paths, at, cur = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(cur) > 1:
        for k, p in enumerate(at):
            first = p - p % 3
            paths[k].append((cur[first:p], cur[p + 1:first + 3]))
            at[k] = p // 3
        cur = [digest("".join(cur[k:k + 3])) for k in range(0, len(cur), 3)]
    return cur[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        r = r.asDict()
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, above = climb([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above, strict=True):
        for (_, _, own, r), path in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            node = leaf(r, r["text"].replace("\n", "") if even and r["text"] is not None else r["text"])
            path = path + up
            for left, right in path:
                node = digest("".join([*left, node, *right]))
            out.append((r["doc_id"], own, trees[s][0], root, digest("".join("".join(a + b) for a, b in path)), node, node == root))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()], key=str)


def apply(docs, **more):
    return MM.manifest(docs, {"text": MM.tampered_text()}, **more)


def test_query_equals_its_sql(spark, sf):
    assert oracle_equal(spark, sf, "op13_merkle_manifest")


@pytest.mark.parametrize("levels", [1, 6])
def test_groups_of_many_sizes(spark, levels):
    """Lone rows, sizes at and around powers of three, a hot group; superblocks of 3 and 729."""
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 9, "f": 10, "g": 27, "h": 28, "é": 5, "": 2, None: 11, "hot": 260}
    rows = [(10 * k + n, f"line\n{k}\n" * (n % 3), None if n % 4 == 0 else "en", s, n % 5 or None)
            for k, (s, size) in enumerate(sizes.items()) for n in range(size)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(apply(docs, levels=levels)) == brute(docs.collect())


def test_superblock_boundary(spark):
    rows = [(k, f"t{k}\n", "en", "s" if k < 1500 else "t", k) for k in range(1500 + 729)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(apply(docs)) == brute(docs.collect())


def test_nulls_repeats_and_clashing_names(spark, messy):
    assert got(apply(messy)) == brute(messy.select("doc_id", "text", "lang", "source", "n_chars").collect())
    tagged = messy.withColumnsRenamed({"a": "__tree", "b": "__hash", "seed": "__pos", "item": "leaf"})
    assert got(apply(tagged)) == got(apply(messy))


def test_empty_table(spark):
    assert apply(spark.createDataFrame([], SCHEMA)).collect() == []


def test_null_and_empty_fields_differ(spark):
    rows = [(1, None, "", "s", 0), (2, "", None, "s", None)]
    leaves = {r.doc_id: r.leaf for r in apply(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert leaves == {1: digest("1:11:s0:1:0-"), 2: digest("1:21:s--0:")}


def test_only_changed_rows_fail(spark):
    docs = spark.createDataFrame([(k, f"text {k}", "en", f"s{k % 3}", k) for k in range(40)], SCHEMA)
    changed = F.when(F.col("doc_id") == 7, F.lit("other")).otherwise(F.col("text"))
    assert [r.doc_id for r in MM.manifest(docs, {"text": changed}).where("NOT verified").collect()] == [7]
    assert MM.manifest(docs).where("NOT verified").count() == 0
