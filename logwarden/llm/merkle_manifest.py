"""Merkle manifest of a table: one tree per group, one tree over the groups, a proof for every row.

A row's leaf is the SHA-256 of its fields; the leaves of a group, ordered by
id, form a tree of runs of ``ARITY`` nodes, and the groups' roots, in order
of the group, form one more such tree.  Whoever holds the root can check one
row from its fields and its proof, the siblings on the way up.

Method (cogrouped subtree exchange).  A *superblock* is up to ``ARITY ** LEVELS``
neighbouring nodes, so ``LEVELS`` levels of the tree.  Upwards, every superblock is
reduced to its top node, and these nodes are the next, that much smaller
stage, until each tree has one node.  Downwards, a stage's nodes and the
outer nodes that their superblock needs (one row: the siblings from the
superblock's top to the root) are cogrouped by superblock; one
``applyInPandas`` finishes the local reduction, joins local and outer proof,
and folds.  So no call ever holds more than one superblock and one path,
whatever the size of a group, and texts never leave the scan.

Positions come from a distributed sort: a row's place in its range partition
plus the rows that earlier partitions hold of its group, so a group of any
size spreads over many tasks.

Cases: null fields are leaves' ``-``, apart from the empty text's ``0:``.
Null ids come first in their group, null groups are a group of their own,
first in the order.  Rows of equal id are ordered by leaf; equal rows are
separate leaves, and a lone row's leaf is its group's root.  An empty table
gives no rows.  Columns that are not named do not enter a leaf.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, stored

#: nodes that become one; levels of a superblock
ARITY, LEVELS = 3, 6
#: what a row of a manifest is made of
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "__tree string, __pos long, __n long, __hash string"
_PATH = "__tree string, __block long, __top string, __root string, __left array<string>, __right array<string>"


def leaf_digest(fields: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields: ``-`` if null, else byte count, colon and value."""
    parts = []
    for c in fields:
        v = c.cast("string")
        parts.append(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts), 256)


def _digest(nodes) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def _reduced(hashes: list[str], size: int, rise: int) -> list[list[str]]:
    """The levels of a superblock of a tree of ``size`` nodes at this stage, from the given nodes to its top."""
    levels = [hashes]
    # a tree that fits into one superblock ends with its single node; else every superblock rises as many levels
    while len(levels) <= rise if size > ARITY ** rise else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_digest(last[k:k + ARITY]) for k in range(0, len(last), ARITY)])
    return levels


def _siblings(levels: list[list[str]]) -> list[tuple[list[str], list[str]]]:
    """For each level below the top: the joined siblings on the left and on the right of every node."""
    out = []
    for nodes in levels[:-1]:
        left, right = [], []
        for k in range(len(nodes)):
            first = k - k % ARITY
            left.append("".join(nodes[first:k]))
            right.append("".join(nodes[k + 1:first + ARITY]))
        out.append((left, right))
    return out


def _path(siblings, k: int) -> tuple[list[str], list[str]]:
    """Siblings of the k-th node of a superblock, level by level."""
    left, right = [], []
    for at_left, at_right in siblings:
        left.append(at_left[k])
        right.append(at_right[k])
        k //= ARITY
    return left, right


def _blocks(nodes: DataFrame, rise: int):
    """The nodes grouped by superblock."""
    return nodes.withColumn("__block", F.expr(f"__pos div {ARITY ** rise}")).groupBy("__tree", "__block")


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with ``__tree`` -> written rows with their place ``__pos`` in it by ``order`` and its size ``__n``."""
    # the row number spreads equal rows over several range partitions
    t = rows.withColumn("__tie", F.monotonically_increasing_id())
    t = t.repartitionByRange("__tree", *order, "__tie").sortWithinPartitions("__tree", *order, "__tie").drop("__tie")
    t = stored(t.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__idx", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), name)
    parts = t.groupBy("__tree", "__pid").agg(F.count(F.lit(1)).alias("__own"), F.min("__idx").alias("__first"))
    tree = Window.partitionBy("__tree")  # at most one row for each range partition
    before = tree.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__tree", "__pid", "__first", F.coalesce(F.sum("__own").over(before), F.lit(0)).alias("__base"),
                         F.sum("__own").over(tree).alias("__n"))
    # the key holds the range partition, so a group of any size is joined in pieces
    return t.join(parts, ["__tree", "__pid"]).withColumn(
        "__pos", F.col("__base") + F.col("__idx") - F.col("__first")).drop("__pid", "__idx", "__first", "__base")


def _raised(nodes: DataFrame, rise: int) -> DataFrame:
    """The next stage: one node for each superblock."""
    def top(key, t):
        size = int(t["__n"].iloc[0])
        hashes = t.sort_values("__pos")["__hash"].tolist()
        return pd.DataFrame({"__tree": [key[0]], "__pos": [key[1]], "__n": [-(-size // ARITY ** rise)],
                             "__hash": [_reduced(hashes, size, rise)[-1][0]]})

    return _blocks(nodes.select("__tree", "__pos", "__n", "__hash"), rise).applyInPandas(top, _NODE)


def _stages(leaves: DataFrame, rise: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The nodes of each stage, and after each stage the trees (and roots) that it completes."""
    stages, done, cur = [leaves], [], leaves
    while True:
        up = stored(_raised(cur, rise), "manifest-nodes")
        done.append(up.where("__n = 1").select("__tree", F.col("__hash").alias("__top")))
        cur = up.where("__n > 1")
        if not cur.take(1):
            return stages, done
        stages.append(cur)


def _outer(done: DataFrame, above: DataFrame, inner: DataFrame | None) -> DataFrame:
    """Paths by superblock of one stage: from the next stage's nodes, or from above for trees that end here."""
    out = done.join(above, "__tree").select("__tree", F.lit(0).cast("long").alias("__block"), "__top", "__root", "__left", "__right")
    return out if inner is None else out.unionAll(inner)


def _descend(stages: list[DataFrame], done: list[DataFrame], above: DataFrame, rise: int) -> DataFrame:
    """The paths that the superblocks of the lowest stage need; ``above(__tree, __root, __left, __right)`` is a tree's own."""
    def paths(key, nodes, outer):
        nodes, up = nodes.sort_values("__pos"), outer.iloc[0]
        siblings = _siblings(_reduced(nodes["__hash"].tolist(), int(nodes["__n"].iloc[0]), rise))
        own = [_path(siblings, k) for k in range(len(nodes))]
        return pd.DataFrame({"__tree": key[0], "__block": nodes["__pos"], "__top": up["__top"], "__root": up["__root"],
                             "__left": [x + list(up["__left"]) for x, _ in own],
                             "__right": [x + list(up["__right"]) for _, x in own]})

    inner = None
    for k in range(len(stages) - 1, 0, -1):
        outer = _outer(done[k], above, inner).groupBy("__tree", "__block")
        inner = stored(_blocks(stages[k], rise).cogroup(outer).applyInPandas(paths, _PATH), "manifest-paths")
    return _outer(done[0], above, inner)


def _proved(leaves: DataFrame, outer: DataFrame, rise: int) -> DataFrame:
    """Leaves and the outer nodes of their superblocks -> proof and fold of every leaf."""
    def finish(key, t, outer):
        t, up = t.sort_values("__pos"), outer.iloc[0]
        siblings = _siblings(_reduced(t["__hash"].tolist(), int(t["__n"].iloc[0]), rise))
        proofs, folds = [], []
        for k, node in enumerate(t["__received"].tolist()):
            left, right = _path(siblings, k)
            left, right = left + list(up["__left"]), right + list(up["__right"])
            proofs.append(_digest(x + y for x, y in zip(left, right, strict=True)))
            for x, y in zip(left, right, strict=True):
                node = _digest((x, node, y))
            folds.append(node)
        return pd.DataFrame({"__id": t["__id"], "leaf": t["__hash"], "subroot": up["__top"], "root": up["__root"],
                             "proof_sha256": proofs, "folded_root": folds, "verified": [x == up["__root"] for x in folds]})

    schema = "__id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _blocks(leaves, rise).cogroup(outer.groupBy("__tree", "__block")).applyInPandas(finish, schema)


def manifest(docs: DataFrame, received: dict[str, Column] | None = None, fields=FIELDS, id_col: str = "doc_id",
             group_col: str = "source", levels: int = LEVELS) -> DataFrame:
    """One row per row: ``id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Leaves, roots and proofs are those of ``docs``; ``received`` gives fields
    as a reader got them, from which ``folded_root`` is computed with the
    original siblings and compared with the root.  A superblock rises
    ``levels`` levels; the result does not depend on it.
    """
    cols = [F.col(c) for c in fields]
    got = [(received or {}).get(c, F.col(c)) for c in fields]
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        # sorts as null first, then bytewise
        F.when(group.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), group)).alias("__tree"),
        F.col(id_col).alias("__order"), F.col(id_col).cast("string").alias("__id"),
        leaf_digest(cols).alias("__hash"), leaf_digest(got).alias("__received"))
    leaves = stored(placed(leaves, ["__order", "__hash"], "manifest-order").drop("__order"), "manifest-leaves")
    stages, done = _stages(leaves, levels)
    groups = done[0]
    for d in done[1:]:
        groups = groups.unionAll(d)
    # the tree over the groups' roots: the same, with one tree
    g = placed(groups.select(F.lit("root").alias("__tree"), F.col("__tree").alias("__group"), F.col("__top").alias("__hash")),
               ["__group"], "manifest-groups")
    g = stored(g, "manifest-group-nodes")
    g_stages, g_done = _stages(g, levels)
    root = g_done[-1].select("__tree", F.col("__top").alias("__root"), *[
        F.array().cast("array<string>").alias(c) for c in ("__left", "__right")])
    above = stored(_group_paths(g, _descend(g_stages, g_done, root, levels), levels), "manifest-group-paths")
    out = _proved(leaves, _descend(stages, done, above, levels), levels)
    return out.withColumn("__id", F.col("__id").cast(docs.schema[id_col].dataType)).withColumnRenamed("__id", id_col)


def _group_paths(groups: DataFrame, outer: DataFrame, rise: int) -> DataFrame:
    """The path from each group's root to the root: ``(__tree, __root, __left, __right)``."""
    def paths(key, nodes, outer):
        nodes, up = nodes.sort_values("__pos"), outer.iloc[0]
        siblings = _siblings(_reduced(nodes["__hash"].tolist(), int(nodes["__n"].iloc[0]), rise))
        own = [_path(siblings, k) for k in range(len(nodes))]
        return pd.DataFrame({"__tree": nodes["__group"], "__root": up["__root"],
                             "__left": [x + list(up["__left"]) for x, _ in own],
                             "__right": [x + list(up["__right"]) for _, x in own]})

    return _blocks(groups, rise).cogroup(outer.groupBy("__tree", "__block")).applyInPandas(
        paths, "__tree string, __root string, __left array<string>, __right array<string>")


def tampered_text(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text as the registered query's reader gets it: without line feeds for even CRCs of the id."""
    odd = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 != 0
    return F.when(F.coalesce(odd, F.lit(True)), F.col(text_col)).otherwise(F.replace(F.col(text_col), F.lit("\n"), F.lit("")))


def query(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*FIELDS)
    return manifest(docs, {"text": tampered_text()})


#: levels that the SQL spells out: enough for 3**16 rows a group
_SQL_LEVELS = 16


def _sql_field(c: str) -> str:
    v = f"CAST({c} AS VARCHAR)"
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({v}) || ':' || {v} END"


def _sql_tree(name: str) -> str:
    """Levels ``<name>0`` (tree, pos, h) upwards; ``run`` holds a node's children where it has any."""
    out = []
    for k in range(1, _SQL_LEVELS + 1):
        out.append(f"""{name}{k} AS MATERIALIZED (
  SELECT tree, pos // 3 AS pos, CASE WHEN any_value(m) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h,
    CASE WHEN any_value(m) > 1 THEN list(h ORDER BY pos) END AS run
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM {name}{k - 1}) GROUP BY tree, pos // 3)""")
    return ",\n".join(out)


def _sql_fold(name: str, tree: str) -> str:
    """Rows ``<name>0`` (id, tree, pos, f, proof, ...) folded through the levels of ``tree``."""
    out = []
    for k in range(1, _SQL_LEVELS + 1):
        left, right = "array_to_string(run[1:r.pos % 3], '')", "array_to_string(run[r.pos % 3 + 2:], '')"
        out.append(f"""{name}{k} AS MATERIALIZED (
  SELECT r.id, r.src, r.leaf, r.tree, r.pos // 3 AS pos,
    CASE WHEN run IS NULL THEN r.f ELSE sha256({left} || r.f || {right}) END AS f,
    CASE WHEN run IS NULL THEN r.proof ELSE r.proof || {left} || {right} END AS proof
  FROM {name}{k - 1} r JOIN {tree}{k} t ON t.tree = r.tree AND t.pos = r.pos // 3)""")
    return ",\n".join(out)


_CRC = """list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))"""

ORACLE = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id AS id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS src,
    sha256({" || ".join(_sql_field(c) for c in FIELDS)}) AS leaf,
    CASE WHEN xor({_CRC}, 4294967295) % 2 = 0
      THEN sha256({" || ".join(_sql_field(c) for c in FIELDS if c != "text")} || {_sql_field("replace(text, chr(10), '')")})
      ELSE sha256({" || ".join(_sql_field(c) for c in FIELDS)}) END AS f
  FROM documents),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY src ORDER BY id NULLS FIRST, leaf) - 1 AS pos FROM d),
a0 AS (SELECT src AS tree, pos, leaf AS h FROM o),
{_sql_tree("a")},
b0 AS (SELECT 'root' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, tree AS src FROM a{_SQL_LEVELS}),
{_sql_tree("b")},
r0 AS (SELECT id, src, leaf, src AS tree, pos, f, '' AS proof FROM o),
{_sql_fold("r", "a")},
q0 AS (SELECT r.id, r.src, r.leaf, 'root' AS tree, b.pos, r.f, r.proof FROM r{_SQL_LEVELS} r JOIN b0 b ON b.src = r.src),
{_sql_fold("q", "b")}
SELECT q.id AS doc_id, q.leaf, s.h AS subroot, t.h AS root, sha256(q.proof) AS proof_sha256, q.f AS folded_root, q.f = t.h AS verified
FROM q{_SQL_LEVELS} q JOIN b0 s ON s.src = q.src CROSS JOIN b{_SQL_LEVELS} t
"""
