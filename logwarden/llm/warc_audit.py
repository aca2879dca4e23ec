"""WARC fixity audit: Merkle trees over records and ordered offset ranges.

``warc_records`` renders pages as WARC/1.0 response records in ordered
volumes of ``VOLUME_RECORDS`` records; the catalogue gives every record its
volume, number and byte range.  A replica is a set of records with their
volume and number, and the byte ranges they have there.

``merkle_tree`` hashes a replica: a leaf is the SHA-256 of 0x00 and the
record's bytes; a node covers up to ``FANOUT`` consecutive nodes, so an
ordered byte range of the volume, and is the SHA-256 of 0x01 and, for each
child, its number, its byte range and its hash.  So a record at another
offset changes the root like another content.  A catalogued record that the
replica lost is a leaf ``missing``, and a record that the catalogue does not
know is a leaf of the replica's tree.  Each level is one aggregation over a
FANOUT-th of the rows of the level below, and no group is larger than FANOUT.

``audit`` compares the roots of the volumes of two replicas and descends
only into children of nodes that differ: each level joins the two trees'
nodes under the differing parents alone, down to the damaged records.  All
damage is found this way.

Cases: pages are ordered by id (nulls first), then URL and content; repeated
rows are repeated records, null URL or content is empty.  A replica without
byte ranges is read at the catalogue's.  Damage is ``missing``, ``extra`` (not
in the catalogue), ``conflict`` (two unequal records at one place), ``corrupt``
(other content) or ``moved`` (same content, other byte range).  Empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ordered_positions, read, stored, whole_text

#: children of a node; levels below a volume's root
FANOUT, LEVELS = 16, 3
VOLUME_RECORDS = FANOUT ** LEVELS
# --- fixed values: the header of a rendered record ---
HEADER = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nContent-Type: text/html\r\n"
          "Content-Length: {length}\r\n\r\n")
TRAILER = "\r\n\r\n"
# --- end of fixed values ---


def record_bytes(url: Column, content: Column) -> Column:
    """A WARC response record as binary."""
    head, rest = HEADER.split("{url}")
    middle, tail = rest.split("{length}")
    return F.encode(F.concat(F.lit(head), url, F.lit(middle), F.octet_length(content).cast("string"), F.lit(tail),
                             content, F.lit(TRAILER)), "UTF-8")


def leaf_hash(record: Column) -> Column:
    return F.sha2(F.concat(F.unhex(F.lit("00")), record), 256)


def warc_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", content_col: str = "html") -> DataFrame:
    """The catalogue: ``page_id, volume, record, start, end, leaf`` of every record; contents are not moved."""
    rec = record_bytes(whole_text(url_col), whole_text(content_col))
    t = pages.select(F.col(id_col).alias("page_id"), F.xxhash64(whole_text(url_col)).alias("__url"),
                     F.octet_length(rec).cast("long").alias("__size"), leaf_hash(rec).alias("leaf"))
    t = ordered_positions(t, ["page_id", "__url", "leaf"], "warc-order")
    t = t.select("page_id", F.floor(F.col("__pos") / VOLUME_RECORDS).cast("long").alias("volume"),
                 (F.col("__pos") % VOLUME_RECORDS).cast("int").alias("record"), "__size", "leaf")
    # a volume has a bounded number of records
    to_here = Window.partitionBy("volume").orderBy("record").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("end", F.sum("__size").over(to_here)).select(
        "page_id", "volume", "record", (F.col("end") - F.col("__size")).alias("start"), "end", "leaf")


def merkle_tree(catalogue: DataFrame, replica: DataFrame | None = None) -> DataFrame:
    """All nodes ``level, volume, node, start, end, hash``; level 0 is the records, level ``LEVELS`` the roots.

    ``replica(volume, record, leaf[, start, end])`` holds the leaf hashes of a
    copy; None is the catalogue itself.
    """
    c = catalogue.select("volume", F.col("record").alias("node"), "start", "end", "leaf")
    if replica is not None:
        own = F.struct(*([F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")] if "start" in replica.columns else [
            F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end")]), "leaf")
        r = replica.groupBy("volume", F.col("record").alias("node")).agg(
            F.min(own).alias("r"), (F.min(own) != F.max(own)).alias("conflict"))
        c = c.withColumnsRenamed({"start": "c_start", "end": "c_end"}).drop("leaf").join(r, ["volume", "node"], "full_outer").select(
            "volume", "node", F.coalesce("r.start", "c_start").alias("start"), F.coalesce("r.end", "c_end").alias("end"),
            F.when(F.col("conflict"), "conflict").otherwise(F.col("r.leaf")).alias("leaf"))
    level = c.select(F.lit(0).alias("level"), "volume", "node", "start", "end",
                     F.coalesce("leaf", F.lit("missing")).alias("hash"))
    out = level
    place = lambda x: F.coalesce(x.cast("string"), F.lit("-"))
    for k in range(1, LEVELS + 1):
        kids = F.sort_array(F.collect_list(F.struct("node", "start", "end", "hash")))
        joined = F.array_join(F.transform(kids, lambda x: F.concat_ws(
            ":", x["node"].cast("string"), place(x["start"]), place(x["end"]), x["hash"])), ",")
        level = level.groupBy("volume", F.floor(F.col("node") / FANOUT).cast("int").alias("parent")).agg(
            F.min("start").alias("start"), F.max("end").alias("end"),
            F.sha2(F.concat(F.unhex(F.lit("01")), F.encode(joined, "UTF-8")), 256).alias("hash")).select(
            F.lit(k).alias("level"), "volume", F.col("parent").alias("node"), "start", "end", "hash")
        out = out.unionAll(level)
    return out


def audit(tree_a: DataFrame, tree_b: DataFrame) -> DataFrame:
    """Records in which the replicas differ: ``volume, record, start, end, hash_a, hash_b`` (and ``start_b``, ``end_b``).

    A hash is null where a tree has no such record.
    """
    def pairs(level: int, parents: DataFrame | None) -> DataFrame:
        a, b = (t.where(F.col("level") == level) for t in (tree_a, tree_b))
        if parents is not None:
            up = parents.select("volume", F.col("node").alias("parent"))

            def below(t):
                return t.withColumn("parent", F.floor(F.col("node") / FANOUT).cast("int")).join(
                    up, ["volume", "parent"], "left_semi").drop("parent")

            a, b = below(a), below(b)
        b = b.select("volume", "node", F.col("start").alias("start_b"), F.col("end").alias("end_b"), F.col("hash").alias("hash_b"))
        j = a.withColumnRenamed("hash", "hash_a").join(b, ["volume", "node"], "full_outer")
        same = F.lit(True)
        for x, y in (("hash_a", "hash_b"), ("start", "start_b"), ("end", "end_b")):
            same = same & F.col(x).eqNullSafe(F.col(y))
        return j.where(~same)

    differ = None
    for level in range(LEVELS, -1, -1):
        differ = pairs(level, differ)
        if level:
            differ = stored(differ, f"differing-{level}")  # small: read by the next level's two sides
    return differ.select("volume", F.col("node").alias("record"), "start", "end", "hash_a", "hash_b", "start_b", "end_b")


# --- fixed values: the damage of the second replica of the registered query, by page id ---
FLIPPED, CUT, LOST = (211, 3), (389, 7), (577, 11)
# --- end of fixed values ---


def damaged_replica(pages: DataFrame, places: DataFrame) -> DataFrame:
    """A second copy of the pages with planted damage, under the catalogue's places.

    Records of some ids have one character changed, of some the end cut off,
    and some are lost.
    """
    hit = lambda rule: F.coalesce(F.pmod("page_id", F.lit(rule[0])) == rule[1], F.lit(False))
    html = whole_text("html")
    kept = F.when(hit(FLIPPED), F.concat(F.lit("\x01"), html)).when(hit(CUT), F.substring(html, F.lit(1), F.length(html) - 10)).otherwise(html)
    rec = record_bytes(whole_text("url"), whole_text("html"))
    copy = record_bytes(whole_text("url"), kept)
    b = pages.where(~hit(LOST)).select("page_id", leaf_hash(rec).alias("leaf"), leaf_hash(copy).alias("__copy"))
    b = b.groupBy("page_id", "leaf").agg(F.first("__copy").alias("__copy"))  # repeated rows are equal copies
    p = places.select("page_id", "volume", "record", "leaf")
    b = b.select(F.col("page_id").alias("__page"), F.col("leaf").alias("__leaf"), "__copy")
    return p.join(b, p["page_id"].eqNullSafe(b["__page"]) & (p["leaf"] == b["__leaf"])).select(
        "volume", "record", F.col("__copy").alias("leaf"))


def fixity_report(catalogue: DataFrame, replica: DataFrame) -> DataFrame:
    """Damaged records of a replica with page id, place, hashes and kind of damage."""
    a = stored(merkle_tree(catalogue), "tree-a")
    b = stored(merkle_tree(catalogue, replica), "tree-b")
    d = audit(a, b)
    kind = (F.when(F.col("hash_a").isNull(), "extra").when(F.col("hash_b") == "missing", "missing").when(F.col("hash_b") == "conflict", "conflict")
            .when(F.col("hash_a") == F.col("hash_b"), "moved").otherwise("corrupt"))
    pages = catalogue.select("volume", "record", "page_id")
    return d.join(pages, ["volume", "record"], "left").select(
        "page_id", "volume", "record", F.coalesce("start", "start_b").alias("start"), F.coalesce("end", "end_b").alias("end"),
        "hash_a", "hash_b", kind.alias("damage"))


_REC = """'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
  || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen({h})
  || chr(13) || chr(10) || chr(13) || chr(10) || {h} || chr(13) || chr(10) || chr(13) || chr(10)"""

ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url, row_number() OVER (ORDER BY page_id) - 1 AS pos FROM pages),
c AS (
  SELECT page_id, pos // {VOLUME_RECORDS} AS volume, pos % {VOLUME_RECORDS} AS record, html, url,
    CASE WHEN page_id % {FLIPPED[0]} = {FLIPPED[1]} THEN chr(1) || html
         WHEN page_id % {CUT[0]} = {CUT[1]} THEN substr(html, 1, length(html) - 10) ELSE html END AS copy FROM p),
s AS (SELECT *, {_REC.format(h='html')} AS rec, {_REC.format(h='copy')} AS rec2 FROM c),
o AS (SELECT *, CAST(sum(strlen(rec)) OVER (PARTITION BY volume ORDER BY record) AS BIGINT) AS "end",
        sha256('\\x00'::BLOB || encode(rec)) AS hash_a,
        CASE WHEN page_id % {LOST[0]} = {LOST[1]} THEN 'missing' ELSE sha256('\\x00'::BLOB || encode(rec2)) END AS hash_b FROM s)
SELECT page_id, CAST(volume AS BIGINT) AS volume, CAST(record AS INTEGER) AS record, "end" - strlen(rec) AS start, "end",
  hash_a, hash_b, CASE WHEN hash_b = 'missing' THEN 'missing' ELSE 'corrupt' END AS damage
FROM o WHERE hash_a <> hash_b
"""


def query(spark, sf_dir) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    catalogue = stored(warc_records(pages), "catalogue")
    return fixity_report(catalogue, stored(damaged_replica(pages, catalogue), "replica"))
