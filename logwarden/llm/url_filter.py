"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes.

Every rule ``(host, path, verdict)`` is keyed by the SHA-256 of its host and
of its path up to the last ``/``.  Every URL is expanded into the
expressions a rule that fits it could have: each suffix of its host at a
dot, joined with each prefix of its path that ends in ``/`` (and the empty
one).  URL expressions and rules meet in an equi-join on the first four
bytes of the digest; a meeting counts only if the full digests are equal and
the URL's path starts with the rule's whole path.  The longest fitting rule
(host plus path; then the longer host) decides.

Only as many labels and path parts are expanded as the deepest rule has: a
deeper expression can fit no rule, so nothing is lost, and a URL of a
thousand dots costs no more than the rule list is deep.

Cases: a null URL or one without ``://`` has an empty host and path and fits
no rule but one with an empty host.  Repeated rows stay rows.  A rule given
twice with different verdicts blocks.  Rules with a null host, path or
verdict are left out.  An empty page table gives no rows, an empty rule
table gives every URL the default verdict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# --- fixed values: the rule list of the registered query (host, path, verdict) ---
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# --- end of fixed values ---

DEFAULT_VERDICT = "allow"
#: up to so many rules (counted, with texts of bounded digests) are sent to every task; beyond, the join shuffles
BROADCAST_RULES = 200_000


def rules_frame(spark, rules=RULES) -> DataFrame:
    rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("host", "path", "verdict"), strict=True)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def url_parts(url) -> tuple:
    """``(host, path)`` columns of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host, path):
    # the length keeps ("ab", "c") and ("a", "bc") apart
    return F.sha2(F.concat_ws("|", F.length(host).cast("string"), host, path), 256)


def _short(digest):
    return F.substring(digest, 1, 8)


def _keyed_rules(rules: DataFrame) -> DataFrame:
    folder = F.regexp_extract("__rpath", r"(?s)^(.*/)?", 1)  # up to the last slash; may be empty
    r = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        ascii_lower(F.col("host")).alias("__rhost"), F.col("path").alias("__rpath"),
        F.col("verdict").alias("__rverdict"))
    # of one rule with two verdicts the stricter stays
    r = r.groupBy("__rhost", "__rpath").agg(F.max("__rverdict").alias("__rverdict"))
    return r.withColumn("__rfolder", folder).withColumn(
        "__rdigest", _digest(F.col("__rhost"), F.col("__rfolder"))).withColumn(
        "__rshort", _short(F.col("__rdigest")))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages(id, url)`` -> ``id, host, path, rule, verdict``, one row per page row."""
    r = _keyed_rules(rules)
    depth = r.agg(F.count(F.lit(1)).alias("n"),
                  F.max(F.size(F.split("__rhost", r"\."))).alias("labels"),
                  F.max(F.size(F.split("__rfolder", "/"))).alias("folders"),
                  F.max(F.length("__rhost") + F.length("__rpath")).alias("chars")).first()
    host, path = url_parts(F.col("__url"))
    u = pages.select(F.col(id_col).alias("__id"), F.col(url_col).cast("string").alias("__url"))
    u = u.withColumns({"__host": host, "__path": path, "__row": F.monotonically_increasing_id()}).drop("__url")
    if not depth["n"]:
        return u.select(F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"),
                        F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # host suffixes: the last 1..labels labels; path prefixes: '' and the first 1..folders parts
    labels, parts = F.split("__host", r"\."), F.split("__path", "/")
    n_labels = F.least(F.size(labels), F.lit(depth["labels"]))
    n_parts = F.least(F.size(parts), F.lit(depth["folders"]))
    suffixes = F.transform(F.sequence(F.lit(1), n_labels), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    prefixes = F.transform(F.sequence(F.lit(0), n_parts - 1), lambda k: F.when(k == 0, F.lit("")).otherwise(
        F.concat(F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/"))))
    e = u.withColumn("__suffix", F.explode(suffixes)).withColumn("__prefix", F.explode(prefixes))
    e = e.withColumn("__digest", _digest(F.col("__suffix"), F.col("__prefix"))).withColumn(
        "__short", _short(F.col("__digest"))).drop("__suffix", "__prefix")
    # the size of the rule side is counted, not assumed
    small = depth["n"] <= BROADCAST_RULES and depth["n"] * (depth["chars"] + 200) < 256 << 20
    r = F.broadcast(r) if small else r
    m = e.join(r, F.col("__short") == F.col("__rshort"), "left")
    # a meeting of short prefixes counts only if the digests agree and the whole rule path fits
    fits = (F.col("__digest") == F.col("__rdigest")) & F.col("__path").startswith(F.col("__rpath"))
    best = F.max(F.when(fits, F.struct(
        (F.length("__rhost") + F.length("__rpath")).alias("length"), F.length("__rhost").alias("host_length"),
        F.concat("__rhost", "__rpath").alias("rule"), F.col("__rverdict").alias("verdict"))))
    # __row keeps repeated pages apart; partial aggregation folds a page's expressions before the shuffle
    out = m.groupBy("__row", "__id", "__host", "__path").agg(best.alias("__best"))
    return out.select(F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"),
                      F.col("__best.rule").alias("rule"),
                      F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict"))


ORACLE = """
WITH u AS (
  SELECT page_id, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
j AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""


def query(spark, sf_dir) -> DataFrame:
    from .common import read

    return judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules_frame(spark))
