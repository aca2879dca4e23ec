"""Aggregations (A1-A21) over log lines.

Shapes used throughout:

* per-key counts ``(key, cnt)``: ``groupBy(key)`` -> partial count on the map
  side, hash exchange on the key, final count.  A key holding a third of all
  rows is collapsed to one partial row per map task before the exchange, so
  hot IPs or users never concentrate raw rows in one task.
* category counts ``(metric, cnt)``: one scan with one ``count_if`` per
  category, unpivoted into long form; categories with zero hits are kept.
* anything that counts *distinct* suspicious lines goes through
  ``line_facts`` (one shuffle keyed by the suspicious line, map-side dedup).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..functions import columns as X
from ..functions import patterns as P
from . import filters as flt
from . import parse as prs
from .rules import Rule, builtin_rules, pairs
from .tagging import line_facts, token_weight


def long_form(row: DataFrame, names: list[str], key: str = "metric", value: str = "cnt") -> DataFrame:
    """Unpivot a one-row aggregate into ``(metric, cnt)`` rows (order kept)."""
    cols = [F.col(X.quoted(n)).cast("bigint").alias(n) for n in names]
    return row.select(*cols).unpivot([], [F.col(X.quoted(n)) for n in names], key, value)


def _sum_n(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")


# ---------------------------------------------------------------- IP counts

def ip_weights(facts: DataFrame) -> DataFrame:
    """``(ip, w)`` tokens of the three filter sets."""
    return (facts.where(F.col("f_failed") | F.col("f_susp") | F.col("f_srv_err"))
            .select(F.explode("ips").alias("ip"), token_weight().alias("w")))


def ip_summary(lines: DataFrame, cfg: Thresholds = DEFAULT, facts: DataFrame | None = None) -> DataFrame:
    """A1 + R1: ``(ip, occurrences, risk)`` over F1 + F2 + F3."""
    facts = facts if facts is not None else line_facts(lines)
    agg = ip_weights(facts).groupBy("ip").agg(F.sum("w").cast("bigint").alias("occurrences"))
    return agg.select("ip", "occurrences", risk("occurrences", cfg))


def risk(n: str, cfg: Thresholds = DEFAULT) -> Column:
    return X.risk_tier(n, cfg).alias("risk")


def ip_rank(summary: DataFrame) -> DataFrame:
    """O2: summary ordered by occurrences, ties by IP text, both descending."""
    return summary.orderBy(F.desc("occurrences"), F.desc("ip"))


def top_suspicious_ips(summary: DataFrame, n: int = DEFAULT.top_ips) -> DataFrame:
    """The ``n`` first rows of the ranked summary (a TakeOrderedAndProject)."""
    return ip_rank(summary).limit(n)


def failed_by_ip(lines: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """A2: IP tokens of failed-login lines, repeats counted.

    Standalone it needs no line shuffle (tokens are counted straight from
    the scan); with ``facts`` it reuses the deduplicated lines and weights
    each token by the line's multiplicity.
    """
    if facts is not None:
        return (facts.where("f_failed")
                .select(F.explode("ips").alias("ip"), "n")
                .groupBy("ip").agg(F.sum("n").cast("bigint").alias("cnt")))
    return (prs.extract_ips(flt.failed_logins(lines), keep=())
            .groupBy("ip").agg(F.count(F.lit(1)).alias("cnt")))


def unique_ips(lines: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of distinct IP tokens in all lines.

    Exact by default (a shuffle of the distinct tokens, pre-deduplicated per
    map task); ``approx`` uses a HyperLogLog++ sketch with no shuffle of keys.
    """
    ips = prs.extract_ips(lines, keep=())
    fn = F.approx_count_distinct("ip", rsd) if approx else F.count_distinct("ip")
    return ips.agg(fn.cast("bigint").alias("unique_ips"))


# ---------------------------------------------------------------- auth

def _auth_kind(lines: DataFrame, kind: str, cfg: Thresholds) -> DataFrame:
    return prs.parse_auth(lines, cfg).where(F.col("kind") == kind)


def auth_failed_per_ip(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """A3: parsed failed logins per source IP."""
    return (_auth_kind(lines, P.LIT_FAILED_PASSWORD, cfg).groupBy("ip")
            .agg(F.count(F.lit(1)).alias("cnt")))


def auth_failed_per_user(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """A4: parsed failed logins per target user."""
    return (_auth_kind(lines, P.LIT_FAILED_PASSWORD, cfg).groupBy("user")
            .agg(F.count(F.lit(1)).alias("cnt")))


def auth_invalid_per_ip(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """A5: invalid-user attempts per source IP."""
    return (_auth_kind(lines, P.LIT_INVALID_USER, cfg).groupBy("ip")
            .agg(F.count(F.lit(1)).alias("cnt")))


def auth_summary(lines: DataFrame) -> DataFrame:
    """Failed / successful / invalid auth record totals."""
    a = lines.where(F.col("log_type") == "auth")
    row = a.agg(F.count_if(X.has(P.LIT_FAILED_PASSWORD)).alias("failed"),
                F.count_if(X.has(P.LIT_ACCEPTED_PASSWORD)).alias("success"),
                F.count_if(X.has(P.LIT_INVALID_USER)).alias("invalid"))
    return long_form(row, ["failed", "success", "invalid"])


# ---------------------------------------------------------------- apache

def apache_summary(lines: DataFrame) -> DataFrame:
    """OK vs error requests; a missing or non-numeric status counts as OK."""
    a = prs.parse_apache(lines)
    err = F.coalesce(F.col("status") >= 400, F.lit(False))
    row = a.agg(F.count_if(~err).alias("ok"), F.count_if(err).alias("error"))
    return long_form(row, ["ok", "error"])


def requests_per_ip(lines: DataFrame) -> DataFrame:
    """Requests per client IP."""
    return prs.parse_apache(lines).groupBy("ip").agg(F.count(F.lit(1)).alias("cnt"))


def error_code_breakdown(lines: DataFrame) -> DataFrame:
    """Error requests per status code."""
    return (flt.http_errors(prs.parse_apache(lines)).groupBy("status")
            .agg(F.count(F.lit(1)).alias("cnt")))


def sensitive_hits_per_ip(lines: DataFrame) -> DataFrame:
    """A10: sensitive-path requests per client IP."""
    return (flt.sensitive_paths(prs.parse_apache(lines)).groupBy("ip")
            .agg(F.count(F.lit(1)).alias("cnt")))


# ---------------------------------------------------------------- syslog

def syslog_summary(lines: DataFrame) -> DataFrame:
    """Syslog lines with and without ``ERROR``."""
    s = lines.where(F.col("log_type") == "syslog")
    row = s.agg(F.count_if(X.has(P.LIT_ERROR)).alias("errors"),
                F.count_if(~X.has(P.LIT_ERROR)).alias("normal"))
    return long_form(row, ["errors", "normal"])


def errors_per_service(lines: DataFrame) -> DataFrame:
    """Syslog error lines per service."""
    return (prs.parse_syslog(lines).where("is_error").groupBy("service")
            .agg(F.count(F.lit(1)).alias("cnt")))


# ---------------------------------------------------------------- categories

USAGE_NAMES = ["total_lines", "total_errors", "total_success", "total_success_strict", "unique_ips"]


def anomaly_names(rules: list[Rule] | None = None) -> list[str]:
    return [n for n, _ in pairs(rules or builtin_rules(), "count")] + [P.TOTAL]


def line_stats(lines: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """A13 + A14 in ONE scan: ``(metric, cnt)`` for every anomaly category (rule of kind ``count``) and usage metric.

    Each line is exploded into its IP tokens (or one null row); line-level
    counts only look at the first row of a line, and the single distinct
    aggregate on the token makes Spark shuffle pre-deduplicated tokens only.
    Every count is over all lines but ``total_lines``, which skips ``#`` comments.
    The anomaly ``TOTAL`` is the sum of the categories (a line in two
    categories counts twice), as in the original report.

    Reports read this one table several times; the branches share one plan,
    so Spark reuses its exchanges instead of scanning the lines again.
    """
    cats = pairs(rules or builtin_rules(), "count")
    x = X.with_folded(lines.select("line")).select(
        flt.not_comment().alias("nc"),
        flt.is_server_error(X.FOLDED).alias("err"),
        X.matches(P.RX_SUCCESS_LOOSE).alias("ok_loose"),
        X.matches(P.RX_SUCCESS_STRICT).alias("ok_strict"),
        *[X.matches(rx, folded=X.FOLDED).alias(f"_c{k}") for k, (_, rx) in enumerate(cats)],
        F.posexplode_outer(X.ip_tokens("line")).alias("pos", "ip"))
    first = F.coalesce(F.col("pos") == 0, F.lit(True))
    row = x.agg(
        *[F.count_if(first & F.col(f"_c{k}")).alias(n) for k, (n, _) in enumerate(cats)],
        F.count_if(first & F.col("nc")).alias("total_lines"),
        F.count_if(first & F.col("err")).alias("total_errors"),
        F.count_if(first & F.col("ok_loose")).alias("total_success"),
        F.count_if(first & F.col("ok_strict")).alias("total_success_strict"),
        F.count_distinct("ip").alias("unique_ips"))
    row = row.withColumn(P.TOTAL, sum((F.col(X.quoted(n)) for n, _ in cats), F.lit(0)))
    return long_form(row, anomaly_names(rules) + USAGE_NAMES)


def anomaly_counts(lines: DataFrame, stats: DataFrame | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """Five category line counts and their ``TOTAL`` (from ``line_stats``); other categories by ``rules``."""
    stats = stats if stats is not None else line_stats(lines, rules)
    return stats.where(F.col("metric").isin(anomaly_names(rules)))


def usage_stats(lines: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Total lines, error lines (F3), success lines, distinct IP tokens (from ``line_stats``)."""
    stats = stats if stats is not None else line_stats(lines)
    return stats.where(F.col("metric").isin(USAGE_NAMES))


def stage2_counts(lines: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Sizes of F1 (repeats kept), F2 (distinct lines), F3 (repeats kept)."""
    facts = facts if facts is not None else line_facts(lines)
    row = facts.agg(_sum_n(F.col("f_failed")).alias("failed_logins"),
                    F.count_if("f_susp").alias("suspicious_ips"),
                    _sum_n(F.col("f_srv_err")).alias("server_errors"))
    return long_form(row, ["failed_logins", "suspicious_ips", "server_errors"])


def http_class_counts(lines: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """4xx and 5xx lines among the distinct suspicious lines."""
    facts = facts if facts is not None else line_facts(lines)
    s = facts.where("f_susp")
    row = s.agg(F.count_if("f_4xx").alias("http_4xx"),
                F.count_if("f_5xx").alias("http_5xx"))
    return long_form(row, ["http_4xx", "http_5xx"])


def probe_counts(lines: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """``.env``, ``/admin``, ``wp-admin`` among distinct suspicious lines (case-sensitive)."""
    facts = facts if facts is not None else line_facts(lines)
    s = facts.where("f_susp")
    row = s.agg(F.count_if("f_env").alias("env"),
                F.count_if("f_admin").alias("admin"),
                F.count_if("f_wp").alias("wp_admin"))
    return long_form(row, ["env", "admin", "wp_admin"])


def system_fault_counts(lines: DataFrame) -> DataFrame:
    """Out-of-memory, segfault and disk I/O lines among F3, plus F3's size."""
    e = flt.server_errors(lines)
    row = e.agg(F.count_if(X.has(P.LIT_OOM)).alias("out_of_memory"),
                F.count_if(X.has(P.LIT_SEGFAULT)).alias("segmentation"),
                F.count_if(X.has(P.LIT_DISK_IO)).alias("disk_io"),
                F.count(F.lit(1)).alias("total_errors"))
    return long_form(row, ["out_of_memory", "segmentation", "disk_io", "total_errors"])


def collection_summary(lines: DataFrame) -> DataFrame:
    """Files collected and non-comment lines."""
    row = lines.agg(F.count_distinct("source_file").alias("files_collected"),
                    F.count_if(flt.not_comment()).alias("total_lines"))
    return long_form(row, ["files_collected", "total_lines"])


def tracked_ips(summary: DataFrame) -> DataFrame:
    """Number of IPs in the IP summary."""
    return long_form(summary.agg(F.count(F.lit(1)).alias("tracked_ips")), ["tracked_ips"])
