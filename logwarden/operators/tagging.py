"""Multi-label rule tagging (G1, G2) and the shared fact table.

``line_facts`` is the one intermediate the later stages share: matched lines
only, with every rule flag, their IP tokens and a multiplicity ``n``.  Only
the suspicious set (F2) is defined on *distinct* lines, so only F2 lines are
keyed by a digest of their text; every other matched line is keyed by its IP
tokens and flags, which map-side partial aggregation collapses to a few rows
per task.  All rules are evaluated before the shuffle, so no text travels:
the exchange carries one digest per distinct suspicious line plus a small
per-IP residue, and a hot line or a hot IP is collapsed before it.

``incidents`` reduces the facts to one row per IP and one row of totals in a
single aggregation; every alert, threshold metric and report section is a
projection of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import patterns as P
from . import filters as flt
from .rules import Rule, builtin_rules, pairs


def anomaly_scan(lines: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """G1: ``(line, anomaly_type)``, one row per (line, matching rule of kind ``scan``)."""
    tags = F.array_compact(F.array(*[
        F.when(X.matches(rx), F.lit(name)) for name, rx in pairs(rules or builtin_rules(), "scan")]))
    return lines.select("line", F.explode(tags.cast("array<string>")).alias("anomaly_type"))


def anomaly_summary(lines: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``(anomaly_type, cnt)`` per rule with hits, plus a ``TOTAL`` row.

    One pass of ``count_if`` per rule (no explode, no shuffle beyond the
    single-row final aggregate); the total is the sum over rules, so a line
    matching two rules counts twice, and it is present (0) on empty input.
    """
    scans = pairs(rules or builtin_rules(), "scan")
    # names are data: the counters are told apart by place
    one = lines.agg(F.array(*[F.struct(F.lit(name).alias("anomaly_type"), F.count_if(X.matches(rx)).alias("cnt"))
                              for name, rx in scans]).alias("c"))
    total = F.struct(F.lit(P.TOTAL).alias("anomaly_type"), F.aggregate("c", F.lit(0).cast("bigint"), lambda a, x: a + x["cnt"]).alias("cnt"))
    long = one.select(F.inline(F.concat(F.col("c"), F.array(total))))
    return long.where((F.col("cnt") > 0) | (F.col("anomaly_type") == P.TOTAL)).select(
        "anomaly_type", F.col("cnt").cast("bigint").alias("cnt"))


FACT_FLAGS = {
    # flag column -> predicate on the line (given the folded-line column)
    "f_failed": lambda lc=None: flt.is_failed(lc),
    "f_susp": lambda lc=None: flt.is_suspicious(lc),
    "f_srv_err": lambda lc=None: flt.is_server_error(lc),
    "f_invalid": lambda lc=None: X.has(P.LIT_INVALID_USER),
}
DETAIL_FLAGS = {
    # counted among F3, with repeats
    "f_oom": lambda: X.has(P.LIT_OOM),
    "f_segv": lambda: X.has(P.LIT_SEGFAULT),
    "f_disk": lambda: X.has(P.LIT_DISK_IO),
    # counted among the distinct suspicious lines
    "f_http": lambda: X.matches(P.RX_HTTP_ERR),
    "f_4xx": lambda: X.matches(P.RX_HTTP_4XX),
    "f_5xx": lambda: X.matches(P.RX_HTTP_5XX),
    "f_env": lambda: X.has(P.LIT_ENV),
    "f_admin": lambda: X.has(P.LIT_ADMIN),
    "f_wp": lambda: X.has(P.LIT_WP_ADMIN),
}
#: scope of a metric rule -> flag of its lines
SCOPE_FLAGS = {"all": None, "failed": "f_failed", "suspicious": "f_susp", "errors": "f_srv_err"}


def _metric_flag(rule: Rule) -> str:
    return f"x_{rule.name}"


def line_facts(lines: DataFrame, metrics: list[Rule] = ()) -> DataFrame:
    """``(digest, ips, flags..., n)`` over the matched lines.

    ``digest`` (SHA-256) tells suspicious lines apart and is null otherwise;
    ``ips`` are the line's IP tokens.  ``metrics`` adds a flag for each rule
    of that kind; a rule over all lines selects lines like a built-in one.  The case-folded line is computed once,
    and the flags once: the filter on them is fenced off so it cannot be
    rewritten into a second evaluation.
    """
    folded = X.with_folded(lines.select("line"))
    own = {_metric_flag(r): X.matches(r.pattern, folded=X.FOLDED) for r in metrics}
    flagged = X.fenced(folded, F.col("line"),
                       *[fn(X.FOLDED).alias(k) for k, fn in FACT_FLAGS.items()], *[c.alias(k) for k, c in own.items()])
    anyf = None
    for k in (*FACT_FLAGS, *(_metric_flag(r) for r in metrics if r.scope == "all")):
        anyf = F.col(k) if anyf is None else anyf | F.col(k)
    keyed = flagged.where(anyf).select(
        F.when(F.col("f_susp"), F.unhex(F.sha2("line", 256))).alias("digest"),
        X.ip_tokens("line").alias("ips"),
        *FACT_FLAGS, *[fn().alias(k) for k, fn in DETAIL_FLAGS.items()], *own)
    return keyed.groupBy("digest", "ips", *FACT_FLAGS, *DETAIL_FLAGS, *own).agg(F.count(F.lit(1)).alias("n"))


#: totals of ``incidents``: name -> (flag that must hold, further flag, repeats counted)
TOTALS = {
    "failed_lines": ("f_failed", None, True),
    "invalid_users": ("f_invalid", None, True),
    "susp_lines": ("f_susp", None, False),
    "http_errors": ("f_susp", "f_http", False),
    "err4xx": ("f_susp", "f_4xx", False),
    "err5xx": ("f_susp", "f_5xx", False),
    "env_hits": ("f_susp", "f_env", False),
    "admin_hits": ("f_susp", "f_admin", False),
    "wp_hits": ("f_susp", "f_wp", False),
    "total_errors": ("f_srv_err", None, True),
    "oom": ("f_srv_err", "f_oom", True),
    "segfault": ("f_srv_err", "f_segv", True),
    "disk": ("f_srv_err", "f_disk", True),
}


def token_weight() -> Column:
    """How often an IP token of a fact counts: F1 and F3 with repeats, F2 once.

    A line in two sets counts in both, as the three files were concatenated.
    """
    return (F.col("n") * (F.col("f_failed").cast("int") + F.col("f_srv_err").cast("int"))
            + F.col("f_susp").cast("int"))


def incidents(facts: DataFrame, metrics: list[Rule] = ()) -> DataFrame:
    """One row per IP and one of totals: ``ip, is_total, occurrences, failed, <TOTALS>, <metrics>``.

    A fact's line counters ride on its first token, so one ``rollup`` over the
    exploded tokens gives the per-IP numbers and, in its grand-total row, the
    line totals.  An empty input has the total row too.  The result is fenced:
    several branches over it share one exchange.
    """
    flags = [*FACT_FLAGS, *DETAIL_FLAGS, *(_metric_flag(r) for r in metrics)]
    none = facts.sparkSession.range(1).select(
        F.lit(None).cast("binary").alias("digest"), F.array().cast("array<string>").alias("ips"),
        *[F.lit(False).alias(k) for k in flags], F.lit(0).cast("bigint").alias("n"))
    t = facts.select("digest", "ips", *flags, "n").unionAll(none).select(
        F.posexplode_outer("ips").alias("pos", "ip"), token_weight().alias("w"), "n", *flags)
    first = F.coalesce(F.col("pos") == 0, F.lit(True))
    sums = []
    totals = TOTALS | {r.name: (_metric_flag(r), SCOPE_FLAGS[r.scope], r.scope != "suspicious") for r in metrics}
    for name, (flag, more, repeats) in totals.items():
        cond = first & F.col(flag) if more is None else first & F.col(flag) & F.col(more)
        sums.append(F.sum(F.when(cond, F.col("n") if repeats else F.lit(1)).otherwise(0)).cast("bigint").alias(name))
    out = t.rollup("ip").agg(
        F.grouping("ip").cast("boolean").alias("is_total"),
        F.sum(F.when(F.col("ip").isNotNull(), F.col("w")).otherwise(0)).cast("bigint").alias("occurrences"),
        F.sum(F.when(F.col("f_failed"), F.col("n")).otherwise(0)).cast("bigint").alias("failed"), *sums)
    return X.fenced(out, *[F.col(c) for c in ("ip", "is_total", "occurrences", "failed", *totals)])
