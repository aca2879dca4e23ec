"""Alert rules (L1-L18) and their routing, as one ``alerts`` table.

Both engines emit rows of the same schema (``ALERT_COLUMNS``), told apart by
``engine``.  All rules read one table, ``tagging.incidents``: a row per IP and
a row of totals.  A rule is a struct that is null where it does not fire
(tiers are ``when`` chains, first match wins); an engine is the ``inline`` of
its rules' structs.  So an engine is one projection over one aggregation of
one scan: no join, no rescan per rule, nothing written in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as K
from ..config import DEFAULT, Thresholds
from ..functions import columns as X
from .rules import Rule, builtin_rules, metrics
from .rules import alerts as alert_rules
from .tagging import incidents, line_facts

ALERT_COLUMNS = ["engine", "severity", "category", "ip", "metric_value", "threshold",
                 "message", "action", "channel", "in_main_log"]


def route(severity: Column) -> Column:
    """CRITICAL/HIGH -> critical channel, MEDIUM/LOW -> warning channel."""
    return (F.when(severity.isin("CRITICAL", "HIGH"), "critical")
            .when(severity.isin("MEDIUM", "LOW", "WARNING"), "warning").otherwise("main"))


def alert(cond: Column, engine: str, severity, category: str, ip, value: Column, threshold, message: Column,
          action: Column | None = None, channel: Column | None = None, in_main: Column | None = None) -> Column:
    """One alert row as a struct, null where ``cond`` does not hold."""
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return F.when(cond, F.struct(
        F.lit(engine).alias("engine"), sev.alias("severity"), F.lit(category).alias("category"),
        (ip if ip is not None else F.lit(None).cast("string")).alias("ip"),
        value.cast("bigint").alias("metric_value"),
        (threshold if isinstance(threshold, Column) else F.lit(threshold)).cast("bigint").alias("threshold"),
        message.alias("message"), (action if action is not None else F.lit(None).cast("string")).alias("action"),
        (channel if channel is not None else route(sev)).alias("channel"),
        (in_main if in_main is not None else F.lit(True)).alias("in_main_log")))


def _fire(table: DataFrame, rules: list[Column]) -> DataFrame:
    return table.select(F.inline(F.array_compact(F.array(*rules)))).select(*ALERT_COLUMNS)


def incident_table(lines: DataFrame | None, facts: DataFrame | None = None) -> DataFrame:
    return incidents(facts if facts is not None else line_facts(lines))


def _tiers(n: Column, tiers, pick) -> Column:
    """First tier reached: ``pick(tier)`` of it, null below the lowest."""
    out = None
    for t in tiers:
        out = F.when(n >= t[0], pick(t)) if out is None else out.when(n >= t[0], pick(t))
    return out


def is_ip() -> Column:
    """Rows of an address."""
    return ~F.col("is_total") & F.col("ip").isNotNull()


def is_total() -> Column:
    """The row of totals."""
    return F.col("is_total")


# ---------------------------------------------------------------- stage-4 engine

def _brute_force(cfg: Thresholds) -> list[Column]:
    crit = F.col("failed") >= cfg.failed_login
    msg = F.when(crit, X.template(K.STAGE4_BRUTE_FORCE, ip="ip", n="failed", t=F.lit(cfg.failed_login))).otherwise(
        X.template(K.STAGE4_ELEVATED, ip="ip", n="failed"))
    return [alert(is_ip() & (F.col("failed") > 0), "stage4", F.when(crit, "CRITICAL").otherwise("WARNING"), "SSH",
                  F.col("ip"), F.col("failed"), cfg.failed_login, msg,
                  channel=F.when(crit, "critical").otherwise("warning"), in_main=crit)]


def error_rate_rule(cond: Column, n: str, cfg: Thresholds) -> Column:
    crit = F.col(n) >= cfg.error
    msg = F.when(crit, X.template(K.STAGE4_ERROR_RATE, n=n, t=F.lit(cfg.error))).otherwise(
        X.template(K.STAGE4_ERRORS_NORMAL, n=n))
    return alert(cond, "stage4", F.when(crit, "CRITICAL").otherwise("INFO"), "SYSTEM", None, F.col(n), cfg.error,
                 msg, channel=F.when(crit, "critical").otherwise("main"))


def _suspicious_ip(cfg: Thresholds) -> list[Column]:
    risk = X.risk_tier("occurrences", cfg)
    crit = risk == "CRITICAL"
    msg = F.when(crit, X.template(K.STAGE4_SUSPICIOUS_CRIT, ip="ip", n="occurrences")).otherwise(
        X.template(K.STAGE4_SUSPICIOUS_HIGH, ip="ip", n="occurrences"))
    return [alert(is_ip() & risk.isin("CRITICAL", "HIGH"), "stage4", F.when(crit, "CRITICAL").otherwise("WARNING"),
                  "IP", F.col("ip"), F.col("occurrences"),
                  F.when(crit, F.lit(cfg.tiers[0])).otherwise(F.lit(cfg.tiers[1])), msg)]


def alert_brute_force(lines: DataFrame, cfg: Thresholds = DEFAULT, facts=None) -> DataFrame:
    """L1 + L2: per failed-login IP, CRITICAL brute force at the bound, else an elevated WARNING.

    WARNING rows go to the warning channel only (not the main log).
    """
    return _fire(incident_table(lines, facts), _brute_force(cfg))


def alert_error_rate(lines: DataFrame, cfg: Thresholds = DEFAULT, facts=None) -> DataFrame:
    """L3: F3 size at the bound -> CRITICAL; else an INFO line in the main log only."""
    return _fire(incident_table(lines, facts), [error_rate_rule(is_total(), "total_errors", cfg)])


def alert_suspicious_ip(lines: DataFrame, cfg: Thresholds = DEFAULT, facts=None) -> DataFrame:
    """L4: IPs of risk CRITICAL -> CRITICAL, HIGH -> WARNING (both in the main log)."""
    return _fire(incident_table(lines, facts), _suspicious_ip(cfg))


def stage4_rules(cfg: Thresholds) -> list[Column]:
    return [*_brute_force(cfg), error_rate_rule(is_total(), "total_errors", cfg), *_suspicious_ip(cfg)]


def stage4_alerts(lines: DataFrame | None, cfg: Thresholds = DEFAULT, facts=None, table=None) -> DataFrame:
    """L1-L4 together."""
    return _fire(table if table is not None else incident_table(lines, facts), stage4_rules(cfg))


# ---------------------------------------------------------------- detailed engine

def ssh_tier_rule(cond: Column, n: str, cfg: Thresholds) -> Column:
    """L5 on a failed-login count: EXTREME / CRITICAL / HIGH / MEDIUM; one attempt gives none."""
    tiers = [
        (cfg.ssh_extreme, "CRITICAL", K.SSH_EXTREME),
        (cfg.ssh_critical, "CRITICAL", K.SSH_CRITICAL),
        (cfg.failed_login, "HIGH", K.SSH_HIGH),
        (cfg.ssh_medium, "MEDIUM", K.SSH_MEDIUM),
    ]
    c = F.col(n)
    sev = _tiers(c, tiers, lambda t: F.lit(t[1]))
    return alert(cond & sev.isNotNull(), "detailed", sev, "SSH", F.col("ip"), c, _tiers(c, tiers, lambda t: F.lit(t[0])),
                 _tiers(c, tiers, lambda t: X.template(t[2][0], ip="ip", n=n)),
                 _tiers(c, tiers, lambda t: X.template(t[2][1], ip="ip", n=n)))


def _ssh_tiers(cfg: Thresholds) -> list[Column]:
    return [ssh_tier_rule(is_ip(), "failed", cfg)]


def compiled(rules: list[Rule]) -> list[Column]:
    """Alert rules as structs over the row of totals; in a group, a rule fires where none before it does."""
    out, before = [], {}
    for r in alert_rules(rules):
        n, bound = F.col(r.metric), F.lit(r.bound)
        holds = n > bound if r.op == ">" else n >= bound
        cond = is_total() & holds if r.guard is None else is_total() & (F.col(r.guard) > 0) & holds
        group = r.grp or r.name
        if group in before:
            cond = cond & ~before[group]
        before[group] = before[group] | holds if group in before else holds
        out.append(alert(cond, "detailed", r.severity, r.category, None, n, r.bound, X.template(r.message, n=r.metric),
                         X.template(r.action, n=r.metric) if r.action is not None else None))
    return out


def _global_rules(cfg: Thresholds) -> list[Column]:
    return compiled(builtin_rules(cfg))


def _reputation(cfg: Thresholds) -> list[Column]:
    m, a = K.REPUTATION
    return [alert(is_ip() & (X.risk_tier("occurrences", cfg) == "CRITICAL"), "detailed", "CRITICAL", "REPUTATION",
                  F.col("ip"), F.col("occurrences"), cfg.tiers[0], X.template(m, ip="ip", n="occurrences"),
                  X.template(a, ip="ip", n="occurrences"))]


def alert_ssh_tiers(lines: DataFrame, cfg: Thresholds = DEFAULT, facts=None) -> DataFrame:
    """Per failed-login IP."""
    return _fire(incident_table(lines, facts), _ssh_tiers(cfg))


def global_alerts(lines: DataFrame, cfg: Thresholds = DEFAULT, facts=None) -> DataFrame:
    """L6-L15 from the row of totals."""
    return _fire(incident_table(lines, facts), _global_rules(cfg))


def alert_ip_reputation(lines: DataFrame, cfg: Thresholds = DEFAULT, facts=None) -> DataFrame:
    """Each CRITICAL IP, with its occurrences (an exact key, no prefix match)."""
    return _fire(incident_table(lines, facts), _reputation(cfg))


def detailed_rules(cfg: Thresholds) -> list[Column]:
    return [*_ssh_tiers(cfg), *_global_rules(cfg), *_reputation(cfg)]


def detailed_alerts(lines: DataFrame | None, cfg: Thresholds = DEFAULT, facts=None, table=None) -> DataFrame:
    """SSH, WEB, SYSTEM and REPUTATION alerts together, routed."""
    return _fire(table if table is not None else incident_table(lines, facts), detailed_rules(cfg))


def all_alerts(lines: DataFrame | None, cfg: Thresholds = DEFAULT, facts=None, table=None) -> DataFrame:
    """Both engines, in one projection."""
    return _fire(table if table is not None else incident_table(lines, facts), [*stage4_rules(cfg), *detailed_rules(cfg)])


def rule_alerts(lines: DataFrame, rules: list[Rule]) -> DataFrame:
    """The alerts of a rule table (kinds ``metric`` and ``alert``), from one scan like the built-in ones."""
    own = metrics(rules)
    return _fire(incidents(line_facts(lines, own), own), compiled(rules))


def all_alerts_by_rules(lines: DataFrame, rules: list[Rule], cfg: Thresholds = DEFAULT) -> DataFrame:
    """Both engines, with the rules over totals taken from a rule table instead of the built-in ones."""
    own = metrics(rules)
    return _fire(incidents(line_facts(lines, own), own), [*stage4_rules(cfg), *_ssh_tiers(cfg), *compiled(rules), *_reputation(cfg)])


def alert_severity_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per (severity, channel) — the true severity, never a shifted counter."""
    return alerts.groupBy("severity", "channel").agg(F.count(F.lit(1)).alias("cnt"))
