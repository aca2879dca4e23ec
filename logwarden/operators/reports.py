"""Reports (T1-T5) as long tables, and the text forms of alerts / summaries.

Reports are ``(section, ord, key, value)`` tables: a ``unionByName`` of small
aggregates, each tagged with a section literal.  ``ord`` orders rows inside a
section (ascending); rows of the IP section use ``-occurrences`` so the
ranking needs no global window (which would pull every IP into one task).
Rendering to text is left to the consumer.

``generated_at`` is a parameter, never ``current_timestamp()``, so reports
are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as K
from ..config import DEFAULT, Thresholds
from ..functions import columns as X
from . import aggregates as A
from . import alerts as AL

REPORT_COLUMNS = ["section", "ord", "key", "value"]

# --- fixed values: report section names and executive-summary labels ---
SEC_EXEC = "EXECUTIVE SUMMARY"
SEC_ANOMALY = "ANOMALY BREAKDOWN"
SEC_IPS = "IP RISK SUMMARY"
SEC_CRIT = "CRITICAL ALERTS"
SEC_WARN = "WARNING ALERTS"
SEC_USAGE = "USAGE STATISTICS"
SEC_STATUS = "STATUS"
SEC_TOP = "TOP SUSPICIOUS IPS"
SEC_ACTIONS = "RECOMMENDED ACTIONS"
SEC_HEADER = "HEADER"
# --- end of fixed values ---


def _rows(df: DataFrame, section: str, ord_col, key_col, value_col) -> DataFrame:
    def col(c):
        return F.col(c) if isinstance(c, str) else c
    return df.select(F.lit(section).alias("section"), col(ord_col).cast("bigint").alias("ord"),
                     col(key_col).cast("string").alias("key"), col(value_col).cast("string").alias("value"))


def _long_rows(long: DataFrame, section: str, names: list[str]) -> DataFrame:
    """Metric rows in a fixed order (``ord`` from the name list, not a window)."""
    pos = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("metric"))
    return _rows(long, section, pos, "metric", "cnt")


def _alert_counts(alerts: DataFrame) -> DataFrame:
    """One row: critical / warning channel sizes."""
    return alerts.agg(F.count_if(F.col("channel") == "critical").alias("critical"),
                      F.count_if(F.col("channel") == "warning").alias("warning"))


def _alert_rows(alerts: DataFrame, channel: str, section: str) -> DataFrame:
    a = alerts.where(F.col("channel") == channel)
    # order inside the section: severity rank (ties in any order)
    sev_rank = F.array_position(F.array(*[F.lit(s) for s in ("CRITICAL", "HIGH", "WARNING", "MEDIUM",
                                                              "LOW", "INFO")]), F.col("severity"))
    return _rows(a, section, sev_rank, F.col("severity"), F.col("message"))


def _header(df: DataFrame, generated_at: str) -> DataFrame:
    """A literal row: no data is read for it."""
    return _rows(df.sparkSession.range(1), SEC_HEADER, F.lit(0), F.lit("Generated"), F.lit(generated_at))


def _ip_rows(table: DataFrame, cfg: Thresholds) -> DataFrame:
    """``ip, occurrences, risk`` of an incident table."""
    t = table.where(AL.is_ip() & (F.col("occurrences") > 0))
    return t.select("ip", "occurrences", X.risk_tier("occurrences", cfg).alias("risk"))


def _inputs(lines, cfg, table, stats, alerts):
    """The three small tables reports are made of: incidents, line statistics, stage-4 alerts."""
    table = table if table is not None else AL.incident_table(lines)
    stats = stats if stats is not None else A.line_stats(lines)
    return table, stats, alerts if alerts is not None else AL.stage4_alerts(None, cfg, table=table)


def final_report(lines: DataFrame | None, cfg: Thresholds = DEFAULT, generated_at: str = "", table: DataFrame | None = None,
                 stats: DataFrame | None = None, alerts: DataFrame | None = None) -> DataFrame:
    """Executive summary, anomaly breakdown, IP risk, alerts, usage.

    Sections are small branches over the incident table and the line
    statistics; the branches share their exchanges.
    """
    table, stats, alerts = _inputs(lines, cfg, table, stats, alerts)
    usage = A.usage_stats(lines, stats)
    counts = _alert_counts(alerts)
    exec_rows = (
        _rows(usage.where(F.col("metric") == "total_lines"), SEC_EXEC, F.lit(1),
              F.lit("Total Log Lines Processed"), "cnt")
        .unionByName(_rows(usage.where(F.col("metric") == "unique_ips"), SEC_EXEC, F.lit(2),
                           F.lit("Unique IP Addresses"), "cnt"))
        .unionByName(_rows(counts, SEC_EXEC, F.lit(3), F.lit("Critical Alerts"), "critical"))
        .unionByName(_rows(counts, SEC_EXEC, F.lit(4), F.lit("Warning Alerts"), "warning")))
    ips = _rows(_ip_rows(table, cfg), SEC_IPS, -F.col("occurrences"), "ip",
                F.concat_ws(" ", F.col("occurrences").cast("string"), F.col("risk")))
    return (_header(table, generated_at).unionByName(exec_rows)
            .unionByName(_long_rows(A.anomaly_counts(lines, stats), SEC_ANOMALY, A.anomaly_names()))
            .unionByName(ips)
            .unionByName(_alert_rows(alerts, "critical", SEC_CRIT))
            .unionByName(_alert_rows(alerts, "warning", SEC_WARN))
            .unionByName(_long_rows(usage, SEC_USAGE, A.USAGE_NAMES)))


def status_flag(alerts: DataFrame) -> DataFrame:
    """T4: ``ACTION REQUIRED`` when any alert reached the critical channel."""
    c = alerts.agg(F.count_if(F.col("channel") == "critical").alias("n"))
    return c.select(F.when(F.col("n") > 0, K.STATUS_ACTION).otherwise(K.STATUS_NORMAL).alias("status"))


def alert_digest(lines: DataFrame | None, cfg: Thresholds = DEFAULT, generated_at: str = "", table: DataFrame | None = None,
                 stats: DataFrame | None = None, alerts: DataFrame | None = None) -> DataFrame:
    """Digest sections: summary, status, alerts, anomalies, top IPs, actions."""
    table, stats, alerts = _inputs(lines, cfg, table, stats, alerts)
    counts = _alert_counts(alerts)
    total = stats.where(F.col("metric") == "total_lines").select(F.col("cnt").alias("n"))
    exec_rows = (_rows(total, SEC_EXEC, F.lit(1), F.lit("Log lines processed"), "n")
                 .unionByName(_rows(counts, SEC_EXEC, F.lit(2), F.lit("Critical alerts"), "critical"))
                 .unionByName(_rows(counts, SEC_EXEC, F.lit(3), F.lit("Warning alerts"), "warning")))
    status = _rows(status_flag(alerts), SEC_STATUS, F.lit(1), F.lit("STATUS"), "status")
    top = A.top_suspicious_ips(_ip_rows(table, cfg), cfg.top_ips)
    top_rows = _rows(top, SEC_TOP, -F.col("occurrences"), "ip",
                     F.concat_ws(" ", F.col("occurrences").cast("string"), F.col("risk")))
    crit_actions = F.array(*[F.lit(a) for a in K.ACTIONS_CRITICAL])
    norm_actions = F.array(*[F.lit(a) for a in K.ACTIONS_NORMAL])
    actions = counts.select(F.posexplode(F.when(F.col("critical") > 0, crit_actions)
                                         .otherwise(norm_actions)).alias("p", "a"))
    action_rows = _rows(actions, SEC_ACTIONS, F.col("p") + 1, (F.col("p") + 1).cast("string"), "a")
    return (_header(table, generated_at).unionByName(exec_rows).unionByName(status)
            .unionByName(_alert_rows(alerts, "critical", SEC_CRIT))
            .unionByName(_alert_rows(alerts, "warning", SEC_WARN))
            .unionByName(_long_rows(A.anomaly_counts(lines, stats), SEC_ANOMALY, A.anomaly_names()))
            .unionByName(top_rows).unionByName(action_rows))


def render_stage4_alerts(alerts: DataFrame, generated_at: str) -> DataFrame:
    """Stage-4 alert text lines: ``[SEV] <ts> | <message>`` (message holds the type)."""
    return alerts.select(F.concat(F.lit("["), F.col("severity"), F.lit("] "), F.lit(generated_at),
                                  F.lit(" | "), F.col("message")).alias("line"))


def parse_alert_lines(text: DataFrame) -> DataFrame:
    """Alert text -> ``(severity, ts, type, detail)`` split on the pipe, trimmed."""
    parts = F.split(F.col("line"), r"\|")
    head = F.trim(F.get(parts, 0))
    return text.select(
        F.nullif(F.regexp_extract(head, r"^\[([A-Z]+)\]", 1), F.lit("")).alias("severity"),
        F.trim(F.regexp_replace(head, r"^\[[A-Z]+\]", "")).alias("ts"),
        F.trim(F.get(parts, 1)).alias("type"),
        F.trim(F.get(parts, 2)).alias("detail"))


def render_detailed_alerts(alerts: DataFrame, generated_at: str) -> DataFrame:
    """Detailed alert text lines: ``[ts] [SEV] [CATEGORY] message | ACTION: action``; no action is an empty one."""
    return alerts.select(F.concat(
        F.lit(f"[{generated_at}] ["), F.col("severity"), F.lit("] ["), F.col("category"), F.lit("] "), F.col("message"),
        F.lit(" | ACTION: "), F.coalesce("action", F.lit(""))).alias("line"))


RX_DETAILED = r"^\[([^\]]*)\] \[([A-Z]+)\] \[([^\]]*)\] (.*) \| ACTION: (.*)$"


def parse_detailed_alerts(text: DataFrame) -> DataFrame:
    """Detailed alert text -> ``(ts, severity, category, message, action)``; the action is what follows the last mark.

    Lines of another form have null columns, an empty action is null.
    """
    fits = F.col("line").rlike(RX_DETAILED)
    part = lambda k: F.when(fits, F.regexp_extract("line", RX_DETAILED, k))
    return text.select(part(1).alias("ts"), part(2).alias("severity"), part(3).alias("category"), part(4).alias("message"),
                       F.nullif(part(5), F.lit("")).alias("action"))


def render_ip_summary(summary: DataFrame) -> DataFrame:
    """IP summary text rows; short fields are padded, long ones never cut."""
    return summary.select(F.format_string("%-20s | %-12s | %s", "ip", F.col("occurrences").cast("string"),
                                          "risk").alias("line"))


def parse_ip_summary(text: DataFrame) -> DataFrame:
    """P5: ``ip | count | risk`` text -> typed rows; headings and blanks are dropped."""
    parts = F.split(F.col("line"), r"\|")
    strip = lambda c: F.translate(c, " \t", "")
    out = text.select(strip(F.get(parts, 0)).alias("ip"),
                      strip(F.get(parts, 1)).try_cast("bigint").alias("occurrences"),
                      strip(F.get(parts, 2)).alias("risk"))
    return out.where(F.col("occurrences").isNotNull() & (F.col("ip") != ""))


def run_summary(lines: DataFrame | None, cfg: Thresholds = DEFAULT, generated_at: str = "", table: DataFrame | None = None,
                stats: DataFrame | None = None, alerts: DataFrame | None = None) -> DataFrame:
    """T5: totals, then the critical alerts re-split into (ts, type, detail)."""
    table, stats, alerts = _inputs(lines, cfg, table, stats, alerts)
    usage = A.usage_stats(lines, stats)
    counts = _alert_counts(alerts)
    totals = (_rows(usage.where(F.col("metric") == "total_lines"), SEC_EXEC, F.lit(1),
                    F.lit("Total Log Lines Processed"), "cnt")
              .unionByName(_rows(usage.where(F.col("metric") == "unique_ips"), SEC_EXEC, F.lit(2),
                                 F.lit("Unique IP Addresses Found"), "cnt"))
              .unionByName(_rows(counts, SEC_EXEC, F.lit(3), F.lit("Critical Alerts Fired"), "critical"))
              .unionByName(_rows(counts, SEC_EXEC, F.lit(4), F.lit("Warning Alerts Fired"), "warning")))
    crit = parse_alert_lines(render_stage4_alerts(alerts.where(F.col("channel") == "critical"),
                                                  generated_at))
    return totals.unionByName(_rows(crit, SEC_CRIT, F.lit(1), "type",
                                    F.concat_ws(" | ", F.col("ts"), F.col("detail"))))
