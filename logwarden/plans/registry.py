"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's ``events`` table through the derived
``log_lines`` view, so its work grows with the data.  Names follow the
operator inventory keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..operators import aggregates as A
from ..operators import alerts as AL
from ..operators import filters as FL
from ..operators import parse as PR
from ..operators import reports as RP
from ..operators import rules as RU
from ..operators import sketches as SK
from ..operators import tagging as TG
from ..operators import thresholds as TH
from ..operators import years as YR
from ..sources import files as FI
from ..sources.derived import load_document_lines, load_log_lines, load_long_log_lines
from . import contents as CO
from ..streaming import jobs as J
from ..streaming import windows as W

# A second set of bounds so every tier / status branch is compared too.
# --- fixed values: alternative bounds for branch coverage ---
ALT = Thresholds(failed_login=3, error=2000, tiers=(30, 25, 20), warn_pct=50,
                 ssh_extreme=6, ssh_critical=5, ssh_medium=2, invalid_users=1000,
                 web_5xx=(1000, 300), web_4xx=(5000, 1000), admin_probe=1000, error_storm=5000)
GENERATED_AT = "2024-02-01 00:00:00"
# rules that a user adds to the built-in ones: every kind and scope, tiers, a guard, one that never fires
USER_RULES = [
    RU.Rule("scan", "Log Rotation", 10, pattern="rotated|nightly copy"),
    RU.Rule("scan", "Numbered Host `7`", 11, pattern="^[A-Z][a-z]{2} .* server sshd\\[7[0-9]*\\]"),
    RU.Rule("count", "Scripted Clients", 10, pattern="(?i)CURL/|python-requests"),
    RU.Rule("metric", "curl_hits", scope="suspicious", pattern="curl/"),
    RU.Rule("metric", "root_logins", scope="failed", pattern="for root "),
    RU.Rule("metric", "kernel_lines", scope="all", pattern="kernel\\[[0-9]+\\]"),
    RU.Rule("metric", "refused", scope="errors", pattern="Connection refused"),
    RU.Rule("alert", "curl_many", 20, category="CLIENTS", severity="HIGH", metric="curl_hits", grp="curl", op=">=", bound=100000,
            message="{n} requests by scripts", action="Block scripts"),
    RU.Rule("alert", "curl_some", 21, category="CLIENTS", severity="MEDIUM", metric="curl_hits", grp="curl", op=">=", bound=1,
            message="{n} requests by scripts, now and then", action="Watch ({n})"),
    RU.Rule("alert", "root", 22, category="SSH", severity="CRITICAL", metric="root_logins", guard="failed_lines", op=">", bound=3,
            message="root was tried {n} times"),
    RU.Rule("alert", "kernel", 23, category="SYSTEM", severity="LOW", metric="kernel_lines", op=">=", bound=1, message="{n} kernel lines"),
    RU.Rule("alert", "refused", 24, category="SYSTEM", severity="LOW", metric="refused", op=">", bound=10 ** 12, message="never {n}"),
]
# --- end of fixed values ---

Q = Callable[[SparkSession, str], DataFrame]


def _L(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_log_lines(spark, sf_dir)


def _rules(spark: SparkSession) -> list[RU.Rule]:
    """The built-in rules and a user's, by way of a table."""
    return RU.load_rules(RU.rule_table(spark, RU.builtin_rules() + USER_RULES))


def _lines(fn) -> Q:
    return lambda spark, sf: fn(_L(spark, sf))


def _ids(df: DataFrame) -> DataFrame:
    return df.select("line_id", "line")


REGISTRY: dict[str, Q] = {
    # sources / projections
    "classify_source": lambda s, d: _L(s, d).select("line_id", "line", "source_file", "log_type"),
    "extract_ips": lambda s, d: PR.extract_ips(_L(s, d), keep=("line_id",)),
    "event_time": lambda s, d: PR.with_event_time(_L(s, d)).select("line_id", "log_type", "event_ts"),
    "parse_auth": _lines(PR.parse_auth),
    "auth_events_detail": _lines(PR.auth_events_detail),
    "parse_apache": _lines(PR.parse_apache),
    "apache_events_detail": _lines(PR.apache_events_detail),
    "parse_syslog": _lines(PR.parse_syslog),
    "syslog_errors_detail": _lines(PR.syslog_errors_detail),
    # filters
    "failed_logins": lambda s, d: _ids(FL.failed_logins(_L(s, d))),
    "suspicious_lines": _lines(FL.suspicious_lines),
    "server_errors": lambda s, d: _ids(FL.server_errors(_L(s, d))),
    "strip_comments": lambda s, d: _ids(FL.strip_comments(_L(s, d))),
    "normal_anomaly_split": _lines(FL.normal_anomaly_split),
    "sensitive_paths": lambda s, d: FL.sensitive_paths(PR.parse_apache(_L(s, d))).select("ip", "path", "status"),
    "http_errors": lambda s, d: FL.http_errors(PR.parse_apache(_L(s, d))).select("ip", "path", "status"),
    "success_events": lambda s, d: _ids(FL.success_events(_L(s, d))),
    "success_events_strict": lambda s, d: _ids(FL.success_events(_L(s, d), strict=True)),
    "dedup_lines": _lines(FL.dedup_lines),
    "sorted_log": lambda s, d: FL.sorted_log(_L(s, d)).select("line_id", "line", "source_file"),
    # tagging
    "anomaly_scan": _lines(TG.anomaly_scan),
    "anomaly_summary": _lines(TG.anomaly_summary),
    # rules as a table
    "rule_scan": lambda s, d: TG.anomaly_scan(_L(s, d), _rules(s)),
    "rule_scan_summary": lambda s, d: TG.anomaly_summary(_L(s, d), _rules(s)),
    "rule_counts": lambda s, d: A.anomaly_counts(_L(s, d), rules=_rules(s)),
    "rule_alerts": lambda s, d: AL.rule_alerts(_L(s, d), _rules(s)),
    # files
    "classify_files": lambda s, d: FI.classify_files(_L(s, d)),
    "file_type_lines": lambda s, d: FI.with_file_type(_L(s, d)).select("line_id", "source_file", "log_type"),
    "event_time_inferred": lambda s, d: YR.with_inferred_time(load_long_log_lines(s, d)).select("line_id", "event_ts"),
    # summaries of days that add up
    "unique_ips_by_day": lambda s, d: SK.unique_ips_by_day(_L(s, d)).withColumn("day", F.col("day").cast("string")),
    "unique_ips_merged": lambda s, d: SK.estimate_error(_L(s, d), "2024-01-05", "2024-01-20"),
    "top_ips_merged": lambda s, d: SK.top_between(_L(s, d), SK.daily_top(_L(s, d), keep=40), 11, "2024-01-05", "2024-01-20"),
    # what changes from one table to the next
    "diff_ip_counts": lambda s, d: CO.diff(A.failed_by_ip(_L(s, d)), A.requests_per_ip(_L(s, d)), ["ip"]),
    # aggregates
    "ip_summary": _lines(A.ip_summary),
    "ip_summary_alt_tiers": lambda s, d: A.ip_summary(_L(s, d), ALT),
    "ip_rank": lambda s, d: A.ip_rank(A.ip_summary(_L(s, d))),
    "top_suspicious_ips": lambda s, d: A.top_suspicious_ips(A.ip_summary(_L(s, d))),
    "failed_by_ip": _lines(A.failed_by_ip),
    "auth_failed_per_ip": _lines(A.auth_failed_per_ip),
    "auth_failed_per_user": _lines(A.auth_failed_per_user),
    "auth_invalid_per_ip": _lines(A.auth_invalid_per_ip),
    "auth_summary": _lines(A.auth_summary),
    "apache_summary": _lines(A.apache_summary),
    "requests_per_ip": _lines(A.requests_per_ip),
    "error_code_breakdown": _lines(A.error_code_breakdown),
    "sensitive_hits_per_ip": _lines(A.sensitive_hits_per_ip),
    "syslog_summary": _lines(A.syslog_summary),
    "errors_per_service": _lines(A.errors_per_service),
    "anomaly_counts": _lines(A.anomaly_counts),
    "usage_stats": _lines(A.usage_stats),
    "unique_ips": _lines(A.unique_ips),
    "stage2_counts": _lines(A.stage2_counts),
    "http_class_counts": _lines(A.http_class_counts),
    "probe_counts": _lines(A.probe_counts),
    "system_fault_counts": _lines(A.system_fault_counts),
    "collection_summary": _lines(A.collection_summary),
    "tracked_ips": lambda s, d: A.tracked_ips(A.ip_summary(_L(s, d))),
    # thresholds
    "threshold_scan": _lines(TH.threshold_scan),
    "threshold_scan_alt": lambda s, d: TH.threshold_scan(_L(s, d), ALT),
    "threshold_verdict": lambda s, d: TH.threshold_verdict(TH.threshold_scan(_L(s, d))),
    "request_rate": _lines(TH.request_rate),
    # alerts
    "stage4_alerts": _lines(AL.stage4_alerts),
    "stage4_alerts_alt": lambda s, d: AL.stage4_alerts(_L(s, d), ALT),
    "detailed_alerts": _lines(AL.detailed_alerts),
    "detailed_alerts_alt": lambda s, d: AL.detailed_alerts(_L(s, d), ALT),
    "alert_brute_force": _lines(AL.alert_brute_force),
    "alert_elevated": lambda s, d: AL.alert_brute_force(_L(s, d)).where(F.col("severity") == "WARNING"),
    "alert_error_rate": _lines(AL.alert_error_rate),
    "alert_suspicious_ip": _lines(AL.alert_suspicious_ip),
    "alert_ssh_tiers": _lines(AL.alert_ssh_tiers),
    "alert_invalid_users": lambda s, d: AL.global_alerts(_L(s, d)).where(F.col("category") == "SSH"),
    "alert_web_rules": lambda s, d: AL.global_alerts(_L(s, d)).where(F.col("category") == "WEB"),
    "alert_system_rules": lambda s, d: AL.global_alerts(_L(s, d)).where(F.col("category") == "SYSTEM"),
    "alert_ip_reputation": _lines(AL.alert_ip_reputation),
    "alert_severity_counts": lambda s, d: AL.alert_severity_counts(AL.detailed_alerts(_L(s, d))),
    # reports
    "final_report": lambda s, d: RP.final_report(_L(s, d), DEFAULT, GENERATED_AT),
    "alert_digest": lambda s, d: RP.alert_digest(_L(s, d), DEFAULT, GENERATED_AT),
    "status_flag": lambda s, d: RP.status_flag(AL.stage4_alerts(_L(s, d))),
    "run_summary": lambda s, d: RP.run_summary(_L(s, d), DEFAULT, GENERATED_AT),
    "parse_alert_line": lambda s, d: RP.parse_alert_lines(
        RP.render_stage4_alerts(AL.stage4_alerts(_L(s, d)), GENERATED_AT)),
    "parse_detailed_alert": lambda s, d: RP.parse_detailed_alerts(RP.render_detailed_alerts(AL.detailed_alerts(_L(s, d)), GENERATED_AT)),
    "parse_ip_summary": lambda s, d: RP.parse_ip_summary(RP.render_ip_summary(A.ip_summary(_L(s, d)))),
    # windows (batch form of the streaming rule)
    "failed_login_windows": lambda s, d: W.failed_login_windows(_L(s, d)),
    "window_alerts": lambda s, d: J.window_alerts(W.window_table(_L(s, d))),
    "window_alerts_alt": lambda s, d: J.window_alerts(W.window_table(_L(s, d), ALT), ALT),
    "untimed_failed_logins": lambda s, d: _ids(W.untimed_failed_logins(_L(s, d))),
    "status_check": lambda s, d: TH.threshold_check(PR.raw_status(_L(s, d)).select(
        F.col("path").alias("label"), F.col("status").alias("value"), F.lit("450").alias("threshold"))),
}

#: the same operators over the lines of the documents
DOCUMENT_LINES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "classify_source": lambda t: t,
    "classify_files": FI.classify_files,
    "event_time": lambda t: PR.with_event_time(t).select("line_id", "log_type", "event_ts"),
    "extract_ips": lambda t: PR.extract_ips(t, keep=("line_id",)),
    "strip_comments": lambda t: _ids(FL.strip_comments(t)),
    "dedup_lines": FL.dedup_lines,
    "normal_anomaly_split": FL.normal_anomaly_split,
    "suspicious_lines": FL.suspicious_lines,
    "anomaly_summary": TG.anomaly_summary,
    "usage_stats": A.usage_stats,
    "ip_summary": A.ip_summary,
    "detailed_alerts": AL.detailed_alerts,
    "threshold_scan": TH.threshold_scan,
    "failed_by_ip": A.failed_by_ip,
    "requests_per_ip": A.requests_per_ip,
    "error_code_breakdown": A.error_code_breakdown,
    "final_report": lambda t: RP.final_report(t, DEFAULT, GENERATED_AT),
}
REGISTRY.update({f"doc_{name}": (lambda s, d, fn=fn: fn(load_document_lines(s, d))) for name, fn in DOCUMENT_LINES.items()})


def queries() -> dict[str, Q]:
    return dict(REGISTRY)
