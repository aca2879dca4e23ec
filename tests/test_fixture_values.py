"""Operators on the fixture-shaped lines, against the expected values of FIXTURES.md."""

from pyspark.sql import functions as F

from logwarden.operators import aggregates as A
from logwarden.operators import alerts as AL
from logwarden.operators import filters as FL
from logwarden.operators import parse as PR
from logwarden.operators import reports as RP
from logwarden.operators import tagging as TG
from logwarden.operators import thresholds as TH


def kv(df, k, v="cnt"):
    return {r[k]: r[v] for r in df.collect()}


def test_filter_sizes(mixed):
    assert FL.failed_logins(mixed).count() == 35
    assert FL.suspicious_lines(mixed).count() == 60
    assert FL.server_errors(mixed).count() == 30


def test_ip_summary_and_tiers(mixed):
    s = {r["ip"]: (r["occurrences"], r["risk"]) for r in A.ip_summary(mixed).collect()}
    assert s["192.168.1.100"] == (40, "CRITICAL")
    assert s["10.0.0.55"] == (25, "CRITICAL")
    assert s["45.33.32.156"] == (15, "HIGH")
    assert s["172.16.0.200"] == (15, "HIGH")
    assert len(s) == 4


def test_ip_summary_total_is_sum_of_set_tokens(mixed):
    """Invariant: A1's total = IP tokens of F1 + F2 (distinct) + F3."""
    toks = sum(PR.extract_ips(df).count() for df in
               (FL.failed_logins(mixed), FL.suspicious_lines(mixed), FL.server_errors(mixed)))
    assert A.ip_summary(mixed).agg(F.sum("occurrences")).first()[0] == toks


def test_failed_by_ip(mixed):
    assert kv(A.failed_by_ip(mixed), "ip") == {"192.168.1.100": 20, "10.0.0.55": 15}


def test_anomaly_counts(mixed):
    got = kv(A.anomaly_counts(mixed), "metric")
    assert got == {"Failed SSH Logins": 35, "Invalid User Attempts": 15, "HTTP 4xx/5xx Errors": 45,
                   "System Errors": 30, "Sensitive Path Hits": 45, "TOTAL": 170}


def test_usage_stats(mixed):
    got = kv(A.usage_stats(mixed), "metric")
    assert got["total_lines"] == 225
    assert got["total_errors"] == 30
    assert got["total_success"] == 85          # loose rule: 172.16.0.200 counts
    assert got["total_success_strict"] == 70
    assert got["unique_ips"] == 6


def test_auth_aggregates(mixed):
    assert kv(A.auth_summary(mixed), "metric") == {"failed": 35, "success": 30, "invalid": 15}
    assert kv(A.auth_failed_per_user(mixed), "user") == {"root": 20, "admin": 15}
    assert kv(A.auth_invalid_per_ip(mixed), "ip") == {"172.16.0.200": 15}


def test_apache_aggregates(mixed):
    assert kv(A.apache_summary(mixed), "metric") == {"ok": 40, "error": 45}
    assert kv(A.requests_per_ip(mixed), "ip") == {"192.168.1.2": 40, "192.168.1.100": 20,
                                                   "45.33.32.156": 15, "10.0.0.55": 10}
    assert kv(A.error_code_breakdown(mixed), "status") == {403: 20, 404: 15, 500: 10}
    assert kv(A.sensitive_hits_per_ip(mixed), "ip") == {"192.168.1.100": 20, "45.33.32.156": 15,
                                                         "10.0.0.55": 10}


def test_syslog_aggregates(mixed):
    assert kv(A.syslog_summary(mixed), "metric") == {"errors": 30, "normal": 30}
    assert kv(A.errors_per_service(mixed), "service") == {"kernel": 20, "apache2": 10}


def test_anomaly_summary_and_scan(mixed):
    got = kv(TG.anomaly_summary(mixed), "anomaly_type")
    assert got == {"SSH Brute Force": 50, "Web Probing": 45, "HTTP Errors": 45, "System Errors": 30,
                   "TOTAL": 170}
    # invariant: the tag rows add up to the rollup total
    assert TG.anomaly_scan(mixed).count() == got["TOTAL"]


def test_web_and_probe_counts(mixed):
    assert kv(A.http_class_counts(mixed), "metric") == {"http_4xx": 35, "http_5xx": 10}
    assert kv(A.probe_counts(mixed), "metric") == {"env": 15, "admin": 20, "wp_admin": 10}


def test_normal_anomaly_split(mixed):
    got = kv(FL.normal_anomaly_split(mixed).groupBy("label").count(), "label", "count")
    assert got == {"normal": 115, "anomaly": 125}


def test_event_time_parsed(mixed):
    t = PR.with_event_time(mixed)
    assert t.where(F.col("event_ts").isNull()).count() == 0


def test_stage4_alerts(mixed):
    a = AL.stage4_alerts(mixed)
    ch = kv(a.groupBy("channel").count(), "channel", "count")
    assert ch == {"critical": 5, "warning": 2}
    assert a.where("in_main_log").count() == 7
    bf = a.where(F.col("message").startswith("BRUTE FORCE")).select("ip").collect()
    assert sorted(r.ip for r in bf) == ["10.0.0.55", "192.168.1.100"]


def test_detailed_alerts(mixed):
    a = AL.detailed_alerts(mixed)
    sev = kv(a.groupBy("severity").count(), "severity", "count")
    # SSH, .env, OOM, 2 x reputation / SSH, invalid users, 5xx, 4xx, /admin, system / wp-admin
    assert sev == {"CRITICAL": 5, "HIGH": 6, "MEDIUM": 1}
    ch = kv(a.groupBy("channel").count(), "channel", "count")
    assert ch == {"critical": 11, "warning": 1}
    # severity counts are the true severities (no shifted counters)
    sc = {(r.severity, r.channel): r.cnt for r in AL.alert_severity_counts(a).collect()}
    assert sc[("MEDIUM", "warning")] == 1


def test_threshold_scan_all_exceeded(mixed):
    s = {r.label: (r.value, r.pct, r.status) for r in TH.threshold_scan(mixed).collect()}
    assert s["Failed logins from 192.168.1.100"] == (20, 400, "EXCEEDED")
    assert s["Failed logins from 10.0.0.55"] == (15, 300, "EXCEEDED")
    assert s["Total server errors"] == (30, 300, "EXCEEDED")
    assert s["HTTP 4xx/5xx errors"] == (45, 450, "EXCEEDED")
    assert TH.threshold_verdict(TH.threshold_scan(mixed)).first().any_exceeded is True


def test_top_ips_and_rank(mixed):
    top = A.top_suspicious_ips(A.ip_summary(mixed), 3).collect()
    # ties by IP text, descending
    assert [r.ip for r in top] == ["192.168.1.100", "10.0.0.55", "45.33.32.156"]


def test_reports_shape(mixed):
    rep = RP.final_report(mixed, generated_at="2024-02-01 00:00:00")
    assert rep.columns == RP.REPORT_COLUMNS
    secs = {r.section for r in rep.select("section").distinct().collect()}
    assert {"EXECUTIVE SUMMARY", "ANOMALY BREAKDOWN", "IP RISK SUMMARY", "CRITICAL ALERTS",
            "WARNING ALERTS", "USAGE STATISTICS"} <= secs
    st = RP.status_flag(AL.stage4_alerts(mixed)).first().status
    assert st.startswith("ACTION REQUIRED")
    dig = RP.alert_digest(mixed, generated_at="x")
    assert dig.where("section = 'TOP SUSPICIOUS IPS'").count() == 4


def test_alert_text_round_trip(mixed):
    a = AL.stage4_alerts(mixed)
    parsed = RP.parse_alert_lines(RP.render_stage4_alerts(a, "2024-02-01 00:00:00"))
    assert parsed.count() == a.count()
    assert parsed.where("ts <> '2024-02-01 00:00:00'").count() == 0
    s = A.ip_summary(mixed)
    back = RP.parse_ip_summary(RP.render_ip_summary(s))
    assert back.exceptAll(s).count() == 0 and s.exceptAll(back).count() == 0
