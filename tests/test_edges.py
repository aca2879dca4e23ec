"""Edge lines: no ``from``, two IPs, odd octets, short Apache lines, zero matches."""

from pyspark.sql import functions as F

from fixture_lines import lines_df
from logwarden.functions import columns as X
from logwarden.operators import aggregates as A
from logwarden.operators import filters as FL
from logwarden.operators import parse as PR
from logwarden.operators import tagging as TG
from logwarden.operators import thresholds as TH


def test_ip_tokens_all_and_whole_match(spark):
    df = lines_df(spark, ["a 1.2.3.4 b 5.6.7.8", "x 1.2.3.4.5 y", "1234.5.6.789", "999.999.999.999", "none"])
    got = [r.ip for r in PR.extract_ips(df).collect()]
    # group 0 (the whole token), every token, leftmost-first scanning
    assert got == ["1.2.3.4", "5.6.7.8", "1.2.3.4", "234.5.6.789", "999.999.999.999"]


def test_auth_last_from_and_for(spark):
    lines = [
        "May 01 10:00:00 server sshd[1]: Failed password for invalid user bob from 9.9.9.9 port 22 ssh2",
        "May 01 10:00:01 server sshd[2]: Failed password for root from 1.1.1.1 from 2.2.2.2 port 22 ssh2",
        "May 01 10:00:02 server sshd[3]: Failed password for nobody",
        "May 01 10:00:03 server sshd[4]: Failed password for x from 3.3.3.3 port 22 from",
    ]
    rows = PR.parse_auth(lines_df(spark, lines)).orderBy("pid").collect()
    assert rows[0].user == "invalid" and rows[0].user_clean == "bob" and rows[0].ip == "9.9.9.9"
    assert rows[1].ip == "2.2.2.2" and rows[1].port == 22
    # no carry-over from the previous line
    assert rows[2].ip is None
    # a trailing word with nothing after it is skipped: the last usable ``from`` counts
    assert rows[3].ip == "3.3.3.3" and rows[3].port == 22


def test_short_apache_line(spark):
    df = lines_df(spark, ['1.2.3.4 - - [16/May/2026:00:00:01 +0000] "GET /x', "5.6.7.8"],
                  "apache", "apache.log")
    p = PR.parse_apache(df).orderBy("ip").collect()
    assert p[0].status is None and p[0].path == "/x"
    # null status counts as OK in the summary
    assert {r.metric: r.cnt for r in A.apache_summary(df).collect()} == {"ok": 2, "error": 0}


def test_syslog_message_fields(spark):
    df = lines_df(spark, ["May  1 10:00:00 host kernel[42]: ERROR:   Disk I/O   error",
                          "May 01 10:00:00 host cron: ok"], "syslog", "syslog")
    rows = {r.service: r for r in PR.parse_syslog(df).collect()}
    assert rows["kernel"].pid == 42 and rows["kernel"].message == "ERROR: Disk I/O error"
    assert rows["kernel"].is_error and not rows["cron"].is_error
    assert rows["cron"].pid is None


def test_zero_matches_keep_rows(spark):
    df = lines_df(spark, ["nothing to see here"])
    assert {r.anomaly_type: r.cnt for r in TG.anomaly_summary(df).collect()} == {"TOTAL": 0}
    got = {r.metric: r.cnt for r in A.anomaly_counts(df).collect()}
    assert got["TOTAL"] == 0 and len(got) == 6
    assert FL.failed_logins(df).count() == 0
    assert TH.threshold_verdict(TH.threshold_scan(df)).first().any_exceeded is False


def test_suspicious_is_distinct_failed_is_not(spark):
    x = 'May 01 10:00:00 server sshd[1]: Failed password for root from 1.1.1.1 port 22 ssh2'
    y = '1.1.1.1 - - [16/May/2026:00:00:01 +0000] "GET /.env HTTP/1.1" 404 10 "-" "-"'
    df = lines_df(spark, [x, x, y, y])
    assert FL.failed_logins(df).count() == 2
    assert FL.suspicious_lines(df).count() == 1
    assert FL.dedup_lines(df).count() == 2
    # A1 mixes both: 2 failed tokens + 1 distinct suspicious token
    assert A.ip_summary(df).first().occurrences == 3


def test_risk_tier_bounds(spark):
    df = spark.createDataFrame([(n,) for n in (0, 4, 5, 9, 10, 19, 20)], "n long")
    got = [r.r for r in df.select(X.risk_tier("n").alias("r")).collect()]
    assert got == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]


def test_threshold_check_statuses(spark):
    m = spark.createDataFrame([("a", "4", "5"), ("b", "3", "5"), ("c", "5", "5"), ("d", "x", "5"),
                               ("e", "1", "0")], "label string, value string, threshold string")
    got = {r.label: (r.pct, r.status) for r in TH.threshold_check(m).collect()}
    assert got == {"a": (80, "WARNING"), "b": (60, "OK"), "c": (100, "EXCEEDED"),
                   "d": (None, "INVALID"), "e": (None, "INVALID")}


def test_thresholds_table(spark):
    t = {r.metric: r.threshold for r in TH.thresholds_table(spark).collect()}
    assert t == {"Failed SSH logins per IP": 5, "Server errors total": 10, "HTTP requests per IP": 100}


def test_line_facts_multiplicity(spark):
    x = 'May 01 10:00:00 server kernel[1]: ERROR: Segmentation fault'
    df = lines_df(spark, [x] * 7 + ["plain"], "syslog", "syslog")
    f = TG.line_facts(df).collect()
    assert len(f) == 1 and f[0].n == 7 and f[0].f_srv_err and not f[0].f_failed
    assert {r.metric: r.cnt for r in A.system_fault_counts(df).collect()}["segmentation"] == 7


def test_window_alert_tiers(spark):
    import datetime as dt

    from logwarden.streaming.jobs import window_alerts

    t = dt.datetime(2024, 1, 1)
    counts = spark.createDataFrame([(t, t, f"ip{n}", n) for n in (1, 2, 4, 5, 20, 50)],
                                   "window_start timestamp_ntz, window_end timestamp_ntz, ip string, cnt bigint")
    got = {(r.engine, r.metric_value): (r.severity, r.channel) for r in window_alerts(counts).collect()}
    assert got == {
        ("detailed", 2): ("MEDIUM", "warning"), ("detailed", 4): ("MEDIUM", "warning"),
        ("detailed", 5): ("HIGH", "critical"), ("detailed", 20): ("CRITICAL", "critical"),
        ("detailed", 50): ("CRITICAL", "critical"),
        ("stage4", 5): ("CRITICAL", "critical"), ("stage4", 20): ("CRITICAL", "critical"),
        ("stage4", 50): ("CRITICAL", "critical"),
    }


def test_sorted_log_splits_hot_line(spark):
    from logwarden.operators.filters import sorted_log

    hot = "May 01 10:00:00 server kernel[1]: ERROR: Segmentation fault"
    df = spark.createDataFrame([(i, hot if i % 3 else f"line {i:05d}") for i in range(3000)],
                               "line_id long, line string")
    out = sorted_log(df)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")        # keep the range partitions apart on this tiny input
    try:
        parts = out.rdd.glom().map(lambda rows: sum(1 for r in rows if r.line == hot)).collect()
    finally:
        spark.conf.set(key, old)
    assert sum(parts) == 2000
    assert sum(1 for p in parts if p) > 1          # the hot line is cut across several sort tasks
    rows = out.collect()
    assert [r.line for r in rows] == sorted(r.line for r in rows)


def test_usage_counts_comment_lines_but_not_in_the_total(spark):
    df = lines_df(spark, ["# ERROR: x 1.2.3.4 Accepted", "plain"])
    got = {r.metric: r.cnt for r in A.usage_stats(df).collect()}
    assert got["total_lines"] == 1 and got["total_errors"] == 1
    assert got["total_success"] == 1 and got["unique_ips"] == 1


def test_event_time_is_utc_in_any_session_zone(spark):
    web = '1.1.1.1 - - [01/May/2024:23:30:00 +0000] "GET / HTTP/1.1" 200 1 "-" "-"'
    log = "May 01 23:30:00 server sshd[1]: x"
    df = lines_df(spark, [web], "apache", "apache.log").unionByName(lines_df(spark, [log]))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = {str(r.t) for r in PR.with_event_time(df).selectExpr("string(event_ts) AS t").collect()}
            assert got == {"2024-05-01 23:30:00"}, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_percent_is_exact_and_never_overflows(spark):
    m = spark.createDataFrame([("a", 9223372036854775807, 5), ("b", 90071992547409931, 100), ("c", -1, 5)],
                              "label string, value bigint, threshold bigint")
    got = {r.label: (r.pct, r.status) for r in TH.threshold_check(m).collect()}
    assert got == {"a": (None, "EXCEEDED"), "b": (90071992547409931, "EXCEEDED"), "c": (None, "INVALID")}


def test_rendered_counts_are_never_cut(spark):
    from logwarden.operators import reports as RP

    s = spark.createDataFrame([("1.2.3.4", 1234567890123, "CRITICAL"), ("a" * 30, 7, "LOW")],
                              "ip string, occurrences bigint, risk string")
    back = {(r.ip, r.occurrences, r.risk) for r in RP.parse_ip_summary(RP.render_ip_summary(s)).collect()}
    assert back == {("1.2.3.4", 1234567890123, "CRITICAL"), ("a" * 30, 7, "LOW")}


def test_order_and_top_k_under_ties(spark):
    s = spark.createDataFrame([("1.1.1.1", 5, "LOW"), ("9.9.9.9", 5, "LOW"), ("5.5.5.5", 5, "LOW"), ("2.2.2.2", 8, "LOW")],
                              "ip string, occurrences bigint, risk string")
    assert [r.ip for r in A.ip_rank(s).collect()] == ["2.2.2.2", "9.9.9.9", "5.5.5.5", "1.1.1.1"]
    assert [r.ip for r in A.top_suspicious_ips(s, 3).collect()] == ["2.2.2.2", "9.9.9.9", "5.5.5.5"]
    df = spark.createDataFrame([(3, "b"), (1, "b"), (2, "a")], "line_id long, line string")
    assert [(r.line, r.line_id) for r in FL.sorted_log(df).collect()] == [("a", 2), ("b", 1), ("b", 3)]


def test_empty_input_has_totals(spark):
    from logwarden.operators import alerts as AL

    a = AL.stage4_alerts(lines_df(spark, ["x"]).limit(0)).collect()
    assert [(r.severity, r.category, r.metric_value) for r in a] == [("INFO", "SYSTEM", 0)]
    assert AL.detailed_alerts(lines_df(spark, ["x"]).limit(0)).count() == 0
