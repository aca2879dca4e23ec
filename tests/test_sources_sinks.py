"""Text collection, source health, sinks and the state reader."""

import os

from pyspark.sql import functions as F

from fixture_lines import apache_lines, auth_lines, syslog_lines
from logwarden.sources import sinks as SK
from logwarden.sources.files import collect_logs, source_health


def _write(path, lines, crlf=False):
    nl = "\r\n" if crlf else "\n"
    with open(path, "w") as fh:
        fh.write(nl.join(lines) + (nl if lines else ""))


def _log_dir(tmp_path):
    d = tmp_path / "logs"
    (d / "nested").mkdir(parents=True)
    _write(d / "auth.log", auth_lines(), crlf=True)
    _write(d / "nested" / "apache.log", apache_lines())
    _write(d / "sample_logs.log", auth_lines())     # a copy: collected unless excluded
    _write(d / "other.txt", syslog_lines())         # unknown name: typed by content
    return str(d)


def test_collect_logs(spark, tmp_path):
    d = _log_dir(tmp_path)
    L = collect_logs(spark, d, exclude=["sample_logs.log"])
    got = {r.log_type: r["count"] for r in L.groupBy("log_type").count().collect()}
    assert got == {"auth": 80, "apache": 85, "syslog": 60}
    assert L.where(F.col("line").endswith("\r")).count() == 0
    files = {r.source_file for r in L.select("source_file").distinct().collect()}
    assert files == {"auth.log", "apache.log", "other.txt"}
    every = collect_logs(spark, d)
    assert every.count() == 80 + 85 + 60 + 80
    # a file of mixed formats is typed line by line
    assert every.where("source_file = 'sample_logs.log' AND log_type = 'auth'").count() == 80


def test_source_health(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    _write(d / "auth.log", ["x"])
    open(d / "syslog", "w").close()
    h = {r.source: (r.status, r.bytes) for r in source_health(spark, str(d)).collect()}
    assert h["auth.log"] == ("OK", 2)
    assert h["syslog"] == ("EMPTY", 0)
    assert h["apache.log"] == ("MISSING", None)


def test_sinks_idempotent_per_run(spark, tmp_path, mixed):
    out = str(tmp_path / "filtered")
    SK.write_filtered(mixed, out, "r1")
    SK.write_filtered(mixed, out, "r1")      # rerun of the same run overwrites, never appends
    SK.write_filtered(mixed.limit(0), out, "r2")
    t = spark.read.parquet(out)
    got = {r.tag: r["count"] for r in t.where("run_id = 'r1'").groupBy("tag").count().collect()}
    assert got == {"failed_logins": 35, "suspicious_ips": 60, "server_errors": 30}
    from logwarden.operators import alerts as AL

    ap = str(tmp_path / "alerts")
    a = AL.stage4_alerts(mixed)
    SK.write_alerts(a, ap, "r1")
    t = spark.read.parquet(ap)
    assert sorted(os.listdir(os.path.join(ap, "run_id=r1"))) == ["channel=critical", "channel=warning"]
    assert SK.main_log(t).count() == 7
    SK.write_reports({"usage": mixed.groupBy("log_type").count()}, str(tmp_path / "rep"), "r1")
    assert spark.read.parquet(str(tmp_path / "rep" / "usage")).count() == 3


def test_parse_state(spark, tmp_path):
    p = tmp_path / "state"
    _write(p, ["# state", "STAGE=2", "STATUS=RUNNING", "STATUS=\"COMPLETED\"", "OTHER=1", ""])
    r = SK.parse_state(spark.read.text(str(p)), ["STAGE", "STATUS", "TIMESTAMP"]).first()
    assert r.STAGE == "2" and r.STATUS == "COMPLETED" and r.TIMESTAMP is None
