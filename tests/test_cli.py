"""The command line over a folder of text logs."""

from fixture_lines import apache_lines, auth_lines, syslog_lines
from logwarden.cli import main


def _logs(tmp_path):
    d = tmp_path / "logs"
    d.mkdir()
    for name, lines in (("auth.log", auth_lines()), ("syslog", syslog_lines()), ("apache.log", apache_lines())):
        (d / name).write_text("\n".join(lines) + "\n")
    return str(d)


def test_cli_run_status_rollback(spark, tmp_path, capsys):
    logs, out = _logs(tmp_path), str(tmp_path / "out")
    assert main(["run", "--logs", logs, "--out", out, "--run-id", "r1"], spark) == 0
    alerts = spark.read.parquet(f"{out}/run_id=r1/alerts")
    assert "Critical Alerts Fired" in capsys.readouterr().out
    # scan, alerts and digest over the tables of the finished run
    assert main(["scan", "--run", out, "--run-id", "r1"], spark) == 1
    again = str(tmp_path / "again")
    assert main(["alerts", "--run", out, "--run-id", "r1", "--out", again], spark) == 0
    assert spark.read.parquet(again).count() == alerts.count()
    assert main(["digest", "--run", out, "--run-id", "r1", "--out", again + "-d"], spark) == 0
    assert alerts.where("engine = 'stage4' AND channel = 'critical'").count() == 5
    assert main(["rollback", "--out", out, "--run-id", "r1", "--stage", "4"], spark) == 0
    assert main(["status", "--out", out, "--run-id", "r1"], spark) == 0
    assert "PENDING" in capsys.readouterr().out
    assert main(["run", "--logs", logs, "--out", out, "--run-id", "r1"], spark) == 0


def test_cli_scan_check_alerts(spark, tmp_path, capsys):
    logs = _logs(tmp_path)
    assert main(["scan", "--logs", logs], spark) == 1          # thresholds exceeded
    assert "any threshold exceeded: True" in capsys.readouterr().out
    assert main(["check", "4", "5", "x"], spark) == 0           # 80% -> WARNING
    assert "WARNING" in capsys.readouterr().out
    assert main(["check", "abc", "5"], spark) == 2              # INVALID
    assert main(["show"], spark) == 0
    out = str(tmp_path / "alerts")
    assert main(["alerts", "--logs", logs, "--out", out, "--run-id", "r"], spark) == 0
    assert spark.read.parquet(out).count() == 7 + 12
    dg = str(tmp_path / "digest")
    assert main(["digest", "--logs", logs, "--out", dg, "--run-id", "r"], spark) == 0
    assert spark.read.parquet(f"{dg}/alert_digest").where("section = 'STATUS'").count() == 1


def test_cli_scan_prints_every_metric(spark, tmp_path, capsys):
    d = tmp_path / "many"
    d.mkdir()
    line = "May 01 10:00:00 server sshd[1]: Failed password for root from 1.1.1.{} port 22 ssh2\n"
    (d / "auth.log").write_text("".join(line.format(i) * (6 if i < 30 else 1) for i in range(60)))
    assert main(["scan", "--logs", str(d)], spark) == 1
    out = capsys.readouterr().out
    assert out.count("EXCEEDED") == 30 and out.count(" OK") == 30


def test_cli_bounds_year_and_excluded_files(spark, tmp_path, capsys):
    logs = _logs(tmp_path)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert main(["alerts", "--logs", logs, "--out", a, "--run-id", "r"], spark) == 0
    cfg = tmp_path / "bounds.json"
    cfg.write_text('{"failed_login": 1000, "tiers": [1000, 900, 800]}')
    assert main(["alerts", "--logs", logs, "--out", b, "--run-id", "r", "--config", str(cfg),
                 "--set", "error=100000"], spark) == 0
    crit = lambda p: spark.read.parquet(p).where("engine = 'stage4' AND severity = 'CRITICAL'").count()
    assert crit(a) > 0 and crit(b) == 0
    p = str(tmp_path / "p")
    assert main(["parse", "auth", "--logs", logs, "--out", p, "--year", "2031"], spark) == 0
    assert {r[0] for r in spark.read.parquet(p).selectExpr("year(event_time)").distinct().collect()} == {2031}
    assert main(["scan", "--logs", logs, "--exclude", "auth.log", "--exclude", "syslog", "--exclude", "apache.log"], spark) == 0
    assert main(["health", "--logs", logs], spark) == 0
    assert "sample_logs.log |  | MISSING" in capsys.readouterr().out


def test_cli_rules_verify_and_compact(spark, tmp_path, capsys):
    """The built-in rules, edited in a file; a run's tables; a stream's output folded and cut."""
    import json

    logs, rules = _logs(tmp_path), str(tmp_path / "rules.json")
    assert main(["rules", "--out", rules], spark) == 0
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert main(["alerts", "--logs", logs, "--out", a], spark) == 0
    assert main(["alerts", "--logs", logs, "--rules", rules, "--out", b], spark) == 0
    read = lambda p: sorted(str(r) for r in spark.read.parquet(p).drop("run_id").collect())
    assert read(a) == read(b)
    rows = [json.loads(x) for x in open(rules)]
    rows += [{"kind": "metric", "name": "pings", "pattern": "sshd", "scope": "all"},
             {"kind": "alert", "name": "ping", "category": "OWN", "severity": "LOW", "metric": "pings", "op": ">=", "bound": 1, "message": "{n} pings"}]
    with open(rules, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    assert main(["alerts", "--logs", logs, "--rules", rules, "--out", b], spark) == 0
    more = set(read(b)) - set(read(a))
    assert len(more) == 1 and "pings" in more.pop()
    run = str(tmp_path / "run")
    assert main(["run", "--logs", logs, "--out", run, "--run-id", "r"], spark) == 0
    assert main(["verify", "--out", run, "--run-id", "r"], spark) == 0
    spark.range(3).write.mode("overwrite").parquet(f"{run}/run_id=r/usage_stats")
    assert main(["verify", "--out", run, "--run-id", "r"], spark) == 1
    assert "usage_stats" in capsys.readouterr().out
    ck, out = str(tmp_path / "ck"), str(tmp_path / "w4")
    assert main(["stream", "dedup", "--logs", logs, "--checkpoint", ck, "--out", out], spark) == 0
    from logwarden.streaming.jobs import stream_dedup_lines

    n = stream_dedup_lines(spark, out).count()
    assert main(["compact", "dedup", "--out", out, "--before", "2000-01-01"], spark) == 0
    assert stream_dedup_lines(spark, out).count() == n > 0
