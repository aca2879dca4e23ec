"""Command line: the batch run and its stages, parsers, scans, alerts, digest, stream.

    python -m logwarden.cli run --logs DIR --out DIR [--run-id ID] [--reset]
    python -m logwarden.cli status --out DIR [--run-id ID]
    python -m logwarden.cli rollback --out DIR --stage N [--run-id ID]
    python -m logwarden.cli filter --logs DIR --out DIR [--run-id ID]
    python -m logwarden.cli parse FORMAT --logs DIR --out DIR
    python -m logwarden.cli scan (--logs DIR | --run DIR [--run-id ID]) [--out DIR]
    python -m logwarden.cli check VALUE THRESHOLD [LABEL]
    python -m logwarden.cli show
    python -m logwarden.cli health --logs DIR
    python -m logwarden.cli alerts (--logs DIR [--rules FILE] | --run DIR) --out DIR [--run-id ID]
    python -m logwarden.cli rules --out FILE
    python -m logwarden.cli verify --out DIR [--run-id ID]
    python -m logwarden.cli digest (--logs DIR | --run DIR) --out DIR [--run-id ID]
    python -m logwarden.cli stream [alerts|windows|dedup] --logs DIR --checkpoint DIR --out DIR [--continuous SECONDS]
    python -m logwarden.cli compact alerts|windows|dedup --out DIR [--before DATE]

``rules`` writes the built-in rules as JSON lines; an edited copy is read by
``alerts --rules``.  ``verify`` compares a run's tables with the digests taken
when they were written (exit code 1 if one differs).  ``compact`` folds the
batch folders of a stream's output and drops the days before a date.

``--run DIR`` reads the tables of a finished run instead of scanning raw logs.
Every bound can be set: ``--config FILE`` (JSON, names as in ``Thresholds``),
``--set NAME=VALUE`` (repeatable) and ``--year`` for the year of syslog lines;
``--exclude NAME`` (repeatable) leaves files of that name out.

Every command builds DataFrames and writes tables; rows on the console are
streamed, all of them.  On a cluster, submit this module with
``spark-submit`` and set ``spark.checkpoint.dir`` to shared storage.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from .config import DEFAULT, Thresholds


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import get_spark

    return get_spark()


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def _run_id(args) -> str:
    return args.run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d")


def _config(args) -> Thresholds:
    values: dict = {}
    if args.config:
        with open(args.config) as f:
            values |= json.load(f)
    for pair in args.set or ():
        name, _, value = pair.partition("=")
        values[name] = value
    if args.year is not None:
        values["syslog_year"] = args.year
    return DEFAULT.replaced(values)


def _lines(spark: SparkSession, args) -> DataFrame:
    from .sources.files import collect_logs

    return collect_logs(spark, args.logs, exclude=args.exclude or ())


def _print_rows(df: DataFrame) -> None:
    """Every row, fetched partition by partition."""
    for r in df.toLocalIterator():
        print(" | ".join("" if v is None else str(v) for v in r))


def _incidents(spark, args) -> DataFrame:
    """The incident table of a finished run, or of raw logs."""
    from .operators.alerts import incident_table
    from .plans.pipeline import read_table

    return read_table(spark, args.run, _run_id(args), "incidents") if args.run else incident_table(_lines(spark, args))


def cmd_run(spark, args) -> int:
    from .plans import manifest as M
    from .plans.pipeline import read_table, run_pipeline
    from .sources.files import source_health

    run_id = _run_id(args)
    st = run_pipeline(spark, lambda s: _lines(s, args), args.out, run_id, _config(args),
                      resume=not args.reset, generated_at=_now())
    _print_rows(st)
    done = M.resume_point(st).first().resume_stage == "done"
    if done:
        _print_rows(read_table(spark, args.out, run_id, "run_summary").orderBy("section", "ord", "key"))
    _print_rows(source_health(spark, args.logs))
    return 0 if done else 1


def cmd_status(spark, args) -> int:
    from .plans import manifest as M

    st = M.stage_status(spark, args.out, _run_id(args))
    _print_rows(st.orderBy("stage"))
    _print_rows(M.resume_point(st))
    return 0


def cmd_rollback(spark, args) -> int:
    from .plans import manifest as M

    later = M.rollback(spark, args.out, _run_id(args), args.stage)
    print("rolled back stages:", ", ".join(str(s) for s in later))
    return 0


def cmd_filter(spark, args) -> int:
    from .sources.sinks import write_filtered

    write_filtered(_lines(spark, args), args.out, _run_id(args))
    return 0


def cmd_parse(spark, args) -> int:
    from .operators import parse as PR

    lines, cfg = _lines(spark, args), _config(args)
    parsed = {"auth": lambda: PR.parse_auth(lines, cfg), "apache": lambda: PR.parse_apache(lines),
              "syslog": lambda: PR.parse_syslog(lines)}[args.format]()
    parsed.write.mode("overwrite").parquet(args.out)
    return 0


def cmd_scan(spark, args) -> int:
    from .operators import thresholds as TH

    scan = TH.threshold_scan(None, _config(args), table=_incidents(spark, args))
    if args.out:
        scan.write.mode("overwrite").parquet(args.out)
        scan = spark.read.parquet(args.out)
    exceeded = False
    for r in scan.toLocalIterator():
        print(f"{r.label}: {r.value}/{r.threshold} ({r.pct}%) {r.status}")
        exceeded |= r.status == "EXCEEDED"
    print("any threshold exceeded:", exceeded)
    return 1 if exceeded else 0


def cmd_check(spark, args) -> int:
    from .operators import thresholds as TH

    m = spark.createDataFrame([(args.label, args.value, args.threshold)],
                              "label string, value string, threshold string")
    r = TH.threshold_check(m, cfg=_config(args)).first()
    print(f"{r.label}: {r.value}/{r.threshold} ({r.pct}%) {r.status}")
    return {"EXCEEDED": 0, "WARNING": 0, "OK": 1}.get(r.status, 2)


def cmd_show(spark, args) -> int:
    from .operators import thresholds as TH

    _print_rows(TH.thresholds_table(spark, _config(args)))
    return 0


def cmd_health(spark, args) -> int:
    from .sources.files import source_health

    _print_rows(source_health(spark, args.logs))
    return 0


def cmd_alerts(spark, args) -> int:
    from .operators import alerts as AL
    from .sources.sinks import write_alerts

    if args.rules:
        from .operators.rules import load_rules, read_rules

        if args.run:
            print("--rules needs --logs: the tables of a run hold the counts of its own rules")
            return 2
        alerts = AL.all_alerts_by_rules(_lines(spark, args), load_rules(read_rules(spark, args.rules)), _config(args))
    else:
        alerts = AL.all_alerts(None, _config(args), table=_incidents(spark, args))
    write_alerts(alerts, args.out, _run_id(args))
    return 0


def cmd_rules(spark, args) -> int:
    from dataclasses import asdict

    from .operators.rules import builtin_rules

    with open(args.out, "w") as f:  # a file to edit by hand: one line for each rule
        f.writelines(json.dumps({k: v for k, v in asdict(r).items() if v is not None}) + "\n" for r in builtin_rules(_config(args)))
    return 0


def cmd_verify(spark, args) -> int:
    from .plans.pipeline import check_run

    rows = check_run(spark, args.out, _run_id(args)).orderBy("name").collect()
    for r in rows:
        print(" | ".join(str(v) for v in r))
    return 0 if rows and all(r.status == "OK" for r in rows) else 1


def cmd_digest(spark, args) -> int:
    from .operators import reports as RP
    from .plans.pipeline import read_table
    from .sources.sinks import write_reports

    stats = read_table(spark, args.run, _run_id(args), "line_stats") if args.run else None
    lines = None if args.run else _lines(spark, args)
    digest = RP.alert_digest(lines, _config(args), _now(), _incidents(spark, args), stats)
    write_reports({"alert_digest": digest}, args.out, _run_id(args))
    return 0


def cmd_stream(spark, args) -> int:
    from .streaming import jobs as J

    job = {"alerts": J.stream_alerts, "windows": J.stream_failed_login_windows, "dedup": J.stream_dedup}[args.job]
    q = job(spark, args.logs, args.checkpoint, args.out, _config(args), available_now=args.continuous is None,
            processing_time=f"{args.continuous} seconds" if args.continuous else None)
    q.awaitTermination()
    return 0


def cmd_compact(spark, args) -> int:
    from .streaming import jobs as J

    {"alerts": J.compact_alerts, "windows": J.compact, "dedup": J.compact_lines}[args.job](spark, args.out)
    if args.before:
        if args.job == "windows":
            print("windows are not kept by day: nothing was dropped")
            return 2
        out = f"{args.out.rstrip('/')}/alerts" if args.job == "alerts" else args.out
        print("dropped:", ", ".join(J.drop_days(spark, out, args.before)) or "nothing")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="logwarden", description="Spark security-log analytics")
    sub = p.add_subparsers(dest="cmd", required=True)

    def add(name, fn, *opts):
        s = sub.add_parser(name)
        s.add_argument("--config", default=None, help="JSON file of bounds")
        s.add_argument("--set", action="append", metavar="NAME=VALUE", help="one bound")
        s.add_argument("--year", type=int, default=None, help="year of syslog lines")
        s.add_argument("--exclude", action="append", metavar="NAME", help="file name to leave out")
        for o in opts:
            o(s)
        s.set_defaults(fn=fn)
        return s

    def logs(s):
        s.add_argument("--logs", required=True)

    def logs_or_run(s):
        g = s.add_mutually_exclusive_group(required=True)
        g.add_argument("--logs")
        g.add_argument("--run", help="output folder of a finished run")

    out = lambda s: s.add_argument("--out", required=True)
    rid = lambda s: s.add_argument("--run-id", default=None)
    add("run", cmd_run, logs, out, rid).add_argument("--reset", action="store_true")
    add("status", cmd_status, out, rid)
    add("rollback", cmd_rollback, out, rid).add_argument("--stage", type=int, required=True)
    add("filter", cmd_filter, logs, out, rid)
    add("parse", cmd_parse, logs, out).add_argument("format", choices=("auth", "apache", "syslog"))
    add("scan", cmd_scan, logs_or_run, rid).add_argument("--out", default=None)
    c = add("check", cmd_check)
    c.add_argument("value")
    c.add_argument("threshold")
    c.add_argument("label", nargs="?", default="metric")
    add("show", cmd_show)
    add("health", cmd_health, logs)
    add("alerts", cmd_alerts, logs_or_run, out, rid).add_argument("--rules", default=None, help="rule table: JSON lines, CSV or Parquet")
    add("rules", cmd_rules, out)
    add("verify", cmd_verify, out, rid)
    add("digest", cmd_digest, logs_or_run, out, rid)
    jobs = ("alerts", "windows", "dedup")
    s = add("compact", cmd_compact, out)
    s.add_argument("job", choices=jobs)
    s.add_argument("--before", default=None, help="drop the days before this date")
    s = add("stream", cmd_stream, logs, out)
    s.add_argument("job", nargs="?", choices=jobs, default="alerts")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--continuous", type=int, default=None, help="trigger interval in seconds")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    return args.fn(spark or _session(), args)


if __name__ == "__main__":
    sys.exit(main())
