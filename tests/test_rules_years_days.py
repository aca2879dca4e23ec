"""Rule tables, years of syslog lines, file types, day summaries, and the contents of a run."""

import json
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixture_lines import lines_df
from logwarden.config import DEFAULT
from logwarden.operators import aggregates as A
from logwarden.operators import alerts as AL
from logwarden.operators import rules as RU
from logwarden.operators import sketches as SK
from logwarden.operators import tagging as TG
from logwarden.operators import years as YR
from logwarden.plans import contents as CO
from logwarden.plans.pipeline import check_run, run_pipeline, table_path
from logwarden.sources import files as FI


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ---- rules

def test_built_in_rules_from_a_table_give_the_same_rows(spark, mixed):
    rules = RU.load_rules(RU.rule_table(spark))
    assert same(TG.anomaly_scan(mixed, rules), TG.anomaly_scan(mixed))
    assert same(TG.anomaly_summary(mixed, rules), TG.anomaly_summary(mixed))
    assert same(A.anomaly_counts(mixed, rules=rules), A.anomaly_counts(mixed))
    assert same(AL.rule_alerts(mixed, rules), AL.global_alerts(mixed))


def test_rule_from_a_file_without_code(spark, tmp_path):
    """A pattern, a severity and tiers come from a file that a user edits."""
    lines = lines_df(spark, ["disk full on /var", "disk full on /var", "DISK FULL", "tape full", "Failed password disk full from 1.1.1.1"])
    path = str(tmp_path / "rules.json")
    rows = [{"kind": "scan", "name": "Disk", "pattern": "(?i)disk full", "ord": 1},
            {"kind": "count", "name": "Disks", "pattern": "disk full|tape full"},
            {"kind": "metric", "name": "full", "pattern": "(?i)disk full", "scope": "all"},
            {"kind": "metric", "name": "full_failed", "pattern": "disk full", "scope": "failed"},
            {"kind": "alert", "name": "x2", "ord": 2, "grp": "x", "category": "DISK", "severity": "LOW", "metric": "full", "op": ">=", "bound": 1, "message": "{n} full"},
            {"kind": "alert", "name": "x1", "ord": 1, "grp": "x", "category": "DISK", "severity": "HIGH", "metric": "full", "op": ">", "bound": 3, "message": "{n} full!", "action": "free {n}"},
            {"kind": "alert", "name": "y", "ord": 3, "category": "DISK", "severity": "LOW", "metric": "full_failed", "op": ">=", "bound": 1, "message": "{n}"},
            {"kind": "alert", "name": "z", "ord": 4, "category": "DISK", "severity": "LOW", "metric": "full", "guard": "susp_lines", "op": ">=", "bound": 1, "message": "{n}"}]
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    rules = RU.load_rules(RU.read_rules(spark, path))
    assert TG.anomaly_scan(lines, rules).count() == 4
    assert {r.anomaly_type: r.cnt for r in TG.anomaly_summary(lines, rules).collect()} == {"Disk": 4, "TOTAL": 4}
    assert {r.metric: r.cnt for r in A.anomaly_counts(lines, rules=rules).collect()} == {"Disks": 4, "TOTAL": 4}
    got = [(r.severity, r.metric_value, r.threshold, r.message, r.action) for r in AL.rule_alerts(lines, rules).orderBy("severity").collect()]
    assert got == [("HIGH", 4, 3, "4 full!", "free 4"), ("LOW", 1, 1, "1", None)]


@pytest.mark.parametrize(("row", "why"), [
    ({"kind": "scam", "name": "a", "pattern": "x"}, "one of the kinds"),
    ({"kind": "scan", "name": "a"}, "lacks pattern"),
    ({"kind": "scan", "name": "a", "pattern": "("}, "pattern"),
    ({"kind": "metric", "name": "m", "pattern": "x", "scope": "some"}, "scope"),
    ({"kind": "metric", "name": "oom", "pattern": "x", "scope": "all"}, "new name"),
    ({"kind": "alert", "name": "a", "category": "c", "severity": "LOW", "metric": "nope", "op": ">", "message": "m"}, "unknown metric"),
    ({"kind": "alert", "name": "a", "category": "c", "severity": "LOW", "metric": "oom", "op": "=", "message": "m"}, "op not"),
    ({"kind": "alert", "name": "a", "category": "c", "severity": "LOW", "metric": "oom", "op": ">", "message": "{who}"}, "filled"),
])
def test_bad_rules_are_named(row, why):
    with pytest.raises(ValueError, match=why):
        RU.check([RU.Rule(**row)])


def test_rule_table_is_bounded(spark):
    many = spark.range(RU.MAX_RULES + 1).select(F.lit("scan").alias("kind"), F.col("id").cast("string").alias("name"), F.lit("x").alias("pattern"))
    with pytest.raises(ValueError, match="at most"):
        RU.load_rules(many)
    with pytest.raises(ValueError, match="given twice"):
        RU.load_rules(many.limit(3).withColumn("name", F.lit("same")))


# ---- years

def stamped(spark, tmp_path, files):
    """Files of lines with their last change; read in splits of a few hundred bytes."""
    logs = tmp_path / "logs"
    logs.mkdir()
    for name, (lines, at) in files.items():
        (logs / name).write_text("".join(x + "\n" for x in lines))
        import calendar

        t = calendar.timegm(at)
        os.utime(logs / name, (t, t))
    return str(logs)


def test_year_turns_within_a_file(spark, tmp_path):
    line = "{} server sshd[1]: Failed password for root from 1.1.1.1 port 22 ssh2"
    long = [f"{m} {d:2d} 10:00:00" for _ in range(3) for m in "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split() for d in (1, 15)]
    files = {
        # the turn, a late line of the old year, and an unreadable one between
        "auth.log": ([line.format(s) for s in ("Dec 30 23:59:00", "Dec 31 23:59:59", "Jan  1 00:00:01", "Dec 31 23:59:58", "nonsense", "Jan 02 10:00:00")],
                     (2025, 1, 2, 11, 0, 0)),
        # last changed in January, last line of December
        "syslog": ([line.format("Nov 11 10:00:00"), line.format("Dec 31 10:00:00")], (2025, 1, 5, 0, 0, 0)),
        # three years, in many splits
        "long.txt": ([line.format(s) for s in long], (2025, 12, 20, 0, 0, 0)),
        "feb.txt": ([line.format(s) for s in ("Feb 28 10:00:00", "Feb 29 10:00:00", "Mar 01 10:00:00")], (2025, 3, 2, 0, 0, 0)),
        "web.txt": (['1.1.1.1 - - [01/Jan/2019:00:00:00 +0000] "GET / HTTP/1.1" 200 1 "-" "-"'], (2025, 3, 2, 0, 0, 0)),
    }
    path = stamped(spark, tmp_path, files)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        t = YR.with_inferred_time(FI.collect_logs(spark, path, with_place=True))
        rows = [(r.source_file, r.source_block, r.source_row, r.line, r.event_ts) for r in t.collect()]
        assert len({r[1] for r in rows if r[0] == "long.txt"}) > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {name: [str(r[4]) for r in sorted(rows, key=lambda r: r[1:3]) if r[0] == name] for name in files}
    assert got["auth.log"] == ["2024-12-30 23:59:00", "2024-12-31 23:59:59", "2025-01-01 00:00:01", "2024-12-31 23:59:58", "None", "2025-01-02 10:00:00"]
    assert got["syslog"] == ["2024-11-11 10:00:00", "2024-12-31 10:00:00"]
    assert got["long.txt"][0] == "2023-01-01 10:00:00" and got["long.txt"][-1] == "2025-12-15 10:00:00"
    assert got["long.txt"] == sorted(got["long.txt"]) and Counter(x[:4] for x in got["long.txt"]) == {"2023": 24, "2024": 24, "2025": 24}
    assert got["feb.txt"] == ["2025-02-28 10:00:00", "None", "2025-03-01 10:00:00"]
    assert got["web.txt"] == ["2019-01-01 00:00:00"]


# ---- files

def test_one_type_for_each_file(spark):
    auth = "Jan 01 10:00:00 server sshd[1]: Failed password for root from 1.1.1.1 port 22 ssh2"
    sys_ = "Jan 01 10:00:00 server kernel[1]: ERROR: x"
    web = '1.1.1.1 - - [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 1 "-" "-"'
    files = {"a": [auth, auth, web], "tie": [auth, web], "tie2": [sys_, auth], "none": ["x", ""], "syslog": [web, web], "one": [sys_, "x", "x"]}
    rows = [(line, name) for name, lines in files.items() for line in lines]
    t = spark.createDataFrame(rows, "line string, source_file string")
    got = {r.source_file: (r.log_type, r.mixed, r.n_lines) for r in FI.classify_files(t).collect()}
    assert got == {"a": ("auth", True, 3), "tie": ("apache", True, 2), "tie2": ("auth", True, 2), "none": ("unknown", False, 2),
                   "syslog": ("syslog", False, 2), "one": ("syslog", False, 3)}
    assert {(r.source_file, r.log_type) for r in FI.with_file_type(t).collect()} == {(k, v[0]) for k, v in got.items()}


def test_health_lists_empty_and_missing_names_at_once(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "syslog").write_text("")
    (tmp_path / "auth.log").write_text("x\n")
    (tmp_path / "a b%.log").write_text("")
    got = {r.source: (r.bytes, r.status) for r in FI.source_health(spark, str(tmp_path), ["auth.log", "syslog", "apache.log", "a b%.log"]).collect()}
    assert got == {"auth.log": (2, "OK"), "syslog": (0, "EMPTY"), "apache.log": (None, "MISSING"), "a b%.log": (0, "EMPTY")}


# ---- summaries of days

@pytest.fixture(scope="module")
def skewed_days(spark):
    """Ten days; one address a third of all, ties, and addresses that no day has often but the whole range has."""
    rng = random.Random(7)
    rows = []
    for day in range(1, 11):
        at = f"May {day:02d} 10:00:00 server sshd[1]: Failed password for root from {{}} port 22 ssh2"
        rows += [at.format("9.9.9.9")] * 200 + [at.format(f"8.8.8.{k % 12}") for k in range(120)]
        rows += [at.format(f"7.7.{rng.randrange(40)}.{rng.randrange(5)}") for _ in range(280)]
    return lines_df(spark, rows)


def exact(lines, days, n):
    c = Counter(ip for d, ip in ((r.day.day, r.ip) for r in SK.ip_days(lines).collect() if r.day) if d in days)
    return sorted(c.items(), key=lambda x: (x[1], x[0]), reverse=True)[:n]


@pytest.mark.parametrize("keep", [1, 5, 14, 30, 1000])
def test_top_of_any_range_is_exact(skewed_days, keep):
    """Whatever a day keeps; the few that may be among the top are counted again."""
    summary = SK.daily_top(skewed_days, keep=keep)
    for start, end in ((1, 10), (3, 3), (2, 6)):
        got = [(r.ip, r.cnt) for r in SK.top_between(skewed_days, summary, 11, f"2024-05-{start:02d}", f"2024-05-{end:02d}").collect()]
        assert got == exact(skewed_days, range(start, end + 1), 11)
    ips, bound, others = SK.top_candidates(summary, 11)
    truth = dict(exact(skewed_days, range(1, 11), 10 ** 6))
    assert all(r.low <= truth[r.ip] <= r.high for r in ips.collect())
    kept = {r.ip for r in ips.collect()}
    assert max([c for ip, c in truth.items() if ip not in kept], default=0) <= others
    if keep == 30:  # recounted: the candidates, not every address
        assert others < bound and ips.where(F.col("high") >= bound).count() < len(truth) / 2


def test_sketches_merge(spark, skewed_days):
    """Days are sketched apart; a range is their union, within the stated error."""
    parts = [SK.daily_sketches(skewed_days.where(F.col("line").startswith(f"May {d:02d}"))) for d in range(1, 11)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionAll(p)
    for start, end in ((1, 10), (4, 5)):
        want = len(exact(skewed_days, range(start, end + 1), 10 ** 6))
        got = SK.unique_ips_between(merged, f"2024-05-{start:02d}", f"2024-05-{end:02d}").first().unique_ips
        assert abs(got - want) <= max(1, 0.05 * want)
    assert SK.unique_ips_between(merged, "2030-01-01").first().unique_ips == 0
    assert SK.estimate_error(skewed_days, "2024-05-01", "2024-05-10").first().within


# ---- contents of a run

def test_cut_and_edited_outputs_are_found(spark, mixed, tmp_path):
    out = str(tmp_path / "out")
    run_pipeline(spark, lambda s: mixed, out, "r1", DEFAULT, generated_at="t")
    assert {r.status for r in check_run(spark, out, "r1").collect()} == {"OK"}
    # one row gone, one value edited, two swapped between rows, a table gone
    path = lambda n: table_path(out, "r1", n)
    ips = spark.read.parquet(path("ip_summary")).collect()
    spark.createDataFrame(ips[1:], "ip string, occurrences bigint, risk string").write.mode("overwrite").parquet(path("ip_summary"))
    stats = [(r.metric, r.cnt) for r in spark.read.parquet(path("line_stats")).collect()]
    swapped = [(stats[0][0], stats[1][1]), (stats[1][0], stats[0][1]), *stats[2:]]
    assert stats[0][1] != stats[1][1]
    spark.createDataFrame(swapped, "metric string, cnt bigint").write.mode("overwrite").parquet(path("line_stats"))
    import shutil

    shutil.rmtree(path("apache"))
    bad = {r.name: r.status for r in check_run(spark, out, "r1").collect() if r.status != "OK"}
    assert bad == {"ip_summary": "CHANGED", "line_stats": "CHANGED", "apache": "MISSING"}


def test_diff_of_two_tables(spark):
    a = spark.createDataFrame([("x", 1, None), ("y", 2, "b"), (None, 3, "c"), ("gone", 4, "d")], "k string, n int, s string")
    b = spark.createDataFrame([("x", 1, None), ("y", 2, "B"), (None, 3, None), ("new", None, None)], "k string, n int, s string")
    got = sorted((tuple(r) for r in CO.diff(a, b, ["k"]).collect()), key=str)
    assert got == sorted([("y", "changed", 2, "b", 2, "B"), (None, "changed", 3, "c", 3, None), ("gone", "removed", 4, "d", None, None),
                          ("new", "added", None, None, None, None)], key=str)
    assert CO.diff(a, a, ["k"]).count() == 0
    one = a.agg(*CO.content_exprs(a)).first()
    assert one == a.repartition(3).select("s", "k", "n").agg(*CO.content_exprs(a)).first()
    moved = spark.createDataFrame([(None, "q"), ("q", None)], "k string, s string")
    assert moved.limit(1).agg(*CO.content_exprs(moved)).first() != moved.offset(1).agg(*CO.content_exprs(moved)).first()
    assert re.fullmatch(r"-?\d+", one["hash_sum"])
