"""Resumable batch run (manifest) and the streaming jobs against their batch form."""

import pytest
from pyspark.sql import functions as F  # noqa: F401

from conftest import SMOKE, have_testdata
from logwarden.plans import manifest as M
from logwarden.plans.pipeline import STAGE_TABLES, read_table, run_pipeline
from logwarden.sources.derived import load_log_lines
from logwarden.sources.files import collect_logs
from logwarden.streaming import jobs as J
from logwarden.streaming import windows as W

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver test data not present")


def write_logs(lines, logs):
    """Text files under the names the view gives them."""
    import os

    for r in lines.select("source_file").distinct().collect():
        os.makedirs(logs, exist_ok=True)
        own = lines.where(F.col("source_file") == r.source_file).select("line").collect()
        with open(os.path.join(logs, r.source_file), "w") as f:
            f.writelines(x.line + "\n" for x in own)


def test_pipeline_resume_and_rollback(spark, tmp_path):
    out = str(tmp_path / "out")
    src = lambda s: load_log_lines(s, SMOKE)
    st = run_pipeline(spark, src, out, "run1", generated_at="t")
    assert {r.status for r in st.collect()} == {"COMPLETE"}
    assert M.resume_point(st).first().resume_stage == "done"
    n_alerts = read_table(spark, out, "run1", "alerts").count()
    assert n_alerts > 0
    # the lines table is partitioned by type and day: a day range prunes partitions
    from logwarden.plans.pipeline import read_lines
    from logwarden.operators.parse import with_event_time

    part = read_lines(spark, out, "run1", "2024-01-05", "2024-01-06", "auth")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_type" in plan or "event_date" in plan.split("PartitionFilters")[1]
    want = (with_event_time(load_log_lines(spark, SMOKE))
            .where("log_type = 'auth' AND to_date(event_ts) BETWEEN '2024-01-05' AND '2024-01-06'").count())
    assert part.count() == want > 0
    M.rollback(spark, out, "run1", 3)
    st = M.stage_status(spark, out, "run1")
    assert M.resume_point(st).first().resume_stage == "3"
    assert {r.stage: r.status for r in st.collect()} == {1: "COMPLETE", 2: "COMPLETE", 3: "PENDING", 4: "PENDING"}
    st = run_pipeline(spark, src, out, "run1", generated_at="t")
    assert M.resume_point(st).first().resume_stage == "done"
    assert read_table(spark, out, "run1", "alerts").count() == n_alerts
    # a stage refuses to run without its predecessor's output
    with pytest.raises(RuntimeError):
        M.stage_inputs_ok(spark, [str(tmp_path / "nope")])


def test_stream_matches_batch(spark, tmp_path):
    logs = str(tmp_path / "logs")
    L = load_log_lines(spark, SMOKE)
    write_logs(L, logs)
    batch = W.failed_login_windows(collect_logs(spark, logs))
    q = J.stream_failed_login_windows(spark, logs, str(tmp_path / "ck1"), str(tmp_path / "w2"))
    q.awaitTermination()
    got = J.latest_window_counts(spark, str(tmp_path / "w2")).select(*batch.columns)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    # the alert stream covers every window that reaches the lowest tier
    q = J.stream_alerts(spark, logs, str(tmp_path / "ck2"), str(tmp_path / "w3"))
    q.awaitTermination()
    a = J.latest_stream_alerts(spark, str(tmp_path / "w3"))
    want = J.window_alerts(W.window_table(collect_logs(spark, logs))).select(*a.columns)
    assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0
    # dedup keeps one copy of each line
    q = J.stream_dedup(spark, logs, str(tmp_path / "ck3"), str(tmp_path / "w4"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "w4"))
    from logwarden.operators.parse import with_event_time

    T = with_event_time(collect_logs(spark, logs))
    assert got.where("event_ts IS NOT NULL").count() == T.where("event_ts IS NOT NULL").select("line").distinct().count()
    assert got.where("event_ts IS NULL").count() == T.where("event_ts IS NULL").count() > 0


def test_stream_picks_up_only_new_files(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    line = "May 01 10:0{}:00 server sshd[1]: Failed password for root from 1.1.1.{} port 22 ssh2\n"
    (logs / "a.log").write_text(line.format(1, 1))
    ck, out = str(tmp_path / "ck"), str(tmp_path / "out")
    J.stream_failed_lines(spark, str(logs), ck, out).awaitTermination()
    (logs / "b.log").write_text(line.format(2, 2))
    J.stream_failed_lines(spark, str(logs), ck, out).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_stream_dedup_hot_line(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    hot = "May 01 10:00:00 server sshd[1]: Failed password for root from 1.1.1.1 port 22 ssh2\n"
    other = "May 01 10:0{}:00 server kernel[2]: ERROR: Segmentation fault {}\n"
    for f in range(4):
        (logs / f"part{f}.log").write_text(hot * 50 + "".join(other.format(i % 10, i) for i in range(f * 5, f * 5 + 5)))
    (logs / "again.log").write_text(hot * 10 + other.format(0, 0))
    q = J.stream_dedup(spark, str(logs), str(tmp_path / "ck"), str(tmp_path / "out"))
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 1 + 20
    assert out.select("line").distinct().count() == 21


def test_stream_dedup_keeps_late_and_untimed_lines(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    ck, out = str(tmp_path / "ck"), str(tmp_path / "out")
    at = "May 0{} 10:00:00 server sshd[1]: Failed password for root from 1.1.1.{} port 22 ssh2\n"
    (logs / "a.log").write_text(at.format(9, 1) + "no time here\nno time here\n")
    J.stream_dedup(spark, str(logs), ck, out).awaitTermination()
    # days older than anything a watermark would keep, one of them a repeat
    (logs / "b.log").write_text(at.format(1, 2) + at.format(9, 1) + "no time here\n")
    J.stream_dedup(spark, str(logs), ck, out).awaitTermination()
    got = sorted(r.line for r in spark.read.parquet(out).select("line").collect())
    assert got == sorted([at.format(9, 1).strip(), at.format(1, 2).strip(), *["no time here"] * 3])


def test_stream_windows_count_late_lines_and_survive_a_new_checkpoint(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    out = str(tmp_path / "out")
    at = "May 0{} 10:00:00 server sshd[1]: Failed password for root from 1.1.1.1 port 22 ssh2\n"
    (logs / "a.log").write_text(at.format(9))
    J.stream_failed_login_windows(spark, str(logs), str(tmp_path / "ck"), out).awaitTermination()
    (logs / "b.log").write_text(at.format(1) + at.format(9) + "Failed password without a time from 1.1.1.1\n")
    J.stream_failed_login_windows(spark, str(logs), str(tmp_path / "ck"), out).awaitTermination()
    got = {str(r.window_start): r.cnt for r in J.latest_window_counts(spark, out).collect()}
    assert got == {"2024-05-09 10:00:00": 2, "2024-05-01 10:00:00": 1, "None": 1}
    kept = J.compact(spark, out)
    assert kept == 3
    assert {str(r.window_start): r.cnt for r in J.latest_window_counts(spark, out).collect()} == got
    # another checkpoint is another job: it writes beside, never over, what is there
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "c.log").write_text(at.format(9))
    J.stream_failed_login_windows(spark, str(tmp_path / "more"), str(tmp_path / "ck2"), out).awaitTermination()
    got["2024-05-09 10:00:00"] = 3
    assert {str(r.window_start): r.cnt for r in J.latest_window_counts(spark, out).collect()} == got


def test_runs_keep_apart_and_a_reset_leaves_nothing_complete(spark, tmp_path, monkeypatch):
    from fixture_lines import lines_df
    from logwarden.operators import tagging as TG
    from logwarden.plans import pipeline as PL

    out = str(tmp_path / "out")
    bad = "May 01 10:00:00 server sshd[1]: Failed password for root from {} port 22 ssh2"
    one = lambda s: lines_df(s, [bad.format("1.1.1.1")])
    two = lambda s: lines_df(s, [bad.format("2.2.2.2")] * 3)
    run_pipeline(spark, one, out, "a")
    run_pipeline(spark, two, out, "b")
    ips = lambda r: [(x.ip, x.occurrences) for x in read_table(spark, out, r, "ip_summary").collect()]
    assert ips("a") == [("1.1.1.1", 1)] and ips("b") == [("2.2.2.2", 3)]
    for names in STAGE_TABLES.values():
        for n in names:
            read_table(spark, out, "a", n).collect()

    def crash(*_):
        raise RuntimeError("crash in stage 2")

    monkeypatch.setattr(PL, "line_facts", crash)
    with pytest.raises(RuntimeError, match="crash"):
        run_pipeline(spark, two, out, "a", resume=False)
    assert {r.stage: r.status for r in M.stage_status(spark, out, "a").collect()} == {
        1: "COMPLETE", 2: "PENDING", 3: "PENDING", 4: "PENDING"}
    monkeypatch.setattr(PL, "line_facts", TG.line_facts)
    run_pipeline(spark, two, out, "a")
    assert ips("a") == [("2.2.2.2", 3)]


def test_append_mode_emits_closed_windows_only(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    line = "May 01 {}:{:02d}:00 server sshd[1]: Failed password for root from 1.1.1.1 port 22 ssh2\n"
    # windows 10:00, 10:30, 11:00 and 13:00; the last event moves the watermark to 12:00
    (logs / "a.log").write_text(line.format(10, 5) + line.format(10, 40) + line.format(11, 10)
                                + line.format(13, 0))
    out = str(tmp_path / "out")
    J.stream_failed_login_windows(spark, str(logs), str(tmp_path / "ck"), out,
                                  output_mode="append").awaitTermination()
    got = J.latest_window_counts(spark, out)
    # closed behind the watermark: the three windows ending by 12:00; 13:00 stays open
    assert got.count() == 3


def test_text_path_equals_derived_view(spark, tmp_path):
    """The real-log path (text files -> collect_logs) gives the oracle-checked answers."""
    from logwarden.operators import aggregates as A
    from logwarden.operators import alerts as AL
    from logwarden.operators import parse as PR

    L = load_log_lines(spark, SMOKE)
    logs = str(tmp_path / "logs")
    write_logs(L, logs)
    T = collect_logs(spark, logs)
    for fn in (A.ip_summary, A.anomaly_counts, A.usage_stats, AL.stage4_alerts, AL.detailed_alerts,
               PR.parse_auth, PR.parse_apache, PR.parse_syslog, W.failed_login_windows):
        a, b = fn(L), fn(T)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, fn.__name__
