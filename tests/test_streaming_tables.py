"""Tables of batch folders: crashes at every step of a compaction, replays, and what a batch has to read."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from logwarden.sources.files import collect_logs
from logwarden.streaming import delta as D
from logwarden.streaming import jobs as J
from logwarden.streaming import windows as W

AT = "May {:02d} 10:{:02d}:00 server sshd[1]: Failed password for root from 1.1.1.{} port 22 ssh2\n"


def counts(spark, n, ip="1.1.1.1"):
    return spark.sql(f"SELECT timestamp_ntz'2024-05-01 10:00:00' AS window_start, timestamp_ntz'2024-05-01 10:30:00' AS window_end, "
                     f"'{ip}' AS ip, {n}L AS cnt, 0L AS errors")


def add(spark, out, query, number, n, ip="1.1.1.1"):
    counts(spark, n, ip).write.mode("overwrite").parquet(f"{out}/query={query}/batch_id={number}")


def totals(spark, out):
    return {r.ip: r.cnt for r in J.window_totals(spark, out).collect()}


class Crash(Exception):
    pass


def crash_in_fold(mp):
    def fold(rows):
        raise Crash
    mp.setattr(J, "add_up", fold)


def crash_while_writing(mp):
    """Half of the snapshot is there, without a pointer to it."""
    real = J.add_up

    def fold(rows):
        return real(rows).withColumn("cnt", F.when(F.col("ip") == "2.2.2.2", F.raise_error(F.lit("crash"))).otherwise(F.col("cnt")))
    mp.setattr(J, "add_up", fold)


def crash_before_the_pointer(mp):
    def publish(*_):
        raise Crash
    mp.setattr(D, "publish", publish)


def crash_before_the_rename(mp):
    real = D._fs

    class NoRename:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "rename":
                raise Crash
            return getattr(self.fs, name)

    mp.setattr(D, "_fs", lambda s, p: (lambda fs, q: (NoRename(fs), q))(*real(s, p)))


def crash_after_the_pointer(mp):
    def expire(*_):
        raise Crash
    mp.setattr(D, "expire", expire)


def crash_after_some_deletes(mp):
    real, left = D.delete, [1]

    def delete(spark, path):
        if not left[0]:
            raise Crash
        left[0] -= 1
        real(spark, path)
    mp.setattr(D, "delete", delete)


@pytest.mark.parametrize("crash", [crash_in_fold, crash_while_writing, crash_before_the_pointer, crash_before_the_rename,
                                   crash_after_the_pointer, crash_after_some_deletes])
def test_compaction_that_crashes_loses_and_doubles_nothing(spark, tmp_path, crash):
    out = str(tmp_path / "t")
    for number in range(4):
        add(spark, out, "q", number, 10 ** number)
    add(spark, out, "q", 4, 7, "2.2.2.2")
    add(spark, out, "other", 0, 5)
    add(spark, out, "other", 1, 6)
    J.compact(spark, out)
    for number in range(5, 9):
        add(spark, out, "q", number, 10 ** number)
    want = {"1.1.1.1": 1111 + 11 + 111100000, "2.2.2.2": 7}
    assert totals(spark, out) == want
    with pytest.MonkeyPatch.context() as mp:
        crash(mp)
        try:
            J.compact(spark, out)
        except Exception as e:  # noqa: BLE001
            assert isinstance(e, Crash) or "crash" in str(e)
    assert totals(spark, out) == want
    assert J.compact(spark, out) == 2 and totals(spark, out) == want
    add(spark, out, "q", 9, 1)
    J.compact(spark, out)
    J.compact(spark, out)
    assert totals(spark, out) == want | {"1.1.1.1": want["1.1.1.1"] + 1}
    # what was folded two versions ago is gone, and nothing that failed is left
    assert len(glob.glob(f"{out}/_snapshots/rows-*")) <= 2
    assert not os.path.exists(f"{out}/query=q/batch_id=0")


def test_replayed_batch_counts_once(spark, tmp_path):
    """A batch that was written, then folded, then replayed because it was never committed."""
    out = str(tmp_path / "t")
    for number in range(3):
        add(spark, out, "q", number, 10)
    J.compact(spark, out)
    assert D.current(spark, out).marks == {"q": 1}
    add(spark, out, "q", 1, 10)
    add(spark, out, "q", 2, 10)  # the newest: written again, not folded yet
    assert totals(spark, out) == {"1.1.1.1": 30}
    J.compact(spark, out)
    assert totals(spark, out) == {"1.1.1.1": 30}


def test_two_compactions_cannot_both_win(spark, tmp_path):
    out = str(tmp_path / "t")
    for number in range(3):
        add(spark, out, "q", number, 1)
    old = D.current(spark, out)
    J.compact(spark, out)
    with pytest.raises(RuntimeError, match="another job"):
        D.publish(spark, out, D.Version(old.number + 1, "rows-x", {"q": 99}))
    assert totals(spark, out) == {"1.1.1.1": 3}


def test_table_before_its_first_write(spark, tmp_path):
    out = str(tmp_path / "none")
    assert totals(spark, out) == {} and J.compact(spark, out) == 0
    assert J.stream_dedup_lines(spark, out).count() == 0 and J.stream_alert_rows(spark, out).count() == 0


def lines(spark, day, text):
    return spark.sql(f"SELECT '{text}' AS line, 'f' AS source_file, 'auth' AS log_type, "
                     f"timestamp_ntz'{day} 10:00:00' AS event_ts, date'{day}' AS day")


def test_dedup_lookup_does_not_grow_with_history(spark, tmp_path):
    """Of all batches ever written, a batch reads those of its days that its state does not cover."""
    out, hour = str(tmp_path / "t"), 3600
    for n in range(12):  # one batch an hour, three a day
        J._write_by_day(lines(spark, f"2024-05-{1 + n // 3:02d}", f"x{n}"), out, {"query": "q", "arrived": n * hour, "batch_id": n})
    J._write_by_day(lines(spark, "2024-05-02", "y"), out, {"query": "old", "arrived": 0, "batch_id": 0})

    def files(days, since):
        folders = J.lines_before(spark, out, days, "q", 12, since)
        return len(D.read(spark, folders, J.LINE_SCHEMA).inputFiles())

    assert files(["2024-05-04"], 6 * hour) == 0  # today's lines are all in the state
    assert files(["2024-05-02"], 6 * hour) == 3 + 1  # a late line: its own day, and what another job wrote
    assert files(["2024-05-02"], 4 * hour) == 1 + 1
    assert files(["2024-06-01", None], 12 * hour) == 0
    J.compact_lines(spark, out)
    assert sorted(r.line for r in J.stream_dedup_lines(spark, out).collect()) == sorted([*(f"x{n}" for n in range(12)), "y"])
    assert files(["2024-05-02"], 12 * hour) == 1 + 2  # the snapshot and each job's newest batch
    assert J.drop_days(spark, out, "2024-05-03") == ["2024-05-01", "2024-05-02"]
    assert sorted(r.line for r in J.stream_dedup_lines(spark, out).collect()) == sorted(f"x{n}" for n in range(6, 12))


def test_dedup_beyond_the_horizon(spark, tmp_path):
    """Repeats that the state no longer holds are found in the output of their day; replays change nothing."""
    logs, ck, out = tmp_path / "logs", str(tmp_path / "ck"), str(tmp_path / "out")
    logs.mkdir()
    run = lambda: J.stream_dedup(spark, str(logs), ck, out, horizon="1 second").awaitTermination()
    (logs / "a.log").write_text(AT.format(9, 1, 1) + AT.format(3, 1, 1) + "no time\n")
    run()
    time.sleep(2)
    (logs / "b.log").write_text(AT.format(9, 1, 1) * 3 + AT.format(3, 1, 2) + AT.format(1, 1, 1) + "no time\n")
    run()
    time.sleep(2)
    (logs / "c.log").write_text(AT.format(1, 1, 1) + AT.format(3, 1, 2) + AT.format(3, 1, 1))
    run()
    want = sorted([AT.format(9, 1, 1), AT.format(3, 1, 1), AT.format(3, 1, 2), AT.format(1, 1, 1), "no time\n", "no time\n"])
    got = lambda: sorted(r.line + "\n" for r in J.stream_dedup_lines(spark, out).collect())
    assert got() == want
    # the last commit is lost: its batch runs again
    last = max(glob.glob(f"{ck}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    os.remove(os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc"))
    run()
    assert got() == want


def test_alert_stream_tells_climbs_and_equals_the_batch(spark, tmp_path):
    logs, ck, out = tmp_path / "logs", str(tmp_path / "ck"), str(tmp_path / "out")
    logs.mkdir()
    run = lambda: J.stream_alerts(spark, str(logs), ck, out).awaitTermination()

    def same_as_batch():
        a = J.latest_stream_alerts(spark, out)
        want = J.window_alerts(W.window_table(collect_logs(spark, str(logs)))).select(*a.columns)
        assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0 and want.count()

    (logs / "a.log").write_text(AT.format(9, 1, 1) * 6 + AT.format(8, 1, 2) * 30 + "Failed password from 1.1.1.9\n" * 2)
    run()
    same_as_batch()
    # late lines of the first window, more of the untimed, one more of a window that stays in its tier
    (logs / "b.log").write_text(AT.format(9, 2, 1) * 20 + "Failed password from 1.1.1.9\n" * 4 + AT.format(8, 3, 2))
    run()
    same_as_batch()
    rows = {(r.category, r.severity, r.ip, r.metric_value): r.climbed
            for r in J.stream_alert_rows(spark, out).where("engine = 'detailed'").collect()}
    assert rows == {("SSH", "HIGH", "1.1.1.1", 6): True, ("SSH", "CRITICAL", "1.1.1.2", 30): True, ("SSH", "MEDIUM", "1.1.1.9", 2): True,
                    ("SSH", "CRITICAL", "1.1.1.1", 26): True, ("SSH", "HIGH", "1.1.1.9", 6): True, ("SSH", "CRITICAL", "1.1.1.2", 31): False}
    # a batch of one day reads the alerts of that day alone
    import datetime

    folders = J.alerts_before(spark, f"{out}/alerts", [datetime.date(2024, 5, 9)], "q", 5)
    assert folders and all("day=2024-05-09" in f for f in folders)
    J.compact_alerts(spark, out)
    same_as_batch()
    J.compact_alerts(spark, out)
    same_as_batch()
