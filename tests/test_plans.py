"""Plan shapes that matter at scale, checked on the physical plans of the registered queries."""

import pytest

from conftest import SMOKE, have_testdata

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver test data not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


#: queries whose windows are within a split of a file, the splits of a file, or the first ranks of a day
WINDOWED = ("event_time_inferred", "top_ips_merged")


def test_no_pair_joins_or_windows_anywhere(spark):
    from logwarden.plans.registry import queries

    for name, fn in queries().items():
        p = _plan(fn(spark, SMOKE))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition" if name in WINDOWED else "Window ["):
            assert bad not in p, (name, bad)


def test_ranks_of_a_day_are_cut_before_the_shuffle(spark):
    from logwarden.operators.sketches import daily_top
    from logwarden.sources.derived import load_log_lines

    p = _plan(daily_top(load_log_lines(spark, SMOKE), keep=5))
    assert p.count("WindowGroupLimit") == 2 and "Partial" in p


def test_per_key_counts_aggregate_before_the_shuffle(spark):
    from logwarden.plans.registry import queries

    qs = queries()
    for name in ("ip_summary", "failed_by_ip", "requests_per_ip", "errors_per_service",
                 "auth_failed_per_user", "failed_login_windows", "unique_ips", "suspicious_lines"):
        p = _plan(qs[name](spark, SMOKE))
        # a map-side HashAggregate below the exchange and a final one above it
        # (a distinct has no aggregate functions, so no ``partial_`` name)
        assert p.count("HashAggregate(") >= 2 and "Exchange hashpartitioning" in p, name


def test_event_scan_reads_only_needed_columns(spark):
    from logwarden.plans.registry import queries

    p = _plan(queries()["ip_summary"](spark, SMOKE))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert "value" not in p.split("ReadSchema:")[1].split(">")[0]


def test_alert_engines_have_no_broadcast_of_data(spark):
    from logwarden.plans.registry import queries

    for name in ("stage4_alerts", "detailed_alerts", "final_report", "threshold_scan"):
        p = _plan(queries()[name](spark, SMOKE))
        assert "BroadcastExchange" not in p, name


def _tree_count(df, word: str) -> int:
    return _plan(df).count(word)


def test_alert_engines_are_one_lazy_scan(spark):
    from logwarden.plans.registry import queries

    qs = queries()
    for name in ("threshold_scan", "threshold_verdict", "stage4_alerts", "stage4_alerts_alt", "detailed_alerts",
                 "detailed_alerts_alt", "alert_severity_counts", "status_flag", "parse_alert_line"):
        df = qs[name](spark, SMOKE)
        assert _tree_count(df, "FileScan") == 1, name
        assert "Scan ExistingRDD" not in _plan(df).replace("Scan ExistingRDD[]", ""), name


def test_reports_scan_their_lines_twice_at_most(spark):
    from logwarden.plans.registry import queries

    for name in ("final_report", "alert_digest", "run_summary"):
        df = queries()[name](spark, SMOKE)
        df.collect()
        p = _plan(df)
        final = p.split("== Initial Plan ==")[0]
        assert final.count("FileScan") <= 2, (name, final.count("FileScan"))
