"""The four-stage batch run (collect -> filter -> aggregate -> alert), resumable.

Each stage reads the previous stage's Parquet output and writes its own with
``mode('overwrite')``, so a stage is idempotent and a rerun after a lost
executor or a lost driver repeats at most one stage.  Stage edges are the
only materialisation points; inside a stage Spark plans one DAG.

Outputs of a run are under ``out_dir/run_id=<r>``: runs never overwrite each
other, and older runs stay as they were.

* stage 1: ``lines`` (``line, source_file``, partitioned by ``log_type`` and ``event_date``)
* stage 2: ``filtered`` (the three filter sets, by ``tag``), ``line_facts``
  (their compact form: rule flags, IP tokens, multiplicity), ``auth``,
  ``apache``, ``syslog`` (parsed)
* stage 3: ``incidents`` (a row per IP and one of totals), ``ip_summary``,
  ``line_stats`` and its two views ``anomaly_counts``, ``usage_stats``
* stage 4: ``alerts`` partitioned by ``channel`` (both engines),
  ``final_report``, ``run_summary``
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..operators import aggregates as A
from ..operators import alerts as AL
from ..operators import parse as PR
from ..operators import reports as RP
from ..operators.tagging import incidents, line_facts
from ..sources.derived import load_log_lines
from ..sources.sinks import filtered_lines
from . import contents as C
from . import manifest as M

#: every table that a finished stage leaves
STAGE_TABLES = {
    1: ("lines",),
    2: ("filtered", "line_facts", "auth", "apache", "syslog"),
    3: ("incidents", "ip_summary", "line_stats", "anomaly_counts", "usage_stats"),
    4: ("alerts", "final_report", "run_summary"),
}


def table_path(out_dir: str, run_id: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/run_id={run_id}/{name}"


def _write(df: DataFrame, path: str, *partition_by: str) -> dict:
    """Write a table and return its rows and content digest, taken while they are written."""
    seen = Observation()
    w = df.observe(seen, *C.content_exprs(df)).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return seen.get


def read_table(spark: SparkSession, out_dir: str, run_id: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(out_dir, run_id, name))


def read_lines(spark: SparkSession, out_dir: str, run_id: str, start: str | None = None, end: str | None = None,
               log_type: str | None = None) -> DataFrame:
    """The stage-1 lines of a run, pruned to a day range and log type by partition (no file reads
    outside them); lines without a readable time sit in the null-date partition."""
    df = read_table(spark, out_dir, run_id, "lines")
    if start:
        df = df.where(F.col("event_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("event_date") <= F.lit(end).cast("date"))
    if log_type:
        df = df.where(F.col("log_type") == log_type)
    return df


def run_pipeline(spark: SparkSession, source: Callable[[SparkSession], DataFrame], out_dir: str,
                 run_id: str, cfg: Thresholds = DEFAULT, resume: bool = True,
                 generated_at: str = "") -> DataFrame:
    """M6: run every stage not yet complete for ``run_id``; returns the stage status.

    ``source(spark)`` yields the collected lines (``collect_logs`` for text
    files, ``load_log_lines`` for the events-derived view).  With
    ``resume=False`` all stages run again; they are marked as rolled back
    before the first write, so a crash on the way leaves none of the old
    ones complete.
    """
    if not resume:
        M.rollback(spark, out_dir, run_id, min(M.STAGES))
    status = {r["stage"]: r["status"] for r in M.stage_status(spark, out_dir, run_id).collect()}
    first = min((s for s in M.STAGES if status.get(s) != "COMPLETE"), default=None)
    if first is not None and any(status.get(s) == "COMPLETE" for s in M.STAGES if s > first):
        M.rollback(spark, out_dir, run_id, first)  # a stage runs on its predecessors' outputs: later ones are stale

    written: dict[str, dict] = {}

    def write(name: str, df: DataFrame, *partition_by: str) -> int:
        written[name] = _write(df, table_path(out_dir, run_id, name), *partition_by)
        return int(written[name]["rows"])

    def read(name: str) -> DataFrame:
        return read_table(spark, out_dir, run_id, name)

    for stage in M.STAGES:
        if first is None or stage < first:
            continue
        for before in range(1, stage):
            M.stage_inputs_ok(spark, [table_path(out_dir, run_id, t) for t in STAGE_TABLES[before]],
                              filled=[table_path(out_dir, run_id, "lines")])
        if stage == 1:
            lines = PR.with_event_time(source(spark).select("line", "source_file", "log_type"), cfg)
            dated = lines.select("line", "source_file", "log_type", F.to_date("event_ts").alias("event_date"))
            # few files per (type, day) whatever the order of the input; AQE splits a large one over tasks
            n = write("lines", dated.hint("rebalance", "log_type", "event_date"), "log_type", "event_date")
        elif stage == 2:
            lines = read("lines")
            write("filtered", filtered_lines(lines), "tag")
            n = write("line_facts", line_facts(lines))
            write("auth", PR.parse_auth(lines, cfg))
            write("apache", PR.parse_apache(lines))
            write("syslog", PR.parse_syslog(lines))
        elif stage == 3:
            write("incidents", incidents(read("line_facts")))
            t = read("incidents").where(AL.is_ip() & (F.col("occurrences") > 0))
            n = write("ip_summary", t.select("ip", "occurrences", A.risk("occurrences", cfg)))
            write("line_stats", A.line_stats(read("lines")))
            write("anomaly_counts", A.anomaly_counts(None, read("line_stats")))
            write("usage_stats", A.usage_stats(None, read("line_stats")))
        else:
            table, stats = read("incidents"), read("line_stats")
            n = write("alerts", AL.all_alerts(None, cfg, table=table), "channel")
            alerts = read("alerts").where("engine = 'stage4'").select(*AL.ALERT_COLUMNS)
            write("final_report", RP.final_report(None, cfg, generated_at, table, stats, alerts))
            write("run_summary", RP.run_summary(None, cfg, generated_at, table, stats, alerts))
        C.record(spark, out_dir, run_id, written)
        written.clear()
        M.record_stage(spark, out_dir, run_id, stage, n)

    return M.stage_status(spark, out_dir, run_id)


def check_run(spark: SparkSession, out_dir: str, run_id: str) -> DataFrame:
    """``(name, rows, found_rows, status)``: whether each table of a run still holds what was written."""
    return C.check_outputs(spark, out_dir, run_id, lambda name: table_path(out_dir, run_id, name))


def pipeline_tables(spark: SparkSession, sf_dir: str, cfg: Thresholds = DEFAULT) -> dict[str, DataFrame]:
    """Every stage output as a lazy DataFrame, for measuring and inspection; ``run_pipeline`` is the durable form."""
    lines = load_log_lines(spark, sf_dir)
    facts = line_facts(lines)
    stats = A.line_stats(lines)
    return {
        "line_facts": facts,
        "ip_summary": A.ip_summary(lines, cfg, facts),
        "anomaly_counts": A.anomaly_counts(lines, stats),
        "usage_stats": A.usage_stats(lines, stats),
        "stage2_counts": A.stage2_counts(lines, facts),
        "alerts": AL.all_alerts(lines, cfg, facts),
    }
