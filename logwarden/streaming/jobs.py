"""Structured Streaming jobs (W1-W4): the batch rules, run incrementally.

The batch pipeline re-reads every log on each run.  These jobs pick up only
new files (the file source keeps the list of processed files in the
checkpoint).

* W1 ``stream_lines``: ``readStream.text`` over the log folder with the same
  provenance and classification columns as ``collect_logs``.
* W2 ``stream_failed_login_windows``: each micro-batch writes its own window
  counts.  Counts add up, so readers sum them: lines that arrive late count
  like any other and no state is held.  ``append`` mode is the stateful form:
  a watermark closes windows and each is written once.
* W3 ``stream_alerts``: brute-force tiers and the error-rate rule.  Totals per
  window and address are kept as state (a streaming aggregate), so a batch
  costs what it touches, not what was ever read; a climb to a new tier is told
  by the alerts that the touched days already hold.
* W4 ``stream_dedup``: one copy of each line, whenever its repeats arrive.
  Lines seen lately are state; only folders of the touched days that are older
  than the state are looked up.

Sinks are idempotent: a micro-batch writes to a folder of its own, named by
query id and batch number, so a batch replayed after a failure rewrites it,
and a job restarted with a new checkpoint (a new query id) overwrites
nothing.  ``compact``, ``compact_alerts`` and ``compact_lines`` fold the folders
of a table (see ``delta``), ``drop_days`` ends a table's retention.

Checkpoint and output folders must be on shared storage on a cluster; the
caller passes them in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config as K
from ..config import DEFAULT, Thresholds
from ..functions import columns as X
from ..operators import filters as FL
from ..operators.alerts import ALERT_COLUMNS, alert, error_rate_rule, ssh_tier_rule
from ..sources.files import log_type_of
from . import delta as D
from .windows import KEYS, WATERMARK, WINDOW, add_up, failed_login_events, window_counts, window_table


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 exclude=(), with_block: bool = False) -> DataFrame:
    """New files under ``path`` -> ``(line, source_file, log_type)`` as a stream.

    ``with_block`` adds ``_block``, the file and the block of it that a line is in.
    """
    r = (spark.readStream.format("text").option("recursiveFileLookup", "true")
         .option("lineSep", "\n"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.load(path)
    df = raw.select(F.regexp_replace("value", r"\r$", "").alias("line"),
                    F.col("_metadata.file_name").alias("source_file"),
                    *([F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("_block")] if with_block else []))
    excl = list(exclude or ())
    if excl:
        df = df.where(~F.col("source_file").isin(excl))
    return df.withColumn("log_type", log_type_of("source_file", "line"))


def _events(lines: DataFrame, cfg: Thresholds) -> DataFrame:
    # the watermark needs a session-zone timestamp; the batch form keeps NTZ
    return failed_login_events(lines, cfg).select(F.col("event_ts").cast("timestamp").alias("event_ts"), "ip")


def failed_login_window_stream(lines: DataFrame, cfg: Thresholds = DEFAULT, window: str = WINDOW,
                               watermark: str = WATERMARK) -> DataFrame:
    """W2 plan on a streaming ``lines`` DataFrame: ``(window_start, window_end, ip, cnt)``."""
    ev = _events(lines, cfg).withWatermark("event_ts", watermark)
    return window_counts(ev, window)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Structured Streaming keeps in a checkpoint; another checkpoint has another."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def _folder(spark: SparkSession, out: str, checkpoint: str, batch_id: int) -> str:
    return f"{out.rstrip('/')}/query={_query_id(spark, checkpoint)}/batch_id={batch_id}"


def _write(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def _start(df: DataFrame, checkpoint: str, sink, output_mode: str, available_now: bool,
           processing_time: str | None, name: str | None) -> StreamingQuery:
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.foreachBatch(sink).start()


def stream_failed_login_windows(spark: SparkSession, in_path: str, checkpoint: str, out_path: str,
                                cfg: Thresholds = DEFAULT, output_mode: str = "update",
                                available_now: bool = True, processing_time: str | None = None,
                                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """W2 job: window counts into ``out_path`` (read them with ``latest_window_counts``).

    ``update``: each batch writes the counts of its own lines, late and
    untimed ones included.  ``append``: a window is written once, after the
    watermark passes its end; what comes later is no longer counted.
    """
    lines = stream_lines(spark, in_path, max_files_per_trigger)
    if output_mode == "append":
        t = failed_login_window_stream(lines, cfg).withColumn("errors", F.lit(0).cast("bigint"))
    else:
        t = lines

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch if output_mode == "append" else window_table(batch, cfg)
        _write(rows, _folder(spark, out_path, checkpoint, batch_id))

    return _start(t, checkpoint, sink, "append", available_now, processing_time, "failed_login_windows")


WINDOW_SCHEMA = "window_start timestamp_ntz, window_end timestamp_ntz, ip string, cnt bigint, errors bigint"
ALERT_SCHEMA = ("engine string, severity string, category string, ip string, metric_value bigint, "
                "threshold bigint, message string, action string, in_main_log boolean, "
                "window_start timestamp_ntz, climbed boolean, channel string")
LINE_SCHEMA = "line string, source_file string, log_type string, event_ts timestamp_ntz"
#: how long a line is remembered as state, counted from its arrival
HORIZON = "1 day"
#: folders of a batch in the tables by day
DAY_LEVELS, LINE_LEVELS = ("query", "batch_id"), ("query", "arrived", "batch_id")


def window_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """The window table of all lines that a W2 job has read so far."""
    return add_up(D.read(spark, D.paths(spark, out_path), WINDOW_SCHEMA))


def latest_window_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The current value of every (window, ip)."""
    return window_totals(spark, out_path).where("ip IS NOT NULL").select(*KEYS, "cnt")


def compact(spark: SparkSession, out_path: str) -> int:
    """Fold the batch folders of a W2 job, whether it runs or not; returns the rows of the table.

    No step can lose or double a count: see ``delta``.
    """
    D.compact(spark, out_path, WINDOW_SCHEMA, add_up)
    return window_totals(spark, out_path).count()


# ---- tables by day: <out>/day=<d>/<batch folders>

def _day_folder(out: str, day) -> str:
    return f"{out.rstrip('/')}/day={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def _day_folders(spark: SparkSession, out: str) -> list[str]:
    return sorted(D._glob(spark, f"{out.rstrip('/')}/day=*"))


def _read_days(spark: SparkSession, out: str, schema: str, levels) -> DataFrame:
    return D.read(spark, [p for f in _day_folders(spark, out) for p in D.paths(spark, f, levels)], schema)


def _write_by_day(rows: DataFrame, out: str, values: dict) -> None:
    """Add a batch's rows, which have a column ``day``, to their days; a replay writes the same folders again."""
    for k, v in values.items():
        rows = rows.withColumn(k, F.lit(v))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", *values).parquet(out)


def _staged(rows: DataFrame, path: str) -> DataFrame:
    """A batch's rows written once: a streaming plan read twice would run twice."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _days(rows: DataFrame) -> list:
    """The days of a batch: as many as it has in its lines, not more than the log has."""
    return [r.day for r in rows.select("day").distinct().collect()]


def drop_days(spark: SparkSession, out_path: str, before: str) -> list[str]:
    """Retention of a table by day: delete the days before a date (ISO); returns them.  Untimed rows stay."""
    gone = []
    for f in _day_folders(spark, out_path):
        day = f.rsplit("day=", 1)[1]
        if day[:1].isdigit() and day < before:
            D.delete(spark, f)
            gone.append(day)
    return gone


def window_alerts(counts: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """W3 rules over a window table: L1 (brute force), L5 (tiers), L3 (error rate).

    One row per rule that fires on a window (and address), with the alert
    columns plus ``window_start``.  Counts without ``errors`` have no L3.
    """
    t = counts if "errors" in counts.columns else counts.withColumn("errors", F.lit(0).cast("bigint"))
    ip = F.col("ip").isNotNull()
    brute = alert(ip & (F.col("cnt") >= cfg.failed_login), "stage4", "CRITICAL", "SSH", F.col("ip"), F.col("cnt"),
                  cfg.failed_login, X.template(K.STAGE4_BRUTE_FORCE, ip="ip", n="cnt", t=F.lit(cfg.failed_login)))
    rate = error_rate_rule(~ip & (F.col("errors") >= cfg.error), "errors", cfg)
    rules = F.array_compact(F.array(brute, ssh_tier_rule(ip, "cnt", cfg), rate))
    return t.select("window_start", F.inline(rules)).select(*ALERT_COLUMNS, "window_start")


def stream_alerts(spark: SparkSession, in_path: str, checkpoint: str, out_path: str,
                  cfg: Thresholds = DEFAULT, available_now: bool = True,
                  processing_time: str | None = None,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """W3 job: alerts of the windows each micro-batch touched, below ``<out>/alerts`` by day and channel.

    Every touched window (and address) that stands in a tier gives a row with
    its new total; ``climbed`` marks those whose rule and severity the window
    had not reached before, which are the ones to notify of.  Late lines add
    to their window, untimed ones to the null window.  Totals are streaming
    state, one row per window and address; a batch reads no earlier counts,
    and of earlier alerts only those of the days it touches.
    """
    alerts_path = f"{out_path.rstrip('/')}/alerts"
    tier = ["engine", "category", "severity", "ip", "window_start"]

    def sink(batch: DataFrame, batch_id: int) -> None:
        query = _query_id(spark, checkpoint)
        now = window_alerts(batch, cfg).withColumn("day", F.to_date("window_start"))
        now = _staged(now, f"{out_path.rstrip('/')}/_staged/query={query}")
        before = D.read(spark, alerts_before(spark, alerts_path, _days(now), query, batch_id), ALERT_SCHEMA)
        told = before.select(*[F.col(c).alias(f"_{c}") for c in tier]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in tier]
        rows = now.join(told.withColumn("_told", F.lit(True)), same, "left").withColumn("climbed", F.col("_told").isNull())
        _write_by_day(rows.select(*now.columns, "climbed").drop("query", "batch_id"), alerts_path,
                      {"query": query, "batch_id": batch_id})

    lines = stream_lines(spark, in_path, max_files_per_trigger)
    return _start(window_table(lines, cfg), checkpoint, sink, "update", available_now, processing_time, "stream_alerts")


def alerts_before(spark: SparkSession, alerts_path: str, days: list, query: str, batch_id: int) -> list[str]:
    """The folders of earlier alerts of some days."""
    return [p for day in days for p in D.paths(
        spark, _day_folder(alerts_path, day), DAY_LEVELS, lambda b: (b.query, b.number) != (query, batch_id))]


def stream_alert_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """All rows that a W3 job has written."""
    return _read_days(spark, f"{out_path.rstrip('/')}/alerts", ALERT_SCHEMA, DAY_LEVELS)


def _newest(rows: DataFrame) -> DataFrame:
    """The newest row per rule (engine, category), address and window; ``climbed`` if any had climbed."""
    keys = ["engine", "category", "ip", "window_start"]
    cols = [c for c in rows.columns if c not in (*keys, "climbed")]
    # counts only grow, so of several writes the largest is the newest, whatever job wrote it
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "metric_value").alias("l")).select(*keys, "l.*")


def latest_stream_alerts(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest row per rule (engine, category), address and window."""
    return _newest(stream_alert_rows(spark, out_path))


def compact_alerts(spark: SparkSession, out_path: str) -> None:
    """Fold each day of a W3 job's alerts: one row per rule, severity, address and window, that of the largest total."""
    def fold(rows: DataFrame) -> DataFrame:
        keys = ["engine", "category", "severity", "ip", "window_start"]
        cols = [c for c in rows.columns if c not in (*keys, "climbed")]
        t = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "metric_value").alias("l"), F.bool_or("climbed").alias("climbed"))
        return t.select(*keys, "l.*", "climbed").select(*rows.columns)

    for f in _day_folders(spark, f"{out_path.rstrip('/')}/alerts"):
        D.compact(spark, f, ALERT_SCHEMA, fold, DAY_LEVELS)


def first_copies(lines: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """A stream of lines without those that came before within ``horizon``; lines without a time all stay.

    Lines are remembered from their arrival, so none is ever too late.  Copies
    of a line are first told apart by the block of the file they are in: a
    line that fills the log is folded by many tasks before one task sees one
    copy from each.
    """
    key = F.when(F.col("event_ts").isNotNull(), F.col("line")).otherwise(F.uuid())
    t = lines.withColumn("_key", key).withColumn("arrived", F.current_timestamp()).withWatermark("arrived", horizon)
    t = t.dropDuplicatesWithinWatermark(["_key", "_block"]).dropDuplicatesWithinWatermark(["_key"])
    return t.drop("_key", "_block")


def lines_before(spark: SparkSession, out_path: str, days: list, query: str, batch_id: int, since: int) -> list[str]:
    """The folders of some days that the state of a job does not cover: older ones, other jobs', and snapshots."""
    def uncovered(b: D.Batch) -> bool:
        return b.query != query or (b.number != batch_id and int(b.values["arrived"]) < since)

    return [p for day in days if day is not None for p in D.paths(spark, _day_folder(out_path, day), LINE_LEVELS, uncovered)]


def stream_dedup(spark: SparkSession, in_path: str, checkpoint: str, out_path: str,
                 cfg: Thresholds = DEFAULT, available_now: bool = True,
                 processing_time: str | None = None,
                 max_files_per_trigger: int | None = None, horizon: str = HORIZON) -> StreamingQuery:
    """W4 job: one copy of each line; lines without a readable time pass through as they are.

    Repeats that arrive within ``horizon`` of the first copy are dropped by
    the stream's state.  What passes is looked up in the output of its day
    (equal lines have equal times), but for the batches that the state still
    covers.  So a line of today reads nothing, a late line reads its own day,
    and no batch reads more as the log grows.  However late a repeat comes, it
    is dropped, and a late new line is kept.
    """
    from ..operators.parse import with_event_time

    span = f"unix_seconds(timestamp'1970-01-01 00:00:00Z' + INTERVAL {horizon})"
    seconds = spark.range(1).select(F.expr(span)).first()[0]

    def sink(batch: DataFrame, batch_id: int) -> None:
        query = _query_id(spark, checkpoint)
        t = batch.withColumn("day", F.to_date("event_ts")).withColumn("arrived", F.unix_seconds("arrived"))
        t = _staged(t, f"{out_path.rstrip('/')}/_staged/query={query}")
        at = t.agg(F.max("arrived")).first()[0]
        if at is None:
            return
        before = D.read(spark, lines_before(spark, out_path, _days(t), query, batch_id, at - seconds), LINE_SCHEMA)
        timed = t.where("event_ts IS NOT NULL").join(before.select("line"), "line", "left_anti")
        rows = timed.select(*t.columns).unionAll(t.where("event_ts IS NULL"))
        _write_by_day(rows.drop("arrived"), out_path, {"query": query, "arrived": at, "batch_id": batch_id})

    lines = with_event_time(stream_lines(spark, in_path, max_files_per_trigger, with_block=True), cfg)
    return _start(first_copies(lines, horizon), checkpoint, sink, "append", available_now, processing_time, "stream_dedup")


def stream_dedup_lines(spark: SparkSession, out_path: str) -> DataFrame:
    """All lines that a W4 job has kept."""
    return _read_days(spark, out_path, LINE_SCHEMA, LINE_LEVELS)


def compact_lines(spark: SparkSession, out_path: str) -> None:
    """Fold the batch folders of each day of a W4 job."""
    for f in _day_folders(spark, out_path):
        D.compact(spark, f, LINE_SCHEMA, lambda rows: rows.hint("rebalance"), LINE_LEVELS)


def stream_failed_lines(spark: SparkSession, in_path: str, checkpoint: str, out_path: str,
                        available_now: bool = True) -> StreamingQuery:
    """F1 as a stream: failed-login lines appended as they arrive (stateless)."""
    lines = stream_lines(spark, in_path).where(FL.is_failed())
    w = (lines.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start(out_path)
