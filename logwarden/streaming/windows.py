"""Event-time windows over failed logins and server errors (batch and streaming share the plan).

Rows are ``(window_start, window_end, ip, cnt, errors)``: failed-login tokens
per address, and under a null address the server-error lines of the window.
Lines whose time cannot be read are counted under a null window, so no line
is lost.  Counts of parts of the log add up, which is what the streaming
jobs rely on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..functions import columns as X
from ..operators import filters as FL
from ..operators import parse as PR

WINDOW = "30 minutes"
WATERMARK = "1 hour"
KEYS = ["window_start", "window_end", "ip"]


def failed_login_events(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """Failed-login lines -> ``(event_ts, ip)``, one row per IP token."""
    f = PR.with_event_time(FL.failed_logins(lines), cfg)
    return f.select("event_ts", F.explode(X.ip_tokens("line")).alias("ip"))


def window_counts(events: DataFrame, window: str = WINDOW) -> DataFrame:
    """``(event_ts, ip)`` -> count per window and address (rows without a time belong to none)."""
    w = F.window("event_ts", window)
    return (events.groupBy(w.alias("w"), "ip").agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "ip", "cnt"))


def window_table(lines: DataFrame, cfg: Thresholds = DEFAULT, window: str = WINDOW) -> DataFrame:
    """``(window_start, window_end, ip, cnt, errors)`` of one set of lines, in one aggregation."""
    t = X.with_folded(lines)
    hit = X.fenced(t, "line", "log_type", FL.is_failed(X.FOLDED).alias("failed"), FL.is_server_error(X.FOLDED).alias("error"))
    hit = PR.with_event_time(hit.where("failed OR error"), cfg)
    one = F.lit(1).cast("bigint")
    none = F.lit(0).cast("bigint")
    per_ip = F.transform(F.when(F.col("failed"), X.ip_tokens("line")).otherwise(F.array().cast("array<string>")),
                         lambda ip: F.struct(ip.alias("ip"), one.alias("cnt"), none.alias("errors")))
    error = F.when(F.col("error"), F.array(F.struct(F.lit(None).cast("string").alias("ip"), none.alias("cnt"),
                                                    one.alias("errors")))).otherwise(
        F.array().cast("array<struct<ip:string,cnt:bigint,errors:bigint>>"))
    # a place in time for rows without one: their window becomes null again below
    rows = hit.select(F.coalesce("event_ts", F.lit("1970-01-01").cast("timestamp_ntz")).alias("event_ts"),
                      F.col("event_ts").isNull().alias("untimed"), F.inline(F.concat(per_ip, error)))
    t = rows.groupBy(F.window("event_ts", window).alias("w"), "untimed", "ip").agg(
        F.sum("cnt").alias("cnt"), F.sum("errors").alias("errors"))
    return t.select(F.when(~F.col("untimed"), F.col("w.start")).cast("timestamp_ntz").alias("window_start"),
                    F.when(~F.col("untimed"), F.col("w.end")).cast("timestamp_ntz").alias("window_end"),
                    "ip", "cnt", "errors")


def add_up(parts: DataFrame) -> DataFrame:
    """Window tables of several sets of lines as one."""
    return parts.groupBy(*KEYS).agg(F.sum("cnt").cast("bigint").alias("cnt"), F.sum("errors").cast("bigint").alias("errors"))


def failed_login_windows(lines: DataFrame, cfg: Thresholds = DEFAULT, window: str = WINDOW) -> DataFrame:
    """W2 (batch): ``(window_start, window_end, ip, cnt)``; untimed lines under a null window."""
    return window_table(lines, cfg, window).where("ip IS NOT NULL").select(*KEYS, "cnt")


def untimed_failed_logins(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """Failed-login lines without a readable time."""
    return PR.with_event_time(FL.failed_logins(lines), cfg).where("event_ts IS NULL").drop("event_ts")
