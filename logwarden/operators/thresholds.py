"""Threshold checks.

Bounds come from the ``Thresholds`` dataclass as literals, so a check is a
projection over its metric table; no join with a config table is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, THRESHOLD_ROWS, Thresholds
from ..functions import columns as X
from . import aggregates as agg
from . import alerts as AL

CHECK_COLUMNS = ["label", "value", "threshold", "pct", "status"]


def threshold_check(metrics: DataFrame, value: str = "value", threshold: str = "threshold",
                    label: str = "label", cfg: Thresholds = DEFAULT) -> DataFrame:
    """R2: ``(label, value, threshold, pct, status)`` per metric row.

    ``status`` is EXCEEDED (value >= threshold), WARNING (pct >= 80) or OK;
    a value or bound that is not a non-negative integer, or a zero bound,
    gives INVALID instead of an error.
    """
    v = F.col(value).try_cast("bigint") if dict(metrics.dtypes)[value] == "string" else F.col(value)
    t = F.col(threshold).try_cast("bigint") if dict(metrics.dtypes)[threshold] == "string" else F.col(threshold)
    pct, status = X.threshold_status(v, t, cfg)
    return metrics.select(F.col(label).alias("label"), v.cast("bigint").alias("value"),
                          t.cast("bigint").alias("threshold"), pct.alias("pct"),
                          status.alias("status"))


def threshold_metrics(lines: DataFrame | None, cfg: Thresholds = DEFAULT,
                      facts: DataFrame | None = None, table: DataFrame | None = None) -> DataFrame:
    """The metrics the scan checks: failed logins per IP, total F3, HTTP errors in F2.

    The two totals are only present when their filter set is non-empty,
    like the original scan that skipped empty files.
    """
    t = table if table is not None else AL.incident_table(lines, facts)

    def metric(cond, label, value, threshold: int):
        return F.when(cond, F.struct(label.alias("label"), F.col(value).alias("value"),
                                     F.lit(threshold).cast("bigint").alias("threshold")))

    return t.select(F.inline(F.array_compact(F.array(
        metric(AL.is_ip() & (F.col("failed") > 0), F.concat(F.lit("Failed logins from "), "ip"), "failed", cfg.failed_login),
        metric(AL.is_total() & (F.col("total_errors") > 0), F.lit("Total server errors"), "total_errors", cfg.error),
        metric(AL.is_total() & (F.col("susp_lines") > 0), F.lit("HTTP 4xx/5xx errors"), "http_errors", cfg.error)))))


def threshold_scan(lines: DataFrame | None, cfg: Thresholds = DEFAULT, facts: DataFrame | None = None,
                   table: DataFrame | None = None) -> DataFrame:
    """Every scanned metric checked against its bound."""
    return threshold_check(threshold_metrics(lines, cfg, facts, table), cfg=cfg)


def threshold_verdict(scan: DataFrame) -> DataFrame:
    """R3 verdict: one row, ``any_exceeded`` (false on an empty scan)."""
    return scan.agg(F.coalesce(F.bool_or(F.col("status") == "EXCEEDED"), F.lit(False))
                    .alias("any_exceeded"))


def thresholds_table(spark: SparkSession, cfg: Thresholds = DEFAULT) -> DataFrame:
    """``(metric, threshold)`` rows of the configuration."""
    rows = [(label, int(getattr(cfg, attr))) for label, attr in THRESHOLD_ROWS]
    return spark.createDataFrame(rows, "metric string, threshold bigint")


def request_rate(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """Requests per client IP checked against the request bound."""
    m = agg.requests_per_ip(lines).select(
        F.col("ip").alias("label"), F.col("cnt").alias("value"),
        F.lit(cfg.request).cast("bigint").alias("threshold"))
    return threshold_check(m, cfg=cfg)
