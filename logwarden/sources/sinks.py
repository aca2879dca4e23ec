"""Table sinks (S5-S8) and the ``KEY=VALUE`` state reader.

Every write is ``mode('overwrite')`` with dynamic partition overwrite, so
writing run ``r`` replaces only the partitions of ``r``: a retried or resumed
run is idempotent, and earlier runs stay in place as snapshots (S8).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import filters as FL

# --- fixed values: names of the three filter outputs ---
TAG_FAILED = "failed_logins"
TAG_SUSPICIOUS = "suspicious_ips"
TAG_SERVER_ERRORS = "server_errors"
# --- end of fixed values ---


def _overwrite(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def filtered_lines(lines: DataFrame) -> DataFrame:
    """The three filter outputs as one tagged table ``(tag, line)``.

    F1 and F3 keep repeated lines; F2 holds each suspicious line once (the
    distinct is a hash aggregate on the line with map-side dedup).
    """
    folded = X.with_folded(lines.select("line"))
    tags = F.array_compact(F.array(F.when(FL.is_failed(X.FOLDED), F.lit(TAG_FAILED)),
                                   F.when(FL.is_server_error(X.FOLDED), F.lit(TAG_SERVER_ERRORS))))
    kept = folded.select(F.explode(tags).alias("tag"), "line")
    susp = (folded.where(FL.is_suspicious(X.FOLDED)).select("line").distinct()
            .select(F.lit(TAG_SUSPICIOUS).alias("tag"), "line"))
    return kept.unionByName(susp)


def write_filtered(lines: DataFrame, path: str, run_id: str) -> None:
    """One output per filter: ``path/run_id=<r>/tag=<filter>/``."""
    _overwrite(filtered_lines(lines).withColumn("run_id", F.lit(run_id)), path, ["run_id", "tag"])


def write_reports(tables: Mapping[str, DataFrame], path: str, run_id: str) -> None:
    """S6 + S8: each report table under ``path/<name>/run_id=<r>/``; older runs are the backups."""
    for name, df in tables.items():
        _overwrite(df.withColumn("run_id", F.lit(run_id)), f"{path.rstrip('/')}/{name}", ["run_id"])


def write_alerts(alerts: DataFrame, path: str, run_id: str) -> None:
    """One ``alerts`` table partitioned by run and channel.

    The main log is not a second copy: it is ``where(in_main_log)`` over all
    channels, so an alert is stored once and read through both views.
    """
    _overwrite(alerts.withColumn("run_id", F.lit(run_id)), path, ["run_id", "channel"])


def main_log(alerts: DataFrame) -> DataFrame:
    """The main alert log view of an ``alerts`` table."""
    return alerts.where(F.col("in_main_log"))


def parse_state(text: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``KEY=VALUE`` lines -> one row with a column per key.

    Later lines win over earlier ones for a repeated key (as when the file is
    sourced by a shell); comments, blanks and unknown keys are ignored.
    """
    kv = F.split(F.col("value"), "=", 2)
    rows = (text.select(F.monotonically_increasing_id().alias("_pos"),
                        F.trim(F.get(kv, 0)).alias("key"),
                        F.regexp_replace(F.trim(F.get(kv, 1)), r'^"(.*)"$', "$1").alias("val"))
            .where(F.col("key").isin(list(keys)) & F.col("val").isNotNull()))
    return rows.groupBy().pivot("key", list(keys)).agg(F.max_by("val", "_pos"))
