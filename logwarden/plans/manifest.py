"""Stage manifest (M1-M5): resumable runs recorded in a Parquet table.

The manifest is an append-only table ``(run_id, stage, status, rows,
completed_at)`` next to the stage outputs, in the shared output folder, so
any driver (a restarted one included) sees the same state.  A stage is
recorded only after its output write committed; a crash in between leaves
no SUCCESS row and the stage simply runs again (its write overwrites).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

STAGES = (1, 2, 3, 4)
# --- fixed values: stage names ---
STAGE_NAMES = {1: "Log Collection", 2: "Anomaly Filtering", 3: "Data Aggregation", 4: "Alert Generation"}
# --- end of fixed values ---
SCHEMA = "run_id string, stage int, status string, rows bigint, completed_at timestamp_ntz"


def manifest_path(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/_manifest"


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(manifest_path(out_dir))
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)


def record_stage(spark: SparkSession, out_dir: str, run_id: str, stage: int, rows: int | None,
                 status: str = "SUCCESS", at: dt.datetime | None = None) -> None:
    """M1: append one manifest row (after the stage's output committed)."""
    at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    df = spark.createDataFrame([(run_id, stage, status, rows, at)], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(manifest_path(out_dir))


def _latest(manifest: DataFrame, run_id: str) -> DataFrame:
    """Latest manifest row per stage of one run (ROLLED_BACK rows supersede SUCCESS)."""
    mine = manifest.where(F.col("run_id") == run_id)
    return mine.groupBy("stage").agg(
        F.max_by(F.struct("status", "rows", "completed_at"), F.col("completed_at")).alias("last"))


def stage_status(spark: SparkSession, out_dir: str, run_id: str) -> DataFrame:
    """M2: ``(stage, name, status)``: COMPLETE or PENDING for every stage."""
    stages = spark.createDataFrame([(s, STAGE_NAMES[s]) for s in STAGES], "stage int, name string")
    last = _latest(read_manifest(spark, out_dir), run_id)
    j = stages.join(F.broadcast(last), "stage", "left")
    done = F.col("last.status") == "SUCCESS"
    return j.select("stage", "name", F.when(done, "COMPLETE").otherwise("PENDING").alias("status"),
                    F.col("last.rows").alias("rows"), F.col("last.completed_at").alias("completed_at"))


def resume_point(status: DataFrame) -> DataFrame:
    """M3: one row ``resume_stage``: the first stage not complete, or ``done``."""
    first = F.min(F.when(F.col("status") != "COMPLETE", F.col("stage")))
    return status.agg(F.coalesce(first.cast("string"), F.lit("done")).alias("resume_stage"))


def rollback(spark: SparkSession, out_dir: str, run_id: str, stage: int) -> list[int]:
    """M4: mark ``stage`` and every later stage ROLLED_BACK; the next run overwrites them."""
    later = [s for s in STAGES if s >= stage]
    at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    df = spark.createDataFrame([(run_id, s, "ROLLED_BACK", None, at) for s in later], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(manifest_path(out_dir))
    return later


def stage_inputs_ok(spark: SparkSession, paths: list[str], filled: list[str] = ()) -> None:
    """M5: every prior output exists, and those of ``filled`` are non-empty, else raise."""
    for p in paths:
        try:
            t = spark.read.parquet(p)
        except AnalysisException as e:
            raise RuntimeError(f"missing stage output: {p}") from e
        if p in filled and t.isEmpty():
            raise RuntimeError(f"empty stage output: {p}")
