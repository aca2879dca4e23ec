"""What a run's tables hold: digests that find a cut or edited output, and the difference of two runs.

``content_exprs`` sums up a table while it is written (an ``observe``, so no
second pass): its rows, and two order-independent combinations of its rows'
hashes, a sum and an exclusive or.  ``record`` keeps them beside the run;
``check_outputs`` reads the tables again and compares.  Both combinations are
folded map-side, so a check is one scan and one small row a task.

``diff`` compares two tables by key: a full outer join, one row for each key
that was added, removed or changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_id string, name string, rows bigint, hash_sum string, hash_xor bigint, recorded_at timestamp"


def content_exprs(df: DataFrame) -> list[Column]:
    """``rows, hash_sum, hash_xor`` of a table, whatever the order of its rows and columns."""
    cols = sorted(df.columns)
    # the hash passes over nulls, so which columns are null is a value of its own
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in cols])
    # a column that partitions the folders is read back as the reader infers it: as text it is the same
    own = F.xxhash64(nulls, *[F.col(f"`{c}`") if t.startswith(("array", "struct", "map", "binary")) else F.col(f"`{c}`").cast("string")
                              for c, t in sorted(df.dtypes)])
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(own.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
            F.coalesce(F.bit_xor(own), F.lit(0)).alias("hash_xor")]


def contents_path(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/_contents"


def record(spark: SparkSession, out_dir: str, run_id: str, seen: dict[str, dict]) -> None:
    """Keep the digests of tables that a run has written: ``name -> {rows, hash_sum, hash_xor}``."""
    rows = [(run_id, name, s["rows"], s["hash_sum"], s["hash_xor"]) for name, s in seen.items()]
    df = spark.createDataFrame(rows, "run_id string, name string, rows bigint, hash_sum string, hash_xor bigint")
    df.withColumn("recorded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(contents_path(out_dir))


def recorded(spark: SparkSession, out_dir: str, run_id: str) -> DataFrame:
    """The newest digest of each table of a run."""
    t = spark.read.schema(SCHEMA).parquet(contents_path(out_dir)).where(F.col("run_id") == run_id)
    last = F.max_by(F.struct("rows", "hash_sum", "hash_xor"), "recorded_at").alias("l")
    return t.groupBy("name").agg(last).select("name", "l.*")


def check_outputs(spark: SparkSession, out_dir: str, run_id: str, path_of) -> DataFrame:
    """``(name, rows, found_rows, status)`` of a run's tables: OK, CHANGED or MISSING; ``path_of(name)`` is a table's folder."""
    out = []
    for r in recorded(spark, out_dir, run_id).orderBy("name").collect():  # a row for each table of a run
        try:
            t = spark.read.parquet(path_of(r.name))
            now = t.agg(*content_exprs(t)).first()
        except AnalysisException:
            out.append((r.name, r.rows, None, "MISSING"))
            continue
        same = (now["rows"], now["hash_sum"], now["hash_xor"]) == (r.rows, r.hash_sum, r.hash_xor)
        out.append((r.name, r.rows, now["rows"], "OK" if same else "CHANGED"))
    return spark.createDataFrame(out, "name string, rows bigint, found_rows bigint, status string")


def diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that differ: ``keys..., change, before_<column>..., after_<column>...``; a key has one row on each side.

    ``change`` is added, removed or changed.  Null keys are equal to each
    other; so are null values.
    """
    values = [c for c in before.columns if c not in keys]
    a = before.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(c).alias(f"before_{c}") for c in values], F.lit(True).alias("_in_a"))
    b = after.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(c).alias(f"after_{c}") for c in values], F.lit(True).alias("_in_b"))
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
    change = F.when(F.col("_in_a").isNull(), "added").when(F.col("_in_b").isNull(), "removed").when(~same, "changed")
    t = a.join(b, same_key, "full_outer").withColumn("change", change).where("change IS NOT NULL")
    return t.select(*[F.when(F.col("_in_b").isNull(), F.col(f"_a_{k}")).otherwise(F.col(f"_b_{k}")).alias(k) for k in keys], "change",
                    *[f"before_{c}" for c in values], *[f"after_{c}" for c in values])
