"""Session helpers.

``get_spark`` is for tests, benches and local runs only; on a cluster the
caller brings its own session and this package never changes it except for
``spark.checkpoint.dir`` when (and only when) that is unset.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "logwarden", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session and never overridden.  Where it is unset, a
    folder below the session's warehouse (shared storage as well) is set.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or ""
    if not cur:
        cur = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", cur)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return cur
