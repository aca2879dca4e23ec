"""Helpers shared by the training-data operators.

Column names that start with ``__`` are internal.  Operators select the
columns they need under such names first, so extra columns of the caller,
whatever they are called, never clash with a working column.
"""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for an application: they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for folder, _, names in os.walk(os.path.join(_ROOT, "logwarden")):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), _ROOT))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/logwarden-{app}.zip")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(raw.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(path.toString())


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder that ``spark.checkpoint.dir`` names."""
    ship_package(spark)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    This cuts the lineage: later reads scan committed files, so a lost
    executor repeats a scan and never the work that made the table.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_stored(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def whole_text(c: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def row_key(id_col: str, text_col: str) -> Column:
    """A key that rows share only if they agree in id and text; never null."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
                       F.hex(F.xxhash64(whole_text(text_col))), F.length(whole_text(text_col)))


def fenced(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions read but never inline.

    The optimizer merges neighbouring projections, which would evaluate an
    array expression once per element of a lambda that reads it.  A
    one-element ``inline`` is a node it does not merge through.
    """
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(packed))


def ordered_positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order, as ``__pos``.

    Range partitions are sorted in parallel and written; a row's position is
    its place in its partition plus the rows of the partitions before it.
    Only one count per partition meets in one place.  The table is written
    before it is counted, so both passes see the same partitions.
    """
    spark = df.sparkSession
    # equal rows spread over range partitions by the tie column
    t = df.withColumn("__tie", F.monotonically_increasing_id())
    t = t.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
    t = stored(t.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__idx", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), name)
    n = t.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    base = n.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    # one row per partition: bounded by the number of shuffle partitions
    return t.join(F.broadcast(base), "__pid").withColumn(
        "__pos", F.col("__base") + F.col("__idx")).drop("__pid", "__idx", "__base")


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` -> ``(node, root)``: root is the smallest node reachable.

    Alternating large-star and small-star rounds: every round points nodes at
    smaller ones, and ends when a round changes nothing.  Rows stay as many
    as links; each round is written to the shared folder.  Stars around one
    hot node are aggregated map-side (``min``) and then joined; AQE splits a
    hot join partition.
    """
    spark = links.sparkSession
    e = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a <> b").distinct(), "links")
    last = None
    for _ in range(max_rounds):
        # large star: neighbours larger than u point at the smallest of u's neighbourhood
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: u and its smaller neighbours point at the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionAll(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        new = stored(small, "links")
        state = new.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                                                      F.lit(0).cast("decimal(38,0)"))).first()
        delete_stored(e)
        e = new
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def with_fields(schema: T.StructType, **added: str) -> T.StructType:
    """``schema`` plus fields given as ``name=type``."""
    extra = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in added.items()))
    return T.StructType([*schema.fields, *extra.fields])
