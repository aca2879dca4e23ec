"""The year of syslog lines, which carry none (P8), from the order of a file's lines and its last change.

Lines of a file are read in order: from December to January the year turns,
and back again where a late line of the old year follows.  A step of half a
year or more from one timed line to the next is such a turn.  The file's last
timed line is of the year of the file's last change, or of the year before
if it would lie after it; from there the turns give the year of every line.
The order of the lines is trusted: one that is out of place by half a year
or more counts as a turn there, and back at the next.

The running count of turns is a prefix sum in two levels: within a chunk of
the file (a split, as the scan reads it), and over the chunks' sums, which are
a few rows a file.  So no window holds a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import columns as X

#: a step of so many months or more, either way, is a turn of the year
HALF = 6
#: a leap year, so that every day of a year can be told from no day
_ANY_YEAR = 2024


def _turn(step: Column) -> Column:
    return F.when(step <= -HALF, 1).when(step >= HALF, -1).otherwise(0).cast("bigint")


def with_inferred_time(lines: DataFrame, end: str = "source_modified", file: str = "source_path", chunk: str = "source_block",
                       row: str = "source_row") -> DataFrame:
    """Add ``event_ts``; Apache lines carry their year, syslog lines get it from their file.

    ``chunk`` and ``row`` order the lines of a ``file``, ``end`` is its last
    change (``collect_logs(..., with_place=True)`` gives all four).  A stamp
    that is no date in its year (29 February) has a null time.
    """
    stamp = F.when(F.col("log_type") != "apache", X.syslog_time(_ANY_YEAR))
    t = lines.withColumn("_stamp", stamp).withColumn("_month", F.month("_stamp"))
    own = Window.partitionBy(file, chunk).orderBy(row)
    before = F.last("_month", ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, -1))
    t = t.withColumn("_turn", _turn(F.col("_month") - before))
    t = t.withColumn("_turns", F.sum("_turn").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.when(F.col("_month").isNotNull(), F.col(row))
    chunks = t.groupBy(file, chunk).agg(
        F.min_by("_month", place).alias("_first"), F.max_by("_month", place).alias("_last"),
        F.max_by("_stamp", place).alias("_last_stamp"), F.sum("_turn").alias("_sum"), F.max(end).cast("timestamp_ntz").alias("_end"))
    order = Window.partitionBy(file).orderBy(chunk)  # a row for each split of a file
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    cross = _turn(F.col("_first") - F.last("_last", ignorenulls=True).over(above))
    chunks = chunks.withColumn("_cross", cross)
    chunks = chunks.withColumn("_base", F.sum("_cross").over(order.rowsBetween(Window.unboundedPreceding, 0))
                               + F.coalesce(F.sum("_sum").over(above), F.lit(0)))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.last("_last_stamp", ignorenulls=True).over(whole)
    end_turns = F.last(F.col("_base") + F.col("_sum")).over(whole)
    # of equal years, is the last line's stamp after the file's last change?
    this = F.date_format(last, "MMddHHmmss") > F.date_format(F.max("_end").over(whole), "MMddHHmmss")
    chunks = chunks.select(file, chunk, (F.year(F.max("_end").over(whole)) - this.cast("int") - end_turns + F.col("_base")).alias("_year"))
    t = t.join(chunks.withColumnsRenamed({file: "_file", chunk: "_chunk"}),
               F.col(file).eqNullSafe(F.col("_file")) & F.col(chunk).eqNullSafe(F.col("_chunk")), "left")
    ts = F.when(F.col("log_type") == "apache", X.apache_time("line")).otherwise(
        X.syslog_time(F.col("_year") + F.col("_turns"), "line"))
    return t.withColumn("event_ts", ts).select(*lines.columns, "event_ts")
