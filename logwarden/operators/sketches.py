"""Summaries of a day that add up: distinct addresses (A15) and top addresses (T3) over any range of days.

* ``daily_sketches``: a HyperLogLog sketch of each day's addresses.  The
  sketches of days merge, so a range of days costs its sketches (a few
  kilobytes a day) and no lines.  ``unique_ips_between`` is an estimate, with a
  standard error of some 1.6 % (``LG_K`` = 12).
* ``daily_top``: of each day the ``keep`` most frequent addresses, and the
  largest count that was left out.  ``top_between`` adds the days up: an
  address has at least its kept counts, and at most those and the left-out
  bound of the days that do not keep it.  Addresses whose upper bound reaches
  the k-th lower bound are counted again over the lines of the range, so the
  result is the exact top k.  Where an address that no day keeps could be
  among them, every address is counted.

Days are those of the line's event time; lines without one are of the null
day, which ranges leave out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import DEFAULT, Thresholds
from . import parse as PR

LG_K = 12
KEEP = 1000


def ip_days(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """``(day, ip)``, one row per IP token."""
    t = PR.with_event_time(lines, cfg).select(F.to_date("event_ts").alias("day"), "line")
    return PR.extract_ips(t, keep=("day",))


def daily_sketches(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """``(day, tokens, sketch)``; store it by day and add new days to it."""
    return ip_days(lines, cfg).groupBy("day").agg(F.count(F.lit(1)).alias("tokens"), F.hll_sketch_agg("ip", LG_K).alias("sketch"))


def _between(t: DataFrame, start: str | None, end: str | None) -> DataFrame:
    t = t.where("day IS NOT NULL")
    t = t if start is None else t.where(F.col("day") >= F.lit(start).cast("date"))
    return t if end is None else t.where(F.col("day") <= F.lit(end).cast("date"))


def unique_ips_between(sketches: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """``(unique_ips)`` of a range of days, from their sketches: an estimate."""
    one = _between(sketches, start, end).agg(F.hll_union_agg("sketch").alias("s"))
    return one.select(F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).cast("bigint").alias("unique_ips"))


def estimate_error(lines: DataFrame, start: str | None = None, end: str | None = None, allowed: float = 0.05,
                   cfg: Thresholds = DEFAULT) -> DataFrame:
    """``(unique_ips, within)``: the exact count of a range of days, and whether the merged sketches come as close as allowed."""
    exact = _between(ip_days(lines, cfg), start, end).agg(F.count_distinct("ip").cast("bigint").alias("unique_ips"))
    guess = unique_ips_between(daily_sketches(lines, cfg), start, end)
    none = F.lit(None).cast("bigint")
    # two tables of one row, put side by side
    one = exact.select("unique_ips", none.alias("_guess")).unionAll(guess.select(none, "unique_ips")).agg(
        F.max("unique_ips").alias("unique_ips"), F.max("_guess").alias("_guess"))
    return one.select("unique_ips", (F.abs(F.col("_guess") - F.col("unique_ips")) <= F.greatest(
        F.lit(1.0), F.col("unique_ips") * allowed)).alias("within"))


def unique_ips_by_day(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """``(day, tokens, unique_ips)``, exact."""
    return ip_days(lines, cfg).groupBy("day").agg(F.count(F.lit(1)).alias("tokens"),
                                                  F.count_distinct("ip").cast("bigint").alias("unique_ips"))


def daily_top(lines: DataFrame, cfg: Thresholds = DEFAULT, keep: int = KEEP) -> DataFrame:
    """``(day, ip, cnt, left_out)``: the kept addresses of each day, and the largest count of the others."""
    counts = ip_days(lines, cfg).groupBy("day", "ip").agg(F.count(F.lit(1)).alias("cnt"))
    # limits of a rank are applied before the shuffle: a day gathers keep + 1 rows from each task
    rank = F.row_number().over(Window.partitionBy("day").orderBy(F.desc("cnt"), F.desc("ip")))
    t = counts.withColumn("_rank", rank).where(F.col("_rank") <= keep + 1)
    left = F.max(F.when(F.col("_rank") == keep + 1, F.col("cnt"))).over(Window.partitionBy("day"))
    t = t.withColumn("left_out", F.coalesce(left, F.lit(0)).cast("bigint"))
    return t.where(F.col("_rank") <= keep).select("day", "ip", "cnt", "left_out")


def top_candidates(summary: DataFrame, n: int, start: str | None = None, end: str | None = None) -> tuple[DataFrame, int, int]:
    """``(ip, low, high)`` of the kept addresses, the n-th lower bound, and the upper bound of all others."""
    t = _between(summary, start, end)
    others = t.groupBy("day").agg(F.max("left_out").alias("left_out")).agg(F.coalesce(F.sum("left_out"), F.lit(0))).first()[0]
    # a day that does not keep an address may hold its left-out bound of it
    ips = t.groupBy("ip").agg(F.sum("cnt").alias("low"), F.sum("left_out").alias("_own"))
    ips = ips.select("ip", "low", (F.col("low") + F.lit(others) - F.col("_own")).alias("high"))
    lows = [r.low for r in ips.select("low").orderBy(F.desc("low")).limit(n).collect()]
    return ips, lows[-1] if len(lows) == n else 0, others


def top_between(lines: DataFrame, summary: DataFrame, n: int = DEFAULT.top_ips, start: str | None = None, end: str | None = None,
                cfg: Thresholds = DEFAULT) -> DataFrame:
    """``(ip, cnt)``: the n most frequent addresses of a range of days, exact, ties by the larger address."""
    ips, bound, others = top_candidates(summary, n, start, end)
    t = _between(ip_days(lines, cfg), start, end)
    if others < bound:  # no other address can reach the n-th
        t = t.join(ips.where(F.col("high") >= bound).select("ip"), "ip", "left_semi")
    return t.groupBy("ip").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), F.desc("ip")).limit(n)
