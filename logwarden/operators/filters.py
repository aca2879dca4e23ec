"""Line filters and predicates (F1-F8) and the set operators around them.

Every filter is a ``where`` on a regex flag, planned inside the scan stage;
only F2 (and the explicit dedup) shuffle, because the original keeps one
copy of each suspicious line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import patterns as P


def is_failed(folded: str | None = None) -> Column:
    return X.matches(P.RX_FAILED, folded=folded)


def is_suspicious(folded: str | None = None) -> Column:
    """F2 predicate: sensitive path words OR an HTTP 4xx/5xx status (one scan)."""
    return X.matches(P.RX_SUSP_PATH, folded=folded) | X.matches(P.RX_HTTP_ERR)


def is_server_error(folded: str | None = None) -> Column:
    return X.matches(P.RX_SRV_ERR, folded=folded)


def not_comment() -> Column:
    return ~F.col("line").startswith("#")


def failed_logins(lines: DataFrame) -> DataFrame:
    """failed-login lines, duplicates kept."""
    return X.with_folded(lines).where(is_failed(X.FOLDED)).drop(X.FOLDED)


def suspicious_lines(lines: DataFrame) -> DataFrame:
    """distinct lines that hit a sensitive path rule or an HTTP error.

    The union of the two rules is one OR-predicate over one scan, then a
    ``distinct`` on the line; partial aggregation removes repeats of a hot
    line before the shuffle, so a line repeated a billion times moves once
    per map task.
    """
    return X.with_folded(lines.select("line")).where(is_suspicious(X.FOLDED)).select("line").distinct()


def server_errors(lines: DataFrame) -> DataFrame:
    """server/system error lines, duplicates kept."""
    return X.with_folded(lines).where(is_server_error(X.FOLDED)).drop(X.FOLDED)


def strip_comments(lines: DataFrame) -> DataFrame:
    """lines that are not ``#`` comments."""
    return lines.where(not_comment())


def normal_anomaly_split(lines: DataFrame) -> DataFrame:
    """``(line, label)``, one row per label; a line may be both or neither."""
    labels = F.array_compact(F.array(
        F.when(X.matches(P.RX_NORMAL), F.lit("normal")),
        F.when(X.matches(P.RX_ANOMALY), F.lit("anomaly"))))
    return lines.select("line", F.explode(labels).alias("label"))


def sensitive_paths(requests: DataFrame) -> DataFrame:
    """parsed requests whose *path* hits the case-sensitive sensitive rule."""
    return requests.where(F.col("path").rlike(P.RX_SENS_APACHE))


def http_errors(requests: DataFrame) -> DataFrame:
    """parsed requests with status >= 400."""
    return requests.where(F.col("status") >= 400)


def success_events(lines: DataFrame, strict: bool = False) -> DataFrame:
    """F8: success lines.

    The loose rule is the original one (``Accepted``, ``200`` or ``201``
    anywhere, so an IP such as ``172.16.0.200`` counts); ``strict`` only takes
    accepted logins and HTTP 200/201 statuses.
    """
    return lines.where(X.matches(P.RX_SUCCESS_STRICT if strict else P.RX_SUCCESS_LOOSE))


SORT_TIEBREAKS = ("line_id", "source_path", "source_block")


def sorted_log(lines: DataFrame, by: str = "line") -> DataFrame:
    """O1: the merged log in order (whole-line text order, or ``event_ts``).

    A global sort is a range shuffle; use only when ordered output is the
    product.  The row's origin (``line_id``, or file and split) breaks ties,
    so the range partitioner can cut a line repeated a billion times into
    several tasks instead of sorting all its copies in one.
    """
    ties = [c for c in SORT_TIEBREAKS if c in lines.columns and c != by]
    return lines.orderBy(by, *ties)


def dedup_lines(lines: DataFrame) -> DataFrame:
    """One copy of each line (``sort -u``)."""
    return lines.select("line").distinct()
