"""Parsers: one log line -> typed columns, as pure column expressions.

All parsers are narrow projections (no shuffle, no Python); they keep the
input partitioning and compose with any later filter, which Catalyst pushes
below the projection.  Lines that do not fit a format keep null fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..functions import columns as X
from ..functions import patterns as P

AUTH_KINDS = (
    # --- fixed values: auth record kinds and their detail labels ---
    (P.LIT_FAILED_PASSWORD, "FAILED LOGIN"),
    (P.LIT_ACCEPTED_PASSWORD, "SUCCESS LOGIN"),
    (P.LIT_INVALID_USER, "INVALID USER"),
)


def extract_ips(lines: DataFrame, keep=("line",)) -> DataFrame:
    """One row per IP-like token (several per line, left to right)."""
    return lines.select(*keep, F.explode(X.ip_tokens("line")).alias("ip"))


def with_event_time(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """Add ``event_ts`` from the line's own framing (Apache or syslog)."""
    ts = F.when(F.col("log_type") == "apache", X.apache_time("line")).otherwise(
        X.syslog_time(cfg.syslog_year, "line"))
    return lines.withColumn("event_ts", ts)


def _auth_base(lines: DataFrame, cfg: Thresholds) -> DataFrame:
    kinds = F.array_compact(F.array(*[
        F.when(X.has(lit), F.lit(lit)) for lit, _ in AUTH_KINDS]))
    b = (lines.where(F.col("log_type") == "auth")
         .select("line", X.awk_fields("line").alias("_f"), kinds.alias("_kinds"))
         .where(F.size("_kinds") > 0))
    f5 = X.field(F.col("_f"), 5)
    return b.select(
        "line",
        X.syslog_time(cfg.syslog_year, "line").alias("event_time"),
        X.field(F.col("_f"), 4).alias("host"),
        F.replace(F.regexp_replace(f5, r"\[.*\]", ""), F.lit(":"), F.lit("")).alias("process"),
        F.regexp_extract(f5, r"\[([0-9]+)\]", 1).try_cast("int").alias("pid"),
        F.explode("_kinds").alias("kind"),
        X.field_after(F.col("_f"), "from").alias("ip"),
        X.field_after(F.col("_f"), "for").alias("_for"),
        X.field_after(F.col("_f"), "port").alias("_port"),
    )


def parse_auth(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """Auth lines -> ``(event_time, host, process, pid, kind, ip, user, user_clean, port)``.

    One row per (line, matched kind): a line matching two kinds yields two
    records, as the per-pattern blocks of the original parser did.
    ``ip`` / ``user`` are the tokens after the *last* ``from`` / ``for``;
    invalid-user records carry no user.  ``user_clean`` skips the words
    ``invalid user`` that precede the name in ``for invalid user bob``.
    Values never carry over from an earlier line.
    """
    b = _auth_base(lines, cfg)
    is_invalid = F.col("kind") == P.LIT_INVALID_USER
    user = F.when(~is_invalid, F.col("_for"))
    clean = F.when(~is_invalid, F.coalesce(
        F.when(F.lower(F.col("_for")) == "invalid",
               F.nullif(F.regexp_extract("line", r"^(?:.*[ \t])?for[ \t]+invalid[ \t]+user[ \t]+([^ \t]+)", 1), F.lit(""))),
        F.col("_for")))
    return b.select("event_time", "host", "process", "pid", "kind", "ip",
                    user.alias("user"), clean.alias("user_clean"),
                    F.col("_port").try_cast("int").alias("port"))


def auth_events_detail(lines: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """One labelled row per matched auth record."""
    label = None
    for lit, name in AUTH_KINDS:
        label = F.when(F.col("kind") == lit, name) if label is None else label.when(F.col("kind") == lit, name)
    return parse_auth(lines, cfg).select(label.alias("label"), "ip", "user", "event_time")


def parse_apache(lines: DataFrame) -> DataFrame:
    """Apache lines -> request fields by whitespace position.

    ``status`` is null when the field is missing or not a number; such rows
    get ``parse_ok = false`` and are counted as OK requests, like a missing
    code that compares as 0.
    """
    f = X.awk_fields("line")
    b = lines.where(F.col("log_type") == "apache").select("line", f.alias("_f"))
    fld = lambda i: X.field(F.col("_f"), i)
    status = fld(9).try_cast("int")
    quoted = F.regexp_extract_all("line", F.lit(r'"([^"]*)"'), F.lit(1))
    return b.select(
        fld(1).alias("ip"),
        F.replace(fld(6), F.lit('"'), F.lit("")).alias("method"),
        F.replace(fld(7), F.lit('"'), F.lit("")).alias("path"),
        F.replace(fld(8), F.lit('"'), F.lit("")).alias("protocol"),
        status.alias("status"),
        fld(10).try_cast("bigint").alias("bytes"),
        F.get(quoted, 1).alias("referrer"),
        F.get(quoted, 2).alias("agent"),
        X.apache_time("line").alias("event_time"),
        status.isNotNull().alias("parse_ok"),
    )


def raw_status(lines: DataFrame) -> DataFrame:
    """Path and status field of Apache lines as they stand, numeric or not."""
    b = lines.where(F.col("log_type") == "apache").select(X.awk_fields("line").alias("_f"))
    return b.select(X.field(F.col("_f"), 7).alias("path"), X.field(F.col("_f"), 9).alias("status"))


def apache_events_detail(lines: DataFrame) -> DataFrame:
    """P10: one row per HTTP error and one per sensitive-path hit (a request may give both)."""
    a = parse_apache(lines)
    labels = F.array_compact(F.array(
        F.when(F.col("status") >= 400, F.lit("ERROR")),
        F.when(F.col("path").rlike(P.RX_SENS_APACHE), F.lit("SENSITIVE PATH"))))
    return a.select("ip", "path", "status", F.explode(labels).alias("label"))


def parse_syslog(lines: DataFrame) -> DataFrame:
    """Syslog lines -> ``(service, pid, message, is_error)``.

    ``service`` is field 5 without ``[pid]`` and colons; ``message`` is fields
    6..NF joined by single spaces; ``is_error`` is a case-sensitive ``ERROR``.
    """
    f = X.awk_fields("line")
    b = lines.where(F.col("log_type") == "syslog").select("line", f.alias("_f"))
    f5 = X.field(F.col("_f"), 5)
    n = F.size("_f")
    return b.select(
        F.replace(F.regexp_replace(f5, r"\[.*\]", ""), F.lit(":"), F.lit("")).alias("service"),
        F.regexp_extract(f5, r"\[([0-9]+)\]", 1).try_cast("int").alias("pid"),
        F.when(n >= 6, F.array_join(F.slice("_f", 6, F.greatest(n - 5, F.lit(1))), " "))
        .otherwise(F.lit("")).alias("message"),
        X.has(P.LIT_ERROR).alias("is_error"),
    )


def syslog_errors_detail(lines: DataFrame) -> DataFrame:
    """One row per syslog error line: ``(service, message)``."""
    return parse_syslog(lines).where("is_error").select("service", "message")
