"""A log-line table derived from the driver's ``events`` table.

The driver's tables hold no server logs, so the log operators run on lines
that are rendered from ``events`` rows by deterministic column expressions:
each event becomes one SSH, syslog or Apache combined-log line.  The
rendering is a narrow projection (no shuffle) over four pruned columns, so
it scales with ``events`` and keeps its partitioning.

The same rendering is written in SQL for the oracle; the two are byte-equal.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import sql_str


# --- fixed values: how event rows become log lines ---
# (event_type, bucket predicate on event_id % 840) -> template; first match wins.
# h = "<MMM dd HH:mm:ss> server ", w = "<ip> - - [<dd/MMM/yyyy:HH:mm:ss> +0000] \""
# lines of this block are what real logs hold beside clean records: comments, repeats, other
# letter cases, several addresses, unknown file names, unreadable times and statuses, bursts
LINE_RULES = (
    (None, (42, 5), "auth.log", "# ERROR: rotated by 10.0.0.1, Accepted 200"),
    (None, (42, 11), "shop-access.txt", '{w}GET /Backup/.ENV HTTP/1.1" 404 {sz} "-" "curl/7.68.0"'),
    (None, (42, 17), "host7.out", "{h}sshd[{pid}]: FAILED password for root from {ip} port {port} ssh2"),
    (None, (42, 23), "notes.txt", "ERROR: nightly copy from 10.9.8.7 to 10.9.8.6 failed"),
    (None, (42, 29), "apache.log", '{ip} - - [99/Foo/2024:00:00:00 +0000] "GET /x HTTP/1.1" none {sz} "-" "-"'),
    (None, (42, 35), "auth.log", "Jan 32 25:61:00 server sshd[{pid}]: Failed password for invalid user x from {ip} port {port} ssh2"),
    (None, (42, 41), "sample_logs.log", "{h}kernel[{pid}]: ERROR: Connection refused by 10.7.7.7 for {ip}"),
    (None, (21, 3), "auth.log", "Mar 03 04:10:00 server sshd[77]: Failed password for root from 10.66.0.1 port 22 ssh2"),
    (None, (84, 9), "auth.log", "Mar 03 04:20:00 server sshd[{pid}]: Failed password for root from 10.66.0.2 port 22 ssh2"),
    (None, (420, 10), "auth.log", "Mar 03 04:40:00 server sshd[{pid}]: Failed password for root from 10.66.0.3 port 22 ssh2"),
    (None, (840, 12), "auth.log", "Mar 03 04:50:00 server sshd[{pid}]: Failed password for root from 10.66.0.4 port 22 ssh2"),
    (None, (840, 13), "auth.log", "Mar 03 05:10:00 server sshd[78]: Failed password for root from 10.66.0.5 port 22 ssh2"),
    ("signup", None, "auth.log", "{h}sshd[{pid}]: Accepted password for user{uid} from {ip} port {port} ssh2"),
    ("error", (8, 0), "auth.log", "{h}sshd[{pid}]: Failed password for root from {ip} port {port} ssh2"),
    ("error", (8, 4), "auth.log", "{h}sshd[{pid}]: Failed password for admin from {ip} port {port} ssh2"),
    ("error", (4, 1), "auth.log", "{h}sshd[{pid}]: Invalid user hacker from {ip}"),
    ("error", (8, 2), "syslog", "{h}kernel[{pid}]: ERROR: Out of memory - process killed"),
    ("error", (8, 6), "syslog", "{h}kernel[{pid}]: ERROR: Segmentation fault"),
    ("error", (8, 3), "syslog", "{h}apache2[{pid}]: ERROR: Connection refused"),
    ("error", None, "syslog", "{h}kernel[{pid}]: ERROR: Disk I/O error"),
    ("click", (3, 0), "apache.log", '{w}GET /admin HTTP/1.1" 403 {sz} "-" "curl/7.68.0"'),
    ("click", (3, 1), "apache.log", '{w}GET /.env HTTP/1.1" 404 {sz} "-" "python-requests/2.25"'),
    ("purchase", (5, 0), "apache.log", '{w}POST /wp-admin HTTP/1.1" 500 {sz} "-" "Mozilla/5.0"'),
    ("purchase", (5, 1), "apache.log", '{w}GET /cart HTTP/1.1" 404 {sz} "-" "Mozilla/5.0"'),
    ("view", (7, 0), "apache.log", '{w}GET /config HTTP/1.1" 200 {sz} "-" "Mozilla/5.0"'),
    ("view", (7, 1), "syslog", "{h}systemd[{pid}]: Started daily cleanup service"),
    (None, None, "apache.log", '{w}GET /index.html HTTP/1.1" 200 {sz} "-" "Mozilla/5.0"'),
)
BUCKET_MOD = 840
SYSLOG_STAMP = "MMM dd HH:mm:ss"
CLF_STAMP = "dd/MMM/yyyy:HH:mm:ss"
# --- end of fixed values ---


_SLOTS = ("h", "w", "pid", "uid", "ip", "port", "sz")


def _rule_index_sql() -> str:
    arms = []
    for i, (et, bucket, _src, _t) in enumerate(LINE_RULES, start=1):
        conds = []
        if et is not None:
            conds.append(f"event_type = {sql_str(et)}")
        if bucket is not None:
            conds.append(f"event_id % {BUCKET_MOD} % {bucket[0]} = {bucket[1]}")
        arms.append(f"WHEN {' AND '.join(conds)} THEN {i}" if conds else f"ELSE {i}")
    return "CASE " + " ".join(arms) + " END"


def _segments() -> tuple[list[list[str]], list[list[int]]]:
    """Templates as literal segments around slot numbers, padded to one width.

    Slot ``k`` is the k-th value of ``_SLOTS``; slot ``len(_SLOTS)+1`` is ''.
    """
    split = [re.split(r"\{(\w+)\}", t) for _, _, _, t in LINE_RULES]
    width = max(len(p) // 2 for p in split)
    lits, slots = [], []
    for p in split:
        lit = p[0::2] + [""] * (width + 1 - len(p[0::2]))
        sl = [_SLOTS.index(n) + 1 for n in p[1::2]]
        slots.append(sl + [len(_SLOTS) + 1] * (width - len(sl)))
        lits.append(lit)
    return lits, slots


def event_log_lines(events: DataFrame) -> DataFrame:
    """``events`` -> ``(line_id, line, source_file, log_type)``.

    ``source_file`` names the log file the line would live in; ``log_type``
    is the classifier's answer for name and line.

    A rule index picks, from literal arrays, the text segments of the line's
    template and which value fills each gap; the line is one ``concat`` of
    those lookups.  It is written as one SQL query: a round trip to the JVM
    and an analysis instead of hundreds of ``Column`` calls.
    """
    from .files import log_type_sql

    lits, slots = _segments()
    width = len(slots[0])
    parts = []
    for j in range(width + 1):
        parts.append("element_at(array(" + ", ".join(sql_str(l[j]) for l in lits) + "), rule)")
        if j < width:
            pick = "element_at(array(" + ", ".join(str(sl[j]) for sl in slots) + "), rule)"
            parts.append(f"element_at(vals, {pick})")
    srcs = ", ".join(sql_str(src) for _, _, src, _ in LINE_RULES)
    # a line shows one stamp at most, in the layout of its rule
    clf = ", ".join("true" if "{w}" in t else "false" for _, _, _, t in LINE_RULES)
    vals = ("array(concat(stamp, ' server '), concat(ip, ' - - [', stamp, ' +0000] \"'), "
            "cast(1000 + event_id % 9000 AS string), cast(user_id AS string), ip, "
            "cast(50000 + event_id % 10000 AS string), cast(200 + event_id % 50000 AS string), '')")
    # The one-element explode makes ``line`` a real column, as it is for a
    # text source: filters on it stay above this node instead of being
    # rewritten over the whole rendering expression (once per predicate).
    query = f"""SELECT line_id, line, source_file, {log_type_sql("source_file", "line")} AS log_type FROM (
      SELECT line_id, explode(array(concat({", ".join(parts)}))) AS line, element_at(array({srcs}), rule) AS source_file FROM (
        SELECT line_id, rule, {vals} AS vals FROM (
          SELECT *, if(element_at(array({clf}), rule), date_format(ts, '{CLF_STAMP}'), date_format(ts, '{SYSLOG_STAMP}')) AS stamp FROM (
            SELECT event_id AS line_id, {_rule_index_sql()} AS rule,
              concat('10.', user_id % 3, '.', user_id % 7, '.', user_id % 50) AS ip, ts, user_id, event_id FROM {{events}}))))"""
    # braces of patterns are text, {events} is the table
    query = query.replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}")
    return events.sparkSession.sql(query, events=events)


# the four ``events`` columns the rendering reads, with the driver's types; an
# explicit read schema prunes the other columns and skips schema inference
EVENTS_READ_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"


def load_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS_READ_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return event_log_lines(events)


#: the long log: days of ``events`` as so many days
STRETCH = 24
#: what the lines of a fixed date have in common
FIXED_DATE_MARK = "from 10.66.0."
LONG_START = "2024-01-01 00:00:00"


def load_long_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log lines with their times stretched over years, and each line's place in its file.

    Adds ``source_path``, ``source_block`` (chunks of 500 lines), ``source_row``
    and ``source_modified``, as collecting files does.  The bursts, whose date
    is fixed, are left out: the lines of a log are in the order of their times.
    """
    events = spark.read.schema(EVENTS_READ_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    start = f"TIMESTAMP_NTZ'{LONG_START}'"
    t = events.withColumn("ts", F.expr(f"{start} + (ts - {start}) * {STRETCH}"))
    end = t.agg(F.max("ts").cast("string")).first()[0]
    end = F.lit(None).cast("timestamp_ntz") if end is None else F.expr(f"TIMESTAMP_NTZ'{end}'")
    lines = event_log_lines(t).select("*", F.col("source_file").alias("source_path"), F.expr("line_id div 500").alias("source_block"),
                                      F.col("line_id").alias("source_row"))
    return lines.where(~F.col("line").contains(FIXED_DATE_MARK)).withColumn("source_modified", end)


# --- fixed values: the access record that each document's delivery leaves ---
DOC_RECORD = """CASE
  WHEN doc_id % 9 = 0 THEN concat('Jan 05 10:00:', sec, ' server sshd[7]: Failed password for root from ', ip, ' port 22 ssh2')
  WHEN doc_id % 9 = 1 THEN concat('Jan 05 10:00:', sec, ' server kernel[7]: ERROR: Disk I/O error for ', ip)
  ELSE concat(ip, ' - - [05/Jan/2024:10:00:', sec, ' +0000] "GET ', CASE doc_id % 5 WHEN 0 THEN '/admin' WHEN 1 THEN '/.env' ELSE '/doc' END,
    ' HTTP/1.1" ', CASE doc_id % 4 WHEN 0 THEN '404' WHEN 1 THEN '500' ELSE '200' END, ' ', coalesce(n_chars, 0), ' "-" "-"') END"""
# --- end of fixed values ---


def load_document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as a log line, and after them the record of the document's delivery.

    ``(line_id, line, source_file, log_type)``.  The documents' lines repeat,
    are in several languages, hold addresses and junk, and come from names no
    classifier knows; the records are logins, errors and requests, so every
    rule has lines to find among them.  ``line_id`` is ``doc_id:place``.
    """
    from .files import log_type_of

    docs = spark.read.schema("doc_id bigint, text string, source string, n_chars bigint").parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    docs = docs.selectExpr("*", "concat('10.', doc_id % 3, '.', doc_id % 7, '.', doc_id % 50) AS ip",
                           "lpad(cast(doc_id % 60 AS string), 2, '0') AS sec")
    lines = F.concat(F.coalesce(F.split("text", "\n", -1), F.array().cast("array<string>")),
                     F.when(F.col("doc_id").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.expr(DOC_RECORD))))
    t = docs.select("doc_id", "source", F.posexplode(lines).alias("place", "line"))
    return t.select(F.concat_ws(":", "doc_id", "place").alias("line_id"), "line", F.col("source").alias("source_file"),
                    log_type_of("source", "line").alias("log_type"))
