"""Independent SQL formulations of the registered queries (DuckDB dialect).

Each query starts from the same ``log_lines`` rendering of ``events`` as the
Spark side (``sources.derived``), written here in plain SQL, then answers the
question with ordinary SQL: ``regexp_matches`` for ``rlike``, ``unnest`` of
``regexp_extract_all`` for token extraction, ``count(*) FILTER`` for
``count_if``.  Nothing here imports the Spark operators, so the two sides
are separate implementations of one specification.
"""

from __future__ import annotations

import re

from .. import config as K
from ..config import DEFAULT, Thresholds
from ..functions import patterns as P
from ..operators.reports import (SEC_ACTIONS, SEC_ANOMALY, SEC_CRIT, SEC_EXEC, SEC_HEADER, SEC_IPS, SEC_STATUS, SEC_TOP,
                                 SEC_USAGE, SEC_WARN)
from ..sources import derived as D

SEV_ORDER = ("CRITICAL", "HIGH", "WARNING", "MEDIUM", "LOW", "INFO")


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def tmpl(text: str, **cols) -> str:
    """SQL concatenation of a ``{name}`` template (NULL-propagating ``||``)."""
    parts = re.split(r"\{(\w+)\}", text)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append(q(p))
        else:
            out.append(f"CAST({cols[p]} AS VARCHAR)")
    return "(" + " || ".join(out) + ")"


def _lines_cte() -> str:
    cases = []
    for et, bucket, src, t in D.LINE_RULES:
        conds = []
        if et is not None:
            conds.append(f"et = {q(et)}")
        if bucket is not None:
            conds.append(f"m % {bucket[0]} = {bucket[1]}")
        text = tmpl(t, h="h", w="w", pid="pid", uid="uid", ip="ip", port="port", sz="sz")
        cases.append(("WHEN " + " AND ".join(conds) + f" THEN " if conds else "ELSE ", text, src))
    line = "CASE " + " ".join(f"{c}{t}" for c, t, _ in cases) + " END"
    source = "CASE " + " ".join(f"{c}{q(s)}" for c, _, s in cases) + " END"
    return f"""log_b AS (
  SELECT event_id AS line_id, event_type AS et, event_id % {D.BUCKET_MOD} AS m, user_id AS uid,
    '10.' || CAST(user_id % 3 AS VARCHAR) || '.' || CAST(user_id % 7 AS VARCHAR) || '.'
      || CAST(user_id % 50 AS VARCHAR) AS ip,
    CAST(1000 + event_id % 9000 AS VARCHAR) AS pid,
    CAST(50000 + event_id % 10000 AS VARCHAR) AS port,
    CAST(200 + event_id % 50000 AS VARCHAR) AS sz,
    strftime(ts, '%b %d %H:%M:%S') AS st,
    strftime(ts, '%d/%b/%Y:%H:%M:%S') AS ct
  FROM events),
log_r AS (SELECT *, st || ' server ' AS h, ip || ' - - [' || ct || ' +0000] "' AS w FROM log_b),
log_s AS (SELECT line_id, {line} AS line, {source} AS source_file FROM log_r),
log_lines AS (SELECT line_id, line, source_file, {_log_type()} AS log_type FROM log_s)"""


def _log_type() -> str:
    """The classifier: known names, else the shape of the line."""
    return r"""CASE WHEN source_file = 'auth.log' THEN 'auth' WHEN source_file = 'syslog' THEN 'syslog'
    WHEN source_file = 'apache.log' THEN 'apache'
    WHEN regexp_matches(line, '^\S+ \S+ \S+ \[[^\]]+\] "') THEN 'apache'
    WHEN regexp_matches(line, '^[A-Z][a-z]{2} [ 0-9][0-9] [0-9]{2}:[0-9]{2}:[0-9]{2} \S+ (sshd|sudo|su|login|passwd)(\[[0-9]+\])?:') THEN 'auth'
    WHEN regexp_matches(line, '^[A-Z][a-z]{2} [ 0-9][0-9] [0-9]{2}:[0-9]{2}:[0-9]{2} \S+ [^ \[:]+(\[[0-9]+\])?:') THEN 'syslog'
    ELSE 'unknown' END"""


LOG_LINES = _lines_cte()
DOC_LINES = f"""log_e AS (SELECT *, '10.' || doc_id % 3 || '.' || doc_id % 7 || '.' || doc_id % 50 AS ip,
    lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') AS sec FROM documents),
log_d AS (
  SELECT doc_id, source AS source_file, unnest(w) AS line, generate_subscripts(w, 1) - 1 AS place
  FROM (SELECT doc_id, source, list_concat(coalesce(string_split(text, chr(10)), []), CASE WHEN doc_id IS NULL THEN [] ELSE [CASE
    WHEN doc_id % 9 = 0 THEN 'Jan 05 10:00:' || sec || ' server sshd[7]: Failed password for root from ' || ip || ' port 22 ssh2'
    WHEN doc_id % 9 = 1 THEN 'Jan 05 10:00:' || sec || ' server kernel[7]: ERROR: Disk I/O error for ' || ip
    ELSE ip || ' - - [05/Jan/2024:10:00:' || sec || ' +0000] "GET ' || CASE doc_id % 5 WHEN 0 THEN '/admin' WHEN 1 THEN '/.env' ELSE '/doc' END
      || ' HTTP/1.1" ' || CASE doc_id % 4 WHEN 0 THEN '404' WHEN 1 THEN '500' ELSE '200' END || ' ' || coalesce(n_chars, 0) || ' "-" "-"' END] END) AS w
    FROM log_e)),
log_lines AS (SELECT doc_id || ':' || place AS line_id, line, source_file, {_log_type()} AS log_type FROM log_d)"""


def with_lines(body: str, *ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return f"WITH {LOG_LINES}{extra}\n{body}"


def over_documents(sql: str) -> str:
    """The same question over the lines of the documents."""
    return sql.replace(LOG_LINES, DOC_LINES)


def rx(pattern: str) -> str:
    """A rule pattern as a DuckDB/RE2 regex literal (``(?i)`` stays inline)."""
    return q(pattern)


def m(pattern: str, col: str = "line") -> str:
    return f"regexp_matches({col}, {rx(pattern)})"


def has(text: str, col: str = "line") -> str:
    return f"contains({col}, {q(text)})"


# ---------------------------------------------------------------- building blocks

RX_IP_L = rx(P.RX_IP)
F1 = m(P.RX_FAILED)
F2 = f"({m(P.RX_SUSP_PATH)} OR {m(P.RX_HTTP_ERR)})"
F3 = m(P.RX_SRV_ERR)
NOT_COMMENT = "NOT starts_with(line, '#')"
FIELDS = r"""CASE WHEN regexp_replace(line, '^[ \t]+|[ \t]+$', '', 'g') = '' THEN []::VARCHAR[]
  ELSE string_split_regex(regexp_replace(line, '^[ \t]+|[ \t]+$', '', 'g'), '[ \t]+') END"""


def syslog_ts(year: int, col: str = "line") -> str:
    return (f"try_strptime('{year} ' || regexp_replace(substr({col}, 1, 15), '  +', ' ', 'g'), "
            f"'%Y %b %d %H:%M:%S')")


def apache_ts(col: str = "line") -> str:
    return (rf"(try_strptime(nullif(regexp_extract({col}, '\[([^\]]+)\]', 1), ''), "
            r"'%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC')")


def after(word: str, col: str = "line") -> str:
    return rf"nullif(regexp_extract({col}, '^(?:.*[ \t])?{word}[ \t]+([^ \t]+)', 1), '')"


def ips_of(col: str = "line") -> str:
    return f"regexp_extract_all({col}, {RX_IP_L}, 0)"


def risk(n: str, cfg: Thresholds) -> str:
    c, h, md = cfg.tiers
    return (f"CASE WHEN {n} >= {c} THEN 'CRITICAL' WHEN {n} >= {h} THEN 'HIGH' "
            f"WHEN {n} >= {md} THEN 'MEDIUM' ELSE 'LOW' END")


def longform(row_cte: str, names: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {q(n)} AS metric, CAST(\"{n}\" AS BIGINT) AS cnt FROM {row_cte}" for n in names)


def cte_auth(cfg: Thresholds) -> list[str]:
    kinds = " UNION ALL ".join(
        f"SELECT line, f, {q(k)} AS kind FROM au_a WHERE {has(k)}"
        for k in (P.LIT_FAILED_PASSWORD, P.LIT_ACCEPTED_PASSWORD, P.LIT_INVALID_USER))
    return [
        f"au_a AS (SELECT line, {FIELDS} AS f FROM log_lines WHERE log_type = 'auth')",
        f"au_k AS ({kinds})",
        f"""parsed_auth AS (SELECT {syslog_ts(cfg.syslog_year)} AS event_time, f[4] AS host,
  replace(regexp_replace(f[5], '\\[.*\\]', '', 'g'), ':', '') AS process,
  try_cast(nullif(regexp_extract(f[5], '\\[([0-9]+)\\]', 1), '') AS INTEGER) AS pid,
  kind, {after('from')} AS ip,
  CASE WHEN kind <> {q(P.LIT_INVALID_USER)} THEN {after('for')} END AS "user",
  CASE WHEN kind <> {q(P.LIT_INVALID_USER)} THEN coalesce(
    CASE WHEN lower({after('for')}) = 'invalid' THEN
      nullif(regexp_extract(line, '^(?:.*[ \\t])?for[ \\t]+invalid[ \\t]+user[ \\t]+([^ \\t]+)', 1), '') END,
    {after('for')}) END AS user_clean,
  try_cast({after('port')} AS INTEGER) AS port
FROM au_k)""",
    ]


CTE_APACHE = [
    f"""ap_a AS (SELECT line, {FIELDS} AS f, regexp_extract_all(line, '"([^"]*)"', 1) AS qt
FROM log_lines WHERE log_type = 'apache')""",
    f"""parsed_apache AS (SELECT f[1] AS ip, replace(f[6], '"', '') AS method,
  replace(f[7], '"', '') AS path, replace(f[8], '"', '') AS protocol,
  try_cast(f[9] AS INTEGER) AS status, try_cast(f[10] AS BIGINT) AS bytes,
  qt[2] AS referrer, qt[3] AS agent, {apache_ts()} AS event_time,
  try_cast(f[9] AS INTEGER) IS NOT NULL AS parse_ok
FROM ap_a)""",
]

CTE_SYSLOG = [
    f"sy_a AS (SELECT line, {FIELDS} AS f FROM log_lines WHERE log_type = 'syslog')",
    """parsed_syslog AS (SELECT replace(regexp_replace(f[5], '\\[.*\\]', '', 'g'), ':', '') AS service,
  try_cast(nullif(regexp_extract(f[5], '\\[([0-9]+)\\]', 1), '') AS INTEGER) AS pid,
  CASE WHEN len(f) >= 6 THEN array_to_string(f[6:], ' ') ELSE '' END AS message,
  contains(line, 'ERROR') AS is_error
FROM sy_a)""",
]

CTE_FAILED_BY_IP = (
    f"failed_by_ip AS (SELECT ip, count(*) AS cnt FROM "
    f"(SELECT unnest({ips_of()}) AS ip FROM log_lines WHERE {F1}) GROUP BY ip)")

CTE_SUSP = f"susp AS (SELECT DISTINCT line FROM log_lines WHERE {F2})"


def cte_ip_summary(cfg: Thresholds) -> str:
    return f"""ip_summary AS (
  SELECT ip, count(*) AS occurrences, {risk('count(*)', cfg)} AS risk FROM (
    SELECT unnest({ips_of()}) AS ip FROM (
      SELECT line FROM log_lines WHERE {F1}
      UNION ALL (SELECT DISTINCT line FROM log_lines WHERE {F2})
      UNION ALL SELECT line FROM log_lines WHERE {F3})) GROUP BY ip)"""


# ---------------------------------------------------------------- alerts in SQL

ALERT_SELECT = ("engine, severity, category, ip, CAST(metric_value AS BIGINT) AS metric_value, "
                "CAST(threshold AS BIGINT) AS threshold, message, action, channel, in_main_log")


def _route(sev: str = "severity") -> str:
    return (f"CASE WHEN {sev} IN ('CRITICAL', 'HIGH') THEN 'critical' "
            f"WHEN {sev} IN ('MEDIUM', 'LOW', 'WARNING') THEN 'warning' ELSE 'main' END")


def stage4_sql(cfg: Thresholds) -> tuple[list[str], str]:
    t = cfg.failed_login
    ctes = [CTE_FAILED_BY_IP, cte_ip_summary(cfg)]
    body = f"""
SELECT 'stage4' AS engine, CASE WHEN cnt >= {t} THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
  'SSH' AS category, ip, cnt AS metric_value, {t} AS threshold,
  CASE WHEN cnt >= {t} THEN {tmpl(K.STAGE4_BRUTE_FORCE, ip='ip', n='cnt', t=str(t))}
       ELSE {tmpl(K.STAGE4_ELEVATED, ip='ip', n='cnt')} END AS message,
  CAST(NULL AS VARCHAR) AS action,
  CASE WHEN cnt >= {t} THEN 'critical' ELSE 'warning' END AS channel, cnt >= {t} AS in_main_log
FROM failed_by_ip
UNION ALL
SELECT 'stage4', CASE WHEN n >= {cfg.error} THEN 'CRITICAL' ELSE 'INFO' END, 'SYSTEM', CAST(NULL AS VARCHAR),
  n, {cfg.error},
  CASE WHEN n >= {cfg.error} THEN {tmpl(K.STAGE4_ERROR_RATE, n='n', t=str(cfg.error))}
       ELSE {tmpl(K.STAGE4_ERRORS_NORMAL, n='n')} END,
  CAST(NULL AS VARCHAR), CASE WHEN n >= {cfg.error} THEN 'critical' ELSE 'main' END, TRUE
FROM (SELECT count(*) AS n FROM log_lines WHERE {F3})
UNION ALL
SELECT 'stage4', CASE WHEN risk = 'CRITICAL' THEN 'CRITICAL' ELSE 'WARNING' END, 'IP', ip, occurrences,
  CASE WHEN risk = 'CRITICAL' THEN {cfg.tiers[0]} ELSE {cfg.tiers[1]} END,
  CASE WHEN risk = 'CRITICAL' THEN {tmpl(K.STAGE4_SUSPICIOUS_CRIT, ip='ip', n='occurrences')}
       ELSE {tmpl(K.STAGE4_SUSPICIOUS_HIGH, ip='ip', n='occurrences')} END,
  CAST(NULL AS VARCHAR), CASE WHEN risk = 'CRITICAL' THEN 'critical' ELSE 'warning' END, TRUE
FROM ip_summary WHERE risk IN ('CRITICAL', 'HIGH')"""
    return ctes, body


def detailed_sql(cfg: Thresholds) -> tuple[list[str], str]:
    ctes = [CTE_FAILED_BY_IP, cte_ip_summary(cfg), CTE_SUSP]
    tiers = [
        (cfg.ssh_extreme, "CRITICAL", K.SSH_EXTREME),
        (cfg.ssh_critical, "CRITICAL", K.SSH_CRITICAL),
        (cfg.failed_login, "HIGH", K.SSH_HIGH),
        (cfg.ssh_medium, "MEDIUM", K.SSH_MEDIUM),
    ]

    def case(pick):
        return "CASE " + " ".join(f"WHEN cnt >= {b} THEN {pick(b, s, t)}" for b, s, t in tiers) + " END"

    ssh = f"""SELECT 'detailed' AS engine, sev AS severity, 'SSH' AS category, ip, cnt AS metric_value,
  thr AS threshold, msg AS message, act AS action, {_route('sev')} AS channel, TRUE AS in_main_log
FROM (SELECT ip, cnt, {case(lambda b, s, t: q(s))} AS sev, {case(lambda b, s, t: str(b))} AS thr,
  {case(lambda b, s, t: tmpl(t[0], ip='ip', n='cnt'))} AS msg,
  {case(lambda b, s, t: tmpl(t[1], ip='ip', n='cnt'))} AS act FROM failed_by_ip) WHERE sev IS NOT NULL"""

    counters = f"""det_c AS (SELECT
  (SELECT count(*) FROM log_lines WHERE {F1}) AS failed_lines,
  (SELECT count(*) FROM log_lines WHERE {has(P.LIT_INVALID_USER)}) AS invalid_users,
  (SELECT count(*) FROM susp) AS susp_lines,
  (SELECT count(*) FROM susp WHERE {m(P.RX_HTTP_5XX)}) AS err5xx,
  (SELECT count(*) FROM susp WHERE {m(P.RX_HTTP_4XX)}) AS err4xx,
  (SELECT count(*) FROM susp WHERE {has(P.LIT_ENV)}) AS env_hits,
  (SELECT count(*) FROM susp WHERE {has(P.LIT_ADMIN)}) AS admin_hits,
  (SELECT count(*) FROM susp WHERE {has(P.LIT_WP_ADMIN)}) AS wp_hits,
  (SELECT count(*) FROM log_lines WHERE {F3}) AS total_errors,
  (SELECT count(*) FROM log_lines WHERE {F3} AND {has(P.LIT_OOM)}) AS oom,
  (SELECT count(*) FROM log_lines WHERE {F3} AND {has(P.LIT_SEGFAULT)}) AS segfault,
  (SELECT count(*) FROM log_lines WHERE {F3} AND {has(P.LIT_DISK_IO)}) AS disk)"""
    ctes.append(counters)
    hi5, mid5 = cfg.web_5xx
    hi4, mid4 = cfg.web_4xx
    rules = [
        ("HIGH", "SSH", f"failed_lines > 0 AND invalid_users > {cfg.invalid_users}", "invalid_users",
         cfg.invalid_users, K.SSH_INVALID),
        ("CRITICAL", "WEB", f"susp_lines > 0 AND err5xx >= {hi5}", "err5xx", hi5, K.WEB_5XX_CRIT),
        ("HIGH", "WEB", f"susp_lines > 0 AND err5xx < {hi5} AND err5xx >= {mid5}", "err5xx", mid5, K.WEB_5XX_HIGH),
        ("HIGH", "WEB", f"susp_lines > 0 AND err4xx >= {hi4}", "err4xx", hi4, K.WEB_4XX_HIGH),
        ("MEDIUM", "WEB", f"susp_lines > 0 AND err4xx < {hi4} AND err4xx >= {mid4}", "err4xx", mid4, K.WEB_4XX_MED),
        ("CRITICAL", "WEB", "susp_lines > 0 AND env_hits > 0", "env_hits", 0, K.WEB_ENV),
        ("HIGH", "WEB", f"susp_lines > 0 AND admin_hits > {cfg.admin_probe}", "admin_hits", cfg.admin_probe, K.WEB_ADMIN),
        ("MEDIUM", "WEB", "susp_lines > 0 AND wp_hits > 0", "wp_hits", 0, K.WEB_WP),
        ("CRITICAL", "SYSTEM", f"total_errors > 0 AND total_errors >= {cfg.error_storm}", "total_errors",
         cfg.error_storm, K.SYS_STORM),
        ("HIGH", "SYSTEM", f"total_errors > 0 AND total_errors < {cfg.error_storm} AND total_errors >= {cfg.error}",
         "total_errors", cfg.error, K.SYS_HIGH),
        ("CRITICAL", "SYSTEM", "total_errors > 0 AND oom > 0", "oom", 0, K.SYS_OOM),
        ("CRITICAL", "SYSTEM", "total_errors > 0 AND segfault > 0", "segfault", 0, K.SYS_SEGFAULT),
        ("HIGH", "SYSTEM", "total_errors > 0 AND disk > 0", "disk", 0, K.SYS_DISK),
    ]
    glob = "\nUNION ALL\n".join(
        f"SELECT 'detailed', {q(s)}, {q(c)}, CAST(NULL AS VARCHAR), {v}, {b}, "
        f"{tmpl(t[0], n=v)}, {tmpl(t[1], n=v)}, {_route(q(s))}, TRUE FROM det_c WHERE {cond}"
        for s, c, cond, v, b, t in rules)
    rep = (f"SELECT 'detailed', 'CRITICAL', 'REPUTATION', ip, occurrences, {cfg.tiers[0]}, "
           f"{tmpl(K.REPUTATION[0], ip='ip', n='occurrences')}, {tmpl(K.REPUTATION[1], ip='ip', n='occurrences')}, "
           f"'critical', TRUE FROM ip_summary WHERE risk = 'CRITICAL'")
    return ctes, f"{ssh}\nUNION ALL\n{glob}\nUNION ALL\n{rep}"


def _alerts_query(parts: tuple[list[str], str]) -> str:
    ctes, body = parts
    return with_lines(f"SELECT {ALERT_SELECT} FROM ({body})", *ctes)


def _threshold_sql(cfg: Thresholds) -> tuple[list[str], str]:
    ctes = [CTE_FAILED_BY_IP, CTE_SUSP]
    body = f"""SELECT label, CAST(value AS BIGINT) AS value, CAST(threshold AS BIGINT) AS threshold,
  CAST(value * 100 // threshold AS BIGINT) AS pct,
  CASE WHEN value >= threshold THEN 'EXCEEDED' WHEN value * 100 // threshold >= {cfg.warn_pct} THEN 'WARNING'
       ELSE 'OK' END AS status
FROM (
  SELECT 'Failed logins from ' || ip AS label, cnt AS value, {cfg.failed_login} AS threshold FROM failed_by_ip
  UNION ALL SELECT 'Total server errors', n, {cfg.error} FROM (SELECT count(*) AS n FROM log_lines WHERE {F3}) WHERE n > 0
  UNION ALL SELECT 'HTTP 4xx/5xx errors', h, {cfg.error}
    FROM (SELECT count(*) FILTER (WHERE {m(P.RX_HTTP_ERR)}) AS h, count(*) AS s FROM susp) WHERE s > 0)"""
    return ctes, body


def _sev_rank(col: str = "severity") -> str:
    return "CASE " + " ".join(f"WHEN {col} = {q(s)} THEN {i}" for i, s in enumerate(SEV_ORDER, 1)) + " END"


def _name_rank(names: list[str], col: str = "metric") -> str:
    return "CASE " + " ".join(f"WHEN {col} = {q(n)} THEN {i}" for i, n in enumerate(names, 1)) + " END"


def _report_sql(out: dict[str, str], cfg: Thresholds, generated_at: str) -> dict[str, str]:
    """T1, T2, T4, T5, P4, P5 as unions of the single-table queries (each a subquery)."""
    def sub(name: str) -> str:
        return f"({out[name]})"

    S4 = sub("stage4_alerts")
    usage = sub("usage_stats")
    anomaly = sub("anomaly_counts")
    anom_names = [P.ANOMALY_FAILED_SSH, P.ANOMALY_INVALID, P.ANOMALY_HTTP, P.ANOMALY_SYSTEM,
                  P.ANOMALY_SENSITIVE, P.TOTAL]
    usage_names = ["total_lines", "total_errors", "total_success", "total_success_strict", "unique_ips"]
    cnt_crit = "count(*) FILTER (WHERE channel = 'critical')"
    cnt_warn = "count(*) FILTER (WHERE channel = 'warning')"

    def row(section, ord_, key, value, src="", where=""):
        w = f" WHERE {where}" if where else ""
        f = f" FROM {src}" if src else ""
        return (f"SELECT {q(section)} AS section, CAST({ord_} AS BIGINT) AS ord, CAST({key} AS VARCHAR) AS key, "
                f"CAST({value} AS VARCHAR) AS value{f}{w}")

    header = row(SEC_HEADER, 0, q("Generated"), q(generated_at))
    alerts = [row(SEC_CRIT, _sev_rank(), "severity", "message", S4, "channel = 'critical'"),
              row(SEC_WARN, _sev_rank(), "severity", "message", S4, "channel = 'warning'")]
    anom_rows = row(SEC_ANOMALY, _name_rank(anom_names), "metric", "cnt", anomaly)
    res: dict[str, str] = {}
    res["final_report"] = "\nUNION ALL ".join([
        header,
        row(SEC_EXEC, 1, q("Total Log Lines Processed"), "cnt", usage, "metric = 'total_lines'"),
        row(SEC_EXEC, 2, q("Unique IP Addresses"), "cnt", usage, "metric = 'unique_ips'"),
        row(SEC_EXEC, 3, q("Critical Alerts"), cnt_crit, S4),
        row(SEC_EXEC, 4, q("Warning Alerts"), cnt_warn, S4),
        anom_rows,
        row(SEC_IPS, "-occurrences", "ip", "CAST(occurrences AS VARCHAR) || ' ' || risk", sub("ip_summary")),
        *alerts,
        row(SEC_USAGE, _name_rank(usage_names), "metric", "cnt", usage),
    ])
    status = f"CASE WHEN {cnt_crit} > 0 THEN {q(K.STATUS_ACTION)} ELSE {q(K.STATUS_NORMAL)} END"
    res["status_flag"] = f"SELECT {status} AS status FROM {S4}"
    crit_actions = ", ".join(q(a) for a in K.ACTIONS_CRITICAL)
    norm_actions = ", ".join(q(a) for a in K.ACTIONS_NORMAL)
    res["alert_digest"] = "\nUNION ALL ".join([
        header,
        row(SEC_EXEC, 1, q("Log lines processed"), f"count(*) FILTER (WHERE {NOT_COMMENT})", sub("classify_source")),
        row(SEC_EXEC, 2, q("Critical alerts"), cnt_crit, S4),
        row(SEC_EXEC, 3, q("Warning alerts"), cnt_warn, S4),
        row(SEC_STATUS, 1, q("STATUS"), status, S4),
        *alerts,
        anom_rows,
        row(SEC_TOP, "-occurrences", "ip", "CAST(occurrences AS VARCHAR) || ' ' || risk", sub("top_suspicious_ips")),
        row(SEC_ACTIONS, "i", "i", "a",
            f"(SELECT generate_subscripts(acts, 1) AS i, unnest(acts) AS a FROM (SELECT CASE WHEN {cnt_crit} > 0 "
            f"THEN [{crit_actions}] ELSE [{norm_actions}] END AS acts FROM {S4}))"),
    ])
    rendered = f"(SELECT '[' || severity || '] ' || {q(generated_at)} || ' | ' || message AS line FROM {S4})"
    parsed = r"""SELECT nullif(regexp_extract(head, '^\[([A-Z]+)\]', 1), '') AS severity,
  trim(regexp_replace(head, '^\[[A-Z]+\]', '')) AS ts, trim(parts[2]) AS type, trim(parts[3]) AS detail
FROM (SELECT parts, trim(parts[1]) AS head FROM (SELECT string_split(line, '|') AS parts FROM {src}))"""
    res["parse_alert_line"] = parsed.format(src=rendered)
    res["parse_detailed_alert"] = f"SELECT {q(generated_at)} AS ts, severity, category, message, action FROM {sub('detailed_alerts')}"
    crit_rendered = rendered.replace(f"FROM {S4})", f"FROM {S4} WHERE channel = 'critical')")
    res["run_summary"] = "\nUNION ALL ".join([
        row(SEC_EXEC, 1, q("Total Log Lines Processed"), "cnt", usage, "metric = 'total_lines'"),
        row(SEC_EXEC, 2, q("Unique IP Addresses Found"), "cnt", usage, "metric = 'unique_ips'"),
        row(SEC_EXEC, 3, q("Critical Alerts Fired"), cnt_crit, S4),
        row(SEC_EXEC, 4, q("Warning Alerts Fired"), cnt_warn, S4),
        row(SEC_CRIT, 1, "type", "concat_ws(' | ', ts, detail)", f"({parsed.format(src=crit_rendered)})"),
    ])
    text = f"(SELECT printf('%-20s | %-12s | %s', ip, CAST(occurrences AS VARCHAR), risk) AS line FROM {sub('ip_summary')})"
    strip = "replace(replace(trim(parts[{i}]), ' ', ''), chr(9), '')"
    res["parse_ip_summary"] = (
        f"SELECT * FROM (SELECT {strip.format(i=1)} AS ip, TRY_CAST({strip.format(i=2)} AS BIGINT) AS occurrences, "
        f"{strip.format(i=3)} AS risk FROM (SELECT string_split(line, '|') AS parts FROM {text})) "
        f"WHERE occurrences IS NOT NULL AND ip <> ''")
    return res


def _alert_rule_sql(cfg: Thresholds) -> dict[str, str]:
    """One query per alert rule group: the engine's union, filtered to the rule's rows."""
    s4c, s4 = stage4_sql(cfg)
    dc, det = detailed_sql(cfg)

    def pick(ctes, body, where):
        return with_lines(f"SELECT {ALERT_SELECT} FROM ({body}) WHERE {where}", *ctes)

    return {
        "alert_brute_force": pick(s4c, s4, "category = 'SSH'"),
        "alert_elevated": pick(s4c, s4, "category = 'SSH' AND severity = 'WARNING'"),
        "alert_error_rate": pick(s4c, s4, "category = 'SYSTEM'"),
        "alert_suspicious_ip": pick(s4c, s4, "category = 'IP'"),
        "alert_ssh_tiers": pick(dc, det, "category = 'SSH' AND ip IS NOT NULL"),
        "alert_invalid_users": pick(dc, det, "category = 'SSH' AND ip IS NULL"),
        "alert_web_rules": pick(dc, det, "category = 'WEB'"),
        "alert_system_rules": pick(dc, det, "category = 'SYSTEM'"),
        "alert_ip_reputation": pick(dc, det, "category = 'REPUTATION'"),
    }


def _window_alert_sql(windows_sql: str, errors_sql: str, cfg: Thresholds) -> str:
    """W3 rules over the batch window counts (one row per engine, ip and window)."""
    tiers = [(cfg.ssh_extreme, "CRITICAL", K.SSH_EXTREME), (cfg.ssh_critical, "CRITICAL", K.SSH_CRITICAL),
             (cfg.failed_login, "HIGH", K.SSH_HIGH), (cfg.ssh_medium, "MEDIUM", K.SSH_MEDIUM)]

    def case(pick):
        return "CASE " + " ".join(f"WHEN cnt >= {b} THEN {pick(b, s, t)}" for b, s, t in tiers) + " END"

    t = cfg.failed_login
    body = f"""SELECT 'stage4' AS engine, 'CRITICAL' AS severity, ip, cnt, window_start, {t} AS threshold,
  {tmpl(K.STAGE4_BRUTE_FORCE, ip='ip', n='cnt', t=str(t))} AS message, CAST(NULL AS VARCHAR) AS action
FROM wc WHERE cnt >= {t}
UNION ALL
SELECT 'detailed', {case(lambda b, s, x: q(s))}, ip, cnt, window_start, {case(lambda b, s, x: str(b))},
  {case(lambda b, s, x: tmpl(x[0], ip='ip', n='cnt'))}, {case(lambda b, s, x: tmpl(x[1], ip='ip', n='cnt'))}
FROM wc WHERE cnt >= {cfg.ssh_medium}
UNION ALL
SELECT 'stage4', 'CRITICAL', CAST(NULL AS VARCHAR), errors, window_start, {cfg.error},
  {tmpl(K.STAGE4_ERROR_RATE, n='errors', t=str(cfg.error))}, CAST(NULL AS VARCHAR)
FROM we WHERE errors >= {cfg.error}"""
    return (f"SELECT engine, severity, CASE WHEN ip IS NULL THEN 'SYSTEM' ELSE 'SSH' END AS category, ip, CAST(cnt AS BIGINT) AS metric_value, "
            f"CAST(threshold AS BIGINT) AS threshold, message, action, {_route('severity')} AS channel, "
            f"TRUE AS in_main_log, window_start FROM (WITH wc AS ({windows_sql}), we AS ({errors_sql}) {body})")


def build(cfg: Thresholds = DEFAULT, alt: Thresholds | None = None,
          generated_at: str = "2024-02-01 00:00:00", user_rules=()) -> dict[str, str]:
    """name -> DuckDB SQL over the pre-registered driver tables."""
    W = with_lines
    A = cte_auth(cfg)
    out: dict[str, str] = {}
    out["classify_source"] = W("SELECT line_id, line, source_file, log_type FROM log_lines")
    out["extract_ips"] = W(f"SELECT line_id, unnest({ips_of()}) AS ip FROM log_lines")
    out["event_time"] = W(
        f"SELECT line_id, log_type, CASE WHEN log_type = 'apache' THEN {apache_ts()} "
        f"ELSE {syslog_ts(cfg.syslog_year)} END AS event_ts FROM log_lines")
    out["parse_auth"] = W("SELECT * FROM parsed_auth", *A)
    out["auth_events_detail"] = W(
        "SELECT CASE kind WHEN 'Failed password' THEN 'FAILED LOGIN' WHEN 'Accepted password' "
        "THEN 'SUCCESS LOGIN' WHEN 'Invalid user' THEN 'INVALID USER' END AS label, ip, \"user\", event_time "
        "FROM parsed_auth", *A)
    out["parse_apache"] = W("SELECT * FROM parsed_apache", *CTE_APACHE)
    out["apache_events_detail"] = W(
        "SELECT ip, path, status, 'ERROR' AS label FROM parsed_apache WHERE status >= 400 "
        f"UNION ALL SELECT ip, path, status, 'SENSITIVE PATH' FROM parsed_apache "
        f"WHERE {m(P.RX_SENS_APACHE, 'path')}", *CTE_APACHE)
    out["parse_syslog"] = W("SELECT * FROM parsed_syslog", *CTE_SYSLOG)
    out["syslog_errors_detail"] = W("SELECT service, message FROM parsed_syslog WHERE is_error", *CTE_SYSLOG)
    # filters
    out["failed_logins"] = W(f"SELECT line_id, line FROM log_lines WHERE {F1}")
    out["suspicious_lines"] = W(f"SELECT DISTINCT line FROM log_lines WHERE {F2}")
    out["server_errors"] = W(f"SELECT line_id, line FROM log_lines WHERE {F3}")
    out["strip_comments"] = W(f"SELECT line_id, line FROM log_lines WHERE {NOT_COMMENT}")
    out["normal_anomaly_split"] = W(
        f"SELECT line, 'normal' AS label FROM log_lines WHERE {m(P.RX_NORMAL)} "
        f"UNION ALL SELECT line, 'anomaly' FROM log_lines WHERE {m(P.RX_ANOMALY)}")
    out["sensitive_paths"] = W(
        f"SELECT ip, path, status FROM parsed_apache WHERE {m(P.RX_SENS_APACHE, 'path')}", *CTE_APACHE)
    out["http_errors"] = W("SELECT ip, path, status FROM parsed_apache WHERE status >= 400", *CTE_APACHE)
    out["success_events"] = W(f"SELECT line_id, line FROM log_lines WHERE {m(P.RX_SUCCESS_LOOSE)}")
    out["success_events_strict"] = W(f"SELECT line_id, line FROM log_lines WHERE {m(P.RX_SUCCESS_STRICT)}")
    out["dedup_lines"] = W("SELECT DISTINCT line FROM log_lines")
    out["sorted_log"] = W("SELECT line_id, line, source_file FROM log_lines ORDER BY line")
    # tagging
    scan = [(P.SCAN_SSH, P.RX_SSH_BF), (P.SCAN_WEB, P.RX_WEB_PROBE),
            (P.SCAN_HTTP, P.RX_HTTP_ERR), (P.SCAN_SYS, P.RX_SYS_ERR)]
    out["anomaly_scan"] = W(" UNION ALL ".join(
        f"SELECT line, {q(n)} AS anomaly_type FROM log_lines WHERE {m(r)}" for n, r in scan))
    cnts = ", ".join(f"count(*) FILTER (WHERE {m(r)}) AS \"{n}\"" for n, r in scan)
    total = " + ".join(f"\"{n}\"" for n, _ in scan)
    out["anomaly_summary"] = W(
        "SELECT anomaly_type, CAST(cnt AS BIGINT) AS cnt FROM ("
        + " UNION ALL ".join(f"SELECT {q(n)} AS anomaly_type, \"{n}\" AS cnt FROM sc" for n, _ in scan)
        + f" UNION ALL SELECT 'TOTAL', {total} FROM sc) WHERE cnt > 0 OR anomaly_type = 'TOTAL'",
        f"sc AS (SELECT {cnts} FROM log_lines)")
    # aggregates
    out["ip_summary"] = W("SELECT ip, occurrences, risk FROM ip_summary", cte_ip_summary(cfg))
    if alt is not None:
        out["ip_summary_alt_tiers"] = W("SELECT ip, occurrences, risk FROM ip_summary", cte_ip_summary(alt))
    out["ip_rank"] = out["ip_summary"]
    out["top_suspicious_ips"] = W(
        f"SELECT ip, occurrences, risk FROM ip_summary ORDER BY occurrences DESC, ip DESC LIMIT {cfg.top_ips}",
        cte_ip_summary(cfg))
    out["failed_by_ip"] = W("SELECT ip, cnt FROM failed_by_ip", CTE_FAILED_BY_IP)
    out["auth_failed_per_ip"] = W(
        "SELECT ip, count(*) AS cnt FROM parsed_auth WHERE kind = 'Failed password' GROUP BY ip", *A)
    out["auth_failed_per_user"] = W(
        "SELECT \"user\", count(*) AS cnt FROM parsed_auth WHERE kind = 'Failed password' GROUP BY \"user\"", *A)
    out["auth_invalid_per_ip"] = W(
        "SELECT ip, count(*) AS cnt FROM parsed_auth WHERE kind = 'Invalid user' GROUP BY ip", *A)
    out["auth_summary"] = W(longform("au", ["failed", "success", "invalid"]),
                            f"au AS (SELECT count(*) FILTER (WHERE {has(P.LIT_FAILED_PASSWORD)}) AS failed, "
                            f"count(*) FILTER (WHERE {has(P.LIT_ACCEPTED_PASSWORD)}) AS success, "
                            f"count(*) FILTER (WHERE {has(P.LIT_INVALID_USER)}) AS invalid "
                            f"FROM log_lines WHERE log_type = 'auth')")
    out["apache_summary"] = W(longform("aps", ["ok", "error"]), *CTE_APACHE,
                              "aps AS (SELECT count(*) FILTER (WHERE NOT coalesce(status >= 400, FALSE)) AS ok, "
                              "count(*) FILTER (WHERE coalesce(status >= 400, FALSE)) AS error FROM parsed_apache)")
    out["requests_per_ip"] = W("SELECT ip, count(*) AS cnt FROM parsed_apache GROUP BY ip", *CTE_APACHE)
    out["error_code_breakdown"] = W(
        "SELECT status, count(*) AS cnt FROM parsed_apache WHERE status >= 400 GROUP BY status", *CTE_APACHE)
    out["sensitive_hits_per_ip"] = W(
        f"SELECT ip, count(*) AS cnt FROM parsed_apache WHERE {m(P.RX_SENS_APACHE, 'path')} GROUP BY ip",
        *CTE_APACHE)
    out["syslog_summary"] = W(longform("sys", ["errors", "normal"]),
                              "sys AS (SELECT count(*) FILTER (WHERE contains(line, 'ERROR')) AS errors, "
                              "count(*) FILTER (WHERE NOT contains(line, 'ERROR')) AS normal "
                              "FROM log_lines WHERE log_type = 'syslog')")
    out["errors_per_service"] = W(
        "SELECT service, count(*) AS cnt FROM parsed_syslog WHERE is_error GROUP BY service", *CTE_SYSLOG)
    anom = [(P.ANOMALY_FAILED_SSH, has(P.LIT_FAILED_PASSWORD)), (P.ANOMALY_INVALID, has(P.LIT_INVALID_USER)),
            (P.ANOMALY_HTTP, m(P.RX_HTTP_ERR)), (P.ANOMALY_SYSTEM, has(P.LIT_ERROR_COLON)),
            (P.ANOMALY_SENSITIVE, m(P.RX_SENS_STAGE3))]
    out["anomaly_counts"] = W(
        longform("an2", [n for n, _ in anom] + ["TOTAL"]),
        "an AS (SELECT " + ", ".join(f"count(*) FILTER (WHERE {c}) AS \"{n}\"" for n, c in anom)
        + " FROM log_lines)",
        "an2 AS (SELECT *, " + " + ".join(f"\"{n}\"" for n, _ in anom) + " AS \"TOTAL\" FROM an)")
    out["usage_stats"] = W(
        longform("us", ["total_lines", "total_errors", "total_success", "total_success_strict", "unique_ips"]),
        f"us AS (SELECT count(*) FILTER (WHERE {NOT_COMMENT}) AS total_lines, "
        f"count(*) FILTER (WHERE {F3}) AS total_errors, "
        f"count(*) FILTER (WHERE {m(P.RX_SUCCESS_LOOSE)}) AS total_success, "
        f"count(*) FILTER (WHERE {m(P.RX_SUCCESS_STRICT)}) AS total_success_strict, "
        f"(SELECT count(DISTINCT ip) FROM (SELECT unnest({ips_of()}) AS ip FROM log_lines)) AS unique_ips "
        f"FROM log_lines)")
    out["unique_ips"] = W(
        f"SELECT CAST(count(DISTINCT ip) AS BIGINT) AS unique_ips FROM (SELECT unnest({ips_of()}) AS ip FROM log_lines)")
    out["stage2_counts"] = W(
        longform("s2", ["failed_logins", "suspicious_ips", "server_errors"]),
        f"s2 AS (SELECT count(*) FILTER (WHERE {F1}) AS failed_logins, "
        f"count(DISTINCT line) FILTER (WHERE {F2}) AS suspicious_ips, "
        f"count(*) FILTER (WHERE {F3}) AS server_errors FROM log_lines)")
    out["http_class_counts"] = W(
        longform("hc", ["http_4xx", "http_5xx"]), CTE_SUSP,
        f"hc AS (SELECT count(*) FILTER (WHERE {m(P.RX_HTTP_4XX)}) AS http_4xx, "
        f"count(*) FILTER (WHERE {m(P.RX_HTTP_5XX)}) AS http_5xx FROM susp)")
    out["probe_counts"] = W(
        longform("pc", ["env", "admin", "wp_admin"]), CTE_SUSP,
        f"pc AS (SELECT count(*) FILTER (WHERE {has(P.LIT_ENV)}) AS env, "
        f"count(*) FILTER (WHERE {has(P.LIT_ADMIN)}) AS admin, "
        f"count(*) FILTER (WHERE {has(P.LIT_WP_ADMIN)}) AS wp_admin FROM susp)")
    out["system_fault_counts"] = W(
        longform("sf", ["out_of_memory", "segmentation", "disk_io", "total_errors"]),
        f"sf AS (SELECT count(*) FILTER (WHERE {has(P.LIT_OOM)}) AS out_of_memory, "
        f"count(*) FILTER (WHERE {has(P.LIT_SEGFAULT)}) AS segmentation, "
        f"count(*) FILTER (WHERE {has(P.LIT_DISK_IO)}) AS disk_io, count(*) AS total_errors "
        f"FROM log_lines WHERE {F3})")
    out["collection_summary"] = W(
        longform("cs", ["files_collected", "total_lines"]),
        f"cs AS (SELECT count(DISTINCT source_file) AS files_collected, "
        f"count(*) FILTER (WHERE {NOT_COMMENT}) AS total_lines FROM log_lines)")
    out["tracked_ips"] = W(longform("ti", ["tracked_ips"]), cte_ip_summary(cfg),
                           "ti AS (SELECT count(*) AS tracked_ips FROM ip_summary)")
    # thresholds
    ctes, body = _threshold_sql(cfg)
    out["threshold_scan"] = W(body, *ctes)
    if alt is not None:
        ctes_a, body_a = _threshold_sql(alt)
        out["threshold_scan_alt"] = W(body_a, *ctes_a)
    out["threshold_verdict"] = W(
        f"SELECT coalesce(bool_or(status = 'EXCEEDED'), FALSE) AS any_exceeded FROM ({body})", *ctes)
    out["request_rate"] = W(
        f"""SELECT ip AS label, cnt AS value, CAST({cfg.request} AS BIGINT) AS threshold,
  CAST(cnt * 100 // {cfg.request} AS BIGINT) AS pct,
  CASE WHEN cnt >= {cfg.request} THEN 'EXCEEDED' WHEN cnt * 100 // {cfg.request} >= {cfg.warn_pct} THEN 'WARNING'
       ELSE 'OK' END AS status
FROM (SELECT ip, count(*) AS cnt FROM parsed_apache GROUP BY ip)""", *CTE_APACHE)
    # alerts
    out["stage4_alerts"] = _alerts_query(stage4_sql(cfg))
    out["detailed_alerts"] = _alerts_query(detailed_sql(cfg))
    if alt is not None:
        out["stage4_alerts_alt"] = _alerts_query(stage4_sql(alt))
        out["detailed_alerts_alt"] = _alerts_query(detailed_sql(alt))
    dctes, dbody = detailed_sql(cfg)
    out["alert_severity_counts"] = W(
        f"SELECT severity, channel, count(*) AS cnt FROM ({dbody}) GROUP BY severity, channel", *dctes)
    # windows
    event_ts = f"CASE WHEN log_type = 'apache' THEN {apache_ts()} ELSE {syslog_ts(cfg.syslog_year)} END"
    bucket = """CAST(time_bucket(INTERVAL '30 minutes', ts) AS TIMESTAMP) AS window_start,
  CAST(time_bucket(INTERVAL '30 minutes', ts) + INTERVAL '30 minutes' AS TIMESTAMP) AS window_end"""
    out["failed_login_windows"] = W(
        f"""SELECT {bucket}, ip, count(*) AS cnt
FROM (SELECT {event_ts} AS ts, unnest({ips_of()}) AS ip FROM log_lines WHERE {F1}) GROUP BY ALL""")
    error_windows = W(f"SELECT {bucket}, count(*) AS errors FROM (SELECT {event_ts} AS ts FROM log_lines WHERE {F3}) GROUP BY ALL")
    out["window_alerts"] = _window_alert_sql(out["failed_login_windows"], error_windows, cfg)
    out.update(_alert_rule_sql(cfg))
    if alt is not None:
        out["window_alerts_alt"] = _window_alert_sql(out["failed_login_windows"], error_windows, alt)
    out["untimed_failed_logins"] = W(
        f"SELECT line_id, line FROM log_lines WHERE {F1} AND CASE WHEN log_type = 'apache' THEN {apache_ts()} "
        f"ELSE {syslog_ts(cfg.syslog_year)} END IS NULL")
    out["status_check"] = W(f"""SELECT path AS label, v AS value, CAST(450 AS BIGINT) AS threshold,
  CASE WHEN v >= 0 THEN CAST(v * 100 // 450 AS BIGINT) END AS pct,
  CASE WHEN v IS NULL OR v < 0 THEN 'INVALID' WHEN v >= 450 THEN 'EXCEEDED'
       WHEN v * 100 // 450 >= {cfg.warn_pct} THEN 'WARNING' ELSE 'OK' END AS status
FROM (SELECT f[7] AS path, TRY_CAST(f[9] AS BIGINT) AS v FROM (SELECT {FIELDS} AS f FROM log_lines WHERE log_type = 'apache'))""")
    out.update(_report_sql(out, cfg, generated_at))
    out["diff_ip_counts"] = f"""SELECT coalesce(a.ip, b.ip) AS ip,
  CASE WHEN a.ip IS NULL THEN 'added' WHEN b.ip IS NULL THEN 'removed' ELSE 'changed' END AS change, a.cnt AS before_cnt, b.cnt AS after_cnt
FROM ({out['failed_by_ip']}) a FULL JOIN ({out['requests_per_ip']}) b ON a.ip = b.ip WHERE a.cnt IS DISTINCT FROM b.cnt"""
    out.update(_rule_table_sql(list(user_rules)))
    out.update(_file_sql())
    out.update(_day_sql(event_ts))
    for name in DOCUMENT_QUERIES:
        out[f"doc_{name}"] = over_documents(out[name])
    return out


def _rule_table_sql(user) -> dict[str, str]:
    """The built-in rules and the user's, written out."""
    out = {}
    scan = [(P.SCAN_SSH, P.RX_SSH_BF), (P.SCAN_WEB, P.RX_WEB_PROBE), (P.SCAN_HTTP, P.RX_HTTP_ERR), (P.SCAN_SYS, P.RX_SYS_ERR),
            *((r.name, r.pattern) for r in user if r.kind == "scan")]
    out["rule_scan"] = with_lines(" UNION ALL ".join(
        f"SELECT line, {q(n)} AS anomaly_type FROM log_lines WHERE {m(r)}" for n, r in scan))
    out["rule_scan_summary"] = with_lines(
        "SELECT coalesce(anomaly_type, 'TOTAL') AS anomaly_type, count(line) AS cnt FROM t GROUP BY GROUPING SETS ((anomaly_type), ())",
        "t AS (" + " UNION ALL ".join(f"SELECT line, {q(n)} AS anomaly_type FROM log_lines WHERE {m(r)}" for n, r in scan) + ")")
    counts = [(P.ANOMALY_FAILED_SSH, P.LIT_FAILED_PASSWORD), (P.ANOMALY_INVALID, P.LIT_INVALID_USER), (P.ANOMALY_HTTP, P.RX_HTTP_ERR),
              (P.ANOMALY_SYSTEM, P.LIT_ERROR_COLON), (P.ANOMALY_SENSITIVE, P.RX_SENS_STAGE3),
              *((r.name, r.pattern) for r in user if r.kind == "count")]
    each = " UNION ALL ".join(f"SELECT {q(n)} AS metric, count(*) AS cnt FROM log_lines WHERE {m(r)}" for n, r in counts)
    out["rule_counts"] = with_lines("SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(sum(cnt) AS BIGINT) FROM c", f"c AS ({each})")
    ctes, body = detailed_sql(DEFAULT)
    scope = {"all": "log_lines WHERE TRUE", "failed": f"log_lines WHERE {F1}", "suspicious": "susp WHERE TRUE", "errors": f"log_lines WHERE {F3}"}
    own = ", ".join(f"(SELECT count(*) FROM {scope[r.scope]} AND {m(r.pattern)}) AS {r.name}" for r in user if r.kind == "metric")
    arms, before = [], {}
    for r in (r for r in user if r.kind == "alert"):
        holds = f"{r.metric} {r.op} {r.bound}"
        cond = " AND ".join([holds, *([f"{r.guard} > 0"] if r.guard else []), *(f"NOT ({b})" for b in before.get(r.grp or r.name, []))])
        before.setdefault(r.grp or r.name, []).append(holds)
        action = "CAST(NULL AS VARCHAR)" if r.action is None else tmpl(r.action, n=r.metric)
        arms.append(f"SELECT 'detailed', {q(r.severity)}, {q(r.category)}, CAST(NULL AS VARCHAR), {r.metric}, {r.bound}, "
                    f"{tmpl(r.message, n=r.metric)}, {action}, {_route(q(r.severity))}, TRUE FROM det_c, user_c WHERE {cond}")
    # of the built-in ones, those over totals
    built_in = f"SELECT * FROM ({body}) WHERE ip IS NULL"
    out["rule_alerts"] = _alerts_query(([*ctes, f"user_c AS (SELECT {own})"], "\nUNION ALL\n".join([built_in, *arms])))
    return out


def _file_sql() -> dict[str, str]:
    shape = _log_type().split("WHEN source_file = 'apache.log' THEN 'apache'")[1]
    types = f"""shapes AS (SELECT source_file, CASE {shape} AS shape FROM log_lines),
votes AS (SELECT source_file, count(*) AS n_lines, count(*) FILTER (WHERE shape = 'apache') AS a, count(*) FILTER (WHERE shape = 'auth') AS u,
  count(*) FILTER (WHERE shape = 'syslog') AS s FROM shapes GROUP BY source_file),
types AS (SELECT source_file, n_lines, CASE WHEN source_file = 'auth.log' THEN 'auth' WHEN source_file = 'syslog' THEN 'syslog'
    WHEN source_file = 'apache.log' THEN 'apache' WHEN a > 0 AND a >= u AND a >= s THEN 'apache' WHEN u > 0 AND u >= s THEN 'auth'
    WHEN s > 0 THEN 'syslog' ELSE 'unknown' END AS log_type,
  (a > 0)::INT + (u > 0)::INT + (s > 0)::INT > 1 AS mixed FROM votes)"""
    out = {"classify_files": with_lines("SELECT source_file, log_type, mixed, n_lines FROM types", types),
           "file_type_lines": with_lines(
               "SELECT l.line_id, l.source_file, t.log_type FROM log_lines l JOIN types t ON l.source_file IS NOT DISTINCT FROM t.source_file", types)}
    start = f"TIMESTAMP '{D.LONG_START}'"
    stretched = LOG_LINES.replace("FROM events),", f"FROM (SELECT * REPLACE ({start} + (ts - {start}) * {D.STRETCH} AS ts) FROM events)),")
    any_year = syslog_ts(2024)
    out["event_time_inferred"] = f"""WITH {stretched},
p AS (SELECT *, CASE WHEN log_type <> 'apache' THEN {any_year} END AS st FROM log_lines WHERE NOT contains(line, {q(D.FIXED_DATE_MARK)})),
g AS (SELECT *, month(st) AS mo, last_value(month(st) IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY line_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM p),
s AS (SELECT *, sum(CASE WHEN mo - pm <= -6 THEN 1 WHEN mo - pm >= 6 THEN -1 ELSE 0 END) OVER (PARTITION BY source_file ORDER BY line_id) AS turns FROM g),
f AS (SELECT source_file, arg_max(turns, line_id) AS last_turns, max_by(st, line_id) FILTER (WHERE st IS NOT NULL) AS last_st FROM s GROUP BY source_file),
e AS (SELECT {start} + (max(ts) - {start}) * {D.STRETCH} AS fin FROM events),
y AS (SELECT s.*, year(fin) - CASE WHEN strftime(last_st, '%m%d%H%M%S') > strftime(fin, '%m%d%H%M%S') THEN 1 ELSE 0 END - last_turns + turns AS yr
  FROM s JOIN f USING (source_file) CROSS JOIN e)
SELECT line_id, CASE WHEN log_type = 'apache' THEN {apache_ts()} ELSE
  try_strptime(CAST(yr AS INTEGER) || ' ' || regexp_replace(substr(line, 1, 15), '  +', ' ', 'g'), '%Y %b %d %H:%M:%S') END AS event_ts FROM y"""
    return out


def _day_sql(event_ts: str) -> dict[str, str]:
    days = f"t AS (SELECT CAST(ts AS DATE) AS day, ip FROM (SELECT {event_ts} AS ts, unnest({ips_of()}) AS ip FROM log_lines))"
    between = "day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
    return {
        "unique_ips_by_day": with_lines("SELECT CAST(day AS VARCHAR) AS day, count(*) AS tokens, count(DISTINCT ip) AS unique_ips FROM t GROUP BY day", days),
        "unique_ips_merged": with_lines(f"SELECT count(DISTINCT ip) AS unique_ips, TRUE AS within FROM t WHERE {between}", days),
        "top_ips_merged": with_lines(f"SELECT ip, count(*) AS cnt FROM t WHERE {between} GROUP BY ip ORDER BY cnt DESC, ip DESC LIMIT 11", days),
    }


#: questions that are also asked of the documents' lines
DOCUMENT_QUERIES = ("classify_source", "classify_files", "failed_by_ip", "requests_per_ip", "error_code_breakdown", "event_time", "extract_ips", "strip_comments", "dedup_lines", "normal_anomaly_split",
                    "suspicious_lines", "anomaly_summary", "usage_stats", "ip_summary", "detailed_alerts", "threshold_scan",
                    "final_report")
