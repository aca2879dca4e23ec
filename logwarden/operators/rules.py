"""Rule tables: patterns, categories, severities and bounds as data.

A rule table is a DataFrame (or file) of ``RULE_SCHEMA`` rows of four kinds:

* ``scan``: a line that matches ``pattern`` gets the label ``name`` (G1, G2);
* ``count``: lines that match ``pattern`` are counted as ``name`` (A13);
* ``metric``: ``name`` counts the lines of a ``scope`` that match ``pattern``:
  of ``all`` lines, of ``failed`` logins (F1), of distinct ``suspicious`` lines
  (F2) or of server ``errors`` (F3);
* ``alert``: fires where ``metric`` is beyond ``bound`` (``op`` is > or >=), if
  the metric ``guard`` is not 0; of the rules of one ``grp`` the first in
  order of ``ord`` that holds fires (tiers).

The built-in rules are such rows (``builtin_rows``): the operators run the
same code for them and for a user's.  A table is compiled, when a query is
planned, into one expression over one scan: no join with the rules, and no
pass per rule.  So a table is bounded (``MAX_RULES`` rows, checked).  Patterns
are unanchored regexes, ``(?i)`` for either case; alternations of plain
strings are evaluated as substring tests.

A row that lacks what its kind needs, an unknown kind, scope or metric, a bad
regex, or a name given twice is an error that names the row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import config as K
from ..config import DEFAULT, Thresholds
from ..functions import patterns as P

MAX_RULES = 1000
RULE_SCHEMA = ("kind string, name string, ord int, pattern string, scope string, category string, severity string, "
               "metric string, guard string, grp string, op string, bound bigint, message string, action string")
SCOPES = ("all", "failed", "suspicious", "errors")
#: metrics that need no row: what the incident table counts anyway
KNOWN_METRICS = ("failed_lines", "invalid_users", "susp_lines", "http_errors", "err4xx", "err5xx", "env_hits", "admin_hits",
                 "wp_hits", "total_errors", "oom", "segfault", "disk")
NEEDED = {"scan": ("pattern",), "count": ("pattern",), "metric": ("pattern", "scope"),
          "alert": ("category", "severity", "metric", "op", "message")}


@dataclass(frozen=True)
class Rule:
    kind: str
    name: str
    ord: int = 0
    pattern: str | None = None
    scope: str | None = None
    category: str | None = None
    severity: str | None = None
    metric: str | None = None
    guard: str | None = None
    grp: str | None = None
    op: str | None = None
    bound: int = 0
    message: str | None = None
    action: str | None = None


# --- fixed values: the built-in rules ---
SCANS = ((P.SCAN_SSH, P.RX_SSH_BF), (P.SCAN_WEB, P.RX_WEB_PROBE), (P.SCAN_HTTP, P.RX_HTTP_ERR), (P.SCAN_SYS, P.RX_SYS_ERR))
COUNTS = ((P.ANOMALY_FAILED_SSH, P.LIT_FAILED_PASSWORD), (P.ANOMALY_INVALID, P.LIT_INVALID_USER), (P.ANOMALY_HTTP, P.RX_HTTP_ERR),
          (P.ANOMALY_SYSTEM, P.LIT_ERROR_COLON), (P.ANOMALY_SENSITIVE, P.RX_SENS_STAGE3))


def _alerts(cfg: Thresholds) -> tuple:
    """(name, grp, guard, metric, op, bound, severity, category, text) of L6-L15."""
    return (
        # L6 (count over all lines: the original searched F1, which never holds such lines)
        ("invalid_users", "invalid_users", "failed_lines", "invalid_users", ">", cfg.invalid_users, "HIGH", "SSH", K.SSH_INVALID),
        # L7
        ("web_5xx_critical", "web_5xx", "susp_lines", "err5xx", ">=", cfg.web_5xx[0], "CRITICAL", "WEB", K.WEB_5XX_CRIT),
        ("web_5xx_high", "web_5xx", "susp_lines", "err5xx", ">=", cfg.web_5xx[1], "HIGH", "WEB", K.WEB_5XX_HIGH),
        # L8
        ("web_4xx_high", "web_4xx", "susp_lines", "err4xx", ">=", cfg.web_4xx[0], "HIGH", "WEB", K.WEB_4XX_HIGH),
        ("web_4xx_medium", "web_4xx", "susp_lines", "err4xx", ">=", cfg.web_4xx[1], "MEDIUM", "WEB", K.WEB_4XX_MED),
        # L9-L11
        ("env_probe", "env_probe", "susp_lines", "env_hits", ">", 0, "CRITICAL", "WEB", K.WEB_ENV),
        ("admin_probe", "admin_probe", "susp_lines", "admin_hits", ">", cfg.admin_probe, "HIGH", "WEB", K.WEB_ADMIN),
        ("wp_probe", "wp_probe", "susp_lines", "wp_hits", ">", 0, "MEDIUM", "WEB", K.WEB_WP),
        # L12
        ("error_storm", "errors", "total_errors", "total_errors", ">=", cfg.error_storm, "CRITICAL", "SYSTEM", K.SYS_STORM),
        ("error_count", "errors", "total_errors", "total_errors", ">=", cfg.error, "HIGH", "SYSTEM", K.SYS_HIGH),
        # L13-L15
        ("out_of_memory", "out_of_memory", "total_errors", "oom", ">", 0, "CRITICAL", "SYSTEM", K.SYS_OOM),
        ("segfault", "segfault", "total_errors", "segfault", ">", 0, "CRITICAL", "SYSTEM", K.SYS_SEGFAULT),
        ("disk_io", "disk_io", "total_errors", "disk", ">", 0, "HIGH", "SYSTEM", K.SYS_DISK),
    )
# --- end of fixed values ---


def builtin_rules(cfg: Thresholds = DEFAULT) -> list[Rule]:
    out = [Rule("scan", n, k, pattern=p) for k, (n, p) in enumerate(SCANS)]
    out += [Rule("count", n, k, pattern=p) for k, (n, p) in enumerate(COUNTS)]
    return out + [
        Rule("alert", name, k, category=category, severity=severity, metric=metric, guard=guard, grp=grp, op=op, bound=bound,
             message=text[0], action=text[1])
        for k, (name, grp, guard, metric, op, bound, severity, category, text) in enumerate(_alerts(cfg))]


FIELDS = tuple(Rule.__dataclass_fields__)


def rule_table(spark: SparkSession, rules: list[Rule] | None = None, cfg: Thresholds = DEFAULT) -> DataFrame:
    """Rules (the built-in ones by default) as a table that can be edited, stored and read again."""
    rules = builtin_rules(cfg) if rules is None else rules
    return spark.createDataFrame([tuple(getattr(r, f) for f in FIELDS) for r in rules], RULE_SCHEMA)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A rule table from a file of JSON lines, CSV (with a header) or Parquet, told by its name; missing columns are null."""
    if path.endswith(".csv"):
        df = spark.read.option("header", "true").option("escape", '"').csv(path)
    else:
        df = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.schema(RULE_SCHEMA).json(path)
    unknown = set(df.columns) - set(FIELDS)
    if unknown:
        raise ValueError(f"{path}: no such rule columns: {', '.join(sorted(unknown))}")
    return df


def load_rules(table: DataFrame) -> list[Rule]:
    """The rules of a table, checked."""
    kinds = {"ord": int, "bound": int}
    rows = table.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"a rule table has at most {MAX_RULES} rows")
    out = []
    for r in rows:
        values = {f: r[f] for f in FIELDS if f in table.columns and r[f] is not None}
        out.append(Rule(**{f: kinds.get(f, str)(v) for f, v in {"kind": "", "name": "", **values}.items()}))
    check(out)
    return sorted(out, key=lambda r: (r.kind, r.ord, r.name))


def check(rules: list[Rule]) -> None:
    metrics = {*KNOWN_METRICS, *(r.name for r in rules if r.kind == "metric")}
    seen = set()
    for r in rules:
        def bad(why: str, r=r):
            return ValueError(f"rule {r.name or '?'} ({r.kind or 'no kind'}): {why}")

        if r.kind not in NEEDED or not r.name:
            raise bad("needs a name and one of the kinds " + ", ".join(NEEDED))
        lacking = [f for f in NEEDED[r.kind] if getattr(r, f) in (None, "")]
        if lacking:
            raise bad("lacks " + ", ".join(lacking))
        if (r.kind, r.name) in seen:
            raise bad("the name is given twice")
        seen.add((r.kind, r.name))
        if r.kind == "metric" and (r.scope not in SCOPES or r.name in KNOWN_METRICS or not re.fullmatch(r"\w+", r.name)):
            raise bad("a metric needs a new name of letters, digits and _, and a scope of " + ", ".join(SCOPES))
        if r.kind == "alert" and (r.op not in (">", ">=") or not {r.metric, r.guard or r.metric} <= metrics):
            raise bad("unknown metric or guard, or op not > or >=")
        unfilled = set(re.findall(r"\{(\w+)\}", f"{r.message or ''} {r.action or ''}")) - {"n"}
        if unfilled:
            raise bad("a message is filled with {n} only, not " + ", ".join(sorted(unfilled)))
        if r.pattern is not None:
            try:
                re.compile(r.pattern)
            except re.error as e:
                raise bad(f"pattern: {e}") from e


def pairs(rules: list[Rule], kind: str) -> list[tuple[str, str]]:
    """(name, pattern) of the rules of a kind, in order."""
    return [(r.name, r.pattern) for r in sorted(rules, key=lambda r: r.ord) if r.kind == kind]


def metrics(rules: list[Rule]) -> list[Rule]:
    return [r for r in rules if r.kind == "metric"]


def alerts(rules: list[Rule]) -> list[Rule]:
    return sorted((r for r in rules if r.kind == "alert"), key=lambda r: r.ord)
