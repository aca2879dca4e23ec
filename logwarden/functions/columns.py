"""Column-expression building blocks.

Everything here returns a ``Column`` built from native Spark functions, so
it stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from . import patterns as P


def C(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_META = set("[](){}*+?^$|\\")


def literal_alternatives(pattern: str) -> tuple[bool, list[str]] | None:
    """``(ignore_case, [literal, ...])`` when ``pattern`` is an alternation of
    plain strings (``\\.`` and ``\\/`` escapes allowed); None otherwise."""
    icase = pattern.startswith("(?i)")
    body = pattern[4:] if icase else pattern
    alts = []
    for alt in body.split("|"):
        lit = re.sub(r"\\([./\- ])", r"\1", alt)
        if any(ch in _META for ch in lit):
            return None
        alts.append(lit)
    return icase, alts


FOLDED = "_lc"


def with_folded(df, c="line"):
    """Add ``_lc``, the line with A-Z folded to a-z, computed once per row.

    The one-element ``explode`` makes it a real column: predicates above it
    read the folded text instead of being rewritten to fold the line again
    for every case-blind literal they test.
    """
    c = C(c)
    # an all-ASCII line (as many bytes as characters) takes the fast fold, which means the same there
    fold = F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))
    return df.select("*", F.explode(F.array(fold)).alias(FOLDED))


def fenced(df, *cols):
    """Project ``cols`` behind a one-row ``inline``, so a filter on them is not
    pushed below and re-evaluated from the expressions that define them."""
    return df.select(F.inline(F.array(F.struct(*cols))))


def matches(pattern: str, c="line", folded: str | None = None) -> Column:
    """Unanchored regex find (``grep -E``; ``(?i)`` for ``grep -i``).

    Most rules are alternations of fixed strings; those are evaluated as
    ``contains`` tests (a vectorised substring search) instead of a
    backtracking regex that tries every alternative at every offset.
    ``(?i)`` in Java regex folds ASCII letters only, so the case-blind form
    folds with ``translate`` over A-Z rather than a Unicode ``lower``.
    Anything else stays ``rlike``.  ``folded`` names a column that already
    holds the folded line (see ``with_folded``).
    """
    lit = literal_alternatives(pattern)
    if lit is None:
        return C(c).rlike(pattern)
    icase, alts = lit
    if icase:
        alts = [a.translate(str.maketrans(_UPPER, _LOWER)) for a in alts]
    if isinstance(c, str):
        # one SQL expression (a single JVM call) instead of a Column call per alternative
        if icase:
            subject = f"`{folded}`" if folded else f"translate(`{c}`, '{_UPPER}', '{_LOWER}')"
        else:
            subject = f"`{c}`"
        return F.expr(" OR ".join(f"contains({subject}, {sql_str(a)})" for a in alts))
    if icase:
        subject = F.col(folded) if folded else F.translate(c, _UPPER, _LOWER)
    else:
        subject = c
    out = None
    for a in alts:
        t = subject.contains(a)
        out = t if out is None else out | t
    return out


def quoted(name: str) -> str:
    """A column name as it is, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def sql_str(s: str) -> str:
    """A Spark SQL string literal (backslash escapes, as the default parser reads them)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def has(text: str, c="line") -> Column:
    """Fixed-substring test (``grep -c 'text'`` without metacharacters)."""
    return C(c).contains(text)


def ip_tokens(c="line") -> Column:
    """Every IP-like token of a line, left to right (``grep -oE``).

    The group index must be 0: the default 1 would return the last
    ``octet.`` group instead of the whole token.
    """
    return F.regexp_extract_all(C(c), F.lit(P.RX_IP), F.lit(0))


def awk_fields(c="line") -> Column:
    """Fields split on runs of blanks, leading/trailing blanks ignored (AWK NF)."""
    stripped = F.btrim(C(c), F.lit(" \t"))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, r"[ \t]+"))


def field(fields: Column, i: int) -> Column:
    """1-based AWK field ``$i``; null when the line is shorter."""
    return F.get(fields, i - 1)


def field_after(fields: Column, word: str) -> Column:
    """The field after the last field equal to ``word`` that has a successor
    (AWK loop over fields, as array lookups)."""
    n = F.size(fields)
    head = F.slice(fields, 1, F.greatest(n - 1, F.lit(0)))
    r = F.array_position(F.reverse(head), F.lit(word))
    return F.when(r > 0, F.element_at(fields, (n - r + 1).cast("int")))


def risk_tier(n, cfg: Thresholds = DEFAULT) -> Column:
    crit, high, med = cfg.tiers
    n = C(n)
    return (F.when(n >= crit, "CRITICAL").when(n >= high, "HIGH")
            .when(n >= med, "MEDIUM").otherwise("LOW"))


def int_percent(value: Column, bound: Column) -> Column:
    """Whole percent of ``value`` against ``bound``, rounded down, as bigint.

    Exact decimals throughout: any two bigints work, and a percentage beyond
    bigint is null instead of an error.
    """
    hundredfold = value.cast("decimal(19,0)") * F.lit(100).cast("decimal(3,0)")
    exact = (hundredfold - hundredfold % bound.cast("decimal(19,0)")) / bound.cast("decimal(19,0)")
    return exact.try_cast("bigint")


def threshold_status(value, threshold, cfg: Thresholds = DEFAULT) -> tuple[Column, Column]:
    """(percent, status) of one metric against its bound.

    EXCEEDED when value >= threshold, WARNING when percent >= warn_pct, else
    OK; INVALID when either side is missing or negative, or the bound is 0.
    """
    v = C(value).cast("bigint")
    t = C(threshold).cast("bigint")
    ok = v.isNotNull() & t.isNotNull() & (v >= 0) & (t > 0)
    pct = F.when(ok, int_percent(v, t))
    status = (F.when(~ok, "INVALID").when(v >= t, "EXCEEDED")
              .when(pct >= cfg.warn_pct, "WARNING").otherwise("OK"))
    return pct, status


def template(text: str, **cols) -> Column:
    """Fill a ``{name}`` template with column values (no Python per row)."""
    parts = re.split(r"\{(\w+)\}", text)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append(F.lit(p))
        else:
            out.append(C(cols[p]).cast("string"))
    return F.concat(*out) if out else F.lit("")


def _utc_wall_clock(ts: Column) -> Column:
    """The UTC wall-clock time of an instant, whatever the session's zone."""
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(ts)


def syslog_time(year: int | Column, c="line") -> Column:
    """Event time of a syslog-framed line (``MMM dd HH:mm:ss`` + year), in UTC.

    Real syslog pads one-digit days with a space; both paddings parse.
    """
    stamp = F.regexp_replace(F.substring(C(c), 1, 15), "  +", " ")
    year = F.concat(year.cast("string"), F.lit(" ")) if isinstance(year, Column) else F.lit(f"{year} ")
    return _utc_wall_clock(F.try_to_timestamp(F.concat(year, stamp, F.lit(" +0000")),
                                              F.lit(P.SYSLOG_TIME_FORMAT + " Z")))


def apache_time(c="line") -> Column:
    """Event time of an Apache combined-log line (``[dd/MMM/yyyy:HH:mm:ss Z]``), in UTC."""
    raw = F.regexp_extract(C(c), r"\[([^\]]+)\]", 1)
    return _utc_wall_clock(F.try_to_timestamp(F.when(raw != "", raw), F.lit(P.APACHE_TIME_FORMAT)))
