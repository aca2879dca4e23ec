"""Property tests: the fast column forms agree with the plain regex on random lines."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logwarden.functions import columns as X
from logwarden.functions import patterns as P

RULES = [P.RX_FAILED, P.RX_SUSP_PATH, P.RX_HTTP_ERR, P.RX_SRV_ERR, P.RX_SENS_STAGE3, P.RX_SENS_APACHE,
         P.RX_WEB_PROBE, P.RX_SSH_BF, P.RX_SYS_ERR, P.RX_SUCCESS_LOOSE, P.RX_SUCCESS_STRICT,
         P.RX_HTTP_4XX, P.RX_HTTP_5XX, P.RX_NORMAL, P.RX_ANOMALY]

# fragments of the rules, in mixed case, plus filler, so random lines hit and miss them
FRAGMENTS = ["Failed password", "failed PASSWORD", "Authentication Failure", "FAILED LOGIN", ".env", ".ENV",
             "wp-admin", "WP-Admin", "/admin", "/Admin", "/passwd", "/config", "Invalid user", "INVALID USER",
             "SENSITIVE PATH", "web probe", "ERROR:", "error", "Error", "Out of memory", "Segmentation fault",
             "Disk I/O", "disk i/o error", "Connection refused", "SYSTEM ERROR", '" 404 ', '" 500 ', '" 200 ',
             '" 201 ', '" 4x4 ', "Accepted", "Accepted password", "200", "201", "Started", "backup", "/backup",
             "403", "x", " ", "from", "for", "port", "10.0.0.1", "\t", "é", "İ", "K"]

lines_st = st.lists(st.lists(st.sampled_from(FRAGMENTS), min_size=0, max_size=8).map("".join),
                    min_size=50, max_size=200)


@settings(max_examples=4, deadline=None)
@given(lines_st)
def test_matches_equals_rlike(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    cols = []
    for i, rx in enumerate(RULES):
        cols.append((X.matches(rx) != F.col("line").rlike(rx)).alias(f"d{i}"))
    folded = X.with_folded(df)
    for i, rx in enumerate(RULES):
        cols.append((X.matches(rx, folded=X.FOLDED) != F.col("line").rlike(rx)).alias(f"e{i}"))
    bad = folded.select(*cols).where(" OR ".join(c for c in [f"d{i}" for i in range(len(RULES))]
                                                  + [f"e{i}" for i in range(len(RULES))]))
    assert bad.count() == 0


def _token_after(word):
    """The field after the last ``word`` that has one, as a regex over the line."""
    v = F.regexp_extract("line", r"^(?:.*[ \t])?" + word + r"[ \t]+([^ \t]+)", 1)
    return F.when(v != "", v)


words = st.lists(st.sampled_from(["from", "for", "port", "a", "1.2.3.4", "user", "invalid", "ssh2"]),
                 min_size=0, max_size=10)
seps = st.sampled_from([" ", "  ", "\t", " \t "])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(words, seps, st.booleans()), min_size=30, max_size=80))
def test_field_after_equals_token_after(spark, rows):
    data = [((" " if lead else "") + sep.join(ws),) for ws, sep, lead in rows]
    df = spark.createDataFrame(data, "line string").select("line", X.awk_fields("line").alias("f"))
    checks = []
    for w in ("from", "for", "port"):
        a, b = X.field_after(F.col("f"), w), _token_after(w)
        checks.append(~a.eqNullSafe(b))
    bad = df.where(checks[0] | checks[1] | checks[2])
    assert bad.count() == 0, bad.limit(3).collect()
