"""Text-file sources: collection with provenance, classification, health.

S1/S3: one recursive text scan over a directory (or several paths) keeps
the file name of every line as a column instead of writing header lines
into the merged stream.  The scan splits files by ``maxPartitionBytes``, so
a single huge log still spreads across many tasks.

S2: the expected-file check is a left join of a small expected list with the
file listing that Spark already produces for the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.columns import C, sql_str

# content fallbacks for files whose name is not one of the known logs
_RX_APACHE_LINE = r'^\S+ \S+ \S+ \[[^\]]+\] "'
_RX_SYSLOG_FRAME = r"^[A-Z][a-z]{2} [ 0-9][0-9] [0-9]{2}:[0-9]{2}:[0-9]{2} \S+ [^ \[:]+(\[[0-9]+\])?:"
_RX_AUTH_LINE = r"^[A-Z][a-z]{2} [ 0-9][0-9] [0-9]{2}:[0-9]{2}:[0-9]{2} \S+ (sshd|sudo|su|login|passwd)(\[[0-9]+\])?:"


def _shape_sql(line: str) -> str:
    arms = ((_RX_APACHE_LINE, "apache"), (_RX_AUTH_LINE, "auth"), (_RX_SYSLOG_FRAME, "syslog"))
    return " ".join(f"WHEN {line} RLIKE {sql_str(rx)} THEN '{kind}'" for rx, kind in arms) + " ELSE 'unknown' END"


def log_type_sql(source_file: str, line: str) -> str:
    """``log_type_of`` as a SQL expression over two column names."""
    names = [(n, t) for n, t in P.SOURCE_FILES.items() if n not in P.DERIVED_SOURCE_FILES]
    return "CASE " + " ".join(f"WHEN {source_file} = {sql_str(n)} THEN '{t}'" for n, t in names) + " " + _shape_sql(line)


def content_log_type(line: str = "line") -> Column:
    """Log type from the shape of a line: apache, auth, syslog or unknown."""
    return F.expr("CASE " + _shape_sql(line))


#: shapes of lines, in the order that breaks a tie of a file's lines
SHAPES = ("apache", "auth", "syslog")


def _named_type(source_file) -> Column:
    """The log type of a known file name, else null."""
    name = C(source_file)
    out = None
    for fname, ltype in P.SOURCE_FILES.items():
        if fname in P.DERIVED_SOURCE_FILES:
            continue
        out = F.when(name == fname, ltype) if out is None else out.when(name == fname, ltype)
    return out


def log_type_of(source_file: str = "source_file", line: str = "line") -> Column:
    """File name -> log type; content shape when the name is unknown or holds mixed formats."""
    return F.expr(log_type_sql(source_file, line))


def classify_files(lines: DataFrame, file: str = "source_file") -> DataFrame:
    """S4 by file: ``(source_file, log_type, mixed, n_lines)``, one type for each file.

    A known name decides; else the type that most of the file's lines have
    the shape of (ties: apache, then auth, then syslog; unknown without any).
    ``mixed`` says that lines of more than one type stand in the file.  Counts
    are folded before the shuffle, so a file of any size is a few rows of it.
    """
    shape = content_log_type("line")
    t = lines.groupBy(F.col(file).alias("source_file")).agg(
        F.count(F.lit(1)).alias("n_lines"), *[F.count_if(shape == k).alias(f"_{k}") for k in SHAPES])
    most = F.greatest(*[F.col(f"_{k}") for k in SHAPES])
    vote = F.lit("unknown")
    for k in reversed(SHAPES):
        vote = F.when((F.col(f"_{k}") == most) & (most > 0), k).otherwise(vote)
    kinds = sum((F.when(F.col(f"_{k}") > 0, 1).otherwise(0) for k in SHAPES), F.lit(0))
    return t.select("source_file", F.coalesce(_named_type("source_file"), vote).alias("log_type"),
                    (kinds > 1).alias("mixed"), "n_lines")


def with_file_type(lines: DataFrame, file: str = "source_file") -> DataFrame:
    """Lines with the ``log_type`` of their file (``classify_files``) instead of their own shape's."""
    types = classify_files(lines, file).select(F.col("source_file").alias("_file"), F.col("log_type").alias("_type"))
    t = lines.drop("log_type").join(types, F.col(file).eqNullSafe(F.col("_file")), "left")
    return t.withColumn("log_type", F.col("_type")).drop("_file", "_type")


def collect_logs(spark: SparkSession, paths: str | Sequence[str],
                 exclude: Iterable[str] = (), with_place: bool = False) -> DataFrame:
    """S1 + S3 + S4: every regular file under ``paths`` -> ``(line, source_file, log_type)``.

    Every file is collected; ``exclude`` names files to leave out, such as a
    merged copy of the others, which would count every event twice.  Lines are split on ``\\n`` only and a trailing ``\\r``
    is removed, so CRLF files read like LF files.  ``with_place`` adds the
    line's order in its split and the file's last change (see ``operators.years``).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = (spark.read.option("recursiveFileLookup", "true")
           .option("lineSep", "\n").text(paths))
    df = raw.select(
        F.regexp_replace("value", r"\r$", "").alias("line"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("source_block"),
        *([F.monotonically_increasing_id().alias("source_row"), F.col("_metadata.file_modification_time").alias("source_modified")]
          if with_place else []),
    )
    excl = list(exclude or ())
    if excl:
        df = df.where(~F.col("source_file").isin(excl))
    return df.withColumn("log_type", log_type_of("source_file", "line"))


def _glob_escape(name: str) -> str:
    return "".join("\\" + ch if ch in "{}[]*?,\\" else ch for ch in name)


def source_health(spark: SparkSession, path: str,
                  expected: Sequence[str] = tuple(P.SOURCE_FILES)) -> DataFrame:
    """``(source, bytes, status)`` for each expected file name.

    MISSING when no file of that name exists under ``path``; EMPTY when it
    exists with zero bytes; OK otherwise.

    Sizes come from a ``binaryFile`` scan of the expected names projected to
    ``(path, length)``: no file body is read, and one row per expected name
    comes back, however many hosts ship a file of that name.  That scan skips
    empty files, so the names it does not find are listed, all at once.
    """
    want = list(dict.fromkeys(expected))
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "{" + ",".join(_glob_escape(n) for n in want) + "}")
             .load(path).select(F.element_at(F.split("path", "/"), -1).alias("source"), "length")
             .where(F.col("source").isin(want)).groupBy("source").agg(F.sum("length").alias("bytes")))
    sizes = {r["source"]: r["bytes"] for r in found.collect()}  # at most one row per expected name
    empty = _listed(spark, path, [n for n in want if n not in sizes])
    rows = []
    for name in want:
        size = sizes.get(name, 0 if name in empty else None)
        rows.append((name, size, "MISSING" if size is None else "OK" if size else "EMPTY"))
    return spark.createDataFrame(rows, "source string, bytes bigint, status string")


def _listed(spark: SparkSession, path: str, names: Sequence[str]) -> set[str]:
    """Which of the names exist below ``path``, by one listing for all, which Spark spreads over the folders."""
    if not names:
        return set()
    files = (spark.read.option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "{" + ",".join(_glob_escape(n) for n in names) + "}").text(path).inputFiles())
    return {unquote(f.rsplit("/", 1)[1]) for f in files} & set(names)
