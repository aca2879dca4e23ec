"""Tables that streaming jobs write batch by batch, with versioned snapshots.

A table is a folder of batch folders, ``query=<id>/.../batch_id=<n>``, which a
job only ever adds to or, when it replays a batch, writes again.  ``compact``
folds them:

1. the folded rows are written to a new folder ``_snapshots/<name>``;
2. a pointer, ``_snapshots/<version>.json``, is written under another name
   and renamed into place: it names the folder and, for each job, the last
   batch that the snapshot holds (its mark);
3. what no reader of this or the version before needs is deleted.

The highest pointer is the table: its snapshot, and the batches above the
marks.  A crash before the rename leaves the old version, one after it the
new version; folders that are left over are read by nobody.  A batch at or
below a mark that is replayed writes its folder again, to no effect, so it is
not counted twice.  A job's newest batch may still be replayed or written,
so it is folded by a later call only.  One ``compact`` runs at a time for a table.

The folder must be on a file system with an atomic rename (HDFS, or a local
or mounted one).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

SNAPSHOTS = "_snapshots"


@dataclass(frozen=True)
class Batch:
    """A batch folder: the values in its path, and the path."""

    path: str
    values: dict = field(hash=False, compare=False)

    @property
    def query(self) -> str:
        return self.values["query"]

    @property
    def number(self) -> int:
        return int(self.values["batch_id"])


@dataclass(frozen=True)
class Version:
    """What the highest pointer says; version 0 is a table without snapshots."""

    number: int = 0
    folder: str | None = None
    marks: dict = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def batches(spark: SparkSession, table: str, levels: tuple[str, ...] = ("query", "batch_id")) -> list[Batch]:
    """The batch folders of a table, in order of job and number."""
    out = []
    for path in _glob(spark, "/".join([table.rstrip("/"), *(f"{k}=*" for k in levels)])):
        out.append(Batch(path, dict(x.split("=", 1) for x in path.rsplit("/", len(levels))[1:])))
    return sorted(out, key=lambda b: (b.query, b.number))


def versions(spark: SparkSession, table: str) -> list[Version]:
    """The pointers of a table, the newest last."""
    out = []
    for path in _glob(spark, f"{table.rstrip('/')}/{SNAPSHOTS}/*.json"):
        said = json.loads(spark.read.text(path, wholetext=True).first()[0])
        out.append(Version(said["version"], said["folder"], said["marks"]))
    return sorted(out, key=lambda v: v.number)


def current(spark: SparkSession, table: str) -> Version:
    return max(versions(spark, table), key=lambda v: v.number, default=Version())


def _above(batch: Batch, version: Version) -> bool:
    return batch.number > version.marks.get(batch.query, -1)


def paths(spark: SparkSession, table: str, levels=("query", "batch_id"), keep: Callable[[Batch], bool] | None = None) -> list[str]:
    """The folders that make up the table now; ``keep`` chooses among the batches above the marks."""
    v = current(spark, table)
    snapshot = [f"{table.rstrip('/')}/{SNAPSHOTS}/{v.folder}"] if v.folder else []
    return snapshot + [b.path for b in batches(spark, table, levels) if _above(b, v) and (keep is None or keep(b))]


def read(spark: SparkSession, folders: list[str], schema: str) -> DataFrame:
    """The rows of some folders; empty without any."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def publish(spark: SparkSession, table: str, version: Version) -> None:
    """Make a version the current one, or fail if another has its number."""
    top = f"{table.rstrip('/')}/{SNAPSHOTS}"
    fs, final = _fs(spark, f"{top}/{version.number:08d}.json")
    _, draft = _fs(spark, f"{top}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"version": version.number, "folder": version.folder, "marks": version.marks}).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"{table}: version {version.number} was written by another job")


def expire(spark: SparkSession, table: str, levels=("query", "batch_id")) -> None:
    """Delete what neither the current version nor the one before needs."""
    known = versions(spark, table)
    if not known:
        return
    before = known[-2] if len(known) > 1 else Version()
    for b in batches(spark, table, levels):
        if not _above(b, before):
            delete(spark, b.path)
    kept = {v.folder for v in (before, known[-1])}
    top = f"{table.rstrip('/')}/{SNAPSHOTS}"
    for v in known[:-2]:
        delete(spark, f"{top}/{v.number:08d}.json")
    for path in _glob(spark, f"{top}/rows-*"):
        if path.rsplit("/", 1)[1] not in kept:
            delete(spark, path)


def compact(spark: SparkSession, table: str, schema: str, fold: Callable[[DataFrame], DataFrame],
            levels=("query", "batch_id")) -> Version:
    """Fold all batches but each job's newest into a new snapshot; returns the current version."""
    old, all_ = current(spark, table), batches(spark, table, levels)
    newest = {b.query: b.number for b in all_}
    own = [b for b in all_ if _above(b, old) and b.number < newest[b.query]]
    if not own:
        expire(spark, table, levels)
        return old
    top = f"{table.rstrip('/')}/{SNAPSHOTS}"
    folder = f"rows-{uuid.uuid4().hex}"
    held = [f"{top}/{old.folder}"] if old.folder else []
    fold(read(spark, held + [b.path for b in own], schema)).write.parquet(f"{top}/{folder}")
    new = Version(old.number + 1, folder, old.marks | {b.query: b.number for b in own})
    publish(spark, table, new)
    expire(spark, table, levels)
    return new
