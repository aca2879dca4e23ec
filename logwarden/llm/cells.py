"""Rows by the block: keyed data dealt over cells, and whole cells computed in numpy.

A cell is a share of the keys, chosen by a hash of the key.  What one cell
sends another is one row of packed arrays, a message, however many entries
it holds: they are moved by a shuffle that puts each cell in a partition of
its own, and no entry becomes a row.  The number of cells grows with the
keys (``cell_count``), so a cell has a bounded share of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: ``n`` and the six arrays mean what the ``tag`` says
MESSAGE = "cell int, tag int, n long, a binary, b binary, c binary, d binary, e binary, f binary"
_ARROW = pa.schema([("cell", pa.int32()), ("tag", pa.int32()), ("n", pa.int64()), *[(x, pa.binary()) for x in "abcdef"]])
#: bytes of messages that leave a worker at a time
OUT_BYTES = 4 << 20
#: so few keys need no cell of their own; cells that small inputs are dealt over
LEAST_KEYS, SMALL_CELLS = 128, 24


def cell_count(keys: int, size: int, spark) -> int:
    """Cells of at most some ``size`` keys, and several of them for few keys too."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-keys // size), min(parts, SMALL_CELLS, keys // LEAST_KEYS))


def mix(x: np.ndarray) -> np.ndarray:
    """64 hashed bits of each 64-bit number."""
    x = np.asarray(x).astype(np.int64, copy=False).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cell_of(keys: np.ndarray, cells: int) -> np.ndarray:
    at = mix(keys) % np.uint64(cells)
    return at.astype(np.uint16 if cells <= 1 << 16 else np.int64)  # numpy sorts 16 bits by radix


def message(cell, tag, *arrays, n=0) -> tuple:
    return (int(cell), tag, int(n), *[None if x is None else np.ascontiguousarray(x).tobytes() for x in arrays], *[None] * (6 - len(arrays)))


def deal(at: np.ndarray, cells: int, *arrays: np.ndarray):
    """``(cell, arrays)``: the entries of each cell that has any, in their order."""
    order = np.argsort(at, kind="stable")
    bounds = np.searchsorted(at[order], np.arange(cells + 1))
    arrays = [x[order] for x in arrays]
    for c in np.flatnonzero(np.diff(bounds)):
        yield c, [x[bounds[c]:bounds[c + 1]] for x in arrays]


def small(places: np.ndarray) -> np.ndarray:
    """Numbers from 0 in as few bytes as their largest needs: numpy sorts two bytes by radix."""
    most = int(places.max(initial=0))
    return places.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.int64)


def pair_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The order by ``a``, then ``b``; ``a`` as ``small`` makes it."""
    bits = 63 - 8 * a.itemsize
    if len(b) and a.itemsize < 8 and b.min() >= 0 and b.max() < 1 << bits:  # both in one number, which is sorted sooner
        return np.argsort((a.astype(np.int64) << bits) | b)
    return np.lexsort((b, a))


def firsts(keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins, as a mask."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return new


def distinct(keys: np.ndarray) -> np.ndarray:
    """The keys in order, each once (``np.unique`` hashes first, which is slower)."""
    keys = np.sort(keys)
    return keys[firsts(keys)]


def ranks(keys: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal keys."""
    at = np.arange(len(keys))
    start = np.flatnonzero(firsts(keys))
    return at - np.repeat(start, np.diff(np.append(start, len(keys))))


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``starts[i]``, ... of ``counts[i]`` entries each, one after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def joined(arrays: list, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in arrays]) if arrays else np.zeros(0, kind)


def sent(messages):
    """Messages as Arrow batches."""
    rows, held = [], 0
    for m in messages:
        rows.append(m)
        held += 64 + sum(len(x) for x in m[3:] if x is not None)
        if held >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def received(batch: pa.RecordBatch):
    """``(cell, tag, n, a..f)`` of each message; the arrays as buffers, not copied."""
    heads = [batch.column(i).to_pylist() for i in range(3)]
    arrays = [batch.column(i) for i in range(3, 9)]
    for i, head in enumerate(zip(*heads)):
        yield *head, *[x[i].as_buffer() for x in arrays]


def in_cells(messages: DataFrame, cells: int, run) -> DataFrame:
    """``run(cell, {tag: [(n, a..f)]})`` -> messages, for each cell, where it has all that was sent to it."""

    def whole(batches):
        held: dict = {}
        for b in batches:
            for cell, tag, *rest in received(b):
                held.setdefault(cell, {}).setdefault(tag, []).append(rest)
        for cell in sorted(held):
            yield from sent(run(cell, held.pop(cell)))

    return messages.repartitionById(cells, "cell").mapInArrow(whole, MESSAGE)


def binary_bytes(column: pa.Array) -> memoryview:
    """All values of a binary column, one after the other."""
    if not len(column):
        return memoryview(b"")
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return memoryview(column.buffers()[2])[at[0]:at[-1]]
