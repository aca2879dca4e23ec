"""Approximate nearest neighbours: NN-descent graph, greedy graph search.

Index.  Equal vectors are one class, under their smallest id; the graph is
built over classes, and every row is in a class.  A start graph comes from
``TREES`` random-hyperplane orders cut into blocks of ``BLOCK`` vectors;
vectors of one code, such as near copies, are dealt anew in each.
Each NN-descent round is a chain of shuffles: every node gathers its
neighbours and a sample of the nodes that point at it (``FORWARD`` and
``REVERSE`` of them), with their vectors; all pairs of such a neighbourhood,
neighbours of neighbours, are compared in one small matrix, and pairs that
improve a list are sent to it; entries new to a list are sampled first.
Rounds go on until one changes at most a share ``DELTA`` of all entries.  No
list is longer than ``DEGREE``, no neighbourhood larger than FORWARD +
REVERSE, and hubs are cut to the sampled size before any shuffle.

Cells.  Nodes are dealt over cells by a hash (``cells.py``), some ``CELL`` of
them each, so that their number grows with the nodes.  Cells send one another
packed arrays, and a cell's lists, samples and comparisons are made whole in
numpy: no entry of a list becomes a row.  A vector goes to a cell once,
however many neighbourhoods there hold it.

Search.  A query starts at its own node, if its vector is in the index, and
at ``ENTRIES`` fixed nodes.  It keeps the ``POOL`` best nodes seen.  Each
round asks the cells of the ``WIDTH`` best nodes it has not yet expanded for
their neighbours, and has those that are not in its pool, each once, scored in
their own cells; it ends when its whole pool is expanded, and is left alone
from then on.

Neighbourhoods, adjacency and queries carry the original vectors, as float if
the column holds floats and as double otherwise, and every score on the way is
a double.  Of a pool, what rounding could place among the best is scored once
more in a fixed order of additions, with all members of the classes.

Disk.  Each round writes its result to the shared folder, and its shuffle
files go as soon as it has, as do written tables that nothing reads any more:
what a run holds is one round's exchange of vectors, or the adjacency once,
however many rounds there are.

Cases: rows with a null id, and vectors null, zero, with a null or
non-finite component, or of another length than most, take no part, neither
as query nor as candidate.  Ties go to the smaller id.  Ids that repeat
count once per vector.  Fewer candidates than asked for are all returned; an
empty table gives no rows.
"""

from __future__ import annotations

from contextlib import contextmanager
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .cells import (MESSAGE, binary_bytes, cell_count, cell_of, deal, distinct, firsts, in_cells, joined, message, mix,
                    pair_order, ranks, received, sent, small, spans)
from .common import delete_stored, ordered_positions, read, stored

#: neighbours of a node; start trees, their depth and block size; sampled neighbourhood
DEGREE, TREES, DEPTH, BLOCK = 32, 4, 16, 256
FORWARD, REVERSE = 24, 20
#: the descent ends with a round that changes at most this share of the list entries
DELTA = 0.01
#: nodes a query keeps, expands per round, and starts from
POOL, WIDTH, ENTRIES = 448, 112, 8
SEED = 5
#: nodes of a cell in the descent and in the search, queries of a cell
CELL, SEARCH_CELL, QUERY_CELL = 6144, 32768, 1024
#: neighbourhoods compared at a time, edges held before the best are kept
HOODS_AT_ONCE, EDGES_HELD = 64, 1 << 21
#: vectors of a message: larger rows are a burden to the JVM
VECTORS_AT_ONCE = 512
#: bytes handed to a Python worker at a time
BATCH_BYTES = 4 << 20
#: while an index is built and searched; every round ends in a written table, so no later step needs its shuffle files
SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def _settings(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    try:
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def clean_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, vec)`` of the rows that take part, vectors as double."""
    t = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    t = t.where("id IS NOT NULL AND vec IS NOT NULL").where(~bad & F.exists("vec", lambda x: x != 0))
    sizes = t.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return t.where(F.size("vec") == (sizes[0]["n"] if sizes else 0))


def vector_classes(vectors: DataFrame, members: int) -> DataFrame:
    """``(vec, node, ids)``: distinct vectors, their smallest id, and their smallest ids (sorted)."""
    # the rank limit works before the shuffle too, so a vector that many rows share stays small
    at = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    t = vectors.distinct().withColumn("__at", at).where(F.col("__at") <= members)
    return t.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        "vec", F.col("ids")[0].alias("node"), "ids")


def _stack(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def _mean(classes: DataFrame) -> np.ndarray:
    def sums(batches):
        total, n = 0.0, 0
        for b in batches:
            if len(b):
                total, n = total + _stack(b["vec"]).sum(0), n + len(b)
        if n:
            yield pd.DataFrame({"place": np.arange(len(total)), "total": total, "n": n})

    r = classes.select("vec").mapInPandas(sums, "place int, total double, n long").groupBy("place").agg(
        (F.sum("total") / F.sum("n")).alias("m")).orderBy("place").collect()  # one row per dimension
    return np.array([x["m"] for x in r])


NODES = "node long, q binary, codes array<int>"


def _coded(mean: np.ndarray, kind: str = "f8"):
    planes = np.random.default_rng(SEED).standard_normal((TREES, DEPTH, len(mean)))
    powers = 1 << np.arange(DEPTH - 1, -1, -1)

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            v = _stack(b["vec"])
            codes = np.einsum("nd,tkd->ntk", v - mean, planes) > 0
            yield pd.DataFrame({"node": b["node"].to_numpy(), "q": [x.tobytes() for x in v.astype(kind)],
                                "codes": list((codes @ powers).astype(np.int32))})

    return run


def _block_neighbours(dim: int, degree: int, kind: str):
    def run(table: pa.Table) -> pa.Table:
        block = table.combine_chunks().to_batches()[0]
        nodes, at = np.unique(block["node"].to_numpy(), return_index=True)
        k = min(degree, len(nodes) - 1)
        if k < 1:
            return pa.table({x: pa.array([], pa.binary()) for x in ("a", "b", "sim")})
        m = np.frombuffer(binary_bytes(block["q"]), kind).reshape(-1, dim)[at].astype(np.float64)
        s = m @ m.T
        np.fill_diagonal(s, -np.inf)
        best = np.argpartition(-s, k - 1, axis=1)[:, :k]
        edges = np.repeat(nodes, k), nodes[best].ravel(), np.take_along_axis(s, best, 1).ravel()
        return pa.table({x: pa.array([v.tobytes()], pa.binary()) for x, v in zip(("a", "b", "sim"), edges, strict=True)})

    return run


# what a message holds, by its tag: arrays of 64-bit ids, 32-bit counts, doubles, flags of a byte, vectors
GRAPH = 1  # nodes, counts, neighbours, similarities, old flags; n: entries that are not old
VECTORS = 2  # nodes, vectors
EDGES = 3  # a, b, similarities
FORWARD_PAIRS = 4  # at, nodes
REVERSE_PAIRS = 5  # at, nodes, old flags
LEAST = 6  # nodes, the similarity that an entry new to the list must exceed
HOODS = 7  # counts, members
WANTED = 8  # nodes; n: the cell that asks
FOUND = 9  # nodes, vectors, least similarities
ADJACENCY = 10  # nodes, vectors, counts, lists
LISTS = 11  # nodes, counts, lists
SEARCH = 12  # vector, pool ids, pool similarities, expanded, to be expanded; n: the query
ASKED = 13  # queries, nodes
ANSWERED = 14  # queries, counts, ids
CANDIDATES = 15  # queries, counts, ids, vectors, least similarities; n: the cell that asks
SCORED = 16  # queries, counts, ids, similarities


def _packed_nodes(nodes: DataFrame, cells: int) -> DataFrame:
    """``nodes(node, q)`` -> messages ``VECTORS`` to the nodes' cells."""

    def run(batches):
        def messages():
            for b in batches:
                if b.num_rows:
                    q = np.frombuffer(binary_bytes(b["q"]), np.uint8).reshape(b.num_rows, -1)
                    ids = b["node"].to_numpy()
                    for c, (i, v) in deal(cell_of(ids, cells), cells, ids, q):
                        yield message(c, VECTORS, i, v)

        yield from sent(messages())

    return nodes.select("node", "q").mapInArrow(run, MESSAGE)


def _node_vectors(rows: list, kind, dim: int):
    """Ids in ascending order and their vectors, of messages ``VECTORS``."""
    ids = joined([x[1] for x in rows], np.int64)
    vectors = joined([x[2] for x in rows], kind).reshape(-1, dim)
    order = np.argsort(ids, kind="stable")
    return ids[order], vectors[order]


def _best_entries(a, b, sim, degree: int, old=None):
    """The ``degree`` best distinct ``b`` of each place ``a``, best first; an entry is old if any of its kind is."""
    if not len(a):
        return a, b, sim, old
    a = small(a)
    order = pair_order(a, b)
    a, b, sim = a[order], b[order], sim[order]
    new = np.flatnonzero(firsts(a) | firsts(b))
    sim = np.maximum.reduceat(sim, new)
    if old is not None:
        old = np.maximum.reduceat(old[order], new)
    a, b = a[new], b[new]
    order = np.lexsort((-sim, a))  # of equal ones the smaller b stays first
    order = order[ranks(a[order]) < degree]
    return a[order], b[order], sim[order], None if old is None else old[order]


def _start_edges(degree: int, cells: int):
    def run(batches):
        def messages():
            held, n = [], 0
            for b in batches:
                for r in zip(b["a"], b["b"], b["sim"], strict=True):
                    held.append([x.as_buffer() for x in r])
                    n += len(held[-1][0]) // 8
                    if n >= EDGES_HELD:
                        yield from flushed(held)
                        held, n = [], 0
            if held:
                yield from flushed(held)

        def flushed(held):
            a, b, sim = (joined([x[i] for x in held], t) for i, t in enumerate((np.int64, np.int64, np.float64)))
            nodes, a = np.unique(a, return_inverse=True)
            a, b, sim, _ = _best_entries(a, b, sim, degree)
            a = nodes[a]
            for c, part in deal(cell_of(a, cells), cells, a, b, sim):
                yield message(c, EDGES, *part)

        yield from sent(messages())

    return run


def _lists(degree: int):
    """Lists (or nodes without any) and edges of a cell -> its new lists."""

    def run(cell, rows):
        kinds = np.int64, np.int32, np.int64, np.float64, np.uint8
        nodes, counts, b, sim, old = (joined([x[i + 1] for x in rows.get(GRAPH, ())], t) for i, t in enumerate(kinds))
        if VECTORS in rows:
            nodes = np.sort(joined([x[1] for x in rows[VECTORS]], np.int64))
            counts = np.zeros(len(nodes), np.int32)
        to, by, value = (joined([x[i + 1] for x in rows.get(EDGES, ())], t) for i, t in enumerate((np.int64, np.int64, np.float64)))
        a = np.concatenate([np.repeat(np.arange(len(nodes)), counts), np.searchsorted(nodes, to)])
        old = np.concatenate([np.ones(len(old), np.uint8), np.zeros(len(to), np.uint8)])
        a, b, sim, old = _best_entries(a, np.concatenate([b, by]), np.concatenate([sim, value]), degree, old)
        counts = np.bincount(a, minlength=len(nodes)).astype(np.int32)
        yield message(cell, GRAPH, nodes, counts, b, sim, old, n=len(old) - int(old.sum()))

    return run


def _samples(degree: int, k: int, cells: int):
    """Lists of a cell -> what its nodes' neighbourhoods take of them, and the reverse entries for those of others."""

    def run(batches):
        def messages():
            for batch in batches:
                for cell, _, _, nodes, counts, b, sim, old, _ in received(batch):
                    nodes, counts, b = np.frombuffer(nodes, np.int64), np.frombuffer(counts, np.int32), np.frombuffer(b, np.int64)
                    sim, old = np.frombuffer(sim, np.float64), np.frombuffer(old, np.uint8)
                    least = np.full(len(nodes), -np.inf)
                    full = counts >= degree
                    least[full] = sim[(np.cumsum(counts) - 1)[full]]
                    yield message(cell, LEAST, nodes, least)
                    a = np.repeat(nodes, counts)
                    order = _sampled(np.repeat(np.arange(len(nodes)), counts), _dice(a, b, k, old), FORWARD)
                    yield message(cell, FORWARD_PAIRS, a[order], b[order])
                    # hubs are cut here, before anything moves
                    order = np.argsort(b)
                    if len(b) and np.diff(np.append(np.flatnonzero(firsts(b[order])), len(b))).max() > REVERSE:
                        order = _sampled(np.unique(b, return_inverse=True)[1], _dice(b, a, k, old), REVERSE)
                    for c, part in deal(cell_of(b[order], cells), cells, b[order], a[order], old[order]):
                        yield message(c, REVERSE_PAIRS, *part)

        yield from sent(messages())

    return run


def _dice(a, b, k: int, old):
    """What new entries, then old ones, are sampled by."""
    dice = mix((mix(a) ^ mix((mix(b) + np.uint64(k)).view(np.int64))).view(np.int64))
    return (dice >> np.uint64(1)) | (old.astype(np.uint64) << np.uint64(63))


def _sampled(at, dice, size: int):
    """Where the ``size`` smallest dice of each place lie, place by place."""
    at = small(at)
    if at.itemsize == 2:  # both in one number, which is sorted sooner
        order = np.argsort((at.astype(np.uint64) << np.uint64(48)) | (dice >> np.uint64(16)))
    else:
        order = np.lexsort((dice, at))
    return order[ranks(at[order]) < size]


def _hoods(k: int, cells: int):
    """Sampled pairs of a cell -> its neighbourhoods, and the vectors they want of every cell."""

    def run(cell, rows):
        at, nodes = (joined([x[i] for x in rows.get(FORWARD_PAIRS, ())], np.int64) for i in (1, 2))
        r_at, r_nodes, old = (joined([x[i + 1] for x in rows.get(REVERSE_PAIRS, ())], t) for i, t in enumerate((np.int64, np.int64, np.uint8)))
        own = joined([x[1] for x in rows.get(LEAST, ())], np.int64)
        r_place = np.searchsorted(own, r_at)
        some = _sampled(r_place, _dice(r_at, r_nodes, k, old), REVERSE)
        at, nodes = small(np.concatenate([np.searchsorted(own, at), r_place[some]])), np.concatenate([nodes, r_nodes[some]])
        order = pair_order(at, nodes)
        at, nodes = at[order], nodes[order]
        one = firsts(at) | firsts(nodes)
        at, nodes = at[one], nodes[one]
        for x in rows.get(LEAST, ()):
            yield message(cell, LEAST, *x[1:3])
        if len(at):
            yield message(cell, HOODS, np.diff(np.append(np.flatnonzero(firsts(at)), len(at))).astype(np.int32), nodes)
        wanted = distinct(nodes)
        for c, (x,) in deal(cell_of(wanted, cells), cells, wanted):
            yield message(c, WANTED, x, n=cell)

    return run


def _send_vectors(dim: int, kind: str):
    def run(cell, rows):
        ids, vectors = _node_vectors(rows.get(VECTORS, ()), kind, dim)
        least = np.full(len(ids), -np.inf)
        for x in rows.get(LEAST, ()):
            least[np.searchsorted(ids, np.frombuffer(x[1], np.int64))] = np.frombuffer(x[2], np.float64)
        for x in rows.get(HOODS, ()):
            yield message(cell, HOODS, *x[1:3])
        for x in rows.get(WANTED, ()):
            nodes = np.frombuffer(x[1], np.int64)
            at = np.searchsorted(ids, nodes)
            for i in range(0, len(at), VECTORS_AT_ONCE):
                some = at[i:i + VECTORS_AT_ONCE]
                yield message(x[0], FOUND, nodes[i:i + VECTORS_AT_ONCE], vectors[some], least[some])

    return run


def _local_join(dim: int, kind: str, degree: int, cells: int):
    """Neighbourhoods of a cell, with their vectors -> the pairs that improve a list, at most ``degree`` for a node."""

    def run(cell, rows):
        sources = rows.get(FOUND, ())
        ids = joined([x[1] for x in sources], np.int64)
        m = joined([x[2] for x in sources], kind).reshape(-1, dim)
        least = joined([x[3] for x in sources], np.float64)
        order = np.argsort(ids)
        counts, members = (joined([x[i + 1] for x in rows.get(HOODS, ())], t) for i, t in enumerate((np.int32, np.int64)))
        if not len(counts):
            return
        # place[i, j]: member j of neighbourhood i; places past its end stand for nothing
        place = np.full((len(counts), counts.max()), -1)
        place[np.arange(counts.max()) < counts[:, None]] = order[np.searchsorted(ids, members, sorter=order)]
        by_size = np.argsort(counts, kind="stable")
        place, counts = place[by_size], counts[by_size]
        held, n = [], 0
        for i in range(0, len(place), HOODS_AT_ONCE):
            width = np.arange(counts[i:i + HOODS_AT_ONCE].max())
            p = np.ascontiguousarray(place[i:i + HOODS_AT_ONCE, :len(width)])
            x = m[p].astype(np.float64, copy=False)
            s = x @ x.swapaxes(1, 2)
            none = p < 0
            bound = least[p]
            bound[none] = np.inf
            s.swapaxes(1, 2)[none] = -np.inf
            s[:, width, width] = -np.inf
            ok = np.flatnonzero(s > bound[:, :, None])
            row, b = np.divmod(ok, len(width))
            held.append((p.ravel()[row], p.ravel()[row // len(width) * len(width) + b], s.ravel()[ok]))
            n += len(ok)
            if n >= EDGES_HELD:
                held = [_best_places(held, ids, degree)]
                n = min(len(held[0][0]), EDGES_HELD // 2)
        a, b, sim = _best_places(held, ids, degree)
        for c, part in deal(cell_of(ids[a], cells), cells, ids[a], ids[b], sim):
            yield message(c, EDGES, *part)

    return run


def _best_places(held: list, ids, degree: int):
    """Edges between places: each pair once, and of a place the ``degree`` best."""
    a, b, sim = (np.concatenate([x[i] for x in held]) for i in range(3))
    pair = a * len(ids) + b
    one = np.argsort(pair)
    one = one[firsts(pair[one])]
    a, b, sim = a[one], b[one], sim[one]
    if len(a) and np.bincount(a).max() > degree:
        order = np.lexsort((ids[b], -sim, a))
        order = order[ranks(a[order]) < degree]
        a, b, sim = a[order], b[order], sim[order]
    return a, b, sim


def _unpacked(batches):
    """Messages ``GRAPH`` -> a row for each node."""
    for batch in batches:
        for _, _, _, nodes, counts, b, sim, old, _ in received(batch):
            ends = np.concatenate([[0], np.cumsum(np.frombuffer(counts, np.int32))]).astype(np.int32)
            entries = pa.StructArray.from_arrays(
                [pa.array(np.frombuffer(sim, np.float64)), pa.array(np.frombuffer(b, np.int64)),
                 pa.array(np.frombuffer(old, np.uint8).astype(bool))], ["sim", "b", "old"])
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(nodes, np.int64)), pa.ListArray.from_arrays(ends, entries)],
                                             ["node", "nbrs"])


def nn_descent(nodes: DataFrame, dim: int, kind: str = "f8", degree: int = DEGREE, delta: float = DELTA) -> DataFrame:
    """``nodes(node, q, codes)`` -> ``(node, nbrs array<struct<sim, b, old>>)``."""
    trees = nodes.select("node", "q", F.posexplode("codes").alias("tree", "code")).withColumn("deal", F.xxhash64("tree", "node"))
    blocks = ordered_positions(trees, ["tree", "code", "deal", "node"], "tree-order").withColumn(
        "block", F.floor(F.col("__pos") / BLOCK).cast("long")).select("block", "node", "q")
    cells = cell_count(nodes.count(), CELL, nodes.sparkSession)
    vectors = _packed_nodes(nodes, cells)
    start = blocks.groupBy("block").applyInArrow(_block_neighbours(dim, degree, kind), "a binary, b binary, sim binary")
    start = start.mapInArrow(_start_edges(degree, cells), MESSAGE)
    alone = vectors.withColumn("b", F.lit(None).cast("binary"))
    graph = stored(in_cells(start.unionAll(alone), cells, _lists(degree)), "graph-0")
    delete_stored(blocks)
    for k in count():  # least similarities only grow and lists are bounded, so changes die out
        hoods = in_cells(graph.mapInArrow(_samples(degree, k, cells), MESSAGE), cells, _hoods(k, cells))
        hoods = in_cells(hoods.unionAll(vectors), cells, _send_vectors(dim, kind))
        found = in_cells(hoods, cells, _local_join(dim, kind, degree, cells))
        new = stored(in_cells(found.unionAll(graph), cells, _lists(degree)), f"graph-{k + 1}")
        delete_stored(graph)
        graph = new
        entries, changed = graph.agg(F.sum(F.length("c") / 8), F.sum("n")).first()
        if (changed or 0) <= delta * (entries or 0):
            return graph.mapInArrow(_unpacked, "node long, nbrs array<struct<sim: double, b: long, old: boolean>>")


def adjacency(graph: DataFrame, nodes: DataFrame, dim: int, kind: str, cells: int) -> DataFrame:
    """Messages ``ADJACENCY``: for each cell its nodes, their vectors, and their lists, which begin with themselves."""

    def lists(batches):
        def messages():
            for b in batches:
                if b.num_rows:
                    ids, nbrs = b["node"].to_numpy(), b["nbrs"]
                    ends = nbrs.offsets.to_numpy()
                    flat = nbrs.values.field("b").to_numpy()
                    counts = np.diff(ends)
                    at = cell_of(ids, cells)
                    for c, (i, start, n) in deal(at, cells, ids, ends[:-1], counts):
                        yield message(c, LISTS, i, n.astype(np.int32), flat[spans(start, n)])

        yield from sent(messages())

    def together(cell, rows):
        ids, vectors = _node_vectors(rows[VECTORS], kind, dim)
        of, n, flat = (joined([x[i + 1] for x in rows.get(LISTS, ())], t) for i, t in enumerate((np.int64, np.int32, np.int64)))
        starts, counts = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        at = np.searchsorted(ids, of)
        starts[at], counts[at] = np.cumsum(n) - n, n
        whole = np.empty(len(ids) + len(flat), np.int64)
        own = np.cumsum(counts + 1) - (counts + 1)
        whole[own] = ids
        whole[spans(own + 1, counts)] = flat[spans(starts, counts)]
        yield message(cell, ADJACENCY, ids, vectors, (counts + 1).astype(np.int32), whole)

    return in_cells(graph.mapInArrow(lists, MESSAGE).unionAll(_packed_nodes(nodes, cells)), cells, together)


def _ask(cells: int):
    """Queries -> the nodes they expand, at the nodes' cells."""

    def run(batches):
        def messages():
            for batch in batches:
                rows = [(n, np.frombuffer(todo, np.int64)) for _, _, n, _, _, _, _, todo, _ in received(batch)]
                if rows:
                    nodes = np.concatenate([x for _, x in rows])
                    queries = np.repeat(np.array([n for n, _ in rows]), [len(x) for _, x in rows])
                    for c, part in deal(cell_of(nodes, cells), cells, queries, nodes):
                        yield message(c, ASKED, *part)

        yield from sent(messages())

    return run


def _expand(query_cells: int):
    def run(cell, rows):
        if ASKED not in rows:
            return
        (_, ids, _, counts, flat, *_), = rows[ADJACENCY]
        ids, counts, flat = np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int32).astype(np.int64), np.frombuffer(flat, np.int64)
        starts = np.cumsum(counts) - counts
        queries, nodes = (joined([x[i] for x in rows[ASKED]], np.int64) for i in (1, 2))
        for c, (q, x) in deal(cell_of(queries, query_cells), query_cells, queries, np.searchsorted(ids, nodes)):
            yield message(c, ANSWERED, q, counts[x].astype(np.int32), flat[spans(starts[x], counts[x])])

    return run


def _by_query(rows: list, queries, *kinds):
    """Entries of messages ``(queries, counts, ...)`` ordered by query: their ends, by place in ``queries``, and the entries."""
    q, n = joined([x[1] for x in rows], np.int64), joined([x[2] for x in rows], np.int32).astype(np.int64)
    entries = [joined([x[i + 3] for x in rows], t) for i, t in enumerate(kinds)]
    at = np.searchsorted(queries, q)
    order = np.argsort(at, kind="stable")
    take = spans((np.cumsum(n) - n)[order], n[order])
    ends = np.concatenate([[0], np.cumsum(np.bincount(at, n, len(queries)))]).astype(np.int64)
    return ends, *[x[take] for x in entries]


def _candidates(pool: int, cells: int):
    """Lists that queries asked for -> their members that are not in the pool, each once, at the members' cells."""

    def run(cell, rows):
        state = sorted(rows.get(SEARCH, ()), key=lambda x: x[0])
        queries = np.array([x[0] for x in state], np.int64)
        ends, flat = _by_query(rows.get(ANSWERED, ()), queries, np.int64)
        least = np.full(len(state), -np.inf)
        out = []
        for i, (_, _, ids, sims, *_) in enumerate(state):
            new = distinct(flat[ends[i]:ends[i + 1]])
            ids = np.frombuffer(ids, np.int64)
            if len(ids) and len(new):
                at = np.minimum(np.searchsorted(new, ids), len(new) - 1)
                fresh = np.ones(len(new), bool)
                fresh[at[new[at] == ids]] = False
                new = new[fresh]
            if len(ids) >= pool:
                least[i] = np.frombuffer(sims, np.float64)[-1]
            out.append(new)
        nodes = np.concatenate([*out, np.zeros(0, np.int64)])
        vectors = [np.frombuffer(x[1], np.uint8) for x in state]
        for c, (i, x) in deal(cell_of(nodes, cells), cells, np.repeat(np.arange(len(state)), [len(x) for x in out]), nodes):
            start = np.flatnonzero(firsts(i))
            i, n = i[start], np.diff(np.append(start, len(i)))
            yield message(c, CANDIDATES, queries[i], n.astype(np.int32), x, np.concatenate([vectors[j] for j in i]), least[i], n=cell)

    return run


def _score(dim: int, kind: str):
    def run(cell, rows):
        if CANDIDATES not in rows:
            return
        (_, ids, vectors, *_), = rows[ADJACENCY]
        ids, m = np.frombuffer(ids, np.int64), np.frombuffer(vectors, kind).reshape(-1, dim).astype(np.float64)
        for back, queries, n, nodes, vectors, least, _ in rows[CANDIDATES]:
            n, nodes = np.frombuffer(n, np.int32), np.frombuffer(nodes, np.int64)
            v = np.frombuffer(vectors, kind).reshape(-1, dim).astype(np.float64)
            at, ends = np.searchsorted(ids, nodes), np.cumsum(n)
            s = np.empty(len(nodes))
            for i, (start, end) in enumerate(zip(ends - n, ends)):
                s[start:end] = m[at[start:end]] @ v[i]
            of = np.repeat(np.arange(len(n)), n)
            ok = s > np.frombuffer(least, np.float64)[of]
            yield message(back, SCORED, queries, np.bincount(of[ok], minlength=len(n)).astype(np.int32), nodes[ok], s[ok])

    return run


def _merge(pool: int, width: int):
    def run(cell, rows):
        state = sorted(rows.get(SEARCH, ()), key=lambda x: x[0])
        queries = np.array([x[0] for x in state], np.int64)
        ends, new, scores = _by_query(rows.get(SCORED, ()), queries, np.int64, np.float64)
        for i, (query, vector, ids, sims, done, todo, _) in enumerate(state):
            ids = np.concatenate([np.frombuffer(ids, np.int64), new[ends[i]:ends[i + 1]]])
            sims = np.concatenate([np.frombuffer(sims, np.float64), scores[ends[i]:ends[i + 1]]])
            best = np.lexsort((ids, -sims))[:pool]
            ids, sims = ids[best], sims[best]
            # of what was expanded only pool nodes can come up again
            expanded = np.isin(ids, np.concatenate([np.frombuffer(done, np.int64), np.frombuffer(todo, np.int64)]))
            yield message(cell, SEARCH, np.frombuffer(vector, np.uint8), ids, sims, ids[expanded], ids[~expanded][:width], n=query)

    return run


def graph_search(adj: DataFrame, queries: DataFrame, dim: int, cells: int, kind: str = "f8", pool: int = POOL,
                 width: int = WIDTH) -> DataFrame:
    """``queries(query, qvec, todo)``, ``qvec`` packed as ``kind`` -> pools ``(query, ids, sims)``; ``adj`` as ``adjacency`` makes it, in ``cells``."""
    query_cells = cell_count(queries.count(), QUERY_CELL, queries.sparkSession)

    def begin(batches):
        def messages():
            for b in batches:
                ids = b["query"].to_numpy()
                for c, i, v, todo in zip(cell_of(ids, query_cells), ids, b["qvec"], b["todo"], strict=True):
                    none = np.zeros(0)
                    yield message(c, SEARCH, np.frombuffer(v.as_buffer(), np.uint8), none, none, none, todo.values.to_numpy(), n=i)

        yield from sent(messages())

    def pools(batches):
        for b in batches:
            rows = [(n, np.frombuffer(ids, np.int64), np.frombuffer(sims, np.float64)) for _, _, n, _, ids, sims, *_ in received(b)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.list_(pa.int64())),
                                              pa.array([x[2] for x in rows], pa.list_(pa.float64()))], ["query", "ids", "sims"])

    state = stored(queries.mapInArrow(begin, MESSAGE), "search")
    nodes, vectors = adj.withColumn("b", F.lit(None).cast("binary")), adj.withColumns({x: F.lit(None).cast("binary") for x in "cd"})
    while True:
        live = state.where("length(e) > 0")
        if live.isEmpty():
            return state.mapInArrow(pools, "query long, ids array<long>, sims array<double>")
        lists = in_cells(live.mapInArrow(_ask(cells), MESSAGE).unionAll(nodes), cells, _expand(query_cells))
        wanted = in_cells(lists.unionAll(live), query_cells, _candidates(pool, cells))
        scores = in_cells(wanted.unionAll(vectors), cells, _score(dim, kind))
        merged = in_cells(scores.unionAll(live), query_cells, _merge(pool, width))
        new = stored(merged.unionAll(state.where("length(e) = 0")), "search")
        delete_stored(state)
        state = new


def nearest(table: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``_nearest`` under ``SETTINGS``; the session's own are back when it returns."""
    with _settings(table.sparkSession):
        return _nearest(table, is_query, k, id_col, vec_col)


def _nearest(table: DataFrame, is_query, k: int, id_col: str, vec_col: str) -> DataFrame:
    """The ``k`` nearest rows by inner product of each row that ``is_query`` (a Column) picks.

    ``query_id, rank, vec_id, score``, nearest first, the query's own row left out.
    """
    spark = table.sparkSession
    rows = stored(clean_vectors(table, id_col, vec_col), "vectors")
    head = rows.select(F.size("vec").alias("n")).first()
    dim = head["n"] if head else 0
    classes = stored(vector_classes(rows, k + 1), "classes")
    asked = rows.where(is_query(F.col("id"))).select(F.col("id").alias("query_id"), "vec").distinct()
    asked = stored(asked.join(classes.select("vec", "node"), "vec").select("query_id", "node"), "queries")
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # floats travel as floats: nothing is lost, and half the bytes
    kind = "f4" if table.schema[vec_col].dataType.elementType.typeName() == "float" else "f8"
    nodes = stored(classes.select("node", "vec").mapInPandas(_coded(_mean(classes), kind), NODES), "nodes")
    graph = nn_descent(nodes, dim, kind)
    # joined once; every hop of the search sends queries to it
    cells = cell_count(nodes.count(), SEARCH_CELL, spark)
    adj = stored(adjacency(graph, nodes, dim, kind, cells), "adjacency")
    delete_stored(graph)
    entries = [r["node"] for r in nodes.orderBy(F.xxhash64("node"), "node").select("node").limit(ENTRIES).collect()]
    # queries with the same vector search once
    starts = asked.select("node").distinct().join(classes.select("node", "vec"), "node").select(
        F.col("node").alias("query"), "vec", F.array_distinct(F.concat(
            F.array("node"), F.array(*[F.lit(e).cast("long") for e in entries]))).alias("todo"))

    def packed(batches):
        for b in batches:
            yield pd.DataFrame({"query": b["query"], "todo": b["todo"],
                                "qvec": [np.asarray(v, kind).tobytes() for v in b["vec"]]})

    starts = starts.mapInPandas(packed, "query long, todo array<long>, qvec binary")
    pools = graph_search(adj, starts, dim, cells, kind)
    delete_stored(adj)
    delete_stored(nodes)
    # twice the rounding of a sum of products, for two sums: nodes below it cannot be among the best k + 1
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    slack = 4 * dim * 2.0 ** -52 * classes.agg(F.max(norm("vec"))).first()[0] ** 2
    least = F.get("sims", F.lit(k)) - F.lit(slack)
    near = pools.select("query", least.alias("least"), F.inline(F.arrays_zip("ids", "sims"))).where(
        "least IS NULL OR sims >= least").select("query", F.col("ids").alias("node"))
    vec_of = classes.select(F.col("node").alias("query"), F.col("vec").alias("qvec"))
    near = near.join(vec_of, "query").join(classes, "node")
    score = F.aggregate(F.zip_with("qvec", "vec", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    near = near.select("query", score.alias("score"), F.slice("ids", 1, k + 1).alias("ids"))
    # k + 1 classes with k + 1 members each hold the k best rows beside the query's own
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0]))
    near = near.withColumn("__at", best).where(F.col("__at") <= k + 1)
    lists = near.groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("classes"))
    out = asked.join(lists, asked["node"] == lists["query"]).select(
        "query_id", F.inline("classes")).select("query_id", "score", F.explode("ids").alias("vec_id")).where(
        "vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
