"""Language-model scores from an n-gram trie in Elias-Fano coded, memory-mapped levels.

``train`` counts the words, word pairs and triples of the training rows (no
n-gram is left out) and writes a trie of three levels in files of bounded
size below one shared folder:

* Level 1, the words: sorted by 64-bit hash; a word's number is its place.
* Level 2 (3), the pairs (triples): ascending by parent, the place of the
  n-gram's context in the level above, and child.  Monotone pointers give
  each parent's range of children, the children are one more monotone
  sequence, both Elias-Fano coded.  The child of a pair is its last word's
  number.  The child of a triple (a, b, c) is c's rank among the successors
  of b, which is small: every triple ends in a pair that level 2 holds.
* Each n-gram has its smoothed probability, each parent its back-off weight,
  as one byte on a scale of log10.

A probability is interpolated by absolute discounting: (count - D) / count
of the context, plus what was discounted times the probability after the
shorter context; D = n1 / (n1 + 2 n2) of the level.  Words have (count + 1) /
(N + V + 1), unknown ones 1 / (N + V + 1).

Texts are cut into words once and kept as word numbers; when level 2 is
there, the place of each pair is looked up once and kept beside them.
Counting is one pass a level over those.  A task counts a block, cuts the
counts at bounds of the key and sends each part as one compressed row; a part
is merged and written by one task.  Bounds come from the level above, whose
counts say how many occurrences lie in a range, and they split a frequent
context's children too.  So a part holds about ``PART_TOKENS`` occurrences
at most, whatever one word's or pair's share.

Scoring maps the files and asks them for the distinct n-grams of a block at
a time, for triples first and for pairs where there is no triple: the successor of the child among the numbers of its context, then
the byte at its place.  So a task holds one block, not the model.

Cases: A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, and each text is
closed by an end token; null texts are empty, so of the end alone.  Rows
whose training flag is null count as false.  Without a training row every
token has probability 1.  Repeated rows count and score each.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import word_arrays as WA
from .common import delete_stored, read, shared_path, stored, whole_text
from .elias_fano import EliasFano, encode
from .token_files import _mapped, _open

#: the end of a text; no word holds a blank
END = b" "
#: occurrences that a file of a level is made for
PART_TOKENS = 1 << 21
#: bytes of text that a task counts or scores at a time
BLOCK_BYTES = 4 << 20
#: files of a level that a worker keeps mapped
MAPPED = 4096
_WORDS = "part int, file string, n long, first long, tokens long"
_PART = ("part int, file string, n long, lo long, hi long, first_child long, last_child long, first_kids long, "
         "last_kids long, top long, n1 long, n2 long, hot array<struct<place: long, n: long>>")


# ---- files

def _save(path: str, kind: str, arrays) -> str:
    """Write arrays one after another, each padded to whole 64-bit words behind its length in words."""
    name = f"{kind}-{uuid.uuid4().hex}"
    fs_, root = _open(path)
    with fs_.open_output_stream(f"{root}/{name}") as f:
        for a in arrays:
            raw = np.ascontiguousarray(a).view(np.uint8)
            words = -(-len(raw) // 8)
            f.write(np.array([words], "<u8").tobytes() + raw.tobytes() + bytes(8 * words - len(raw)))
    return name


def _load(path: str, name: str) -> list[np.ndarray]:
    """The arrays of a file as 64-bit words, mapped where the file is local."""
    fs_, root = _open(path)
    flat, out, at = np.asarray(_mapped(fs_, f"{root}/{name}", "<u8")), [], 0
    while at < len(flat):
        size = int(flat[at])
        out.append(flat[at + 1:at + 1 + size])
        at += 1 + size
    return out


def _pack(key: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending keys and their counts, compressed: differences, byte by byte of equal weight."""
    import zstandard

    x = np.stack([np.diff(key, prepend=np.uint64(0)), n.astype(np.uint64)])
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1)).tobytes())


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    x = np.ascontiguousarray(raw.reshape(2, 8, -1).transpose(0, 2, 1)).view(np.uint64)[:, :, 0]
    return np.cumsum(x[0], dtype=np.uint64), x[1].astype(np.int64)


def _hash(names: list[bytes]) -> np.ndarray:
    """The hash of Spark's ``xxhash64``."""
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w, 42) for w in names), np.uint64, len(names))


# ---- reading the trie

def _keep(open_files: dict) -> None:
    """Mapped files are few: a machine has a bounded number of mappings."""
    if len(open_files) >= MAPPED:
        open_files.clear()


def _by_part(part: np.ndarray):
    """Each file's number, and the places of what it is asked for."""
    if not len(part):
        return
    order = np.argsort(part.astype(np.uint16) if part.max() < 1 << 16 else part, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1]]))
    for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(part)], strict=True):
        yield int(part[order[s]]), order[s:e]


class _Level1:
    """Words: number, count and cumulated count."""

    def __init__(self, path: str, parts: list[dict]):
        self.path, self.parts, self.open = path, parts, {}
        self.first = np.array([p["first"] & (1 << 64) - 1 for p in parts], np.uint64)
        self.base = np.cumsum([0] + [p["n"] for p in parts]).astype(np.int64)
        self.before = np.cumsum([0] + [p["tokens"] for p in parts]).astype(np.int64)

    def part(self, k: int):
        if k not in self.open:
            p = self.parts[k]
            key, count, before, off, text = _load(self.path, p["file"])
            names = pa.Array.from_buffers(pa.large_binary(), p["n"], [None, pa.py_buffer(off), pa.py_buffer(text)])
            _keep(self.open)
            self.open[k] = key, count, names, before
        return self.open[k]

    def numbers(self, names: pa.Array) -> np.ndarray:
        """The number of each word, -1 if unknown."""
        out = np.full(len(names), -1, np.int64)
        if not self.parts or not len(names):
            return out
        h = _hash(names.to_pylist())
        order = np.argsort(h)
        for k, at in _by_part(np.maximum(np.searchsorted(self.first, h[order], side="right") - 1, 0)):
            key, _, stored, _ = self.part(k)
            at = order[at]
            place = np.searchsorted(key, h[at])
            while len(at):  # words of one hash stand side by side
                on = place < len(key)
                on[on] = key[place[on]] == h[at[on]]
                at, place = at[on], place[on]
                same = pc.equal(stored.take(pa.array(place)), names.take(pa.array(at)).cast(pa.large_binary()))
                same = same.to_numpy(zero_copy_only=False)
                out[at[same]] = self.base[k] + place[same]
                at, place = at[~same], place[~same] + 1
        return out

    def _gather(self, number: np.ndarray, get) -> np.ndarray:
        out = np.zeros(len(number), np.int64)
        for k, at in _by_part(np.searchsorted(self.base, number, side="right") - 1):
            out[at] = get(self.part(k), number[at] - self.base[k], k)
        return out

    def counts(self, number: np.ndarray) -> np.ndarray:
        return self._gather(number, lambda p, i, k: p[1].view(np.int64)[i])

    def cumulated(self, number: np.ndarray) -> np.ndarray:
        """Training tokens of smaller numbers."""
        return self._gather(number, lambda p, i, k: p[3].view(np.int64)[i] + self.before[k])


class _Part:
    """One file of a level of n-grams."""

    def __init__(self, path: str, p: dict, width: int):
        s = _load(path, p["file"])
        self.n, self.lo, parents = p["n"], p["lo"], p["hi"] - p["lo"] + 1
        self.width = width
        self.pointers = EliasFano(s[0:3], parents + 1, self.n + 1)
        self.children = EliasFano(s[3:6], self.n, parents * width)
        self.codes = self.back = None
        if p.get("codes"):
            self.scale = p["scale"]
            c = _load(path, p["codes"])
            self.codes, self.back = c[0].view(np.uint8), c[1].view(np.uint8)


class _Level:
    """All files of a level of n-grams; places are numbers of n-grams within the level."""

    def __init__(self, path: str, parts: list[dict], width: int):
        self.path, self.parts, self.width, self.open = path, parts, width, {}
        col = lambda c: np.array([p[c] for p in parts], np.int64)
        self.lo, self.hi, self.child = col("lo"), col("hi"), col("first_child")
        self.base = np.cumsum([0] + [p["n"] for p in parts]).astype(np.int64)
        # children of parents that lie in several files
        self.split: dict[int, int] = {}
        for p, q in zip(parts, parts[1:], strict=False):
            if p["hi"] == q["lo"]:
                self.split.setdefault(q["lo"], p["last_kids"])
                self.split[q["lo"]] += q["first_kids"]

    def part(self, k: int) -> _Part:
        if k not in self.open:
            _keep(self.open)
            self.open[k] = _Part(self.path, self.parts[k], self.width)
        return self.open[k]

    def _where(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """The file of each key (keys ascending by parent, then child)."""
        width = np.uint64(self.width)
        first = self.lo.astype(np.uint64) * width + self.child.astype(np.uint64)
        k = np.searchsorted(first, parent.astype(np.uint64) * width + child.astype(np.uint64), side="right") - 1
        k = np.maximum(k, 0)
        after = np.minimum(k + 1, len(self.parts) - 1)
        return np.where((parent > self.hi[k]) & (parent >= self.lo[after]), after, k)

    def find(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Place of each n-gram, -1 where there is none; any order."""
        out = np.full(len(parent), -1, np.int64)
        if not self.parts or not len(parent):
            return out
        order = np.argsort(parent.astype(np.uint64) * np.uint64(self.width) + child.astype(np.uint64))
        a, b = parent[order], child[order]
        for k, on in _by_part(self._where(a, b)):
            on = on[(a[on] >= self.lo[k]) & (a[on] <= self.hi[k])]
            if not len(on):
                continue
            p = self.part(k)
            # the child's successor from the context's own numbers on
            place, hit = p.children.successor((a[on] - p.lo).astype(np.uint64) * np.uint64(self.width) + b[on].astype(np.uint64))
            out[order[on[hit]]] = self.base[k] + place[hit]
        return out

    def _gather(self, place: np.ndarray, get, dtype) -> np.ndarray:
        out = np.zeros(len(place), dtype)
        for k, at in _by_part(np.searchsorted(self.base, place, side="right") - 1):
            out[at] = get(self.part(k), place[at] - self.base[k])
        return out

    def prob(self, place: np.ndarray) -> np.ndarray:
        """log10 of the n-grams' probabilities."""
        return self._gather(place, lambda p, i: p.codes[i] * -p.scale[0], np.float64)

    def child_of(self, lo: int, hi: int) -> np.ndarray:
        """Children (last words) of the n-grams at the places lo to hi."""
        first, last = (int(np.searchsorted(self.base, x, side="right")) - 1 for x in (lo, hi))
        x = np.concatenate([self.part(k).children.all() % np.uint64(self.width) for k in range(first, last + 1)])
        return x[lo - self.base[first]:hi + 1 - self.base[first]].astype(np.int64)

    def kids(self, parent: int) -> int:
        """How many children a parent has."""
        own = self._parents(np.array([parent]), lambda p, i, k: np.diff(p.pointers[np.append(i, i + 1)].astype(np.int64)), np.int64, 0)
        return self.split.get(parent, int(own[0]))

    def _parents(self, parent: np.ndarray, get, dtype, none):
        out = np.full(len(parent), none, dtype)
        if not self.parts:
            return out
        for k, at in _by_part(self._where(parent, np.zeros(len(parent), np.int64))):
            at = at[(parent[at] >= self.lo[k]) & (parent[at] <= self.hi[k])]
            out[at] = get(self.part(k), parent[at] - self.lo[k], k)
        return out

    def back_off(self, parent: np.ndarray) -> np.ndarray:
        """log10 of the parents' back-off weights; 0 for parents without children."""
        return self._parents(parent, lambda p, i, k: p.back[i] * -p.scale[1], np.float64, 0.0)

    def first_place(self, parent: np.ndarray) -> np.ndarray:
        """Where each parent's children begin."""
        return self._parents(parent, lambda p, i, k: p.pointers[i].astype(np.int64) + self.base[k], np.int64, -1)


class Model:
    """The trained trie: parameters and the levels' lists of files; levels are opened where they are used."""

    def __init__(self, path: str, meta: dict):
        self.path, self.meta = path, meta

    def __reduce__(self):
        return Model, (self.path, self.meta)

    def level1(self) -> _Level1:
        return _opened1(_Shared(self))

    def level(self, k: int) -> _Level:
        return _opened(_Shared(self), k)

    @property
    def tokens(self) -> int:
        return self.meta["tokens"]

    def word_prob(self, count: np.ndarray) -> np.ndarray:
        """log10 of the probability of words that were counted so often."""
        return np.log10((count + 1) / (self.tokens + self.meta["words"] + 1))


class _Shared:
    """A model as a key of a cache: equal where the folder and the stage of training are."""

    def __init__(self, model):
        self.model = model

    def __hash__(self):
        return hash(self.model.path)

    def __eq__(self, other):
        return self.model.path == other.model.path and self.model.meta["stage"] == other.model.meta["stage"]


@lru_cache(2)
def _opened1(key: _Shared) -> _Level1:
    return _Level1(key.model.path, key.model.meta["level1"])


@lru_cache(4)
def _opened(key: _Shared, k: int) -> _Level:
    m = key.model.meta
    return _Level(key.model.path, m[f"level{k}"], m[f"width{k}"])


# ---- tokens

def _tokens(batch: pa.RecordBatch, numbers) -> tuple[np.ndarray, np.ndarray]:
    """Number of every token of a block's texts, each closed by the end token, and its text's place."""
    found, row = WA.words(batch.column(batch.schema.get_field_index("text")), WA.not_blank)
    rows = batch.num_rows
    enc = found.dictionary_encode()
    names = pa.concat_arrays([enc.dictionary, pa.array([END], pa.binary())])
    number = numbers(names)
    out, text = np.empty(len(found) + rows, np.int64), np.empty(len(found) + rows, np.int64)
    at = np.arange(len(found)) + row
    out[at], text[at] = number[:-1][enc.indices.to_numpy()], row
    end = np.cumsum(np.bincount(row, minlength=rows) + 1) - 1
    out[end], text[end] = number[-1], np.arange(rows)
    return out, text


def _distinct(key: np.ndarray, width: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the place of its value among the distinct ones, and those, split as ``width`` * x + y."""
    index, values = pd.factorize(key)
    if width == 1:
        return index, values, values
    x, y = np.divmod(values, np.uint64(width))
    return index, x.astype(np.int64), y.astype(np.int64)


def _joint(x: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    return x.astype(np.uint64) * np.uint64(width) + y.astype(np.uint64)


def _split(x: np.ndarray, text: np.ndarray, rows: int, kind) -> pa.Array:
    """Values of each text as a binary."""
    raw = x.astype(kind)
    at = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=rows))]) * raw.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])


def _unrolled(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of all texts one after another, and each value's text."""
    off = WA._offsets(column)
    flat = np.frombuffer(column.buffers()[2], np.uint8, off[-1] - off[0], off[0]).view(kind) if off[-1] > off[0] else np.zeros(0, kind)
    return flat.astype(np.int64), np.repeat(np.arange(len(column)), np.diff(off) // np.dtype(kind).itemsize)


def _kind(n: int):
    """The smallest type for places below n, and -1."""
    return np.int32 if n < 1 << 31 else np.int64


def _encoded(model: Model, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Token numbers and their texts; per text: tokens, known tokens, base score."""
    one, rows = model.level1(), batch.num_rows
    token, text = _tokens(batch, one.numbers)
    index, number, _ = _distinct(token)
    count = np.zeros(len(number), np.int64)
    count[number >= 0] = one.counts(number[number >= 0])
    base = model.word_prob(count)
    return (token, text, np.bincount(text, minlength=rows).astype(np.int64),
            np.bincount(text, (token >= 0).astype(float), rows).astype(np.int64), np.bincount(text, base[index], rows))


def _placed(model: Model, token: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each token the place of the pair that it ends in level 2; -1 without."""
    out = np.full(len(token), -1, np.int64)
    on = np.flatnonzero((text[1:] == text[:-1]) & (token[1:] >= 0) & (token[:-1] >= 0))
    two = model.level(2)
    index, x, y = _distinct(_joint(token[on], token[on + 1], two.width), two.width)
    out[on + 1] = two.find(x, y)[index]
    return out


def _triples(model: Model, token: np.ndarray, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens after a pair that level 2 holds: which, the pair's place, and the rank of the token's own pair; -1 without."""
    at = np.flatnonzero((text[2:] == text[:-2]) & (place[1:-1] >= 0)) + 2
    index, last, _ = _distinct(token[at - 1])
    begin = model.level(2).first_place(last)[index]
    return at, place[at - 1], np.where(place[at] >= 0, place[at] - begin, -1)


def _score(model: Model, token: np.ndarray, text: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
    """log10 of the probability of each text."""
    prob, done = np.zeros(len(token)), np.zeros(len(token), bool)
    if model.tokens:
        two, three = model.level(2), model.level(3)
        at, context, rank = _triples(model, token, text, place)
        index, x, y = _distinct(_joint(context, rank + 1, three.width + 1), three.width + 1)  # 0 is no rank
        found = np.full(len(x), -1, np.int64)
        found[y > 0] = three.find(x[y > 0], y[y > 0] - 1)
        p = np.zeros(len(x))
        hit = found >= 0
        p[hit] = three.prob(found[hit])
        p[~hit] = three.back_off(x[~hit])
        prob[at], done[at] = p[index], hit[index]
        # after the last word alone
        at = np.flatnonzero(~done & (place >= 0))
        prob[at] += two.prob(place[at])
        done[at] = True
        at = np.flatnonzero(~done[1:] & (text[1:] == text[:-1]) & (token[:-1] >= 0)) + 1
        index, last, _ = _distinct(token[at - 1])
        prob[at] += two.back_off(last)[index]
    # by itself
    at = np.flatnonzero(~done)
    count = np.zeros(len(at), np.int64)
    known = token[at] >= 0
    count[known] = model.level1().counts(token[at][known])
    prob[at] += model.word_prob(count)
    return np.bincount(text, prob, rows)


# ---- training

def _rows(parts: DataFrame) -> list[dict]:
    """The list of a level's files, in order: one short row a file."""
    return [{k: ([tuple(x) for x in v] if k == "hot" else v) for k, v in r.asDict().items()} for r in parts.orderBy("part").collect()]


def _train_words(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession

    def count(batches):
        for batch in batches:
            for b in WA.blocks(batch, "text", BLOCK_BYTES):
                found, _ = WA.words(b.column(0), WA.not_blank)
                enc = found.dictionary_encode()
                n = np.bincount(enc.indices.to_numpy(), minlength=len(enc.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([enc.dictionary, pa.array([END], pa.binary())]).cast(pa.string()),
                     pa.array(np.append(n, b.num_rows).astype(np.int64))], ["word", "n"])

    def write(batches):
        from pyspark import TaskContext

        h, count, sizes, text = [], [], [], []
        for b in batches:
            word = b.column(1).cast(pa.binary())
            h.append(b.column(0).to_numpy())
            count.append(b.column(2).to_numpy())
            sizes.append(pc.binary_length(word).to_numpy())
            text += word.to_pylist()
        if not text:
            return
        key, count = np.concatenate(h).view(np.uint64) ^ np.uint64(1 << 63), np.concatenate(count)
        off = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
        raw = np.frombuffer(b"".join(text), np.uint8)
        name = _save(path, "words", [key, count, np.cumsum(count) - count, off, raw])
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]), *[
                pa.array([x], pa.int64()) for x in (len(key), int(key[0].view(np.int64)), int(count.sum()))]],
            ["part", "file", "n", "first", "tokens"])

    t = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # unsigned order of the hash; words of one hash stay together
    t = t.select(F.xxhash64("word").bitwiseXOR(F.lit(-(1 << 63))).alias("__h"), "word", "n")
    t = t.repartitionByRange("__h").sortWithinPartitions("__h", "word")
    t.mapInArrow(write, _WORDS).write.parquet(f"{path}/level1")
    return spark.read.parquet(f"{path}/level1")


def _merged(blobs) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts of packed parts, by key."""
    key, n = zip(*[_unpack(b) for b in blobs], strict=True)
    key, n = np.concatenate(key), np.concatenate(n)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def _count_level(rows: DataFrame, path: str, level: int, keys, parts_of, width: int) -> DataFrame:
    """Count a level's n-grams and write its files without probabilities.

    ``keys(batch)`` gives each n-gram occurrence of a block of encoded rows as
    (parent, child); ``parts_of(parent, child)`` the part of ascending keys.
    """
    spark = rows.sparkSession

    def count(batches):
        for batch in batches:
            for b in WA.blocks(batch, "numbers", BLOCK_BYTES):
                parent, child = keys(b)
                if not len(parent):
                    continue
                key, n = np.unique(parent.astype(np.uint64) * np.uint64(width) + child.astype(np.uint64), return_counts=True)
                part = parts_of((key // np.uint64(width)).astype(np.int64), (key % np.uint64(width)).astype(np.int64))
                cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                ends = np.append(cut[1:], len(key))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[cut].astype(np.int32)), pa.array([_pack(key[s:e], n[s:e]) for s, e in zip(cut, ends, strict=True)], pa.binary())],
                    ["part", "blob"])

    def write(key, t):
        own, n = _merged(t["blob"])
        parent = (own // np.uint64(width)).astype(np.int64)
        lo, hi = int(parent[0]), int(parent[-1])
        kids = np.bincount(parent - lo, minlength=hi - lo + 1)
        pointers = np.concatenate([[0], np.cumsum(kids)])
        local = own - np.uint64(lo) * np.uint64(width)
        sections = [*encode(pointers, len(own) + 1), *encode(local, (hi - lo + 1) * width)]
        # counts are read once more, for the probabilities
        counts = np.frombuffer(_pack(np.zeros(len(n), np.uint64), n), np.uint8)
        hot = np.flatnonzero(n > PART_TOKENS)
        return pd.DataFrame({
            "part": [key[0]], "file": [_save(path, f"level{level}", [*sections, np.array([len(counts)]), counts])], "n": [len(own)],
            "lo": [lo], "hi": [hi], "first_child": [int(own[0] % np.uint64(width))], "last_child": [int(own[-1] % np.uint64(width))],
            "first_kids": [int(kids[0])], "last_kids": [int(kids[-1])], "top": [int(kids.max())],
            "n1": [int((n == 1).sum())], "n2": [int((n == 2).sum())],
            "hot": [[{"place": int(k), "n": int(n[k])} for k in hot]]})

    t = rows.mapInArrow(count, "part int, blob binary")
    t.groupBy("part").applyInPandas(write, _PART).write.parquet(f"{path}/level{level}")
    return spark.read.parquet(f"{path}/level{level}")


def _counts(path: str, p: dict) -> np.ndarray:
    """The counts of a file's n-grams."""
    s = _load(path, p["file"])
    return _unpack(s[7].view(np.uint8)[:int(s[6][0])].tobytes())[1]


def _quantised(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Negative logarithms as bytes, and their step."""
    step = float(-x.min() / 255) if len(x) and x.min() < 0 else 1.0
    return np.round(-x / step).astype(np.uint8), step


def _discount(parts: list[dict]) -> float:
    n1, n2 = (sum(p[c] for p in parts) for c in ("n1", "n2"))
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


def _smooth_level(spark, model: Model, level: int) -> list[dict]:
    """Write the probabilities and back-off weights of a level's files; returns the completed list."""
    parts, path = model.meta[f"level{level}"], model.path
    if not parts:
        return parts
    d = _discount(parts)

    def smooth(batches):
        for b in batches:
            for k in b["k"].tolist():
                lv, p = model.level(level), parts[k]
                own = lv.part(k)
                parents = np.arange(p["lo"], p["hi"] + 1)
                pointers = own.pointers.all().astype(np.int64)
                kids = np.diff(pointers)
                of = np.repeat(np.arange(len(parents)), kids)
                for q in {p["lo"], p["hi"]} & lv.split.keys():
                    kids[q - p["lo"]] = lv.split[q]
                child = (own.children.all() - of.astype(np.uint64) * np.uint64(own.width)).astype(np.int64)
                if level == 2:
                    total = model.level1().counts(parents)
                    lower = model.word_prob(model.level1().counts(child))
                else:
                    two = model.level(2)
                    total = two_counts(p["lo"], p["hi"])
                    # c's pair after b is c's rank on from the first pair of b
                    last, inv = np.unique(two.child_of(p["lo"], p["hi"]), return_inverse=True)
                    lower = two.prob(two.first_place(last)[inv][of] + child)
                back = d * kids / np.maximum(total, 1)
                prob = (_counts(path, p) - d) / total[of] + back[of] * 10 ** lower
                codes, step = _quantised(np.log10(np.minimum(prob, 1)))
                weights, back_step = _quantised(np.log10(np.clip(back, 1e-300, 1)) * (kids > 0))
                yield pd.DataFrame({"k": [k], "codes": [_save(path, f"codes{level}", [codes, weights])], "scale": [[step, back_step]]})

    def two_counts(lo: int, hi: int) -> np.ndarray:
        """Counts of the pairs at the places lo to hi."""
        two = model.level(2)
        first, last = (int(np.searchsorted(two.base, x, side="right")) - 1 for x in (lo, hi))
        n = np.concatenate([_counts(path, two.parts[k]) for k in range(first, last + 1)])
        return n[lo - two.base[first]:hi + 1 - two.base[first]]

    t = spark.range(len(parts), numPartitions=len(parts)).select(F.col("id").cast("int").alias("k"))  # a task for each file
    t.mapInPandas(smooth, "k int, codes string, scale array<double>").write.parquet(f"{path}/codes{level}")
    done = {r.k: r for r in spark.read.parquet(f"{path}/codes{level}").collect()}
    return [p | {"codes": done[k].codes, "scale": list(done[k].scale)} for k, p in enumerate(parts)]


_ROW = "__id string, __train boolean, n_tokens long, n_known long, base_score double, numbers binary"


def _encode_rows(t: DataFrame, model: Model) -> DataFrame:
    """``(__id, __train, text)`` -> ``_ROW``: token numbers of every text, and what words alone give."""
    kind = _kind(model.meta["words"])

    def encode(batches):
        for batch in batches:
            for b in WA.blocks(batch, "text", BLOCK_BYTES):
                token, text, n, known, base = _encoded(model, b)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n), pa.array(known), pa.array(base), _split(token, text, b.num_rows, kind)],
                    ["__id", "__train", "n_tokens", "n_known", "base_score", "numbers"])

    return t.select("__id", "__train", "text").mapInArrow(encode, _ROW)


def _place_rows(rows: DataFrame, model: Model) -> DataFrame:
    """Encoded rows with the places of their pairs."""
    kind, place_kind = _kind(model.meta["words"]), _kind(model.meta["pairs"])

    def place(batches):
        for batch in batches:
            for b in WA.blocks(batch, "numbers", BLOCK_BYTES):
                token, text = _unrolled(b.column(5), kind)
                own = _split(_placed(model, token, text), text, b.num_rows, place_kind) if model.tokens else pa.array([None] * b.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns, own], [*b.schema.names, "places"])

    return rows.mapInArrow(place, f"{_ROW}, places binary")


def _score_rows(rows: DataFrame, model: Model) -> DataFrame:
    """Placed rows -> ``__id, n_tokens, n_known, train_tokens, base_score, score``."""
    kind, place_kind = _kind(model.meta["words"]), _kind(model.meta["pairs"])

    def run(batches):
        for batch in batches:
            for b in WA.blocks(batch, "numbers", BLOCK_BYTES):
                token, text = _unrolled(b.column(5), kind)
                place = _unrolled(b.column(6), place_kind)[0] if model.tokens else np.full(len(token), -1, np.int64)
                score = _score(model, token, text, place, b.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), b.column(3), pa.array(np.full(b.num_rows, model.tokens, np.int64)), b.column(4), pa.array(score)],
                    ["__id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(run, "__id string, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _prepared(docs: DataFrame, is_training: Column, id_col: str | None, text_col: str) -> DataFrame:
    own = F.lit(None).cast("string") if id_col is None else F.col(id_col).cast("string")
    return docs.select(own.alias("__id"), F.coalesce(is_training, F.lit(False)).alias("__train"), whole_text(text_col).alias("text"))


def _train(t: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the training rows of ``(__id, __train, text)``, and all rows, placed."""
    spark = t.sparkSession
    path = shared_path(spark, "ngram-trie")
    fs_, root = _open(path)
    fs_.create_dir(root)
    words = _rows(_train_words(t.where("__train"), path))
    tokens, vocabulary = sum(p["tokens"] for p in words), sum(p["n"] for p in words)
    if vocabulary >= 1 << 32:
        raise ValueError("more than 2**32 words")
    meta = {"stage": 1, "tokens": tokens, "words": vocabulary, "pairs": 0, "level1": words, "level2": [], "level3": [],
            "width2": max(1, vocabulary), "width3": 1}
    model = Model(path, dict(meta))
    rows = stored(_encode_rows(t, model), "encoded")
    if not tokens:
        return model, _place_rows(rows, model)
    n_parts, kind = -(-tokens // PART_TOKENS), _kind(vocabulary)

    def pairs(b):
        token, text = _unrolled(b.column(5), kind)
        at = np.flatnonzero(text[1:] == text[:-1])
        return token[at], token[at + 1]

    def pair_parts(a, b):
        # the share of all pairs before (a, b), if words were independent: ascending, and even for frequent words
        one = model.level1()
        first, of = np.unique(a, return_inverse=True)
        u = one.cumulated(first)[of] + one.counts(first)[of] * (one.cumulated(b) / tokens)
        return np.minimum((u * (n_parts / tokens)).astype(np.int64), n_parts - 1)

    meta["level2"] = _rows(_count_level(rows.where("__train"), path, 2, pairs, pair_parts, meta["width2"]))
    meta |= {"stage": 2, "pairs": sum(p["n"] for p in meta["level2"])}
    model2 = Model(path, dict(meta))
    meta["level2"] = _smooth_level(spark, model2, 2)
    # a parent's children may lie in several files
    meta["width3"] = max([1, *(p["top"] for p in meta["level2"]), *model2.level(2).split.values()])
    meta |= {"stage": 3}
    model3 = Model(path, dict(meta))
    placed = stored(_place_rows(rows, model3), "placed")
    delete_stored(rows)
    place_kind = _kind(meta["pairs"])

    def triples(b):
        token, text = _unrolled(b.column(5), kind)
        _, context, rank = _triples(model3, token, text, _unrolled(b.column(6), place_kind)[0])
        return context, rank

    bounds = _triple_bounds(model3)

    def triple_parts(parent, child):
        return np.searchsorted(bounds, _joint(parent, child, meta["width3"]), side="right")

    meta["level3"] = _rows(_count_level(placed.where("__train"), path, 3, triples, triple_parts, meta["width3"]))
    meta |= {"stage": 4}
    meta["level3"] = _smooth_level(spark, Model(path, dict(meta)), 3)
    meta |= {"stage": 5}
    return Model(path, dict(meta)), placed


def train(docs: DataFrame, is_training: Column, text_col: str = "text") -> Model:
    """A model of the texts of the rows that ``is_training`` holds for."""
    return _train(_prepared(docs, is_training, None, text_col).where("__train"))[0]


def _triple_bounds(model: Model) -> np.ndarray:
    """Keys at which level 3 is cut: where level 2 is, and within the children of a pair with many occurrences."""
    two, width, out = model.level(2), model.meta["width3"], []
    for k, p in enumerate(two.parts):
        out.append(int(two.base[k]) * width)
        for place, n in p["hot"]:
            place += int(two.base[k])
            pieces = -(-n // PART_TOKENS)
            kids = two.kids(int(two.child_of(place, place)[0]))
            out += [place * width + j * kids // pieces for j in range(pieces)] + [(place + 1) * width]
    return np.array(sorted(set(out))[1:], np.uint64)


# ---- scoring

def _named(t: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    return t.withColumn("__id", F.col("__id").cast(docs.schema[id_col].dataType)).withColumnRenamed("__id", id_col)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    rows = _encode_rows(_prepared(docs, F.lit(False), id_col, text_col), model)
    return _named(_score_rows(_place_rows(rows, model), model), docs, id_col)


def train_and_score(docs: DataFrame, is_training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all rows by a model of some: as ``score`` with ``train``, but texts are cut and pairs looked up once."""
    model, placed = _train(_prepared(docs, is_training, id_col, text_col))
    return _named(_score_rows(placed, model), docs, id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that the registered query scores without having learnt it; a null id is not in it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def query(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    t = train_and_score(docs, ~held_out())
    return t.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
