"""Token-ID output: flat unsigned integer files plus 64-bit document offsets.

Documents are range-partitioned and sorted by id.  The task of partition p
writes three flat little-endian files:

* ``ids-*``: all token ids of its documents, each document closed by the end
  id, as unsigned 16-bit integers if the vocabulary fits, else 32-bit;
* ``offsets-*``: n + 1 unsigned 64-bit offsets, of each document's first id
  within the file and of the end;
* ``docs-*``: n signed 64-bit document ids (``NULL_ID`` for null).

A task reports file name, documents and ids; a window over these few rows
(one per partition) gives each partition's base as a prefix sum.  The bases
are written as the Parquet table ``parts``: only files listed there belong
to the output.  A repeated or speculative attempt writes under another name
and is listed only if it is the one that Spark commits, so lost executors
leave the output right.

Readers map the files into memory (one task per part) and add the base.

Encoding uses the tokenizers library.  The tokenizer splits a normalized text
into pieces before it merges anything, so ids of a text are the ids of its
pieces, one after another.  Texts of plain characters (up to Latin
Extended-A) are split by the same rule here, and the library encodes each
distinct piece once, as long as the worker remembers it (``MEMORY_BITS``);
any other text goes through the library whole.

Cases: null and empty texts are documents of the end id alone.  Null ids
come first, equal ids stay in the order of their rows.  An empty table gives
no part.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, shared_path, whole_text

END_ID = 1
#: how the vocabulary marks the end of a piece
END_MARK = "</w>"
NULL_ID = -(1 << 63)
#: size of a worker's memory of pieces: six tenths of two to this power, some 50 bytes each
MEMORY_BITS = 22
#: characters that are split together
BLOCK_CHARS = 1 << 21


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
_U = np.uint64


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, lower-case form and a random 64-bit code of each character up to Latin Extended-A.

    A text without an odd character is its own NFC form, lower-cases letter by
    letter and has no white space but ASCII's; the last entry stands for all
    further characters, which are odd.
    """
    import unicodedata

    kinds = {"L": _LETTER, "N": _NUMBER}
    cls = []
    for c in range(0x181):
        odd = c < 9 or 13 < c < 32 or 0x7f <= c <= 0xa0 or c in (0x130, 0x180)
        cls.append(_ODD if odd else _SPACE if c <= 32 else kinds.get(unicodedata.category(chr(c))[0], _OTHER))
    low = [c if cls[c] == _ODD else ord(chr(c).lower()) for c in range(0x181)]
    code = np.random.default_rng(9).integers(1, 1 << 63, 0x181, dtype=np.uint64)
    return np.array(cls, np.int8), np.array(low, np.int32), code


def _equal(x: np.ndarray, x_at: np.ndarray, y: np.ndarray, y_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ranges of x and y that begin at these places are equal."""
    owner = np.repeat(np.arange(len(size)), size)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    out = np.ones(len(size), bool)
    out[owner[x[x_at[owner] + within] != y[y_at[owner] + within]]] = False
    return out


class _Memory:
    """Ids of pieces by 64-bit hash, and the pieces, in flat arrays: some 50 bytes a piece."""

    def __init__(self, bits: int, dtype):
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.key = np.zeros(1 << bits, np.uint64)
        self.place = np.zeros(1 << bits, np.int32)
        self.room = (1 << bits) * 6 // 10
        self.offset, self.flat, self.n, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, dtype), 0, 0
        self.text_offset, self.text = np.zeros(1 << 16, np.int64), np.zeros(1 << 19, np.uint16)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 if unknown."""
        out = np.full(len(h), -1, np.int64)
        open_, at = np.arange(len(h)), (h >> self.shift).astype(np.int64)
        while len(open_):
            key = self.key[at]
            hit = key == h[open_]
            out[open_[hit]] = self.place[at[hit]]
            go = ~hit & (key != 0)
            open_, at = open_[go], (at[go] + 1) & self.mask
        return out

    def holds(self, number: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the pieces of these numbers are the given ones: pieces of one hash need not be equal."""
        at, size = self.text_offset[number], end - start
        out = self.text_offset[number + 1] - at == size
        out[out] = _equal(self.text, at[out], low, start[out], size[out])
        return out

    def add(self, h: np.ndarray, ids: list[np.ndarray], pieces: list[str]) -> np.ndarray:
        """Remember distinct unknown pieces; returns their numbers."""
        size = np.array([len(x) for x in ids], np.int64)
        while self.n + len(ids) + 1 > len(self.offset):
            self.offset = np.concatenate([self.offset, np.zeros_like(self.offset)])
            self.text_offset = np.concatenate([self.text_offset, np.zeros_like(self.text_offset)])
        text, at = np.frombuffer("".join(pieces).encode("utf-16-le"), "<u2"), int(self.text_offset[self.n])
        while at + len(text) > len(self.text):
            self.text = np.concatenate([self.text, np.zeros_like(self.text)])
        self.text[at:at + len(text)] = text
        self.text_offset[self.n + 1:self.n + len(ids) + 1] = at + np.cumsum([len(x) for x in pieces])
        while self.used + int(size.sum()) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        number = np.arange(self.n, self.n + len(ids))
        self.offset[number + 1] = self.used + np.cumsum(size)
        self.flat[self.used:self.used + int(size.sum())] = np.concatenate(ids)
        self.n, self.used = self.n + len(ids), self.used + int(size.sum())
        open_, at = np.arange(len(h)), (h >> self.shift).astype(np.int64)
        while len(open_):
            free = self.key[at] == 0
            self.key[at[free]] = h[open_[free]]  # of two that want one slot, one gets it
            own = self.key[at] == h[open_]
            self.place[at[own]] = number[open_[own]]
            open_, at = open_[~own], (at[~own] + 1) & self.mask
        return number


class _Encoder:
    """Ids of whole texts; kept by the worker from task to task.

    The tokenizer's splitting rule (contractions; runs of letters; single
    numbers; runs of anything else but white space) is applied to arrays of
    characters.  Pieces are looked up by 64-bit hashes and then compared;
    each distinct piece is encoded by the library once, while it is remembered.
    A text with a piece whose hash another piece holds goes through whole.
    """

    _BASE = _U(0x9E3779B97F4A7C15)

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        n = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        # the last id of a piece carries the end-of-word mark: joined pieces come apart again there
        self.ends = np.zeros(n + 1, bool)
        for token, i in self.tok.get_vocab().items():
            self.ends[i] = token.endswith(END_MARK)
        self.cls, self.low, self.code = _tables()
        self.memory = _Memory(MEMORY_BITS, self.dtype)
        self._powers(BLOCK_CHARS)

    def _powers(self, n: int):
        """Powers of the odd base and of its inverse modulo 2**64."""
        inverse = _U(pow(int(self._BASE), -1, 1 << 64))
        self.up = np.cumprod(np.concatenate([[_U(1)], np.full(n, self._BASE)]), dtype=np.uint64)
        self.down = np.cumprod(np.concatenate([[_U(1)], np.full(n, inverse)]), dtype=np.uint64)

    def split(self, cps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of lower-cased plain characters, and those characters."""
        low, cls = self.low[cps], self.cls[cps]
        begin = np.ones(len(cps), bool)
        begin[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == _NUMBER)
        # contractions: an apostrophe that begins and ends a run, then certain letters
        far = np.concatenate([low, [32, 32]])
        at = np.nonzero(begin & (low == 39))[0]
        at = at[cls[np.minimum(at + 1, len(cls) - 1)] == _LETTER]
        one, two = far[at + 1], far[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for hit, size in ((at[short], 2), (at[long], 3)):
            begin[hit + 1] = False
            after = hit + size
            after = after[after < len(cls)]
            begin[after[cls[after] == _LETTER]] = True
        starts = np.nonzero(begin & (cls != _SPACE))[0]
        edges = np.append(np.nonzero(begin)[0], len(cps))
        return starts, edges[np.searchsorted(edges, starts, side="right")], low

    def _learn(self, pieces: list[str]) -> list[np.ndarray]:
        ids = np.array(self.tok.encode(" ".join(pieces), add_special_tokens=False).ids, self.dtype)
        cuts = np.nonzero(self.ends[ids])[0] + 1
        if len(cuts) == len(pieces) and cuts[-1] == len(ids):
            return np.split(ids, cuts[:-1])
        return [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _known(self, h: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers, in the memory, of pieces of distinct hashes, and which of them are other pieces there."""
        number = self.memory.find(h)
        missing = np.nonzero(number < 0)[0]
        if self.memory.n + len(missing) > self.memory.room:  # full: start afresh
            self.memory = _Memory(MEMORY_BITS, self.dtype)
            missing = np.arange(len(h))
        other = np.zeros(len(h), bool)
        held = np.setdiff1d(np.arange(len(h)), missing, assume_unique=True)
        other[held] = ~self.memory.holds(number[held], low, start[held], end[held])
        if len(missing):
            pieces = [low[s:e].astype("<u4").tobytes().decode("utf-32-le") for s, e in zip(start[missing], end[missing], strict=True)]
            ids = [x for at in range(0, len(missing), 4096) for x in self._learn(pieces[at:at + 4096])]
            number[missing] = self.memory.add(h[missing], ids, pieces)
        return number, other

    def batches(self, texts):
        """Ids of each text in turn, a bounded number of characters at a time."""
        block, chars = [], 0
        for t in texts:
            if block and chars + len(t) + 1 > BLOCK_CHARS:
                yield from self._block(block)
                block, chars = [], 0
            block.append(t)
            chars += len(t) + 1
        yield from self._block(block)

    def _block(self, texts: list[str]):
        if not texts:
            return
        cps = np.frombuffer("\n".join(texts).encode("utf-32-le"), "<u4")
        cps = np.minimum(cps, 0x180).astype(np.int32)
        text_end = np.cumsum([len(t) + 1 for t in texts])
        odd = {int(k) for k in np.unique(np.searchsorted(text_end, np.nonzero(self.cls[cps] == _ODD)[0], side="right"))}
        odd |= {k for k, t in enumerate(texts) if "<|" in t or len(t) >= BLOCK_CHARS}
        if not odd:
            yield from self._plain(cps, text_end, texts)
            return
        rest = self._block([t for k, t in enumerate(texts) if k not in odd])
        for k, t in enumerate(texts):
            yield np.array(self.tok.encode(t, add_special_tokens=False).ids, self.dtype) if k in odd else next(rest)

    def _plain(self, cps: np.ndarray, text_end: np.ndarray, texts: list[str]):
        if not len(cps):
            yield from (np.zeros(0, self.dtype) for _ in text_end)
            return
        starts, ends, low = self.split(cps)
        # hash of a piece: its part of a running sum, moved back to power zero
        run = np.concatenate([[_U(0)], np.cumsum(self.code[low] * self.up[:len(low)], dtype=np.uint64)])
        h = ((run[ends] - run[starts]) * self.down[starts]) | _U(1)
        index, distinct = pd.factorize(h)
        first = np.zeros(len(distinct), np.int64)
        first[index[::-1]] = np.arange(len(index))[::-1]
        # every piece is compared with the one that stands for its hash
        size = ends - starts
        wrong = size != size[first][index]
        same = np.flatnonzero(~wrong)
        wrong[same] = ~_equal(low, starts[same], low, starts[first][index[same]], size[same])
        number, other = self._known(distinct, low, starts[first], ends[first])
        wrong |= other[index]
        whole = set(np.searchsorted(text_end, starts[wrong], side="right").tolist())
        m = self.memory
        place, size = m.offset[number], m.offset[number + 1] - m.offset[number]
        n = size[index]
        done = np.cumsum(n)
        ids = m.flat[np.repeat(place[index] - (done - n), n) + np.arange(done[-1] if len(done) else 0)]
        # each text's pieces are those that start in it
        cuts = np.concatenate([[0], done])[np.searchsorted(starts, text_end)]
        for k, own in enumerate(np.split(ids, cuts[:-1])):
            yield np.array(self.tok.encode(texts[k], add_special_tokens=False).ids, self.dtype) if k in whole else own


_ENCODERS: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID) -> DataFrame:
    """Write the files below ``path``; returns the written table of parts with their bases."""
    spark = docs.sparkSession

    def write(batches):
        from pyspark import TaskContext

        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        enc, fs_, root, ids, off, ends, doc_ids, n = None, None, None, None, None, None, None, 0
        for b in batches:
            if not len(b):
                continue
            if enc is None:  # no file for an empty partition
                enc = _encoder(tokenizer)
                fs_, root = _open(path)
                ids, off, doc_ids = (fs_.open_output_stream(f"{root}/{k}-{part:05d}-{name}") for k in ("ids", "offsets", "docs"))
                end, at, held, sizes = np.array([end_id], enc.dtype).tobytes(), 0, [], [0]
            doc_ids.write(b["__id"].to_numpy(np.int64).astype("<i8").tobytes())
            for x in enc.batches(b["__text"]):
                held += [x.tobytes(), end]
                at += len(x) + 1
                sizes.append(at)
                n += 1
                if len(sizes) > 1 << 12:
                    ids.write(b"".join(held))
                    off.write(np.array(sizes, "<u8").tobytes())
                    held, sizes = [], []
        if enc is None:
            return
        ids.write(b"".join(held))
        off.write(np.array(sizes, "<u8").tobytes())
        for f in (ids, off, doc_ids):
            f.close()
        yield pd.DataFrame({"part": [part], "file": [f"{part:05d}-{name}"], "docs": [n], "ids": [at],
                            "width": [enc.dtype.itemsize]})

    fs_, root = _open(path)
    fs_.create_dir(root)
    t = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("__id"),
                    whole_text(text_col).alias("__text"), F.monotonically_increasing_id().alias("__tie"))
    # the row number spreads one id that holds many rows over several partitions
    t = t.repartitionByRange("__id", "__tie").sortWithinPartitions("__id", "__tie").drop("__tie")
    t.mapInPandas(write, "part int, file string, docs long, ids long, width int").write.parquet(f"{path}/written")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    spark.read.parquet(f"{path}/written").select(
        "*", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("doc_base"),
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("id_base")).write.parquet(f"{path}/parts")
    return spark.read.parquet(f"{path}/parts")


def _mapped(fs_, file: str, dtype) -> np.ndarray:
    """The file as an array: mapped into memory where it is local, else read."""
    from pyarrow import fs as pafs

    if isinstance(fs_, pafs.LocalFileSystem):
        import os

        return np.memmap(file, dtype, mode="r") if os.path.getsize(file) else np.zeros(0, dtype)
    with fs_.open_input_file(file) as f:
        return np.frombuffer(f.read(), dtype)


def read_token_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id, doc_no, start, n_tokens, ids_crc32`` and, if asked for, ``ids``."""
    def documents(batches):
        fs_, root = _open(path)
        for b in batches:
            for r in b.itertuples():
                flat = _mapped(fs_, f"{root}/ids-{r.file}", f"<u{r.width}")
                off = _mapped(fs_, f"{root}/offsets-{r.file}", "<u8").astype(np.int64)
                doc_ids = _mapped(fs_, f"{root}/docs-{r.file}", "<i8")
                for s in range(0, r.docs, 1024):
                    e = min(s + 1024, r.docs)
                    own = [flat[off[k]:off[k + 1]].astype("<u4") for k in range(s, e)]
                    out = {"doc_id": pd.array(doc_ids[s:e], "Int64"), "doc_no": r.doc_base + np.arange(s, e),
                           "start": r.id_base + off[s:e], "n_tokens": np.diff(off[s:e + 1]),
                           "ids_crc32": [zlib.crc32(x.tobytes()) for x in own]}
                    if with_ids:
                        out["ids"] = [x.astype(np.int64) for x in own]
                    yield pd.DataFrame(out)

    parts = spark.read.parquet(f"{path}/parts")
    n = max(1, parts.count())
    t = parts.repartition(n, "part").mapInPandas(
        documents, "doc_id long, doc_no long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    return t.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))


def query(spark, sf_dir) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer_path())
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
