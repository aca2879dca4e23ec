"""SentencePiece encoding by forward filtering, backward sampling; lossless decoding.

A text's segmentations into vocabulary pieces form a lattice.  A piece of
rank r weighs (r + 1) ** -ALPHA, a character outside the vocabulary becomes
its UTF-8 byte pieces.  Forward filtering sums the weights of all
segmentations of every prefix; backward sampling then draws one
segmentation, each with its share of the total weight.  The random numbers
are a hash of row key and character position, so a row is always segmented
alike, wherever and with whatever other rows it is processed.

No piece of the vocabulary crosses a space or line end from the left, so the
lattice falls apart into words.  A task filters each distinct word once, by
vectors over all words of a batch, and draws for all occurrences at once.

Encoding maps a space to the piece mark and puts one space before the text,
as the vocabulary expects; a literal piece mark goes through byte pieces.
Decoding therefore returns the text exactly.

Cases: null is encoded as null, an empty text as no id.  The row key is the
id column as text (null: the empty key).  Long words without a space are
filtered in place, in bounded blocks.  Repeated rows get the same ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read

#: sharpness of the piece weights: higher prefers longer (earlier learned) pieces
ALPHA = 1.0
SEED = 2024
#: characters of a batch that are sampled together, and table cells per block of words
BLOCK_CHARS, BLOCK_CELLS = 1 << 22, 1 << 21
_MARK, _OUTSIDE = 0x2581, 0x110000
#: words up to so many characters are filtered with plain products
_LINEAR = 32
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64."""
    x = x + _STEP
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Sampler:
    """Vocabulary tables, and encoding and decoding of batches of texts."""

    def __init__(self, path: str, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes_of = np.full(256, -1, np.int32)  # piece of each byte
        self.text_of: list[bytes] = []
        rank, found = 0, {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_of[int(piece[1:-1], 16)] = i
                self.text_of.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text_of.append(b"")
            else:
                self.text_of.append(piece.replace("▁", " ").encode())
                cps = np.frombuffer(piece.encode("utf-32-le"), "<u4")
                if _MARK not in cps[1:] or (cps == _MARK).all():
                    found.setdefault(len(cps), []).append((cps, i, rank))
                rank += 1
        self.longest = max(found)
        self.tables = {}
        for length, rows in found.items():
            h = self._hash(np.concatenate([r[0] for r in rows]).astype(np.int64), length)[::length]
            order = np.argsort(h)
            ids = np.array([r[1] for r in rows], np.int32)[order]
            logw = -alpha * np.log(np.array([r[2] for r in rows])[order] + 1.0)
            # most substrings are no piece: a bitmap of hash bits says so before the search
            maybe = np.zeros(1 << 20, bool)
            maybe[h >> _U(44)] = True
            self.tables[length] = (h[order], ids, logw, maybe)
        self.outside_log = -alpha * np.log(4.0 * n)
        # a factor per character, which all segmentations of a word share, keeps products near one
        self.lift = float(np.mean([-t[2].mean() / k for k, t in self.tables.items() if k <= 4]))
        self.breaks_at_newline = not any(10 in r[0] for rows in found.values() for r in rows)

    def _hash(self, cps: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` characters from every place; the last places are meaningless."""
        c = _mix(cps.astype(np.uint64))
        h = c.copy()
        for k in range(1, length):
            h[:-k] = h[:-k] * _U(0x100000001B3) + c[k:]
        return h

    def _words(self, text: str) -> list[str]:
        import re

        return re.findall(r" *[^ \n]+|\n| +" if self.breaks_at_newline else r" *[^ ]+| +", text)

    def _filter(self, words: list[str]):
        """Forward filtering of words of like length: cumulative draw shares and piece of (length - 1, end, word)."""
        size = np.array([len(w) for w in words])
        m, top = int(size.max()), min(int(size.max()), self.longest)
        cps = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        cps = np.where(cps == _MARK, _OUTSIDE, np.where(cps == 32, _MARK, cps))
        start = np.cumsum(size) - size
        at = np.repeat(np.arange(len(words)), size)
        pos = np.arange(len(cps)) - start[at]
        room = size[at] - pos
        piece = np.full((top, m + 1, len(words)), -1, np.int32)
        weight = np.zeros((top, m + 1, len(words)))
        long = m > _LINEAR
        if long:  # products would leave the range of doubles: logarithms
            weight[:] = -np.inf
        c = _mix(cps.astype(np.uint64))
        h = c.copy()
        for length in range(1, top + 1):
            if length > 1:
                h[:1 - length] = h[:1 - length] * _U(0x100000001B3) + c[length - 1:]
            if length not in self.tables:
                continue
            keys, ids, w, maybe = self.tables[length]
            ok = np.nonzero((room >= length) & maybe[h >> _U(44)])[0]
            k = np.searchsorted(keys, h[ok])
            k[k == len(keys)] = 0
            hit = keys[k] == h[ok]
            ok, k = ok[hit], k[hit]
            piece[length - 1, pos[ok] + length, at[ok]] = ids[k]
            value = w[k] + self.lift * length
            weight[length - 1, pos[ok] + length, at[ok]] = value if long else np.exp(value)
        # a character without a piece of its own: its bytes
        bare = np.nonzero(piece[0, pos + 1, at] < 0)[0]
        piece[0, pos[bare] + 1, at[bare]] = -2
        value = self.outside_log + self.lift
        weight[0, pos[bare] + 1, at[bare]] = value if long else np.exp(value)
        total = np.full((m + 1, len(words)), -np.inf if long else 0.0)
        total[0] = 0.0 if long else 1.0
        share = np.full((top, m + 1, len(words)), 2.0, np.float32)
        with np.errstate(divide="ignore", invalid="ignore"):
            for j in range(1, m + 1):
                n = min(j, top)
                v = weight[:n, j]
                if long:
                    v = v + total[j - 1::-1][:n]
                    high = np.where(np.isfinite(high := v.max(0)), high, 0.0)
                    v = np.exp(v - high)
                else:
                    v = v * total[j - 1::-1][:n]
                s = np.cumsum(v, 0)
                total[j] = high + np.log(s[-1]) if long else s[-1]
                share[:n, j] = s / s[-1]
        return share, piece

    def encode(self, texts: list[str], keys: list[str], seed: int = SEED) -> list[np.ndarray]:
        """Sampled ids of each text."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):  # a bounded number of characters at a time
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= BLOCK_CHARS):
                chars += len(texts[end])
                end += 1
            out += self._encode(texts[at:end], keys[at:end], seed)
            at = end
        return out

    def _encode(self, texts, keys, seed):
        import xxhash

        texts = [" " + t if t else "" for t in texts]
        chars = np.array([len(t) for t in texts])
        first = np.cumsum(chars) - chars  # of each text, among the characters of the block
        words = [w for t in texts for w in self._words(t)]
        if not words:
            return [np.zeros(0, np.int32) for _ in texts]
        index, distinct = pd.factorize(np.array(words, object))
        size = np.array([len(w) for w in distinct])
        end = np.cumsum(size[index])
        start = end - size[index]
        doc = np.searchsorted(np.cumsum(chars), start, side="right")
        row = np.array([xxhash.xxh64_intdigest(k.encode(), seed) for k in keys], np.uint64)
        drawn = np.full(int(chars.sum()), -1, np.int32)  # at a piece's first character: the piece
        # occurrences of each distinct word
        order = np.argsort(index, kind="stable")
        at = np.searchsorted(index[order], np.arange(len(distinct) + 1))
        by_size = np.argsort(size, kind="stable")
        k = 0
        while k < len(by_size):
            m = max(8, 1 << int(size[by_size[k]] - 1).bit_length())
            cells = m * min(m, self.longest)
            last = min(int(np.searchsorted(size[by_size], m, side="right")), k + max(1, BLOCK_CELLS // cells))
            own = by_size[k:last]
            share, piece = self._filter([distinct[i] for i in own])
            flat = share.reshape(len(share), -1)
            occ = np.concatenate([order[at[i]:at[i + 1]] for i in own])
            word = np.repeat(np.arange(len(own)), at[own + 1] - at[own])
            lo, j = start[occ], size[index[occ]]
            # a stream of random numbers per row, one number per character position
            base = row[doc[occ]] + (lo - first[doc[occ]]).astype(np.uint64) * _STEP
            while len(lo):
                u = (_mix(base + j.astype(np.uint64) * _STEP) >> _U(40)).astype(np.float32) * np.float32(2.0 ** -24)
                state = j * len(own) + word
                length = np.ones(len(lo), np.int64)
                for k_share in flat:
                    length += u >= k_share[state]
                length = np.minimum(length, np.minimum(j, len(flat)))
                at_end = j - length
                drawn[lo + at_end] = piece[length - 1, j, word]
                more = np.nonzero(at_end)[0]
                word, j, lo, base = word[more], at_end[more], lo[more], base[more]
            k = last
        return self._collect(texts, chars, drawn)

    def _collect(self, texts, chars, drawn):
        at = np.nonzero(drawn != -1)[0]
        ids = drawn[at]
        bare = np.nonzero(ids == -2)[0]
        n = np.ones(len(ids), np.int64)
        if len(bare):
            cps = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")[at[bare]]
            raw = [chr(c).encode() for c in cps.tolist()]
            n[bare] = [len(r) for r in raw]
            flat = np.repeat(ids, n)
            flat[flat == -2] = self.bytes_of[np.frombuffer(b"".join(raw), np.uint8)]
        else:
            flat = ids
        ends = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(at, np.cumsum(chars))]
        return np.split(flat, ends[:-1])

    def decode(self, ids) -> str:
        """The text that the ids were sampled from."""
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")[1:]


_SAMPLERS: dict = {}


def _sampler(path: str, alpha: float) -> Sampler:
    """One per Python worker."""
    if (path, alpha) not in _SAMPLERS:
        _SAMPLERS[path, alpha] = Sampler(path, alpha)
    return _SAMPLERS[path, alpha]


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    """An Arrow array of id lists; None is null."""
    offsets = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in ids])]).astype(np.int32)
    values = [x for x in ids if x is not None]
    flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int32), pa.int32())
    mask = pa.array([x is None for x in ids], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=mask)


def _encoded(s: Sampler, texts: pa.Array, keys: pa.Array, seed: int) -> list:
    plain = texts.to_pylist()
    ids = s.encode([t or "" for t in plain], keys.to_pylist(), seed)
    return [None if t is None else x for t, x in zip(plain, ids, strict=True)]


def _row_key(id_col: str):
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def encode_sampled(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", to: str = "ids",
                   alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """Add the sampled ids of every whole text; the other columns stay."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        s = _sampler(path, alpha)
        for texts, keys in batches:
            yield _lists(_encoded(s, texts, keys, seed))

    return docs.withColumn(to, F.arrow_udf(run, "array<int>")(F.col(text_col).cast("string"), _row_key(id_col)))


def decode_ids(docs: DataFrame, path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the text of the ids; null stays null."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = _sampler(path, ALPHA)
        for ids in batches:
            yield pa.array([None if x is None else s.decode(x) for x in ids.to_pylist()], pa.string())

    return docs.withColumn(to, F.arrow_udf(run, "string")(F.col(ids_col)))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
               seed: int = SEED) -> DataFrame:
    """``id, n_tokens, lossless, ids``: encode every text, decode the ids and compare, in one pass.

    Rows go through in slices, so no more than a slice's ids are held at a time.
    """
    def run(batches):
        s = _sampler(path, alpha)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                ids = _encoded(s, part["text"], part["key"], seed)
                same = [x is None or s.decode(x.tolist()) == t for x, t in zip(ids, part["text"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array([None if x is None else len(x) for x in ids], pa.int32()),
                     pa.array(same, pa.bool_()), _lists(ids)], ["id", "n_tokens", "lossless", "ids"])

    t = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), _row_key(id_col).alias("key"))
    kind = t.schema["id"].dataType.simpleString()
    out = t.mapInArrow(run, f"id {kind}, n_tokens int, lossless boolean, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir) -> DataFrame:
    """Ids of every text, and whether decoding them gave the text back."""
    return round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"), model_path())
