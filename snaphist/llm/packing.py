"""Packing documents into fixed-length sequences along a space-filling curve.

A document's words are hashed into a vector, which a fixed random projection takes to a few dimensions.
Its place on the Hilbert curve through them is its sort key. Documents are dealt to ranges of
the curve, sorted there, and laid end to end: the stream is cut every ``length`` ids, so only its
very end is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.llm import words as W
from snaphist.llm.store import table

LENGTH = 4096
END = 2

HASHED = 256
DIMENSIONS = 4
BITS = 12

# Ids of one range of the curve, which a task sorts and cuts; about 16 MB.
RANGE_TOKENS = 8_000_000

# Encoded units kept by a Python worker.
MAX_CACHED = 1_000_000

# Units given to the tokenizer at once. What it returns for each is about a kilobyte until its ids are taken out.
ENCODED_AT_ONCE = 8192

_TOKENS = "doc_id long, row_id long, key long, n long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long"
)


def _kinds() -> np.ndarray:
    """Classes of bytes: 1 letter, 2 digit, 3 other ASCII, 4 apostrophe, 5 beyond ASCII, 0 space."""
    kind = np.full(256, 3, np.uint8)
    kind[128:] = 5
    kind[97:123] = kind[65:91] = 1
    kind[48:58] = 2
    kind[39] = 4
    kind[W.SPACE] = 0
    return kind


_KIND = _kinds()


def _parts() -> np.ndarray:
    """Pairs of neighbouring classes between which a text can be cut without changing its ids."""
    cut = np.zeros((6, 6), bool)
    cut[1, 2] = cut[2, 1] = cut[2, 2] = cut[1, 3] = cut[3, 1] = cut[2, 3] = cut[3, 2] = True
    cut[5, 3] = False
    return cut


_CUT = _parts()


def units(t: W.Texts) -> W.Words:
    """Words cut further where a tokenizer splits by letter, digit and other ASCII signs anyway.

    No cut touches an apostrophe or a character beyond ASCII, whose class depends on more.
    """
    w = W.words(t)
    kind = _KIND[t.buf]
    inner = np.flatnonzero(_CUT[kind[:-1], kind[1:]]) + 1 if len(kind) > 1 else np.zeros(0, np.int64)
    edge = np.zeros(len(kind) + 1, bool)
    edge[t.offsets] = True
    inner = inner[~edge[inner]]
    starts = np.sort(np.concatenate([w.starts, inner]))
    ends = np.sort(np.concatenate([w.ends, inner]))
    return W.Words(starts, ends, np.searchsorted(starts, t.offsets))


class Encoder:
    """Token ids of whole texts, encoding each distinct unit once.

    Exact for tokenizers that lower-case, drop white space and split at the boundaries of ``units``;
    ``by_units=False`` encodes each text as it is, for any other.
    """

    def __init__(self, path: str, by_units: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.by_units = by_units
        # Units seen, by their sorted hashes: where their ids are in the store, and how many.
        self.keys = np.zeros(0, np.uint64)
        self.begin = self.size = np.zeros(0, np.int64)
        self.store = np.zeros(0, self.kind)

    def encode(self, t: W.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        if not self.by_units:
            whole = [t.buf[a:b].tobytes().decode() for a, b in zip(t.offsets, t.offsets[1:])]
            ids = [e.ids for e in self.tokenizer.encode_batch(whole, add_special_tokens=False)]
            counts = np.array([len(i) for i in ids], np.int64)
            flat = [np.array(i, self.kind) for i in ids]
            return np.concatenate([np.zeros(0, self.kind), *flat]), counts
        u = units(t)
        h = W.hash_spans(t.buf, u.starts, u.ends)
        distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
        begin, size, store = self._looked_up(t, u, distinct, first)
        ids = W.take_spans(store, begin[which], (begin + size)[which])
        each = size[which]
        total = np.concatenate([[0], np.cumsum(each)])
        return ids, total[u.first[1:]] - total[u.first[:-1]]

    def _looked_up(self, t, u: W.Words, distinct: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where the ids of each distinct unit begin in a store, how many they are, and the store."""
        at = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        known = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        begin, size = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        begin[known], size[known] = self.begin[at[known]], self.size[at[known]]
        new = np.flatnonzero(~known)
        if not len(new):
            return begin, size, self.store
        flat = [self.store]
        for i in range(0, len(new), ENCODED_AT_ONCE):
            some = new[i : i + ENCODED_AT_ONCE]
            where = first[some]
            spans = [t.buf[a:b].tobytes().decode() for a, b in zip(u.starts[where], u.ends[where])]
            made = [e.ids for e in self.tokenizer.encode_batch_fast(spans, add_special_tokens=False)]
            size[some] = [len(ids) for ids in made]
            flat.append(np.fromiter((i for ids in made for i in ids), self.kind, int(size[some].sum())))
        begin[new] = len(self.store) + np.cumsum(size[new]) - size[new]
        store = np.concatenate(flat)
        if len(self.keys) + len(new) > MAX_CACHED:
            # The units of this slice are the first of a new cache.
            self.keys, self.begin, self.size, self.store = distinct, begin, size, store
            if len(store) > 16 * MAX_CACHED:
                self.keys, self.begin, self.size, self.store = distinct[:0], begin[:0], size[:0], store[:0]
        else:
            place = np.searchsorted(self.keys, distinct[new])
            self.keys, self.store = np.insert(self.keys, place, distinct[new]), store
            self.begin = np.insert(self.begin, place, begin[new])
            self.size = np.insert(self.size, place, size[new])
        return begin, size, store


@lru_cache(maxsize=1)
def encoder(path: str, by_units: bool) -> Encoder:
    """One per Python worker, which serves many tasks."""
    return Encoder(path, by_units)


def vectors(t: W.Texts) -> np.ndarray:
    """Hashed word counts, damped, of unit length; a text without words is the zero vector."""
    t = W.Texts(W._LOWER[t.buf], t.offsets)
    w = W.words(t)
    h = W.hash_spans(t.buf, w.starts, w.ends)
    cell = w.text_of() * HASHED + (h % np.uint64(HASHED)).astype(np.int64)
    sign = 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(float)
    v = np.bincount(cell, sign, len(t) * HASHED).reshape(len(t), HASHED)
    v = np.sign(v) * np.sqrt(np.abs(v))
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def project(v: np.ndarray) -> np.ndarray:
    """A fixed random projection to whole coordinates of ``BITS`` bits."""
    axes = np.random.default_rng(0).standard_normal((HASHED, DIMENSIONS))
    spread = 1 << BITS
    return np.clip((v @ axes + 3) / 6 * spread, 0, spread - 1).astype(np.int64)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point on the Hilbert curve: Gray code of the axes, undone level by level."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for i in range(n):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = top
    while level > 1:
        turn ^= np.where((x[n - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def tokenised(docs: DataFrame, path: str, end: int, by_units: bool) -> DataFrame:
    """(doc_id, row_id, key, n, ids) of each row, written once.

    The key is the place on the curve with 15 bits of chance below it, so equal texts, however many,
    fall into many ranges. ``ids`` end with ``end``.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, by_units)
        made = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in W.slices(batch, "text", W.SMALL_SLICE_BYTES):
                t = W.texts(part.column(1))
                flat, counts = coder.encode(t)
                stop = np.cumsum(counts)
                ids = np.insert(flat, stop, end)
                edges = np.concatenate([[0], np.cumsum(counts + 1)]) * ids.itemsize
                data = ids.tobytes()
                row = np.arange(made, made + len(t))
                made += len(t)
                chance = (W.mix(row.astype(np.uint64)) >> np.uint64(49)).astype(np.int64)
                key = (hilbert(project(vectors(t)), BITS) << 15) | chance
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(row),
                        pa.array(key),
                        pa.array(counts + 1),
                        pa.array([data[a:b] for a, b in zip(edges, edges[1:])], pa.binary()),
                    ],
                    names=["doc_id", "row_id", "key", "n", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return table(rows.mapInArrow(W.giving_back(encode), _TOKENS), "tokens")


def _ranges(tokens: DataFrame, range_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Borders of even ranges of the curve and the first id of each range in the whole stream."""
    total = tokens.agg(F.sum("n")).first()[0] or 0
    count = max(1, -(-total // range_tokens))
    levels = [i / count for i in range(1, count)]
    borders = np.unique(tokens.approxQuantile("key", levels, 0.1 / count) if levels else []).astype(np.int64)
    by_range = tokens.groupBy(_range_of(borders)(F.col("key")).alias("r")).agg(F.sum("n").alias("n"))
    sizes = np.zeros(len(borders) + 1, np.int64)
    # One row per range, a range being millions of ids.
    for r, n in by_range.collect():
        sizes[r] = n
    return borders, np.cumsum(sizes) - sizes


def _range_of(borders: np.ndarray):
    def place(key: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(borders, key.to_numpy(), side="right"))

    return F.arrow_udf(place, "long")


def pack(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    end: int = END,
    by_units: bool = True,
    range_tokens: int = RANGE_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), with the ids themselves as
    unsigned 32-bit values if ``with_ids``. ``start`` is where the piece begins in its document,
    ``offset`` where in its sequence; each id lies in one piece. Null text counts as empty and gives the end id
    alone, as does an empty one; a null doc_id is kept. A document longer than a sequence spans several.
    Repeated rows are packed each. Other columns, whatever their names, are ignored. An empty table gives
    no rows. The last sequence alone may be shorter than ``length``.
    """
    from tokenizers import Tokenizer

    tokens = tokenised(docs, path, end, by_units)
    kind = np.uint16 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else np.uint32
    borders, firsts = _ranges(tokens, range_tokens)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, at = None, 0
        for part in (part for batch in batches for part in W.slices(batch, "ids", W.SMALL_SLICE_BYTES)):
            out: list[tuple] = []
            columns = [part.column(c) for c in ("doc_id", "n", "ids", "_range")]
            for doc, n, ids, r in zip(*(c.to_pylist() for c in columns)):
                if r != current:
                    current, at = r, int(firsts[r])
                values = np.frombuffer(ids, kind).astype("<u4")
                begin = 0
                while begin < n:
                    sequence, offset = divmod(at + begin, length)
                    size = min(length - offset, n - begin)
                    data = values[begin : begin + size].tobytes()
                    piece = (doc, begin, size, zlib.crc32(data), n, sequence, offset)
                    out.append((*piece, data) if with_ids else piece)
                    begin += size
                at += n
            columns = list(zip(*out))
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: len(columns)],
            )

    placed = tokens.withColumn("_range", _range_of(borders)(F.col("key")))
    return (
        placed.repartition(len(borders) + 1, "_range")
        .sortWithinPartitions("_range", "key", "row_id")
        .select("doc_id", "n", "ids", "_range")
        .mapInArrow(W.giving_back(cut), _PIECES + (", ids binary" if with_ids else ""))
    )
