"""Words of whole texts as arrays: bounds, hashes and counts for many documents at once.

Everything works on UTF-8 bytes, which is exact for patterns of ASCII characters: no byte of a
longer character is below 0x80. Texts are taken in slices of a few megabytes, so that the arrays
stay small whatever the size of an Arrow batch; one text is never cut.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
# For work whose arrays are many times the text, such as a hash for each run of words.
SMALL_SLICE_BYTES = 1 << 20

# The longest word hashed eight bytes at a time along with all others; longer ones go one by one.
_LANE_BYTES = 64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Texts:
    """Bytes of consecutive texts; text i is ``buf[offsets[i]:offsets[i + 1]]``."""

    buf: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Word w is ``buf[starts[w]:ends[w]]``; text i has words ``first[i]`` to ``first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def texts(column: pa.Array, lower: bool = False) -> Texts:
    """The bytes of a string column, null as empty, A-Z lower-cased on demand."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if binary else pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return Texts(_LOWER[buf] if lower else buf, offsets - offsets[0])


def give_back() -> None:
    """Return the memory that this worker has freed to the system; it stays, idle, while others work."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(read: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``read``, which maps a task's batches; after the last one its arrays are gone and their memory is given back."""

    @wraps(read)
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from read(batches)
        give_back()

    return mapped


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes of text, of one row at least."""
    at = batch.schema.get_field_index(column)
    sizes = np.diff(texts(batch.column(at)).offsets)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def spans(t: Texts, inside: np.ndarray) -> Words:
    """Maximal runs of bytes marked in ``inside`` (a mask by byte value), ending with each text."""
    marked = inside[t.buf]
    n = len(marked)
    cut = np.zeros(n + 1, bool)
    cut[t.offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = marked[:-1]
    starts = np.flatnonzero(marked & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = marked[1:]
    ends = np.flatnonzero(marked & (~after | cut[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, t.offsets))


def words(t: Texts) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return spans(t, ~SPACE)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    lanes = np.ndarray(len(buf) + 1, "<u8", padded.data, 0, (1,))
    size = (ends - starts).astype(np.uint64)
    out = mix(size + _STEP)
    at, left, who = starts, ends - starts, None
    for _ in range(_LANE_BYTES // 8):
        value = lanes[at] & _MASKS[np.minimum(left, 8)]
        if who is None:
            out = mix(out * _STEP ^ value)
        else:
            out[who] = mix(out[who] * _STEP ^ value)
        keep = np.flatnonzero(left > 8)
        if not len(keep):
            break
        who = keep if who is None else who[keep]
        at, left = at[keep] + 8, left[keep] - 8
    for i in np.flatnonzero(size > _LANE_BYTES):
        digest = hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.uint64(int.from_bytes(digest, "little"))
    return out


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each ``k`` consecutive values; entry i covers i to i + k - 1."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        out = mix(out * _STEP + h[j : j + n])
    return out


def run_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which ``k`` words of one text begin, and how many each text has."""
    n = np.maximum(0, np.diff(first) - k + 1)
    total = int(n.sum())
    shift = np.repeat(first[:-1] - (np.cumsum(n) - n), n)
    return np.arange(total) + shift, n


def take_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of all spans one after another."""
    size = ends - starts
    total = int(size.sum())
    return buf[np.arange(total) + np.repeat(starts - (np.cumsum(size) - size), size)]


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return h.view(np.int64)
