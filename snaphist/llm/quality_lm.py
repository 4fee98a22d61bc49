"""Quality by perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

The model is trained on one half of the trusted documents, all of it. Its counts are tables of sorted n-grams, packed
and hash-sharded: trigrams by their first two words, bigrams by both. Scoring deals the trigrams of the documents, packed per
slice of texts, to the trigram shards and from there to the bigram shards, each next to the counts it asks for; only
sums per document come out. What belongs to single words reaches all tasks. The other half of the trusted documents,
all of it, sets a perplexity limit per language and length class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.llm import words as W
from snaphist.llm.store import fetch, small, table
from snaphist.session import remove_table

# Share of trusted documents whose perplexity is within their language's limit.
QUANTILE = 0.998
# Words seen less often in the sample count as unknown.
MIN_COUNT = 2
# Held-out trusted documents that a length class of a language needs to have a limit of its own.
MIN_HELD = 100
# Words of training text per shard, and shards at least.
SHARD_WORDS = 1 << 20
MIN_SHARDS = 24
# Documents are scored in so many rounds, which bounds the shuffle files that exist at once. Each reads all texts and all counts.
ROUNDS = 8
# Trigrams gathered in a task before they are dealt on.
CHUNK = 1 << 19

UNKNOWN, BEGIN, END = (np.uint64(i) for i in (1, 2, 3))
_FIRST = 4

_PACKED = "shard int, kind int, n int, blob binary, docs binary"
_COUNTS, _ASKED = 0, 1


@dataclass
class Model:
    """Sorted word hashes, word i having code i + 4, what belongs to single codes, and the tables of counts."""

    hashes: np.ndarray
    # Log of the number of words that share the unknown word's probability.
    unknown_kinds: float
    shards: int = MIN_SHARDS
    # Probability by code, and of a code after any: weight of it, and sum of bigram counts.
    p1: np.ndarray = field(default_factory=lambda: np.zeros(0))
    w2: np.ndarray = field(default_factory=lambda: np.zeros(0))
    all2: np.ndarray = field(default_factory=lambda: np.zeros(0))
    d2: tuple[float, ...] = ()
    d3: tuple[float, ...] = ()

    @property
    def vocabulary(self) -> np.ndarray:
        return np.arange(_FIRST, _FIRST + len(self.hashes), dtype=np.uint64)

    @cached_property
    def starts(self) -> np.ndarray:
        """``starts_of`` the hashes, made once by each worker that has the model and not sent."""
        return starts_of(self.hashes)


@dataclass
class Tables:
    """Rows (shard, blob) of (a, b, c, count) by (a, b) and of (b, c, count) by (b, c)."""

    tri: DataFrame
    bi: DataFrame


class Trained(Model):
    """A model with its tables, which stay with the driver's plans."""

    tables: Tables


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("fold")), F.lit(2))


def trusted(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled good and not toxic, each once."""
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null")
    return good.select(F.col("doc_id").cast("long").alias("_id")).distinct()


def starts_of(hashes: np.ndarray) -> np.ndarray:
    """Where the sorted hashes begin that share their leading bits, by the value of these bits; one or two share them on average."""
    bits = max(1, len(hashes).bit_length() - 1)
    return np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.uint32)


def places(hashes: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """As ``np.searchsorted``, the last place for what is beyond it.

    Hashes are spread evenly, so that few steps lead from the first with the same leading bits to the place.
    """
    last = len(hashes) - 1
    at = np.minimum(starts[wanted >> np.uint64(65 - len(starts).bit_length())], last).astype(np.int64)
    who = np.flatnonzero(hashes[at] < wanted)
    while len(who):
        who = who[at[who] < last]
        at[who] += 1
        who = who[hashes[at[who]] < wanted[who]]
    return at


def coded(t: W.Texts, hashes: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Word codes of all texts, two begin marks before and an end mark after each, and their ends."""
    w = W.words(t)
    h = W.hash_spans(t.buf, w.starts, w.ends)
    code = np.full(len(h), UNKNOWN, np.uint32)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1) if starts is None else places(hashes, starts, h)
        code = np.where(hashes[at] == h, at + _FIRST, code).astype(np.uint32)
    n = w.counts()
    ends = np.cumsum(n + 3)
    out = np.full(int(ends[-1]) if len(ends) else 0, BEGIN, np.uint32)
    out[np.arange(len(h)) + 2 + 3 * w.text_of()] = code
    out[ends - 1] = END
    return out, ends


def _trigrams(
    t: W.Texts, hashes: np.ndarray, starts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, c, text) of each word and end mark c after a and b."""
    codes, ends = coded(t, hashes, starts)
    begins = np.r_[0, ends[:-1]].astype(np.int64)
    inside = np.ones(len(codes), bool)
    inside[begins] = inside[begins + 1] = False
    at = np.flatnonzero(inside)
    text = np.repeat(np.arange(len(ends), dtype=np.uint32), ends - begins - 2)
    return codes[at - 2], codes[at - 1], codes[at], text


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte planes one after another, compressed."""
    planes = np.empty(sum(c.nbytes for c in columns), np.uint8)
    at = 0
    for c in columns:
        bits = np.ascontiguousarray(c).view(f"u{c.itemsize}")
        for i in range(c.itemsize):
            planes[at : at + len(c)] = bits >> bits.dtype.type(8 * i)
            at += len(c)
    return pa.compress(planes, "zstd", asbytes=True)


def _unpack(blob: bytes, n: int, kinds: str) -> list[np.ndarray]:
    """Columns of ``kinds``, type letters and sizes such as ``u4u4i8``."""
    types = [np.dtype(kinds[i : i + 2]) for i in range(0, len(kinds), 2)]
    raw = np.frombuffer(pa.decompress(blob, n * sum(k.itemsize for k in types), "zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for k in types:
        column = np.empty(n, k)
        for i in range(k.itemsize):
            column.view(np.uint8)[i :: k.itemsize] = raw[at : at + n]
            at += n
        out.append(column)
    return out


def _summed(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``columns``, sorted, and their sums of ``n``."""
    # The first two words in one key: one sort less.
    keys = [_pair(*columns[:2]), *columns[2:]] if len(columns) > 1 else columns
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _dealt(a: np.ndarray, b: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that rows with keys (a, b) go to, and their places, in order."""
    shard = (W.mix(_pair(a, b)) % np.uint64(shards)).astype(np.uint32)
    order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
    ends = np.cumsum(np.bincount(shard, minlength=shards))
    for s in np.flatnonzero(np.diff(ends, prepend=0)):
        yield int(s), order[ends[s - 1] if s else 0 : ends[s]]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * 5
    names = ["shard", "kind", "n", "blob", "docs"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _gathered(dealt: DataFrame) -> DataFrame:
    """All rows of a shard in one task, counts first."""
    return dealt.repartition("shard").sortWithinPartitions("shard", "kind")


def _added_up(dealt: DataFrame, kinds: str, name: str) -> DataFrame:
    """One row of distinct n-grams per shard, from rows with parts of their counts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in groupby(_rows(batches), itemgetter(0)):
            parts = [_unpack(blob, n, kinds) for _, _, n, blob, _ in rows]
            *columns, n = (np.concatenate(c) for c in zip(*parts))
            columns, n = _summed(columns, n)
            yield _batch([(shard, _COUNTS, len(n), _pack(*columns, n), None)])

    return table(_gathered(dealt).mapInArrow(W.giving_back(read), _PACKED), name)


def _count_trigrams(sample: DataFrame, hashes: np.ndarray, shards: int) -> DataFrame:
    shared = sample.sparkSession.sparkContext.broadcast(hashes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                a, b, c, _ = _trigrams(W.texts(part.column(0)), shared.value)
                (a, b, c), n = _summed([a, b, c], np.ones(len(a), np.int64))
                yield _batch([
                    (s, _COUNTS, len(at), _pack(a[at], b[at], c[at], n[at]), None) for s, at in _dealt(a, b, shards)
                ])

    counted = _added_up(sample.select("text").mapInArrow(W.giving_back(read), _PACKED), "u4u4u4i8", "lm-trigrams")
    shared.destroy()
    return counted


def _count_bigrams(tri: DataFrame, shards: int) -> DataFrame:
    """Of each bigram the number of different words before it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, n, blob, _ in _rows(batches):
            _, b, c, _ = _unpack(blob, n, "u4u4u4i8")
            (b, c), k = _summed([b, c], np.ones(n, np.int64))
            yield _batch([(s, _COUNTS, len(at), _pack(b[at], c[at], k[at]), None) for s, at in _dealt(b, c, shards)])

    return _added_up(tri.mapInArrow(W.giving_back(read), _PACKED), "u4u4i8", "lm-bigrams")


def _tally(df: DataFrame, kinds: str) -> DataFrame:
    """(of, code, n): how many n-grams have a count, 4 at most; of bigrams also sums by word.

    ``of`` is 0 for a count, 1 for the bigrams that end in a word, 2 for the sum of counts of those that
    begin with it, and 3, 4, 5 for how many of those have count 1, 2 or more.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, size, blob, _ in _rows(batches):
            *words, n = _unpack(blob, size, kinds)
            found = [(0, *np.unique(np.minimum(n, 5), return_counts=True))]
            if len(words) == 2:
                found.append((1, *np.unique(words[1], return_counts=True)))
                found.append((2, *((x[0] if isinstance(x, list) else x) for x in _summed([words[0]], n))))
                for i in (1, 2, 3):
                    found.append((2 + i, *np.unique(words[0][np.minimum(n, 3) == i], return_counts=True)))
            for of, code, k in found:
                columns = [pa.array(np.full(len(code), of, np.int32)), pa.array(code.astype(np.int64)), pa.array(k.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["of", "code", "n"])

    return df.mapInArrow(W.giving_back(read), "of int, code long, n long").groupBy("of", "code").agg(F.sum("n").alias("n"))


def _discounts(found: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from the counts of counts."""
    n1, n2, n3, n4 = (max(1, found.get(i, 0)) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.05), i) for i, d in ((0.95, 1 - 2 * y * n2 / n1), (1.9, 2 - 3 * y * n3 / n2), (2.8, 3 - 4 * y * n4 / n3)))


def _discounted(d: tuple[float, ...], n: np.ndarray) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3)]


def train(docs: DataFrame, labels: DataFrame) -> Trained:
    """The model of the training half of the trusted documents, which is all those with an even hashed id."""
    chosen = table(trusted(labels).where(_fold(F.col("_id")) == 0), "lm-chosen")
    sample = table(
        docs.join(small(chosen), docs["doc_id"].cast("long") == F.col("_id")).select("text"), "lm-sample"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                t = W.texts(part.column(0))
                w = W.words(t)
                kinds, n = np.unique(W.hash_spans(t.buf, w.starts, w.ends), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(kinds)), pa.array(n)], names=["h", "n"])

    seen = table(
        sample.mapInArrow(W.giving_back(read), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "lm-words"
    )
    hashes = np.sort(fetch(seen.where(F.col("n") >= MIN_COUNT).select("h"))["h"].to_numpy().view(np.uint64))
    total, rare = seen.agg(F.sum("n"), F.count_if(F.col("n") < MIN_COUNT)).first()
    shards = max(MIN_SHARDS, (total or 0) // SHARD_WORDS)
    tri = _count_trigrams(sample, hashes, shards)
    # The counts are written; what they came from is needed no more.
    for used in (sample, seen, chosen):
        remove_table(used)
    bi = _count_bigrams(tri, shards)
    # Chance of one particular word among those not in the vocabulary.
    model = Trained(hashes, float(np.log(max(1, rare))), shards)
    model.tables = Tables(tri, bi)
    of3 = fetch(_tally(tri, "u4u4u4i8")).to_pandas()
    model.d3 = _discounts(dict(zip(of3["code"], of3["n"])))
    of2 = fetch(_tally(bi, "u4u4i8"))
    of, code, n = (of2[c].to_numpy() for c in ("of", "code", "n"))
    model.d2 = _discounts(dict(zip(code[of == 0], n[of == 0])))

    def by_code(i: int) -> np.ndarray:
        out = np.zeros(_FIRST + len(hashes))
        out[code[of == i]] = n[of == i]
        return out

    uni = by_code(1).astype(np.int64)
    d1 = _discounts(dict(enumerate(np.bincount(np.minimum(uni, 5)).tolist())))
    every = float(uni.sum() or 1)
    spare = float(_discounted(d1, uni).sum() or 1.0)
    floor = spare / every / (np.count_nonzero(uni) + 1)
    model.p1 = (uni - _discounted(d1, uni)) / every + floor
    model.all2 = np.maximum(by_code(2), 1)
    free = sum(d * by_code(3 + i) for i, d in enumerate(model.d2))
    model.w2 = np.where(by_code(2) > 0, free / model.all2, 1.0)
    return model


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` among sorted ``keys``, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class _Contexts:
    """Discounted share of each c after a and b, and the weight of shorter n-grams after them."""

    def __init__(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray, d3: tuple[float, ...]):
        pairs = _pair(a, b)
        new = np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)]
        first, of = np.flatnonzero(new), np.cumsum(new) - 1
        less = _discounted(d3, n)
        total = np.add.reduceat(n, first) if len(first) else n
        self.pairs, self.keys = pairs[first], _pair(of, c)
        self.weight = (np.add.reduceat(less, first) / total if len(first) else less).astype(np.float32)
        self.share = ((n - less) / total[of]).astype(np.float32) if len(first) else less.astype(np.float32)

    def of(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, known = _find(self.pairs, _pair(a, b))
        share, weight = np.zeros(len(a), np.float32), np.ones(len(a), np.float32)
        who = np.flatnonzero(known)
        weight[who] = self.weight[at[who]]
        hit, found = _find(self.keys, _pair(at[who], c[who]))
        share[who[found]] = self.share[hit[found]]
        return share, weight


def _logs(model: Model, bi: tuple, b: np.ndarray, c: np.ndarray, share: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log probabilities from what the trigrams give and sorted bigrams (keys, counts) that hold all (b, c)."""
    keys, n = bi
    at, found = _find(keys, _pair(b, c))
    p2 = model.w2[b] * model.p1[c]
    who = np.flatnonzero(found)
    k = n[at[who]]
    p2[who] += (k - _discounted(model.d2, k)) / model.all2[b[who]]
    return np.log(share + weight * p2) - np.where(c == UNKNOWN, model.unknown_kinds, 0.0)


def _whole(df: DataFrame, kinds: str) -> list[np.ndarray]:
    """All rows of a table of counts that fits into memory, sorted."""
    parts = [_unpack(r.blob, r.n, kinds) for r in df.collect()] or [_unpack(_pack(np.zeros(0, np.uint8)), 0, kinds)]
    *columns, n = (np.concatenate(c) for c in zip(*parts))
    columns, n = _summed(columns, n)
    return [*columns, n]


def trigram_scores(a: np.ndarray, b: np.ndarray, c: np.ndarray, model: Trained) -> np.ndarray:
    """Log probability of each c after a and b by a model whose tables fit into memory."""
    a, b, c = (np.asarray(x).astype(np.uint32) for x in (a, b, c))
    share, weight = _Contexts(*_whole(model.tables.tri, "u4u4u4i8"), model.d3).of(a, b, c)
    first, second, n = _whole(model.tables.bi, "u4u4i8")
    return _logs(model, (_pair(first, second), n), b, c, share, weight)


def _sums(texts: DataFrame, model: Trained, shared: Broadcast) -> DataFrame:
    """(_key, total, n): summed log probability and how many there are of each text; equal texts may add up.

    ``shared`` is the model without its tables.
    """

    def asked(shard: int, at: np.ndarray, columns: list[np.ndarray], text: np.ndarray, keys: np.ndarray) -> tuple:
        text = text[at]
        if len(keys) <= len(text):
            here = np.zeros(len(keys), bool)
            here[text] = True
            own, of = np.flatnonzero(here), (np.cumsum(here) - 1)[text]
        else:
            own, of = np.unique(text, return_inverse=True)
        return shard, _ASKED, len(at), _pack(*(c[at] for c in columns), of.astype(np.uint32)), keys[own].tobytes()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in W.slices(batch, "text", W.SLICE_BYTES // 2):
                # Half-size slices, since a round reads twice the text it did with 16 rounds: the arrays stay as small.
                keys, first = np.unique(part.column(0).to_numpy(), return_index=True)
                a, b, c, text = _trigrams(W.texts(part.column(1).take(pa.array(first))), own.hashes, own.starts)
                order = np.argsort(_pair(a, b))
                columns, text = [x[order] for x in (a, b, c)], text[order]
                yield _batch([asked(s, at, columns, text, keys) for s, at in _dealt(*columns[:2], own.shards)])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value

        def dealt(parts: list[tuple]) -> pa.RecordBatch:
            b, c, share, weight, text, keys = (np.concatenate(x) for x in zip(*parts))
            keys, of = np.unique(keys, return_inverse=True)
            text = of[text]
            order = np.argsort(_pair(b, c))
            columns, text = [x[order] for x in (b, c, share, weight)], text[order]
            return _batch([asked(s, at, columns, text, keys) for s, at in _dealt(*columns[:2], own.shards)])

        none, parts, size, docs = np.zeros(0, np.int64), [], 0, 0
        for _, rows in groupby(_rows(batches), itemgetter(0)):
            known = _Contexts(none, none, none, none, own.d3)
            for _, kind, n, blob, keys in rows:
                if kind == _COUNTS:
                    known = _Contexts(*_unpack(blob, n, "u4u4u4i8"), own.d3)
                    continue
                a, b, c, text = _unpack(blob, n, "u4u4u4u4")
                keys = np.frombuffer(keys, np.int64)
                parts.append((b, c, *known.of(a, b, c), text.astype(np.int64) + docs, keys))
                size, docs = size + n, docs + len(keys)
                if size >= CHUNK:
                    yield dealt(parts)
                    parts, size, docs = [], 0, 0
        if parts:
            yield dealt(parts)

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for _, rows in groupby(_rows(batches), itemgetter(0)):
            known = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for _, kind, n, blob, keys in rows:
                if kind == _COUNTS:
                    b, c, k = _unpack(blob, n, "u4u4i8")
                    known = _pair(b, c), k
                    continue
                b, c, share, weight, text = _unpack(blob, n, "u4u4f4f4u4")
                total = np.bincount(text, _logs(own, known, b, c, share, weight))
                columns = [pa.array(np.frombuffer(keys, np.int64)), pa.array(total), pa.array(np.bincount(text))]
                yield pa.RecordBatch.from_arrays(columns, names=["_key", "total", "n"])

    asking = texts.select("_key", "text").mapInArrow(W.giving_back(ask), _PACKED)
    passed = _gathered(model.tables.tri.unionByName(asking)).mapInArrow(W.giving_back(contexts), _PACKED)
    parts = _gathered(model.tables.bi.unionByName(passed)).mapInArrow(W.giving_back(bigrams), "_key long, total double, n long")
    return parts.groupBy("_key").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit("text"))


def score(docs: DataFrame, fitted: Trained) -> DataFrame:
    """``docs`` without its text, with _key, n_words and perplexity, null where a text has no word.

    Own columns of these names go. Equal texts are scored once in each slice; sums and counts both add up, so
    that their ratio is the same.
    """
    keyed = docs.withColumn("_key", text_key(F.col("text")))
    plain = Model(**{k: getattr(fitted, k) for k in Model.__dataclass_fields__})
    # Sent once for all rounds, and dropped when their sums are written.
    shared = docs.sparkSession.sparkContext.broadcast(plain)
    parts = []
    for i in range(ROUNDS):
        own = keyed.where(F.pmod("_key", F.lit(ROUNDS)) == i)
        parts.append(table(_sums(own, fitted, shared), "lm-sums"))
    shared.destroy()
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    sums = table(sums.select(F.col("_key").alias("_of"), F.col("total").alias("_total"), F.col("n").alias("_n")), "lm-sums")
    for part in parts:
        remove_table(part)

    def count(text: pa.Array) -> pa.Array:
        column = pa.RecordBatch.from_arrays([text], names=["text"])
        counts = [W.words(W.texts(part.column(0))).counts() for part in W.slices(column, "text")]
        return pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64())

    kept = [c for c in docs.columns if c not in ("text", "n_words", "perplexity", "_key")]
    rows = table(keyed.select(*kept, "_key", F.arrow_udf(count, "long")("text").alias("n_words")), "lm-rows")
    scored = rows.join(small(sums), F.col("_key") == F.col("_of"), "left")
    nll = F.when(F.col("n_words") > 0, F.exp(-F.col("_total") / F.col("_n")))
    return scored.select(*kept, "_key", "n_words", nll.alias("perplexity"))


def _length_class(n_words: Column) -> Column:
    """Texts of 1 to 3 words, 4 to 15, 16 to 63 and so on."""
    return F.floor(F.log2(n_words.cast("double")) / 2).cast("int")


def limits(scored: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(lang, class, limit) from the trusted documents outside the training half.

    A length class of a language has its own if at least ``MIN_HELD`` of them are in it. Class null: all lengths;
    lang null too: all languages.
    """
    held = scored.join(
        trusted(labels).where(_fold(F.col("_id")) == 1), F.col("doc_id").cast("long") == F.col("_id")
    )
    held = held.where("perplexity is not null").select("lang", _length_class(F.col("n_words")).alias("class"), "perplexity")
    at = F.percentile_approx("perplexity", quantile, 10000)
    known = held.where("lang is not null")
    by_class = known.groupBy("lang", "class").agg(at.alias("limit"), F.count("*").alias("_held"))
    none = F.lit(None).cast("int").alias("class")
    found = by_class.where(F.col("_held") >= MIN_HELD).drop("_held")
    found = found.unionByName(known.groupBy("lang").agg(at.alias("limit")).select("lang", none, "limit"))
    every = held.agg(at.alias("limit")).select(F.lit(None).cast("string").alias("lang"), none, "limit")
    return table(found.unionByName(every), "limits")


def judge(scored: DataFrame, limit: DataFrame) -> DataFrame:
    """``scored`` with ``limit`` and ``kept``."""
    named = limit.where("lang is not null")
    near = small(named.where("class is not null").select(F.col("lang").alias("_near_lang"), F.col("class").alias("_near_class"), F.col("limit").alias("_near")))
    own = small(named.where("class is null").select(F.col("lang").alias("_lang"), F.col("limit").alias("_own")))
    every = small(limit.where("lang is null").select(F.col("limit").alias("_every"), F.lit(1).alias("_one")))
    rows = scored.withColumns({"_join": F.lit(1), "_class": _length_class(F.col("n_words"))})
    rows = rows.join(near, (F.col("lang") == F.col("_near_lang")) & (F.col("_class") == F.col("_near_class")), "left")
    rows = rows.join(own, F.col("lang") == F.col("_lang"), "left")
    rows = rows.join(every, F.col("_join") == F.col("_one"), "left")
    bound = F.coalesce("_near", "_own", "_every")
    return rows.select(
        *[c for c in scored.columns if c not in ("limit", "kept")],
        bound.alias("limit"),
        (F.col("perplexity").isNotNull() & (bound.isNull() | (F.col("perplexity") <= bound))).alias("kept"),
    )


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, n_words, perplexity, limit, kept) of each row of ``docs``.

    A document is kept if its perplexity is at most the limit of its language and length class: the ``quantile`` of the
    trusted documents that the model has not seen. A class with few takes the limit of its language. A language without any, or a null language, takes the
    limit of all languages; without trusted documents at all nothing is rejected for its
    perplexity. Text that is null or has no word has no perplexity and is not kept. Repeated rows are
    judged alike. Other columns are ignored. An empty table gives no rows.
    """
    scored = table(score(docs.select("doc_id", "lang", "text"), train(docs, labels)), "lm-scores")
    return judge(scored, limits(scored, labels, quantile)).drop("_key")


def keep(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns.

    The texts and languages that are not kept are broadcast as hashes if they are few; otherwise the join shuffles the texts.
    """
    scored = table(score(docs.select("doc_id", "lang", "text"), train(docs, labels)), "lm-scores")
    judged = judge(scored, limits(scored, labels, quantile))
    bad = judged.where(~F.col("kept")).select("_key", F.col("lang").alias("_lang")).distinct()
    same_text = (text_key(docs["text"]) == F.col("_key")) & docs["lang"].eqNullSafe(F.col("_lang"))
    return docs.join(small(table(bad, "lm-rejected")), same_text, "left_anti")
