"""Repeated word sequences by prefix-partitioned suffix trees.

The suffixes of all texts that begin at sampled places are split by their first words. Prefixes met in
one document only have no repeat below them and go at once. Of those left, a group of ordinary size
is one subtree: its suffixes are sorted by their words, ranked exactly by doubling, and neighbours whose common
prefix is ``length`` words or longer lie below one deep internal node, which knows the smallest document below it. A
large group is split by a prefix longer by up to the whole ``length``; at that depth a node's rows are
all alike, so its smallest document is a plain aggregate over the words themselves.

A place is sampled if its prefix hashes lowest among those of some window of ``length`` words.
Equal windows sample the same place, so each repeat of ``length`` words begins at a suffix that is kept. Hashes say
only which suffixes meet in a group; that words are equal is found by comparing words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.llm import words as W
from snaphist.llm.store import fetch, same, table

LENGTH = 13
# Words of the first prefix.
PREFIX = 8
# A prefix with more suffixes than this is split by longer prefixes, up to whole windows.
GROUP_ROWS = 100_000


# Prefixes known to the tasks at once, at most; beyond that they are joined by a shuffle.
MAX_BROADCAST_PREFIXES = 4_000_000

_SUFFIX = "key long, large boolean, span binary, doc_id long, row_key long, start long"


def sampled(h: np.ndarray, first: np.ndarray, length: int, prefix: int):
    """(window starts, sampled place of each, prefix hashes by word) for windows of ``length`` words."""
    starts, n = W.run_starts(first, length)
    grams = W.runs(h, prefix)
    if not len(starts):
        return starts, starts, grams, n
    width = length - prefix + 1
    best, place = grams[starts].copy(), starts.copy()
    for j in range(1, width):
        g = grams[starts + j]
        lower = g < best
        best[lower] = g[lower]
        place[lower] = starts[lower] + j
    return starts, place, grams, n


def hashed(t: W.Texts, bits: int = 64) -> tuple[W.Words, np.ndarray]:
    w = W.words(t)
    return w, W.hash_spans(t.buf, w.starts, w.ends) >> np.uint64(64 - bits)


def _rows(docs: DataFrame) -> DataFrame:
    """Texts under a name that rows share only if they agree in doc_id and text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_key"),
        "text",
    )


def _places(docs: DataFrame, length: int, prefix: int, columns: list[str], bits: int) -> DataFrame:
    """(key, doc_id, row_key, place) of the sampled suffixes of each text; ``place`` counts words."""
    kinds = {"key": "long", "doc_id": "long", "row_key": "long", "place": "long"}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                w, h = hashed(W.texts(part.column(2)), bits)
                _, place, grams, n = sampled(h, w.first, length, prefix)
                # Windows of a text that share a place stand in a row.
                keep = np.r_[True, place[1:] != place[:-1]][: len(place)]
                place, row = place[keep], np.repeat(np.arange(len(n)), n)[keep]
                found = {
                    "key": lambda: pa.array(W.signed(grams[place])),
                    "doc_id": lambda: part.column(0).take(pa.array(row)),
                    "row_key": lambda: part.column(1).take(pa.array(row)),
                    "place": lambda: pa.array(place - w.first[row]),
                }
                yield pa.RecordBatch.from_arrays([found[c]() for c in columns], names=columns)

    return _rows(docs).mapInArrow(read, ", ".join(f"{c} {kinds[c]}" for c in columns))


def prefixes(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, bits: int = 64) -> DataFrame:
    """(key, n): prefixes of sampled suffixes that occur in several documents, and how often."""
    found = _places(docs, length, prefix, ["key", "doc_id"], bits).groupBy("key").agg(
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
        F.count("*").alias("n"),
        F.count("doc_id").alias("named"),
    )
    # A null doc_id is above all others, and not above another null.
    return found.where("low < high or (named > 0 and named < n)").select("key", "n")


def _binary(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of ``buf`` as one binary column."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    data = W.take_spans(buf, starts, ends)
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    )


def _joined(t: W.Texts, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """All words, each followed by one space, and where each begins."""
    size = w.ends - w.starts + 1
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.full(int(at[-1]), 32, np.uint8)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = W.take_spans(t.buf, w.starts, w.ends)
    return out, at


def _suffix_rows(part: pa.RecordBatch, length: int, prefix: int, bits: int, wanted) -> pa.RecordBatch:
    """Suffixes of one slice with a repeated prefix, each with the words that its windows span.

    ``wanted(key, place, w)`` tells for each window whether its prefix is repeated, and if it is large.
    A large one gives a row per window.
    """
    t = W.texts(part.column(2))
    w, h = hashed(t, bits)
    starts, place, grams, n = sampled(h, w.first, length, prefix)
    row = np.repeat(np.arange(len(n)), n)
    hit, large = wanted(grams[place], place, w)
    starts, place, row, large = starts[hit], place[hit], row[hit], large[hit]
    head = np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)][: len(place)] | large
    first = np.flatnonzero(head)
    last = np.r_[first[1:], len(place)] - 1
    key = W.signed(np.where(large, W.runs(h, length)[starts], grams[place]) if len(starts) else np.zeros(0, np.uint64))
    text, at = _joined(t, w)
    spans = _binary(text, at[starts[first]], at[starts[last] + length] - 1) if len(first) else pa.array([], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key[first]),
            pa.array(large[first]),
            spans,
            part.column(0).take(pa.array(row[first])),
            part.column(1).take(pa.array(row[first])),
            pa.array((starts - w.first[row])[first]),
        ],
        names=["key", "large", "span", "doc_id", "row_key", "start"],
    )


def suffixes(
    docs: DataFrame,
    repeated: DataFrame,
    length: int = LENGTH,
    prefix: int = PREFIX,
    group_rows: int = GROUP_ROWS,
    max_broadcast: int = MAX_BROADCAST_PREFIXES,
    bits: int = 64,
) -> DataFrame:
    """(key, large, span, doc_id, row_key, start) of the suffixes with a repeated prefix."""
    if repeated.limit(max_broadcast + 1).count() <= max_broadcast:
        known = fetch(repeated.select("key", (F.col("n") > group_rows).alias("large")))
        keys, large = known["key"].to_numpy().view(np.uint64), known["large"].to_numpy()
        order = np.argsort(keys)
        shared = docs.sparkSession.sparkContext.broadcast((keys[order], large[order]))

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, big = shared.value

            def wanted(key, place, w):
                if not len(keys):
                    return np.zeros(len(key), bool), np.zeros(len(key), bool)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                return hit, hit & big[at]

            for batch in batches:
                for part in W.slices(batch, "text"):
                    yield _suffix_rows(part, length, prefix, bits, wanted)

        return _rows(docs).mapInArrow(read, _SUFFIX)

    places = _places(docs, length, prefix, ["key", "doc_id", "row_key", "place"], bits)
    per_row = (
        places.join(repeated.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"))
        .select("doc_id", "row_key", F.struct("place", (F.col("n") > group_rows).alias("large")).alias("at"))
        .groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_row"))
        .agg(F.array_sort(F.collect_set("at")).alias("at"))
        .select("_id", "_row", F.transform("at", lambda x: x.place).alias("places"), F.transform("at", lambda x: x.large).alias("large"))
    )

    def read_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):

                def wanted(key, place, w):
                    lists = part.column(3)
                    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                    at = lists.flatten().to_numpy() + w.first[row]
                    big = part.column(4).flatten().to_numpy(zero_copy_only=False)
                    i = np.minimum(np.searchsorted(at, place), len(at) - 1)
                    hit = at[i] == place
                    return hit, hit & big[i]

                yield _suffix_rows(part, length, prefix, bits, wanted)

    rows = same(_rows(docs), per_row, {"doc_id": "_id", "row_key": "_row"}, "inner")
    return rows.select("doc_id", "row_key", "text", "places", "large").mapInArrow(read_joined, _SUFFIX)


_FOUND = "doc_id long, row_key long, start long, mask long"
_NO_ID = np.iinfo(np.int64).max


def _ranks(t: W.Texts, w: W.Words, length: int) -> np.ndarray:
    """For each word a number that orders the ``length`` words from there on, equal if they are equal.

    Words are numbered in their own order, then pairs of such numbers, pairs of those, and so on: no hash is
    involved. Numbers of words with fewer than ``length`` left mean nothing.
    """
    coded = _binary(t.buf, w.starts, w.ends).dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    place = np.empty(len(distinct), np.int64)
    place[sorted(range(len(distinct)), key=distinct.__getitem__)] = np.arange(len(distinct))
    rank = place[coded.indices.to_numpy()] if distinct else np.zeros(0, np.int64)

    def paired(step: int) -> np.ndarray:
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - step)] = rank[step:]
        return (rank << 32) | after

    covered = 1
    while covered < length:
        step = min(covered, length - covered)
        rank = np.unique(paired(step), return_inverse=True)[1].astype(np.int64)
        covered += step
    return rank


def _subtrees(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Windows of whole groups that some smaller document has too, as a bit mask per suffix."""
    t = W.texts(batch.column(1))
    w = W.words(t)
    starts, n = W.run_starts(w.first, length)
    row = np.repeat(np.arange(len(n)), n)
    key = batch.column(0).to_numpy()[row]
    doc = batch.column(2).fill_null(_NO_ID).to_numpy()[row]
    code = _ranks(t, w, length)[starts]
    # Suffixes in the order of their words; neighbours of one rank share ``length`` words: a deep internal node.
    order = np.lexsort((doc, code, key))
    first = np.r_[True, (key[order][1:] != key[order][:-1]) | (code[order][1:] != code[order][:-1])][: len(order)]
    lowest = doc[order][np.flatnonzero(first)][np.cumsum(first) - 1]
    bad = np.zeros(len(order), bool)
    bad[order] = doc[order] > lowest
    bit = starts - w.first[row]
    mask = np.zeros(len(n), np.int64)
    np.bitwise_or.at(mask, row[bad], np.int64(1) << bit[bad])
    hit = pa.array(np.flatnonzero(mask))
    return pa.RecordBatch.from_arrays(
        [batch.column(2).take(hit), batch.column(3).take(hit), batch.column(4).take(hit), pa.array(mask).take(hit)],
        names=["doc_id", "row_key", "start", "mask"],
    )


def repeats(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, row_key, start, mask): bit i set if the window at ``start + i`` is in a smaller document."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            change = np.flatnonzero(keys[1:] != keys[:-1])
            # Everything up to the last change of key is whole groups.
            stop = int(change[-1]) + 1 if len(change) else 0
            if held and keys[0] != held[-1].column(0)[held[-1].num_rows - 1].as_py():
                yield from flush(held)
                held = []
            if stop:
                yield from flush([*held, batch.slice(0, stop)])
                held = []
            held.append(batch.slice(stop))
        yield from flush(held)

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if parts:
            yield _subtrees(pa.Table.from_batches(parts).combine_chunks().to_batches()[0], length)

    ordinary = (
        found.where("not large")
        .select("key", "span", "doc_id", "row_key", "start")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(walk, _FOUND)
    )
    # Whole windows: rows of the same words are alike, so the smallest document is combined before the shuffle.
    whole = found.where("large").select(
        "span", "doc_id", "row_key", "start", F.coalesce("doc_id", F.lit(_NO_ID)).alias("rank")
    )
    lowest = whole.groupBy(F.col("span").alias("_span")).agg(F.min("rank").alias("_low"))
    deep = whole.join(lowest, F.col("span") == F.col("_span")).where("rank > _low")
    return ordinary.unionByName(
        deep.select("doc_id", "row_key", "start", F.lit(1).cast("long").alias("mask"))
    )


def remove(
    docs: DataFrame,
    length: int = LENGTH,
    prefix: int = PREFIX,
    group_rows: int = GROUP_ROWS,
    max_broadcast: int = MAX_BROADCAST_PREFIXES,
    bits: int = 64,
) -> DataFrame:
    """(doc_id, n_words, n_removed, text): each text without what a smaller document also has.

    A window is ``length`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document, unchanged. Each word in a window that
    also stands in a document with a smaller doc_id goes; windows are judged on the input. ``text`` is the
    words left, joined by one space. Null or empty text has no words. A null doc_id counts as larger
    than all others and as equal to another null. Rows with equal doc_id take nothing from each other.
    Other columns, whatever their names, are ignored. An empty table gives no rows. ``bits`` of each word's hash are
    used to deal suffixes to groups; the result is the same with few.
    """
    repeated = table(prefixes(docs, length, prefix, bits), "prefixes")
    found = table(suffixes(docs, repeated, length, prefix, group_rows, max_broadcast, bits), "suffixes")
    marks = table(repeats(found, length), "repeats")
    per_row = marks.groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_row")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("mask").alias("masks")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                t = W.texts(part.column(1))
                w = W.words(t)
                lists = part.column(2)
                row = np.repeat(np.arange(len(t)), lists.value_lengths().fill_null(0).to_numpy())
                start = lists.flatten().to_numpy() + w.first[row]
                mask = part.column(3).flatten().to_numpy()
                # How many removed windows begin and end at each word.
                step = np.zeros(len(w.starts) + length + 1, np.int64)
                for bit in range(length):
                    at = start[(mask >> bit) & 1 == 1] + bit
                    np.add.at(step, at, 1)
                    np.add.at(step, at + length, -1)
                gone = np.cumsum(step)[: len(w.starts)] > 0
                text, at = _joined(t, w)
                stay = np.flatnonzero(~gone)
                kept = np.concatenate([[0], np.cumsum(~gone)])[w.first]
                size = np.concatenate([[0], np.cumsum((at[1:] - at[:-1])[stay])])
                data = W.take_spans(text, at[stay], at[stay + 1])
                begin, end = size[kept[:-1]], size[kept[1:]]
                # Without the space after the last word.
                out = _binary(data, begin, np.maximum(begin, end - 1)).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(w.counts()), pa.array(w.counts() - np.diff(kept)), out],
                    names=["doc_id", "n_words", "n_removed", "text"],
                )

    rows = same(_rows(docs), per_row, {"doc_id": "_id", "row_key": "_row"}, "left")
    return rows.select("doc_id", "text", "starts", "masks").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, text string"
    )
