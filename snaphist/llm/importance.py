"""Importance resampling towards the word statistics of a target, with Arrow kernels.

Texts are lower-cased and split by Arrow; the words of a batch become dictionary indices, shifted indices of a
text form longer runs, and only distinct runs are hashed. Each document keeps its bucket codes, from which
both the counts of the corpus and, through the buckets' gains, its weight are taken.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.llm import words as W
from snaphist.llm.store import fetch, table
from snaphist.operators.surrogate import surrogate_key

# Everything that is no part of a word, once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_CODED = "doc_id long, n_words long, n_features long, codes binary"
_WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def _hashes(values: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    raw = [x.encode() for x in values.to_pylist()]
    return np.array([zlib.crc32(x) for x in raw], np.uint32), raw


def features(column: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, features per text, bucket codes text by text) of runs of 1 to ``longest`` words."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(column, "")), SEPARATORS)
    flat, text = pc.list_flatten(parts), pc.list_parent_indices(parts)
    full = pc.not_equal(flat, "")
    coded = flat.filter(full).dictionary_encode()
    text = text.filter(full).to_numpy(zero_copy_only=False).astype(np.int64)
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    crc, raw = _hashes(coded.dictionary)
    run, run_crc = word, crc
    codes, texts = [run_crc[run]], [text]
    for n in range(2, longest + 1):
        # A run of n words is a run of n - 1 and the next word, inside one text.
        at = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.zeros(0, np.int64)
        pairs = np.full(len(text), -1)
        distinct, pairs[at] = np.unique(run[at] * max(1, len(raw)) + word[at + n - 1], return_inverse=True)
        run_crc = np.array(
            [zlib.crc32(b" " + raw[p % len(raw)], int(run_crc[p // len(raw)])) for p in distinct], np.uint32
        )
        run = pairs
        codes.append(run_crc[run[at]])
        texts.append(text[at])
    where = np.concatenate(texts)
    order = np.argsort(where, kind="stable")
    n = len(column)
    codes = (np.concatenate(codes)[order] % np.uint32(buckets)).astype(_kind(buckets))
    return np.bincount(text, minlength=n), np.bincount(where, minlength=n), codes


def _kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def code(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, n_features, codes) of each text, whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                n_words, n, codes = features(part.column(1), longest, buckets)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n_words, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([codes[e - k : e].tobytes() for e, k in zip(ends, n)], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "n_features", "codes"],
                )

    return docs.mapInArrow(run, _CODED)


def counts(coded: DataFrame, buckets: int) -> np.ndarray:
    """How many features of the table fall in each bucket: one row per bucket and task, then per bucket."""
    kind = _kind(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            raw = W.texts(batch.column(0)).buf
            found += np.bincount(np.frombuffer(raw.tobytes(), kind), minlength=buckets)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at])], names=["bucket", "n"])

    parts = coded.select("codes").mapInArrow(count, "bucket int, n long")
    rows = fetch(parts.groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of target to corpus frequency, per bucket."""
    all_corpus, all_target, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array(
        [
            math.floor(1000 * math.log(float((t + 1) * (all_corpus + n)) / float((s + 1) * (all_target + n))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weights(coded: DataFrame, gain: np.ndarray, buckets: int) -> DataFrame:
    """The floored mean gain over each document's features, 0 if it has none."""
    kind, known = _kind(buckets), pa.array(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "codes"):
                codes = np.frombuffer(W.texts(part.column(3)).buf.tobytes(), kind)
                taken = known.take(pa.array(codes)).to_numpy(zero_copy_only=False)
                n = part.column(2).to_numpy()
                ends = np.cumsum(n)
                sums = np.zeros(len(n), np.int64)
                some = np.flatnonzero(n)
                if len(some):
                    sums[some] = np.add.reduceat(taken, (ends - n)[some])
                weight = sums // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return coded.mapInArrow(weigh, _WEIGHED)


def gumbel(seed: int, doc_id: Column) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(seed:doc_id); null as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; features are all runs of 1 to
    ``longest`` words, repeats counted, each in the bucket of its crc32. A bucket's gain compares its smoothed
    frequency in ``target`` (text) with that in ``docs``; a document's weight is the floored mean over its features,
    and its score adds the Gumbel noise of its id, which draws without replacement. Of the N rows with at
    least ``min_words`` words the floor(percent * N / 100) best are drawn and ranked; rank is null
    for all others. Equal scores go to the smaller doc_id, a null id last, then by features and weight.

    Null and empty texts have no features, weight 0 and are never drawn if ``min_words`` is above 0. Repeated rows
    are separate rows with equal scores. An empty ``docs`` gives no rows; an empty ``target`` counts
    as one without features. Other columns are ignored, whatever their names. The driver and all
    tasks see one number per bucket.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = table(code(rows, longest, buckets), "importance-codes")
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = table(code(wanted, longest, buckets), "importance-target")
    gain = gains(counts(coded, buckets), counts(wanted, buckets))
    scored = table(
        weights(coded, gain, buckets).withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id"))),
        "importance-scores",
    )
    able = scored.where(F.col("n_words") >= min_words).withColumn("_low", -F.col("score"))
    drawn = percent * able.count() // 100
    ranked = surrogate_key(able, ["_low", "doc_id", "n_features", "weight"], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long")))
    others = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*names).unionByName(others.select(*names))
