"""Order-independent hashes of a snapshot's member set."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from snaphist.functions.hashing import (
    FIELD_SEPARATOR,
    MEMBER_SEPARATOR,
    as_text,
    bit_chunks,
    member_bits,
    member_text,
)
from snaphist.functions.text import strip
from snaphist.operators.skew import match_keys

# The fields of a member that enter the set hash; the first one names it.
HASH_FIELDS = ("full_name", "number", "position")

# Forms of the hash: the md5 over the sorted members, and the additive digest.
LISTED, DIGEST = "listed", "digest"


def _fields(fields: Sequence[str]) -> list[Column]:
    return [as_text(F.col(f)) for f in fields]


def _is_named(fields: Sequence[str]) -> Column:
    return strip(as_text(F.col(fields[0]))) != ""


def drop_unnamed(df: DataFrame, name: str) -> DataFrame:
    """Drop members whose name is NULL, empty or white space only."""
    return df.where(strip(as_text(F.col(name))) != "")


def set_digest(df: DataFrame, keys: Sequence[str], fields: Sequence[str] = HASH_FIELDS) -> DataFrame:
    """Additive multiset hash per snapshot: sums over hash bits of the named members.

    Equal sets give equal digests in any order, duplicates count. It is a handful of plain
    sums, so it combines before the shuffle and never holds a snapshot in one place.
    """
    names = [f"_f{i}" for i in range(len(fields))]
    stripped = df.select(*keys, *[strip(c).alias(n) for c, n in zip(_fields(fields), names)])
    members = stripped.select(
        *keys,
        *[
            F.when(F.col(names[0]) != "", member_bits(names, seed)).alias(f"_bits{seed}")
            for seed in (0, 1)
        ],
    )
    chunks = [c for seed in (0, 1) for c in bit_chunks(F.col(f"_bits{seed}"))]
    parts = {f"_s{i}": F.sum(chunk) for i, chunk in enumerate(chunks)}
    parts["_named"] = F.count("_bits0")
    text = F.concat_ws(FIELD_SEPARATOR, *[as_text(F.col(name)) for name in parts])
    return (
        members.groupBy(*keys)
        .agg(
            *[part.alias(name) for name, part in parts.items()],
            F.count("*").cast("bigint").alias("member_count"),
        )
        .select(*keys, F.md5(text).alias("set_hash"), "member_count")
    )


def set_hash(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str] = HASH_FIELDS
) -> DataFrame:
    """Hash and member count per snapshot: md5 of the sorted ``name|number|position`` texts.

    The same function whatever the size. Members are sorted by Spark, by their fields as they came,
    and a task reads them batch by batch into the running md5, so it holds one batch at most. An md5
    is serial by nature: a huge snapshot takes one task. Where snapshots are huge, choose
    ``set_digest`` instead. Members without a name are counted but do not enter the hash.
    """
    names = [f"_f{i}" for i in range(len(fields))]
    members = (
        df.select(*keys, *[c.alias(n) for c, n in zip(_fields(fields), names)], _is_named(fields).alias("_named"))
        .select(*keys, *names, F.when(F.col("_named"), member_text([F.col(n) for n in names])).alias("_text"))
        .repartition(*keys)
        .sortWithinPartitions(*keys, *names)
        .select(*keys, "_text")
    )
    width = len(keys)

    kinds = [members.schema[k] for k in keys]
    schema = StructType([*kinds, StructField("set_hash", StringType()), StructField("member_count", LongType())])
    types = [to_arrow_type(f.dataType) for f in schema]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, running, count, started = None, None, 0, False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = [batch.column(i) for i in range(width)]
            edges = _edges(columns, batch.num_rows)
            # Keys stay in Arrow; only those at the borders of a batch become Python values.
            found = [c.take(pa.array(edges[:-1])) for c in columns]
            texts = batch.column(width).to_pylist()
            if running is not None and tuple(c[0].as_py() for c in found) != open_key:
                yield _batch([[v] for v in (*open_key, running.hexdigest(), count)])
                running = None
            hashes, counts = [], []
            for start, stop in zip(edges, edges[1:]):
                if running is None:
                    running, count, started = hashlib.md5(), 0, False
                named = [t for t in texts[start:stop] if t is not None]
                count += stop - start
                if named:
                    running.update(((MEMBER_SEPARATOR if started else "") + MEMBER_SEPARATOR.join(named)).encode())
                    started = True
                if stop < batch.num_rows:
                    hashes.append(running.hexdigest())
                    counts.append(count)
                    running = None
            if hashes:
                yield _batch([*[c.slice(0, len(hashes)) for c in found], hashes, counts])
            open_key = tuple(c[-1].as_py() for c in found)
        if running is not None:
            yield _batch([[v] for v in (*open_key, running.hexdigest(), count)])

    def _batch(columns: list) -> pa.RecordBatch:
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return members.mapInArrow(digests, schema)


def _edges(columns: Sequence[pa.Array], n: int) -> list[int]:
    """Where rows that agree in all ``columns`` begin, and the end; NULL agrees with NULL."""
    change = np.zeros(max(0, n - 1), bool)
    for c in columns:
        code = c.dictionary_encode(null_encoding="encode").indices.to_numpy()
        change |= code[1:] != code[:-1]
    return [0, *(np.flatnonzero(change) + 1).tolist(), n]


def hash_sets(
    df: DataFrame, keys: Sequence[str], form: str, fields: Sequence[str] = HASH_FIELDS
) -> DataFrame:
    """``set_hash`` or ``set_digest``, as named by ``form``."""
    return {LISTED: set_hash, DIGEST: set_digest}[form](df, keys, fields)


def with_set_hash(df: DataFrame, hashes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach each row's snapshot hash. Spark splits a skewed snapshot in this join at run time."""
    return match_keys(
        df.drop("set_hash"), hashes.select(*keys, "set_hash"), keys, "left"
    )
