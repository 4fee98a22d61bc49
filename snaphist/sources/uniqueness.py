"""Whether a column stays unique as runs add rows, without reading all earlier values each time.

Values lie in hash buckets, each with a Bloom filter of what it holds. A run asks the filters first; only values
that may be there are looked up, in the buckets that hold such. What was ever found twice is recorded, so
the answer after each run equals the test over all rows. A filter wrongly holds about one value in 250; the shares of
the filters of several runs add up, which costs look-ups and never the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from snaphist.schemas import POINTER
from snaphist.session import materialize
from snaphist.sources.tables import has_table, read_folders, read_table, write_partitions

# Part of the layout: buckets, and bits and hashes of a filter per value it was built for.
BUCKETS = 64
BITS_PER_VALUE = 12
HASHES = 6
# A filter is built for so many values at least.
LEAST = 1 << 10

_MEET = "bucket int, kind int, size long, bits binary, h1 long, h2 long, row long"
_FILTER = "bucket int, size long, bits binary"


def _folder(root: str, kind: str, number: int, bucket: int | None = None) -> str:
    return f"{root}/{kind}/number={number:012d}" + ("" if bucket is None else f"/bucket={bucket}")


def _commits(spark: SparkSession, root: str) -> list[int]:
    return sorted(r["number"] for r in read_table(spark, f"{root}/commits", POINTER).collect())


def _bucket(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int")


def _positions(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    """The bits of each value, one row per value: double hashing."""
    first, step = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    return (first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(size)


def _hashed(values: DataFrame) -> DataFrame:
    value = F.col("value")
    return values.select(
        _bucket(value).alias("bucket"), F.xxhash64(F.lit(1), value).alias("h1"), F.xxhash64(F.lit(2), value).alias("h2"), "value"
    )


def build_filters(values: DataFrame) -> DataFrame:
    """(bucket, size, bits) of distinct ``values``; a filter's size follows the number of values in its bucket."""
    hashed = _hashed(values).drop("value")
    counts = hashed.groupBy("bucket").agg(F.count("*").alias("n"))
    # One row per bucket.
    sizes = {r["bucket"]: BITS_PER_VALUE * max(LEAST, r["n"]) for r in counts.collect()}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, None

        def done() -> pa.RecordBatch:
            packed = np.packbits(held).tobytes()
            return pa.RecordBatch.from_pydict(
                {"bucket": pa.array([bucket], pa.int32()), "size": [sizes[bucket]], "bits": [packed]}
            )

        for batch in batches:
            keys = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
            for s, e in zip(edges, edges[1:]) if len(keys) else ():
                if keys[s] != bucket:
                    if held is not None:
                        yield done()
                    bucket = int(keys[s])
                    held = np.zeros(sizes[bucket], bool)
                h1, h2 = (batch.column(i).slice(s, e - s).to_numpy() for i in (1, 2))
                held[_positions(h1, h2, len(held)).ravel()] = True
        if held is not None:
            yield done()

    return hashed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(build, _FILTER)


def possible_repeats(values: DataFrame, filters: DataFrame) -> DataFrame:
    """The ``values`` that some filter of their bucket may hold; none that is held is missing."""
    named = materialize(_hashed(values).withColumn("row", F.monotonically_increasing_id()), "asked")
    asked = named.select("bucket", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("size"),
                         F.lit(None).cast("binary").alias("bits"), "h1", "h2", "row")
    held = filters.select("bucket", F.lit(0).alias("kind"), "size", "bits",
                          *[F.lit(0).cast("long").alias(c) for c in ("h1", "h2", "row")])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, known = None, []
        for batch in batches:
            keys, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (kind[1:] != kind[:-1]), True])
            for s, e in zip(edges, edges[1:]) if len(keys) else ():
                if keys[s] != bucket:
                    bucket, known = int(keys[s]), []
                part = batch.slice(s, e - s)
                if kind[s] == 0:
                    for size, bits in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                        known.append(np.unpackbits(np.frombuffer(bits, np.uint8))[:size].astype(bool))
                    continue
                h1, h2 = part.column(4).to_numpy(), part.column(5).to_numpy()
                maybe = np.zeros(len(h1), bool)
                for bits in known:
                    maybe |= bits[_positions(h1, h2, len(bits))].all(1)
                yield pa.RecordBatch.from_arrays([part.column(6).filter(pa.array(maybe))], names=["_row"])

    both = held.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "kind")
    hits = both.mapInArrow(ask, "_row long")
    return named.join(hits, F.col("row") == F.col("_row"), "left_semi").select("value", "bucket")


def check_run(df: DataFrame, column: str, root: str, run_id: str) -> int:
    """Add a run's values of ``column`` and return how many distinct values occur more than once in all runs.

    NULLs do not count. A run that was added before adds nothing. The commit is written last, so a run that broke
    off can be repeated.
    """
    spark, kind = df.sparkSession, df.schema[column].dataType
    commits = read_table(spark, f"{root}/commits", POINTER)
    numbers = _commits(spark, root)
    if commits.where(F.col("version") == run_id).isEmpty():
        number = (numbers[-1] if numbers else 0) + 1
        counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
        counted = materialize(counted, "values")
        values = counted.select("value")
        filters = read_folders(spark, [_folder(root, "filters", n) for n in numbers], _schema_of(_FILTER, spark))
        maybe = materialize(possible_repeats(values, filters), "possible")
        touched = sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())
        stored = read_table_buckets(spark, root, numbers, touched, kind)
        again = maybe.select("value").join(stored, "value", "left_semi")
        repeated = counted.where(F.col("n") > 1).select("value").unionByName(again).distinct()
        repeated.write.mode("overwrite").parquet(_folder(root, "repeated", number))
        build_filters(values).write.mode("overwrite").parquet(_folder(root, "filters", number))
        placed = values.withColumn("bucket", _bucket(F.col("value")))
        placed.write.mode("overwrite").partitionBy("bucket").parquet(_folder(root, "values", number))
        pointer = spark.createDataFrame([(number, run_id)], POINTER)
        write_partitions(pointer, f"{root}/commits", ["number"], rebalance=False)
        numbers.append(number)
    found = read_folders(spark, [_folder(root, "repeated", n) for n in numbers], _values_schema(kind))
    return found.distinct().count()


def _values_schema(kind: DataType) -> StructType:
    return StructType([StructField("value", kind)])


def _schema_of(ddl: str, spark: SparkSession) -> StructType:
    return spark.createDataFrame([], ddl).schema


def read_table_buckets(spark: SparkSession, root: str, numbers: list[int], buckets: list[int], kind: DataType) -> DataFrame:
    """Stored values of the given buckets; other buckets are not listed."""
    folders = [_folder(root, "values", n, b) for n in numbers for b in buckets]
    return read_folders(spark, [f for f in folders if has_table(spark, f)], _values_schema(kind))
