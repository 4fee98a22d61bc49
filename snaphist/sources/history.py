"""A stored type 2 history that batches of rows bring up to date.

Rows and versions lie in hash buckets of the key. A batch adds its rows to the buckets of its keys and replaces
the versions of these buckets; other buckets are neither read nor written. An index names the version of
each bucket, and the commit, written last, names the index, so readers see whole states only and a batch that
broke off can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampNTZType

from snaphist.operators.skew import match_keys
from snaphist.operators.splice import VERSION_COLUMNS, seeds, splice
from snaphist.schemas import HISTORY_INDEX, POINTER
from snaphist.session import materialize
from snaphist.sources.tables import read_folders, read_table, write_partitions

# Part of the layout of a history, fixed by its first batch.
BUCKETS = 64
# A bucket whose rows lie in so many batches has them written together.
FOLD_AFTER = 16


def _versions_schema(rows: StructType) -> StructType:
    kinds = (TimestampNTZType(), TimestampNTZType(), BooleanType(), StringType())
    return StructType([*rows, *(StructField(n, k) for n, k in zip(VERSION_COLUMNS, kinds))])


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _commits(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/commits", POINTER)


@dataclass
class Layout:
    """The number of buckets, the batch that holds each bucket's versions, and those that hold rows of it."""

    buckets: int
    versions: dict[int, int] = field(default_factory=dict)
    rows: dict[int, list[int]] = field(default_factory=dict)


def _read_layout(spark: SparkSession, root: str, buckets: int) -> tuple[int, Layout]:
    """The last number committed, 0 if there is none, and what lies where."""
    last = _commits(spark, root).agg(F.max("number")).first()[0] or 0
    layout = Layout(buckets)
    if last:
        for r in read_table(spark, f"{root}/index/number={last:012d}", HISTORY_INDEX).orderBy("number").collect():
            if r["kind"] == "buckets":
                layout.buckets = r["bucket"]
            elif r["kind"] == "versions":
                layout.versions[r["bucket"]] = r["number"]
            else:
                layout.rows.setdefault(r["bucket"], []).append(r["number"])
    return last, layout


def _write_layout(spark: SparkSession, root: str, number: int, layout: Layout) -> None:
    rows = [("buckets", layout.buckets, number)]
    rows += [("versions", b, n) for b, n in sorted(layout.versions.items())]
    rows += [("rows", b, n) for b, numbers in sorted(layout.rows.items()) for n in numbers]
    frame = spark.createDataFrame(rows, HISTORY_INDEX).coalesce(1)
    frame.write.mode("overwrite").parquet(f"{root}/index/number={number:012d}")


def _folder(root: str, kind: str, number: int, bucket: int) -> str:
    return f"{root}/{kind}/number={number:012d}/bucket={bucket}"


def merge_history(
    batch: DataFrame,
    root: str,
    name: str,
    key: str,
    ts: str,
    tracked: Sequence[str],
    *,
    collapse: bool = True,
    tiebreak: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """Add the rows of ``batch`` to the history at ``root``; in whatever order batches come, it equals a rebuild.

    ``name`` says which batch it is: one that was merged before is left out, so a batch can be repeated. The
    columns of all batches must be the same; the options are those of ``scd2`` and must not change either. Batches
    of one history must not overlap in time of writing. An empty batch changes nothing.
    """
    spark = batch.sparkSession
    if not _commits(spark, root).where(F.col("version") == name).isEmpty():
        return
    last, layout = _read_layout(spark, root, buckets)
    number, bucket = last + 1, _bucket(key, layout.buckets)
    new = materialize(batch, "batch")
    # At most one row per bucket.
    touched = sorted(r["bucket"] for r in new.select(bucket.alias("bucket")).distinct().collect())
    old = read_folders(
        spark, [_folder(root, "versions", layout.versions[b], b) for b in touched if b in layout.versions],
        _versions_schema(batch.schema),
    )
    seed = materialize(seeds(old, new, key, ts, tiebreak), "seeds")
    known = read_folders(
        spark, [_folder(root, "rows", n, b) for b in touched for n in layout.rows.get(b, [])], batch.schema
    )
    merged = splice(
        old, known.unionByName(new), seed, key, ts, tracked, collapse=collapse, tiebreak=tiebreak
    )
    others = match_keys(old, seed.select(key), [key], "left_anti")

    def write(rows: DataFrame, kind: str) -> None:
        placed = rows.withColumn("bucket", bucket)
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{kind}/number={number:012d}")

    # A bucket whose rows lie in many batches gets them together in this one.
    folded = [b for b in touched if len(layout.rows.get(b, [])) + 1 >= FOLD_AFTER]
    again = read_folders(spark, [_folder(root, "rows", n, b) for b in folded for n in layout.rows[b]], batch.schema)
    write(new.unionByName(again) if folded else new, "rows")
    write(merged.unionByName(others), "versions")
    for b in touched:
        layout.versions[b] = number
        layout.rows[b] = [number] if b in folded else [*layout.rows.get(b, []), number]
    _write_layout(spark, root, number, layout)
    pointer = spark.createDataFrame([(number, name)], POINTER)
    write_partitions(pointer, f"{root}/commits", ["number"], rebalance=False)


def read_history(spark: SparkSession, root: str, rows: StructType) -> DataFrame:
    """The versions after the last batch that was merged in full; ``rows`` is the schema of the batches."""
    _, layout = _read_layout(spark, root, BUCKETS)
    folders = [_folder(root, "versions", n, b) for b, n in sorted(layout.versions.items())]
    return read_folders(spark, folders, _versions_schema(rows))
