"""Intermediate tables of the corpus operators, kept in the folder all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.session import new_dir

# A side of a join is broadcast when it is counted to have at most so many rows of a few numbers.
MAX_BROADCAST_ROWS = 200_000

# Of the queries that write tables: their shuffle files go as soon as they end, and what a task hands to its Python worker
# at once, which both sides hold, is a few megabytes whatever the length of the texts.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    """Queries run inside have the settings ``_WRITING``."""
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def table(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once and read it back. A lost executor then costs a second read only.

    The shuffle files of the writing query go with its end; the table needs them no more.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    with _writing(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fetch(df: DataFrame) -> pa.Table:
    """All rows of ``df``, whose number something else bounds, on the driver."""
    with _writing(df.sparkSession):
        return df.toArrow()


def small(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark a written table for broadcast if it has few rows; otherwise the join shuffles it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased only; null as empty."""
    text = F.coalesce(text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # For ASCII texts the built-in function does the same and is several times faster.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def same(left: DataFrame, right: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    """Join on null-safe equality of ``on``'s keys (left) and values (right, other names)."""
    condition = reduce(
        lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in on.items()]
    )
    return left.join(right, condition, how)
