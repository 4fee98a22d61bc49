"""A stored history cut into periods: an image of what is valid when a period begins, and what starts within it.

A question about a moment reads the one period it falls in. Periods are even in the number of versions that
start, so each holds an image and a bounded number of changes, however long the history is.
"""

from __future__ import annotations

import bisect
import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snaphist.operators.temporal import as_of
from snaphist.sources.tables import has_table, read_folders

# Versions that start in one period, and periods at most: each costs an image.
ROWS_PER_PERIOD = 4_000_000
MAX_PERIODS = 1_000

_FIRST = "1970-01-01 00:00:00"


def _micros(ts: Column) -> Column:
    first = F.lit(_FIRST).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", first, ts)


def _borders(versions: DataFrame, rows_per_period: int) -> list[int]:
    """Where periods after the first begin, in microseconds."""
    n = versions.count()
    periods = max(1, min(MAX_PERIODS, -(-n // rows_per_period)))
    if periods == 1:
        return []
    shares = [i / periods for i in range(1, periods)]
    found = versions.agg(F.percentile_approx(_micros(F.col("effective_date")), shares, 20 * periods).alias("b")).first()
    return sorted(set(found["b"] or []))


def save_images(versions: DataFrame, root: str, rows_per_period: int = ROWS_PER_PERIOD) -> None:
    """Store ``versions`` (with effective_date and end_date) at ``root``, replacing what is there.

    A version lies in each period in which it is valid at some time, once: in that it starts in, and in the images
    of the later ones. Versions that are valid at no time are left out. The borders of the periods are written last.
    """
    valid = versions.where(F.col("effective_date") < F.col("end_date"))
    borders = _borders(valid, rows_per_period)
    listed = F.array(*[F.lit(b) for b in borders]).cast("array<bigint>")
    start, end = _micros(F.col("effective_date")), _micros(F.col("end_date"))
    # Inside a lambda only columns of the row are known, so both moments become columns first.
    placed = valid.withColumns({"_start": start, "_end": end}).withColumns(
        {
            "_first": F.size(F.filter(listed, lambda b: b <= F.col("_start"))),
            "_last": F.size(F.filter(listed, lambda b: b < F.col("_end"))),
        }
    )
    rows = placed.withColumn("period", F.explode(F.sequence("_first", "_last"))).drop("_start", "_end", "_first", "_last")
    rows = rows.hint("rebalance", "period").sortWithinPartitions("period", "effective_date")
    rows.write.mode("overwrite").partitionBy("period").parquet(f"{root}/periods")
    frame = versions.sparkSession.createDataFrame([(i, b) for i, b in enumerate(borders, 1)], "period int, begins bigint")
    frame.coalesce(1).write.mode("overwrite").parquet(f"{root}/borders")


def read_as_of(spark: SparkSession, root: str, at: str | datetime.datetime, schema: StructType) -> DataFrame:
    """The versions valid at a moment, read from its period only; ``schema`` is that of the versions."""
    moment = at if isinstance(at, datetime.datetime) else datetime.datetime.fromisoformat(at)
    begins = sorted(r["begins"] for r in spark.read.parquet(f"{root}/borders").collect())
    micros = (moment - datetime.datetime.fromisoformat(_FIRST)) // datetime.timedelta(microseconds=1)
    folder = f"{root}/periods/period={bisect.bisect_right(begins, micros)}"
    return as_of(read_folders(spark, [folder] if has_table(spark, folder) else [], schema), moment)
