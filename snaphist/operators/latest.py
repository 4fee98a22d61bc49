"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the greatest ``ts`` (then ``tiebreak``) of every key.

    Filtering a row number by 1 lets Spark keep one row per key and task before the
    shuffle, so a hot key sends no more rows than there are tasks.
    """
    order = [F.col(c).desc_nulls_last() for c in (ts, *tiebreak)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
