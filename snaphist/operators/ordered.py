"""Neighbour and carry-forward operators over ordered rows of a key.

For ordinary keys these are plain window functions. A hot key is cut into ranges of
its order column (see ``skew``): each range runs as a window of its own, and only the
rows at the range borders are exchanged, through a table of one row per range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaphist.operators.skew import PART, Splits, hot_only, match_keys, rank


def _order(splits: Splits, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in (splits.order, *tiebreak)]


def _with_edges(df: DataFrame, edges: DataFrame, splits: Splits) -> DataFrame:
    # One row per range of a hot key: bounded by the bound on the cut points.
    return match_keys(df, edges, splits.partition, "left", broadcast=True)


def with_neighbours(
    df: DataFrame,
    splits: Splits,
    tiebreak: Sequence[str] = (),
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add values of the row before (``previous``) and after (``following``) within the key.

    Both map a new column to the column it is taken from. ``df`` carries the part column
    of ``splits`` where a key is hot. NULL comes last in the order and in each tiebreak.
    """
    previous, following = dict(previous or {}), dict(following or {})
    window = Window.partitionBy(*splits.partition).orderBy(*_order(splits, tiebreak))
    if splits.cuts is None:
        return df.select(
            "*",
            *[F.lag(source).over(window).alias(name) for name, source in previous.items()],
            *[F.lead(source).over(window).alias(name) for name, source in following.items()],
        )

    place = rank([splits.order, *tiebreak])
    last = F.struct(F.lit(1).alias("_"), *sorted(set(previous.values())))
    first = F.struct(F.lit(1).alias("_"), *sorted(set(following.values())))
    by_part = Window.partitionBy(*splits.keys).orderBy(PART)
    edges = (
        hot_only(df, splits)
        .groupBy(*splits.partition)
        .agg(F.max_by(last, place).alias("_last"), F.min_by(first, place).alias("_first"))
        .select(
            *splits.partition,
            F.lag("_last").over(by_part).alias("_before"),
            F.lead("_first").over(by_part).alias("_after"),
        )
    )
    at_start = F.row_number().over(window) == 1
    at_end = F.lead(F.lit(1)).over(window).isNull()
    return _with_edges(df, edges, splits).select(
        *df.columns,
        *[
            F.when(at_start, F.col("_before").getField(source))
            .otherwise(F.lag(source).over(window))
            .alias(name)
            for name, source in previous.items()
        ],
        *[
            F.when(at_end, F.col("_after").getField(source))
            .otherwise(F.lead(source).over(window))
            .alias(name)
            for name, source in following.items()
        ],
    )


def carry_forward(
    df: DataFrame, splits: Splits, value: str, name: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Add the latest non-NULL ``value`` at or before each row within the key."""
    window = (
        Window.partitionBy(*splits.partition)
        .orderBy(*_order(splits, tiebreak))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = F.last(value, ignorenulls=True).over(window)
    if splits.cuts is None:
        return df.select("*", within.alias(name))

    earlier_parts = (
        Window.partitionBy(*splits.keys)
        .orderBy(PART)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    place = F.when(F.col(value).isNotNull(), rank([splits.order, *tiebreak]))
    edges = (
        hot_only(df, splits)
        .groupBy(*splits.partition)
        .agg(F.max_by(value, place).alias("_last"))
        .select(
            *splits.partition,
            F.last("_last", ignorenulls=True).over(earlier_parts).alias("_before"),
        )
    )
    return _with_edges(df, edges, splits).select(
        *df.columns, F.coalesce(within, F.col("_before")).alias(name)
    )
