"""Splitting hot keys, so that ordered work over one key can run in many tasks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.session import materialize

PART = "_part"

# A key of at most this many rows is ordered in one task.
ROWS_PER_PART = 5_000_000

# Upper bound for the number of hot keys and of their cut points, all that is broadcast. Beyond
# rows_per_part times this many rows the parts grow with the data.
MAX_CUTS = 100_000
BLOCK = 64


@dataclass(frozen=True)
class Splits:
    """Cut points of the hot keys; ``cuts`` is None where no key is hot."""

    keys: tuple[str, ...]
    order: str
    cuts: DataFrame | None = None
    tiebreak: tuple[str, ...] = ()

    def renamed(self, keys: Sequence[str], order: str) -> Splits:
        """The same cut points for rows whose columns have other names."""
        cuts = self.cuts
        if cuts is not None:
            cuts = cuts.withColumnsRenamed(dict(zip(self.keys, keys)))
        return replace(self, keys=tuple(keys), order=order, cuts=cuts)

    @property
    def partition(self) -> list[str]:
        return [*self.keys] if self.cuts is None else [*self.keys, PART]


def rank(columns: Sequence[str]) -> Column:
    """Columns as one value that compares as sorting by them does, NULL last."""
    parts = []
    for i, c in enumerate(columns):
        parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"c{i}")]
    return F.struct(*parts)


def match_keys(
    df: DataFrame, other: DataFrame, keys: Sequence[str], how: str, broadcast: bool = False
) -> DataFrame:
    """Join on null-safe equal keys, so rows with a NULL key are matched as well.

    The keys of ``other`` are renamed first: it is often derived from ``df``.
    """
    names = {k: f"_other_{k}" for k in keys}
    other = other.withColumnsRenamed(names)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    joined = df.join(F.broadcast(other) if broadcast else other, on, how)
    return joined.drop(*names.values())


def _sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n"))


def _largest(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest key and of all keys."""
    row = _sizes(df, keys).agg(F.max("_n"), F.sum("_n")).first()
    return row[0] or 0, row[1] or 0


def no_splits(keys: Sequence[str], order: str) -> Splits:
    """For keys known to stay small: one task per key, nothing measured."""
    return Splits(tuple(keys), order)


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    rows_per_part: int = ROWS_PER_PART,
    max_cuts: int = MAX_CUTS,
    superset: DataFrame | None = None,
    tiebreak: Sequence[str] = (),
) -> Splits:
    """Measure the rows per key and cut each hot key into even ranges of its order.

    The measuring job reads the key columns only and combines before its shuffle.
    Where no key exceeds ``rows_per_part`` that is all that happens. Otherwise a key is
    hot from ``max(rows_per_part, all rows / max_cuts)`` rows on, so that hot keys and their cut
    points, all that is ever broadcast, stay below ``2 * max_cuts``. Ranges are by ``order`` and then
    ``tiebreak``, so rows that share a time are split as well if the tiebreak tells them apart.

    ``superset`` names rows that include those of ``df`` and are cheaper to count, such as
    the input of an aggregate: where it has no hot key, ``df`` has none and is not computed.
    """
    if superset is not None and _largest(superset, keys)[0] <= rows_per_part:
        return no_splits(keys, order)
    largest, total = _largest(df, keys)
    if largest <= rows_per_part:
        return no_splits(keys, order)
    target = max(rows_per_part, total // max_cuts)
    hot = materialize(_sizes(df, keys).where(F.col("_n") > target), "hot-keys")
    in_hot = hot.agg(F.sum("_n")).first()[0] or 0
    by = [order, *tiebreak]
    # Spark's own range partitioning finds even borders over key and order; the least row of each
    # range is a cut point of its key.
    ranged = match_keys(df.select(*keys, *by), hot.select(*keys), keys, "inner", broadcast=True)
    sorting = [F.col(c).asc_nulls_last() for c in (*keys, *by)]
    cuts = (
        ranged.repartitionByRange(-(-in_hot // target) + 1, *sorting)
        .groupBy(F.spark_partition_id().alias("_range"), *keys)
        .agg(F.min(rank(by)).alias("_cut"))
        .groupBy(*keys)
        .agg(F.array_distinct(F.array_sort(F.collect_list("_cut"))).alias("_cuts"))
        # The first range of a key begins with its first row, which is no border.
        .select(*keys, F.slice("_cuts", F.lit(2), F.size("_cuts")).alias("_cuts"))
        # Cut points in blocks, so that a row is placed by two short searches.
        .select(
            *keys,
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / BLOCK).cast("int")),
                lambda i: F.slice("_cuts", i * BLOCK + 1, BLOCK),
            ).alias("_blocks"),
        )
        .where(F.size("_blocks") > 0)
        .where(F.size(F.element_at("_blocks", 1)) > 0)
        .withColumn("_heads", F.transform("_blocks", lambda block: block[0]))
    )
    # Written once, so that every pass over the data sees the same cut points.
    return Splits(tuple(keys), order, materialize(cuts, "cuts"), tuple(tiebreak))


def with_part(df: DataFrame, splits: Splits) -> DataFrame:
    """Add the part each row falls in: 0 for cold keys, the range of its order for hot ones."""
    if splits.cuts is None:
        return df
    own = rank([splits.order, *splits.tiebreak])

    def passed(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda cut: cut <= F.col("_own")))

    block = passed(F.col("_heads"))
    part = (block - 1) * BLOCK + passed(F.element_at("_blocks", F.greatest(block, F.lit(1))))
    is_first = F.col("_heads").isNull() | (block == 0)
    matched = match_keys(df.withColumn("_own", own), splits.cuts, splits.keys, "left", broadcast=True)
    return matched.select(*df.columns, F.when(is_first, F.lit(0)).otherwise(part).alias(PART))


def hot_only(df: DataFrame, splits: Splits) -> DataFrame:
    """The rows of the hot keys."""
    return match_keys(df, splits.cuts, splits.keys, "left_semi", broadcast=True)
