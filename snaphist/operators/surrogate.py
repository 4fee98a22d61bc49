"""Dense numbering of all rows in a global order."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its task in the low 33 bits


def surrogate_key(
    df: DataFrame, order_by: Sequence[str], name: str, ranged: bool = False
) -> DataFrame:
    """Number the rows 1..n by ``order_by``, as a global ROW_NUMBER would, in parallel.

    Rows are range partitioned and sorted, so the place of a row within its partition
    plus the size of all partitions before it is its number. The sorted rows are written
    once: counting and numbering then see the very same partitions, and counting reads one
    column only. ``order_by`` must order the rows totally. ``ranged`` says that the partitions
    of ``df`` are ranges of that order already, so that they are sorted at most.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    fixed = materialize(
        (df if ranged else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    partition = F.shiftright("_place", _ROW_BITS)
    # One row per shuffle partition.
    sizes = fixed.groupBy(partition.alias("_partition")).count().orderBy("_partition").collect()
    counts = {row["_partition"]: row["count"] for row in sizes}
    starts = list(accumulate((counts.get(p, 0) for p in range(max(counts, default=0))), initial=0))
    before = F.element_at(
        F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"),
        partition.cast("int") + 1,
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return fixed.select((before + place + 1).alias(name), *df.columns)


def stable_key(column: str):
    """A key that depends on the value alone and so survives rebuilds."""
    return F.xxhash64(F.col(column))
