"""Type 2 history: one row per version of a key, with half-open validity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaphist.functions.hashing import row_hash, row_text
from snaphist.operators.ordered import with_neighbours
from snaphist.operators.skew import PART, Splits, match_keys, split_hot_keys, with_part
from snaphist.schemas import FOREVER

ABSENT = "_absent"


def forever() -> Column:
    return F.lit(FOREVER).cast("timestamp_ntz")


def scd2(
    df: DataFrame,
    key: str,
    ts: str,
    tracked: Sequence[str],
    *,
    collapse: bool = True,
    tiebreak: Sequence[str] = (),
    splits: Splits | None = None,
    runs: DataFrame | None = None,
    scope: Sequence[str] = (),
    ranged: bool = False,
) -> DataFrame:
    """Versions of ``key`` ordered by ``ts``, all columns of ``df`` kept.

    ``collapse`` merges consecutive rows whose ``tracked`` attributes are equal; without it
    every row is a version. A version ends where the next one starts, the last one at the
    sentinel date. Both steps share one shuffle and one sort. (key, ts) should be unique, or
    ``tiebreak`` must order equal times; then all but the last of them get an empty validity.

    ``runs`` (columns ``scope`` and ``ts``, the times of all snapshots of each scope, such as a group)
    closes the last version of a key at the first run of its scope that no longer lists it, unless the
    key is listed elsewhere by then; without it a key stays current for ever.

    With ``ranged`` the one shuffle deals ranges of keys instead of hashes, so the versions come out in
    partitions ordered by key.
    """
    columns = [c for c in df.columns if c != "hash_diff"]
    if splits is None:
        splits = split_hot_keys(df, [key], ts, tiebreak=tiebreak)
    rows = df.select(*columns)
    if runs is not None:
        rows = _with_absences(with_part(rows, splits), key, ts, tiebreak, splits, runs, scope)
    rows = with_part(rows, splits)
    if ranged:
        rows = rows.repartitionByRange(*[F.col(c).asc_nulls_last() for c in splits.partition])
    if collapse:
        # The attributes themselves are compared, so the hash neither travels through the
        # shuffle nor is computed for rows that merge away.
        compared = [*tracked, ABSENT] if runs is not None else tracked
        old = {c: f"_old_{c}" for c in compared}
        rows = with_neighbours(
            rows, splits, tiebreak, previous={"_before": ts, **{o: c for c, o in old.items()}}
        )
        differs = F.col("_before").isNull() | (row_text(compared) != row_text(old.values()))
        rows = rows.where(differs).drop("_before", *old.values())
    rows = with_neighbours(rows, splits, tiebreak, following={"_next": ts})
    if runs is not None:
        rows = rows.where(~F.col(ABSENT))
    return rows.select(
        *columns,
        F.col(ts).alias("effective_date"),
        F.coalesce("_next", forever()).alias("end_date"),
        F.col("_next").isNull().alias("is_current"),
        row_hash(tracked).alias("hash_diff"),
    )


def _with_absences(
    rows: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str],
    splits: Splits,
    runs: DataFrame,
    scope: Sequence[str],
) -> DataFrame:
    """Add a row marked absent at each run of its scope at which a key listed before is missing."""
    # A window per scope over its run times; without a scope, over the distinct times of all.
    order = Window.partitionBy(*scope).orderBy(ts)
    calendar = runs.select(*scope, ts).distinct().withColumn("_next_run", F.lead(ts).over(order))
    seen = with_neighbours(rows, splits, tiebreak, following={"_next_seen": ts})
    absent = match_keys(seen, calendar, [*scope, ts], "inner").where(
        F.col("_next_run").isNotNull()
        & (F.col("_next_seen").isNull() | (F.col("_next_seen") > F.col("_next_run")))
    )
    base = [c for c in rows.columns if c != PART]
    values = {c: F.lit(None).cast(rows.schema[c].dataType) for c in base}
    values[key] = F.col(key)
    values[ts] = F.col("_next_run")
    return (
        rows.select(*base)
        .withColumn(ABSENT, F.lit(False))
        .unionByName(
            absent.select(*[values[c].alias(c) for c in base], F.lit(True).alias(ABSENT))
        )
    )
