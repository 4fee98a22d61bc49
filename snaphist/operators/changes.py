"""Change decisions over a snapshot history or against stored state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaphist.operators.skew import match_keys

# A snapshots table has columns (group_id, season, run_ts, set_hash, member_count) and
# one row per group, season and run.
GROUP_KEYS = ("group_id", "season")

# Outcomes of the write decision.
NEW, UNCHANGED, CHANGED, LATE = "new", "unchanged", "changed", "late"


def write_decision(current: Column, previous: Column, exists: Column, force: bool = False) -> Column:
    """Forced or never stored: new. Stored hash equal: unchanged. Otherwise, also without state: changed."""
    fresh = F.lit(force) | ~exists
    return (
        F.when(fresh, F.lit(NEW))
        .when(current.eqNullSafe(previous), F.lit(UNCHANGED))
        .otherwise(F.lit(CHANGED))
    )


def is_write(decision: Column) -> Column:
    return decision.isin(NEW, CHANGED)


def decide_history(
    snapshots: DataFrame, keys: Sequence[str] = GROUP_KEYS, ts: str = "run_ts"
) -> DataFrame:
    """Decide every snapshot of a full history in one pass, each against the one before it.

    The window holds one row per run of a group, however many members the group has.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(ts).asc_nulls_last())
    return (
        snapshots.withColumn("previous_hash", F.lag("set_hash").over(window))
        .withColumn("_exists", F.lag(F.lit(True), 1, False).over(window))
        .withColumn(
            "decision", write_decision(F.col("set_hash"), F.col("previous_hash"), F.col("_exists"))
        )
        .drop("_exists")
    )


def decide_against_state(
    snapshots: DataFrame,
    state: DataFrame,
    existing: DataFrame | None = None,
    force: bool = False,
    keys: Sequence[str] = GROUP_KEYS,
    whole: bool = False,
) -> DataFrame:
    """Decide a batch of snapshots against stored state.

    A group may occur with several runs; each is then compared with the run before it, the
    first one with the state. Snapshots not newer than the state of their group are late:
    marked so, and never compared with. ``existing`` lists the groups that have stored
    snapshots; without it, having state counts as having snapshots. A NULL key is a key.

    ``whole`` says that parts of a snapshot that came before are among its members, and that column ``known_hash``
    holds the hash it had then, NULL for a new snapshot. The very snapshot of the state is then
    compared with the state, not late, and a late one that is as it was is unchanged.
    """
    has_state = F.col("last_ingested").isNotNull()
    known = state.select(*keys, "current_hash", "last_ingested")
    joined = match_keys(snapshots, known, keys, "left")
    if existing is None:
        joined = joined.withColumn("_stored", has_state)
    else:
        marks = existing.select(*keys).distinct().withColumn("_mark", F.lit(True))
        joined = match_keys(joined, marks, keys, "left").withColumn(
            "_stored", F.col("_mark").isNotNull()
        ).drop("_mark")
    late = has_state & (F.col("run_ts") <= F.col("last_ingested"))
    again = F.lit(False)
    if whole:
        late = has_state & (F.col("run_ts") < F.col("last_ingested"))
        again = F.coalesce(F.col("set_hash") == F.col("known_hash"), F.lit(False))
    joined = joined.withColumn("_late", late)
    window = Window.partitionBy(*keys, "_late").orderBy(F.col("run_ts").asc_nulls_last())
    previous = F.when(F.row_number().over(window) == 1, F.col("current_hash")).otherwise(
        F.lag("set_hash").over(window)
    )
    seen = F.col("_stored") | (F.row_number().over(window) > 1)
    return (
        joined.withColumn(
            "previous_hash", F.when(F.col("_late"), F.col("current_hash")).otherwise(previous)
        )
        .withColumn("_seen", seen)
        .withColumn(
            "decision",
            F.when(F.col("_late") & again, F.lit(UNCHANGED)).when(F.col("_late"), F.lit(LATE)).otherwise(
                write_decision(F.col("set_hash"), F.col("previous_hash"), F.col("_seen"), force)
            ),
        )
        .drop("current_hash", "last_ingested", "_stored", "_late", "_seen")
    )


def is_stored(decision: Column) -> Column:
    """Late snapshots are stored too, though they replace nothing."""
    return decision.isin(NEW, CHANGED, LATE)


def change_log(decisions: DataFrame) -> DataFrame:
    """One log row per group and run, whether changed or not."""
    return decisions.select(
        "run_id",
        *GROUP_KEYS,
        is_write(F.col("decision")).alias("changed"),
        F.col("set_hash").alias("current_hash"),
        "previous_hash",
        F.col("member_count").cast("int").alias("member_count"),
        "run_ts",
        "decision",
    )


def state_from_log(log: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """State of every group after the runs in ``log``: the last run seen, changed or not."""
    seen = log.where(F.col("decision") != LATE)
    newest = F.struct("run_ts", "run_id")
    return (
        seen.groupBy(*keys)
        .agg(
            F.max_by(F.struct("current_hash", "run_ts", "run_id", "member_count"), newest).alias("_l")
        )
        .select(
            *keys,
            F.col("_l.current_hash").alias("current_hash"),
            F.col("_l.run_ts").alias("last_ingested"),
            F.col("_l.run_id").alias("last_run_id"),
            F.col("_l.member_count").alias("member_count"),
        )
    )


def upsert_state(state: DataFrame, batch: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """Insert or replace by key: the newer row of state and batch wins, the batch on a tie."""
    both = state.withColumn("_batch", F.lit(0)).unionByName(
        batch.select(*state.columns).withColumn("_batch", F.lit(1))
    )
    return newest_state(both, keys)


def newest_state(parts: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """The newest row of each key in state rows numbered by ``_batch``, the later batch on a tie."""
    columns = [c for c in parts.columns if c != "_batch"]
    values = [c for c in columns if c not in keys]
    newest = F.struct("last_ingested", "_batch", "last_run_id")
    return (
        parts.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), newest).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])
        .select(*columns)
    )


def lookup_state(state: DataFrame, wanted: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """State rows of the wanted keys, all in one job."""
    return state.join(wanted.select(*keys), list(keys), "left_semi")


def list_state(state: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """All state rows in key order."""
    return state.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def empty_groups(expected: DataFrame, seen: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """Expected groups that delivered no member: status rows that leave the state untouched."""
    return expected.join(seen.select(*keys), list(keys), "left_anti").select(
        *keys,
        F.lit("failed").alias("status"),
        F.lit(0).cast("bigint").alias("member_count"),
        F.lit("no members found").alias("error"),
    )


def skip_ratio(decisions: DataFrame, keys: Sequence[str] = ("group_id",)) -> DataFrame:
    """How many snapshots of each group were unchanged and so need no storage."""
    unchanged = F.count_if(F.col("decision") == UNCHANGED)
    return decisions.groupBy(*keys).agg(
        F.count("*").cast("bigint").alias("snapshots"),
        F.count_if(is_write(F.col("decision"))).cast("bigint").alias("written"),
        unchanged.cast("bigint").alias("skipped"),
        (unchanged / F.count("*")).alias("skip_ratio"),
    )
