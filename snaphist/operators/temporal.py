"""Questions about a history: state at a time, changes, usage and membership moves."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaphist.functions.times import moment
from snaphist.operators.ordered import carry_forward, with_neighbours
from snaphist.operators.skew import Splits, split_hot_keys, with_part
from snaphist.session import materialize


def as_of(versions: DataFrame, at: str | datetime.datetime | Column) -> DataFrame:
    """Versions valid at a moment. A plain filter, so it reaches the files of a stored history."""
    t = moment(at)
    return versions.where((F.col("effective_date") <= t) & (t < F.col("end_date")))


def as_of_each(versions: DataFrame, moments: Sequence[str], name: str = "as_of") -> DataFrame:
    """Versions valid at each of a few given moments, without a join."""
    times = F.array(*[moment(m) for m in moments])
    valid = F.filter(times, lambda t: (F.col("effective_date") <= t) & (t < F.col("end_date")))
    return versions.select("*", F.explode(valid).alias(name))


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    *,
    how: str = "inner",
    splits: Splits | None = None,
) -> DataFrame:
    """Attach to every dated fact the version of its key valid at that time.

    Facts and versions are merged and ordered per key, and the latest version is carried
    forward. That is one pass over sorted rows: unlike an equi-join with a range condition
    it never pairs all facts of a key with all its versions. Columns of ``versions`` must
    not clash with those of ``facts``, the key aside. ``splits`` cuts ``key`` by ``ts``; it is
    best measured on the facts together with the rows the versions were made from. A fact
    whose key or time is NULL has no version: it is dropped, or kept with NULLs if ``how`` is left.
    """
    named = F.col(key).isNotNull()
    nameless = facts.where(~named)
    facts, versions = facts.where(named), versions.where(named)
    attributes = [c for c in versions.columns if c != key]
    fact = F.struct(*[c for c in facts.columns])
    starts = versions.select(
        F.col(key).alias("_key"),
        F.col("effective_date").alias("_ts"),
        F.lit(0).alias("_kind"),
        F.col("end_date").alias("_end"),
        F.struct(*attributes).alias("_version"),
        F.lit(None).cast(facts.select(fact.alias("f")).schema["f"].dataType).alias("_fact"),
    )
    dated = facts.select(
        F.col(key).alias("_key"),
        F.col(ts).alias("_ts"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast("timestamp_ntz").alias("_end"),
        F.lit(None).cast(starts.schema["_version"].dataType).alias("_version"),
        fact.alias("_fact"),
    )
    if splits is None:
        dates = versions.select(key, F.col("effective_date").alias(ts))
        splits = split_hot_keys(facts.select(key, ts).unionByName(dates), [key], ts)
    splits = splits.renamed(["_key"], "_ts")
    # Versions of an empty validity come first among equal starts and are overtaken.
    merged = with_part(starts.unionByName(dated), splits)
    carried = carry_forward(merged, splits, "_version", "_at", tiebreak=["_kind", "_end"])
    valid = F.col("_ts") < F.col("_at.end_date")
    result = carried.where(F.col("_kind") == 1)
    if how == "inner":
        result = result.where(valid)
    result = result.select(
        *[F.col(f"_fact.{c}").alias(c) for c in facts.columns],
        *[F.when(valid, F.col(f"_at.{c}")).alias(c) for c in attributes],
    )
    if how == "inner":
        return result
    empty = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in attributes]
    return result.unionByName(nameless.select("*", *empty))


def attribute_changes(
    df: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    *,
    tiebreak: Sequence[str] = (),
    splits: Splits | None = None,
) -> DataFrame:
    """When which attribute of a key changed, from what to what: one row per change."""
    if splits is None:
        splits = split_hot_keys(df, [key], ts, tiebreak=tiebreak)
    rows = with_neighbours(
        with_part(df.select(key, ts, *tiebreak, *attributes), splits),
        splits,
        tiebreak,
        previous={"_before": ts, **{f"_old_{a}": a for a in attributes}},
    )
    triples = []
    for a in attributes:
        triples += [
            F.lit(a),
            F.col(f"_old_{a}").cast("string"),
            F.col(a).cast("string"),
        ]
    return (
        rows.where(F.col("_before").isNotNull())
        .select(
            key,
            F.col(ts).alias("changed_at"),
            F.stack(F.lit(len(attributes)), *triples).alias("attribute", "old_value", "new_value"),
        )
        .where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    )


def members_used(
    df: DataFrame, group: str = "group_id", season: str = "season", member: str = "member"
) -> DataFrame:
    """How many different members each group ever listed in a season."""
    return df.groupBy(group, season).agg(
        F.count_distinct(member).cast("bigint").alias("members_used")
    )


def membership_diff(
    df: DataFrame, group: str = "group_id", run: str = "run_ts", member: str = "member"
) -> DataFrame:
    """Who joined, left or stayed at each run of a group, compared with its run before.

    Members of the first run of a group count as joined. The distinct rows are computed once and
    written; the runs follow from them. Windows run per group over its runs and per (group, member),
    both at most as long as the number of runs.
    """
    listed = materialize(df.select(group, run, member).distinct(), "listed")
    by_group = Window.partitionBy(group).orderBy(run)
    runs = (
        listed.select(group, run)
        .distinct()
        .select(
            group,
            run,
            F.lag(run).over(by_group).alias("_run_before"),
            F.lead(run).over(by_group).alias("_run_after"),
        )
    )
    by_member = Window.partitionBy(group, member).orderBy(run)
    placed = listed.join(runs, [group, run]).select(
        group,
        member,
        run,
        "_run_after",
        F.lag(run).over(by_member).eqNullSafe(F.col("_run_before")).alias("_continues"),
        F.col("_run_before").isNull().alias("_is_first"),
        F.lead(run).over(by_member).alias("_seen_after"),
    )
    status = F.when(F.col("_continues") & ~F.col("_is_first"), F.lit("stayed")).otherwise(
        F.lit("joined")
    )
    leaves = F.col("_run_after").isNotNull() & ~F.col("_seen_after").eqNullSafe(F.col("_run_after"))
    at_run = F.struct(F.col(run).alias("run"), status.alias("status"))
    after = F.struct(F.col("_run_after").alias("run"), F.lit("left").alias("status"))
    moves = F.when(leaves, F.array(at_run, after)).otherwise(F.array(at_run))
    return placed.select(group, member, F.explode(moves).alias("_move")).select(
        group, F.col("_move.run").alias(run), member, F.col("_move.status").alias("status")
    )
