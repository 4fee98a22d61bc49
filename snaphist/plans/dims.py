"""Dimension models built from staging and raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.functions.codes import GROUP_NAMES, code_table, with_code_name
from snaphist.functions.text import first_token, last_token
from snaphist.functions.times import utc_now
from snaphist.operators.scd2 import scd2
from snaphist.operators.skew import Splits, match_keys, split_hot_keys
from snaphist.operators.surrogate import stable_key, surrogate_key
from snaphist.plans.staging import stage_rows, stg_members

# The attributes whose change makes a new version.
TRACKED = ("group_id", "number", "position", "shoots_catches", "height", "weight")

DIM_MEMBER_COLUMNS = [
    "member_sk",
    "member_id",
    "member_nk",
    "full_name",
    "first_name",
    "last_name",
    "group_id",
    "number",
    "position",
    "position_group",
    "shoots_catches",
    "height",
    "weight",
    "birth_date",
    "effective_date",
    "end_date",
    "is_current",
    "hash_diff",
]


def dim_group(raw: DataFrame, names: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """Type 1 group dimension: every group ever seen, with its display name."""
    spark = raw.sparkSession
    lookup = code_table(spark, GROUP_NAMES) if names is None else names
    stamp = utc_now() if as_of is None else as_of
    groups = with_code_name(raw.select("group_id").distinct(), "group_id", lookup, "group_name")
    return surrogate_key(groups, ["group_id"], "group_sk").select(
        "group_sk",
        "group_id",
        "group_name",
        F.lit(1).alias("active_flag"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def dim_member(
    staged: DataFrame,
    *,
    collapse: bool = True,
    tracked: Sequence[str] = TRACKED,
    splits: Splits | None = None,
    runs: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Type 2 member dimension over staged rows.

    On the latest-row staging model with ``collapse=False`` every row is a version; on the
    full history (``stage_rows``) with ``collapse`` it holds each change once. The natural
    key numbers rows by member, then by start, and so equals the surrogate key;
    ``member_key`` is the key that stays the same across rebuilds.

    ``runs`` (group_id, season, run_ts of the stored snapshots) closes a member at the next stored
    run of its group and season that no longer lists it. Runs at which a group did not change are not
    stored and close nobody.
    """
    versions = scd2(
        staged,
        "member_id",
        "run_ts",
        tracked,
        collapse=collapse,
        tiebreak=["group_id"],
        splits=splits,
        runs=runs,
        scope=() if runs is None else ("group_id", "season"),
        ranged=True,
    ).select(
        "member_id",
        "full_name",
        first_token(F.col("full_name")).alias("first_name"),
        last_token(F.col("full_name")).alias("last_name"),
        "group_id",
        "number",
        "position",
        "position_group",
        "shoots_catches",
        "height",
        "weight",
        "birth_date",
        "effective_date",
        "end_date",
        "is_current",
        "hash_diff",
    )
    # The history comes in ranges of members and in order, so numbering takes no shuffle of its own.
    numbered = surrogate_key(
        versions, ["member_id", "effective_date", "group_id"], "member_sk", ranged=True
    )
    if keys is None:
        numbered = numbered.withColumn("member_nk", F.col("member_sk"))
    else:
        numbered = match_keys(numbered, keys.select("member_id", "member_nk"), ["member_id"], "left")
    return numbered.select(*DIM_MEMBER_COLUMNS, stable_key("member_id").alias("member_key"))


def dim_member_latest(
    raw: DataFrame, season: str | None = None, staged: DataFrame | None = None
) -> DataFrame:
    """The member dimension over the staging model: one version per group a member was in.

    ``staged`` is the staging model where it is at hand as a table.
    """
    if staged is not None:
        return dim_member(staged, collapse=False)
    staged = stg_members(raw, season)
    # Staging only drops rows, so members are measured on the raw rows, without its shuffle.
    splits = split_hot_keys(
        staged, ["member_id"], "run_ts", superset=stage_rows(raw, season).select("member_id")
    )
    return dim_member(staged, collapse=False, splits=splits)
