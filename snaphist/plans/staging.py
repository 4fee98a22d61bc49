"""Staging model: the latest row of every member in every group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.functions.codes import position_group
from snaphist.functions.seasons import season_to_short
from snaphist.functions.text import fallback_id
from snaphist.operators.latest import latest_per_key

STAGING_COLUMNS = [
    "group_id",
    "season",
    "member_id",
    "member_url",
    "number",
    "full_name",
    "position",
    "position_group",
    "age",
    "height",
    "weight",
    "shoots_catches",
    "experience",
    "birth_date",
    "set_hash",
    "run_ts",
]


def stage_rows(raw: DataFrame, season: str | None = None) -> DataFrame:
    """All raw rows of a season (or of all) with position group and a usable member id."""
    rows = raw.withColumn("season", season_to_short(F.col("season")))
    if season is not None:
        # Both season forms, as plain comparisons, so that partitions are pruned.
        rows = raw.where(F.col("season").isin(season, f"{season}{int(season) + 1}")).withColumn(
            "season", F.lit(season)
        )
    return rows.withColumn("position_group", position_group(F.col("position"))).withColumn(
        "member_id", fallback_id(F.col("member_id"), F.col("full_name"))
    )


def stg_members(raw: DataFrame, season: str | None = None, by_raw_id: bool = False) -> DataFrame:
    """Latest row per (group, member), ties resolved by run id, then by the attributes.

    The fallback id is applied before ranking, so members without an id stay apart by name.
    ``by_raw_id`` ranks by the id as delivered, which merges all members of a group that
    have none.
    """
    keyed = raw.withColumn("_raw_id", F.col("member_id"))
    rows = stage_rows(keyed, season)
    key = "_raw_id" if by_raw_id else "member_id"
    ties = [c for c in ("run_id", *STAGING_COLUMNS[3:-1]) if c in rows.columns]
    return latest_per_key(rows, ["group_id", key], "run_ts", ties).select(*STAGING_COLUMNS)


def create_staging_view(
    raw: DataFrame, season: str | None = None, name: str = "stg_members"
) -> DataFrame:
    """Staging as a view: computed when read, never stored."""
    staged = stg_members(raw, season)
    staged.createOrReplaceTempView(name)
    return staged
