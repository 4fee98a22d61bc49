"""Distinct members from stored sketches: each snapshot is counted once, and sketches merge on reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.schemas import SKETCHES
from snaphist.sources.tables import read_table, write_partitions

# A sketch of 2^LG_K registers is off by about 1.04 / sqrt(2^LG_K) of the count, 1.6 % here.
LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """Standard error of an estimate as a share of the count."""
    return 1.04 / 2 ** (lg_k / 2)


def sketch_members(rows: DataFrame, member: str = "member_id", lg_k: int = LG_K) -> DataFrame:
    """One sketch of the members of each snapshot (group_id, season, run_ts, run_id), and its number of rows."""
    return rows.groupBy("group_id", "season", "run_ts", "run_id").agg(
        F.hll_sketch_agg(F.col(member).cast("string"), lg_k).alias("sketch"),
        F.count("*").cast("bigint").alias("member_rows"),
    )


def write_sketches(sketches: DataFrame, root: str) -> None:
    """Add the sketches of a run; a repeated run replaces its own."""
    write_partitions(sketches.select(*SKETCHES.names), f"{root}/sketches", ["run_id"])


def read_sketches(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/sketches", SKETCHES)


def estimate_members(sketches: DataFrame, by: Sequence[str] = ("group_id", "season")) -> DataFrame:
    """Distinct members and rows per ``by``, all of the table if empty, without reading a member row."""
    counted = sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("members_estimate"),
        F.coalesce(F.sum("member_rows"), F.lit(0)).cast("bigint").alias("member_rows"),
    )
    return counted.withColumn("members_estimate", F.coalesce("members_estimate", F.lit(0).cast("bigint")))
