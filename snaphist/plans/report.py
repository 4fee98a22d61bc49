"""Counts over the warehouse, as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _long(counts: DataFrame, metrics: list[str]) -> DataFrame:
    pairs = [value for m in metrics for value in (F.lit(m), F.col(m))]
    return counts.select(F.stack(F.lit(len(metrics)), *pairs).alias("metric", "value"))


def warehouse_counts(raw: DataFrame, dim_group: DataFrame, dim_member: DataFrame) -> DataFrame:
    """Six figures: groups, members and rows loaded, groups, members and current members modelled."""
    # One pass over the raw rows; the distinct counts are then taken over its pairs.
    pairs = raw.groupBy("group_id", "member_id").agg(F.count("*").alias("n"))
    raw_counts = pairs.agg(
        F.count_distinct("group_id").alias("raw_groups"),
        F.count_distinct("member_id").alias("raw_members"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_records"),
    )
    parts = [
        _long(raw_counts, ["raw_groups", "raw_members", "raw_records"]),
        _long(dim_group.agg(F.count("*").alias("dim_groups")), ["dim_groups"]),
        _long(
            dim_member.agg(
                F.count_distinct("member_id").alias("dim_members"),
                F.count_if("is_current").alias("current_members"),
            ),
            ["dim_members", "current_members"],
        ),
    ]
    return reduce(DataFrame.unionByName, parts).select(
        "metric", F.col("value").cast("bigint").alias("value")
    )


def approximate_counts(raw: DataFrame) -> DataFrame:
    """Groups and members of the raw table by sketch: one pass, no exchange of values."""
    counts = raw.agg(
        F.approx_count_distinct("group_id").alias("raw_groups"),
        F.approx_count_distinct("member_id").alias("raw_members"),
        F.count("*").alias("raw_records"),
    )
    return _long(counts, ["raw_groups", "raw_members", "raw_records"])
