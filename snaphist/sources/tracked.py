"""The list of groups to track."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.functions.codes import GROUP_NAMES
from snaphist.functions.text import strip


def clean_codes(df: DataFrame, column: str, name: str = "group_id") -> DataFrame:
    """Codes without surrounding white space, blank ones dropped."""
    return df.select(strip(F.col(column)).alias(name)).where(F.col(name) != "")


def read_tracked(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Tracked groups from a text file with one code per line, or the default list."""
    if path is None:
        return spark.createDataFrame([(code,) for code in GROUP_NAMES], "group_id STRING")
    return clean_codes(spark.read.text(path), "value")


def keep_tracked(df: DataFrame, tracked: DataFrame, group: str = "group_id") -> DataFrame:
    return df.join(tracked.select(F.col("group_id").alias(group)), group, "left_semi")


def untracked(df: DataFrame, tracked: DataFrame, group: str = "group_id") -> DataFrame:
    """Rows of groups that are not on the list."""
    return df.join(tracked.select(F.col("group_id").alias(group)), group, "left_anti")
