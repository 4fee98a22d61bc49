"""Reading and writing the warehouse tables as partitioned files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snaphist.session import hadoop_path

# A table partition is dealt to so many shares; Spark merges small ones, so this bounds its files, not its tasks.
SHARES = 32
_SHARE = "_share"


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether anything matches ``path``, asked of the file system without listing below it."""
    where, files = hadoop_path(spark, path)
    return bool(files.globStatus(where))


def read_table(
    spark: SparkSession, path: str, schema: StructType, format: str = "parquet"
) -> DataFrame:
    """The table at ``path``, or an empty one where nothing has been written yet.

    The schema is given, not inferred, so partition values keep their declared type.
    """
    if not has_table(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(format).schema(schema).load(path).select(*schema.names)


def read_run(
    spark: SparkSession, path: str, schema: StructType, run_id: str, above: str = ""
) -> DataFrame:
    """The rows of one run of a table: only its own folders are listed, however many runs there are.

    ``above`` is a pattern for the partition folders above the run's, such as ``season=*/``.
    """
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
    folder = f"{path}/{above}run_id=" + re.sub(r"([\\\[\]{}*?])", r"\\\1", escaped)
    if not has_table(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(folder).select(*schema.names)


def read_folders(spark: SparkSession, folders: list[str], schema: StructType) -> DataFrame:
    """The rows of the given folders, none if there are no folders."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def write_partitions(
    df: DataFrame, path: str, partition_by: list[str], format: str = "parquet", rebalance: bool = True
) -> None:
    """Replace exactly the partitions that occur in ``df``.

    A run writes only partitions named after it, so earlier runs stay untouched and a
    replay of the same run leaves the same rows once. The rebalance evens out file sizes:
    Spark merges small and splits large partitions by their measured size. The run is the same in all rows
    and so says nothing about where they should go. Other columns may have a few values only, and Spark
    measures compressed bytes, of which repetitive rows need few; the rows of a value are therefore dealt to
    shares by their hash, or one task would sort millions of them.
    """
    if rebalance:
        by = [c for c in partition_by if c != "run_id"]
        if by:
            share = F.pmod(F.xxhash64(*df.columns), F.lit(SHARES)).cast("int")
            df = df.withColumn(_SHARE, share).hint("rebalance", *by, _SHARE).drop(_SHARE)
        else:
            df = df.hint("rebalance")
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy" if format == "parquet" else "gzip")
        .partitionBy(*partition_by)
        .format(format)
        .save(path)
    )
