"""Tables stored in buckets of a key and in order, so that work per key needs no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Buckets of a table: about one per 128 MB, at least one per core that should work on it.
BUCKETS = 64


def save_bucketed(df: DataFrame, name: str, path: str, key: str, order: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` to ``path`` in hash buckets of ``key``, each sorted by key and ``order``, as table ``name``.

    Rows are dealt by the same hash before they are written, so a bucket is one file. A window or aggregate per key, or per
    columns that include it, then reads a bucket as it lies.
    """
    dealt = df.repartition(buckets, key)
    (
        dealt.write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key, order)
        .format("parquet")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, schema: StructType, name: str, path: str, key: str, order: str, buckets: int = BUCKETS
) -> DataFrame:
    """The table written before at ``path``, for a session whose catalog does not know it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY (`{key}`) "
        f"SORTED BY (`{key}`, `{order}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
