"""Partitioned writes: rows of one partition value go to many tasks."""

from pathlib import Path

from pyspark.sql import functions as F

from snaphist.sources.tables import write_partitions
from tests.helpers import same


def test_one_partition_value_is_written_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        df = spark.range(60_000).select(
            F.lit("same").alias("text"),
            F.lit("r1").alias("run_id"),
            F.when(F.col("id") > 0, "2024").alias("season"),
            (F.col("id") % 30_000).alias("n"),
        )
        for _ in range(2):  # a repeat replaces what it wrote
            write_partitions(df, str(tmp_path), ["season", "run_id"])
        assert len(list(Path(tmp_path, "season=2024", "run_id=r1").glob("*.parquet"))) > 1
        got = spark.read.schema(df.schema).parquet(str(tmp_path))
        assert sorted(got.columns) == sorted(df.columns) and same(got, df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
