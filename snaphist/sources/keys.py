"""Lasting numbers for keys: a dictionary that only grows, so a number once given never moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from snaphist.operators.skew import match_keys
from snaphist.operators.surrogate import surrogate_key
from snaphist.schemas import KEY_BATCHES
from snaphist.sources.tables import read_folders, read_table, write_partitions


def _folder(root: str, batch: int) -> str:
    return f"{root}/numbers/batch={batch:012d}"


def _batches(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/batches", KEY_BATCHES)


def _schema(keys: DataFrame, key: str, number: str) -> StructType:
    return StructType([StructField(key, keys.schema[key].dataType), StructField(number, LongType())])


def read_keys(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """All keys numbered so far (key, number)."""
    known = sorted(r["batch"] for r in _batches(spark, root).select("batch").collect())
    return read_folders(spark, [_folder(root, b) for b in known], schema)


def number_keys(keys: DataFrame, root: str, key: str, run_id: str, number: str = "member_nk") -> DataFrame:
    """Number the keys of ``keys`` that have no number yet and return the whole dictionary.

    New keys follow the last number given, in their own order: they are dealt to tasks by range, and each task
    numbers its keys within a range reserved for it by the counts of the tasks before. The batch is committed
    last, so a run that broke off is repeated with the same numbers; a committed one is left as it is.
    NULL is a key like any other.
    """
    spark = keys.sparkSession
    schema = _schema(keys, key, number)
    batches = _batches(spark, root)
    done, last, highest = batches.agg(
        F.max(F.col("run_id") == run_id), F.max("batch"), F.max("last_number")
    ).first()
    if not done:
        batch, highest = (last or 0) + 1, highest or 0
        new = match_keys(keys.select(key).distinct(), read_keys(spark, root, schema), [key], "left_anti")
        numbered = surrogate_key(new.select(key), [key], number)
        numbered = numbered.select(key, (F.col(number) + F.lit(highest)).alias(number))
        numbered.write.mode("overwrite").parquet(_folder(root, batch))
        given = spark.read.schema(schema).parquet(_folder(root, batch)).count()
        row = spark.createDataFrame([(batch, run_id, highest + given)], KEY_BATCHES)
        write_partitions(row, f"{root}/batches", ["batch"], rebalance=False)
    return read_keys(spark, root, schema)
