"""Which documents have landed before, by what is in them: one that lands again is not parsed again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.operators.skew import match_keys
from snaphist.schemas import LEDGER, to_schema
from snaphist.sources import warehouse
from snaphist.sources.tables import read_table, write_partitions

_SAME = ["group_id", "season", "run_ts", "digest"]


def with_digest(docs: DataFrame) -> DataFrame:
    return docs.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/ledger", LEDGER)


def landed_before(spark: SparkSession, root: str, before: int) -> DataFrame:
    """Documents of the runs committed up to state version ``before``."""
    runs = warehouse.read_runs(spark, root).where(F.col("state_version") <= before).select(F.col("run_id").alias("_run"))
    return read_ledger(spark, root).join(runs, F.col("run_id") == F.col("_run"), "left_semi")


def split_repeats(docs: DataFrame, root: str, before: int) -> tuple[DataFrame, DataFrame]:
    """Documents that no earlier run has had for the same snapshot, and those that one has.

    Path and file name do not matter. Equal documents of one run stay: a snapshot may list a member twice.
    """
    known = landed_before(docs.sparkSession, root, before).select(*_SAME).distinct()
    return match_keys(docs, known, _SAME, "left_anti"), match_keys(docs, known, _SAME, "left_semi")


def write_ledger(docs: DataFrame, root: str, run_id: str) -> None:
    """Record the documents of a run; they count once the run commits."""
    rows = docs.select(*_SAME).distinct().withColumn("run_id", F.lit(run_id))
    write_partitions(to_schema(rows, LEDGER), f"{root}/ledger", ["run_id"])
