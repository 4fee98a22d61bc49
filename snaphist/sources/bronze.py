"""Bronze layer: immutable snapshots, raw payloads and run manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.functions.text import payload_kind, strip
from snaphist.operators.latest import latest_per_key
from snaphist.schemas import BRONZE, MANIFEST, PAYLOADS, STATE, to_schema
from snaphist.sources.tables import read_run, read_table, write_partitions

GROUP_KEYS = ["group_id", "season"]


def bronze_path(root: str) -> str:
    return f"{root}/bronze"


def payload_path(root: str) -> str:
    return f"{root}/payloads"


def manifest_path(root: str) -> str:
    return f"{root}/manifests"


def enrich(members: DataFrame, loaded_at: Column) -> DataFrame:
    """Bronze rows: member records with their set hash and the load time."""
    return to_schema(members, BRONZE, {"bronze_loaded_at": loaded_at})


def write_bronze(members: DataFrame, root: str, by_group: bool = False) -> None:
    """Append a run's member rows as Parquet, partitioned by season and run.

    ``by_group`` adds a folder per group, which suits a few dozen groups only.
    """
    layout = ["season", "group_id", "run_id"] if by_group else ["season", "run_id"]
    write_partitions(to_schema(members, BRONZE), bronze_path(root), layout)


def read_bronze(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    if run_id is not None:
        return read_run(spark, bronze_path(root), BRONZE, run_id, "season=*/")
    return read_table(spark, bronze_path(root), BRONZE)


def stored_groups(bronze: DataFrame) -> DataFrame:
    """Groups that have at least one stored snapshot."""
    return bronze.select(*GROUP_KEYS).distinct()


def latest_hash(bronze: DataFrame) -> DataFrame:
    """Set hash of each group's latest stored run, by run time."""
    return bronze.groupBy(*GROUP_KEYS).agg(
        F.max_by("set_hash", F.struct("run_ts", "run_id")).alias("set_hash"),
        F.max("run_ts").alias("run_ts"),
    )


def classify_payloads(docs: DataFrame) -> DataFrame:
    """Payload rows with their kind and without surrounding white space."""
    return to_schema(
        docs.withColumn("payload_kind", payload_kind(F.col("payload"))).withColumn(
            "payload", strip(F.col("payload"))
        ),
        PAYLOADS,
    )


def write_payloads(docs: DataFrame, root: str) -> None:
    write_partitions(classify_payloads(docs), payload_path(root), ["payload_kind", "run_id"])


def read_payloads(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, payload_path(root), PAYLOADS)


def manifest(written: DataFrame, root: str, source: str) -> DataFrame:
    """One row per stored snapshot, naming the folders its run was written to.

    ``written`` has one row per group, season and run with its hash and member count.
    """

    def folder(base: str, *parts: Column) -> Column:
        return F.concat(F.lit(base), *parts)

    run = F.concat(F.lit("/run_id="), F.col("run_id"))
    files = F.struct(
        folder(bronze_path(root), F.lit("/season="), F.col("season"), run).alias("bronze"),
        folder(payload_path(root), F.lit("/payload_kind=*"), run).alias("payload"),
    )
    return to_schema(
        written.withColumn("source", F.lit(source)).withColumn("files", files), MANIFEST
    )


def manifest_of(bronze: DataFrame) -> DataFrame:
    """Hash, member count and time of every stored snapshot, recomputed from bronze rows."""
    return bronze.groupBy(*GROUP_KEYS, "run_id").agg(
        F.first("set_hash").alias("set_hash"),
        F.count("*").cast("int").alias("member_count"),
        F.max("run_ts").alias("run_ts"),
        F.first("source").alias("source"),
    )


def write_manifest(rows: DataFrame, root: str) -> None:
    write_partitions(rows, manifest_path(root), ["run_id"], format="json")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, manifest_path(root), MANIFEST, format="json")


def latest_run(manifests: DataFrame) -> DataFrame:
    """Latest manifest row of each group; a group without one has no row."""
    return latest_per_key(manifests, GROUP_KEYS, "run_ts", ["run_id"])


def state_of(manifests: DataFrame) -> DataFrame:
    """State as the stored snapshots tell it, to decide against bronze or to rebuild lost state."""
    return to_schema(
        latest_run(manifests).withColumnsRenamed(
            {"set_hash": "current_hash", "run_ts": "last_ingested", "run_id": "last_run_id"}
        ),
        STATE,
        {"updated_at": F.col("last_ingested")},
    )


def list_runs(
    manifests: DataFrame, group_id: str | None = None, season: str | None = None
) -> DataFrame:
    """Manifest rows in run order, of one group and season if given."""
    if group_id is not None:
        manifests = manifests.where(F.col("group_id") == group_id)
    if season is not None:
        manifests = manifests.where(F.col("season") == season)
    return manifests.orderBy("group_id", "season", "run_ts", "run_id")
