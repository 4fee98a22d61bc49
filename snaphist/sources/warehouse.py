"""Warehouse tables: raw members, state, change log, runs and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from snaphist.functions.times import utc_now
from snaphist.operators.changes import GROUP_KEYS, decide_history, is_stored, is_write, newest_state, upsert_state
from snaphist.operators.sethash import DIGEST, LISTED
from snaphist.operators.skew import match_keys
from snaphist.schemas import (
    CHANGE_LOG,
    INDEX,
    POINTER,
    RAW_MEMBERS,
    RUNS,
    SETTINGS,
    STATE,
    to_schema,
)
from snaphist.session import materialize, remove_folder
from snaphist.sources.tables import read_folders, read_run, read_table, write_partitions

# Part of the layout of a warehouse.
STATE_BUCKETS = 64
# So many runs only add their rows to the state; the next one folds them into the buckets they touch.
FOLD_AFTER = 8

_SNAPSHOT = [*GROUP_KEYS, "run_ts"]


def aligned(df: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Rows conformed to the raw table: known columns kept, absent ones NULL, load time filled in."""
    now = utc_now() if load_ts is None else load_ts
    return to_schema(df, RAW_MEMBERS, {"load_ts": now})


def load_members(df: DataFrame, root: str, load_ts: Column | None = None) -> int:
    """Append member rows to the raw table and return how many there were."""
    if df.isEmpty():
        return 0
    observed = Observation("load")
    rows = aligned(df, load_ts).observe(observed, F.count(F.lit(1)).alias("rows"))
    write_partitions(rows, f"{root}/raw_members", ["season", "run_id"])
    return observed.get["rows"]


def read_members(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/raw_members", RAW_MEMBERS)


def write_log(rows: DataFrame, root: str) -> None:
    write_partitions(to_schema(rows, CHANGE_LOG), f"{root}/change_log", ["run_id"])


def read_log(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    if run_id is not None:
        return read_run(spark, f"{root}/change_log", CHANGE_LOG, run_id)
    return read_table(spark, f"{root}/change_log", CHANGE_LOG)


def committed(rows: DataFrame, root: str) -> DataFrame:
    """The rows of runs that are complete. One row per run is matched, so Spark prunes by it the run folders."""
    runs = read_runs(rows.sparkSession, root).select(F.col("run_id").alias("_run"))
    return rows.join(runs, F.col("run_id") == F.col("_run"), "left_semi")


def _bucket_path(root: str, version: int, bucket: int) -> str:
    return f"{root}/state/version={version:012d}/bucket={bucket}"


def _added_path(root: str, version: int) -> str:
    return f"{root}/state_added/version={version:012d}"


def _index_path(root: str, version: int) -> str:
    return f"{root}/state_index/version={version:012d}"


def _bucket() -> Column:
    return F.pmod(F.xxhash64("group_id", "season"), F.lit(STATE_BUCKETS)).cast("int")


def _read_index(spark: SparkSession, root: str, version: int) -> tuple[dict[int, int], list[int]]:
    """Which version holds each bucket of a state version, and which versions were added since."""
    rows = read_table(spark, _index_path(root, version), INDEX).collect()
    held = {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}
    return held, sorted(r["version"] for r in rows if r["bucket"] is None)


def _read_parts(spark: SparkSession, root: str, held: dict[int, int], added: list[int]) -> DataFrame:
    """The newest row of each group in the given buckets and added versions, the later version on a tie."""
    state = read_folders(spark, [_bucket_path(root, v, b) for b, v in sorted(held.items())], STATE)
    if not added:
        return state
    parts = state.withColumn("_batch", F.lit(0).cast("bigint"))
    for version in added:
        rows = read_folders(spark, [_added_path(root, version)], STATE)
        parts = parts.unionByName(rows.withColumn("_batch", F.lit(version).cast("bigint")))
    return newest_state(parts)


def update_state(batch: DataFrame, root: str, before: int, version: int) -> None:
    """Write state ``version``: that of ``before`` with the rows of ``batch`` upserted.

    A version is the rows of its batch, beside what its index names: the buckets the state lies in and the
    versions added since they were written. Every ``FOLD_AFTER`` versions these are folded into
    the buckets that they touch. Readers see a version once a run names it.
    """
    spark = batch.sparkSession
    held, added = _read_index(spark, root, before)
    if len(added) + 1 < FOLD_AFTER:
        to_schema(batch, STATE).write.mode("overwrite").parquet(_added_path(root, version))
        added = [*added, version]
    else:
        recent = materialize(upsert_state(_read_parts(spark, root, {}, added), to_schema(batch, STATE)), "recent")
        touched = [r["bucket"] for r in recent.select(_bucket().alias("bucket")).distinct().collect()]
        old = _read_parts(spark, root, {b: held[b] for b in touched if b in held}, [])
        rows = to_schema(upsert_state(old, recent), STATE).withColumn("bucket", _bucket())
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/state/version={version:012d}")
        held, added = held | dict.fromkeys(touched, version), []
    index = [*sorted(held.items()), *((None, v) for v in added)]
    spark.createDataFrame(index, INDEX).coalesce(1).write.mode("overwrite").parquet(_index_path(root, version))


def read_state_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return _read_parts(spark, root, *_read_index(spark, root, version))


def drop_old_states(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove what only state versions before the last ``keep`` committed ones read.

    Runs up to there cannot be repeated afterwards.
    """
    versions = [r[0] for r in read_runs(spark, root).select("state_version").distinct().collect()]
    kept = sorted(versions)[-keep:]
    indexes = [_read_index(spark, root, k) for k in kept]
    buckets = {(b, v) for held, _ in indexes for b, v in held.items()}
    parts = {v for _, added in indexes for v in added}
    for version in range(1, max(kept, default=0)):
        if version not in kept:
            remove_folder(spark, _index_path(root, version))
        if version not in parts:
            remove_folder(spark, _added_path(root, version))
        for bucket in range(STATE_BUCKETS):
            if (bucket, version) not in buckets:
                remove_folder(spark, _bucket_path(root, version, bucket))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """Current state: the version named by the latest committed run."""
    version = latest_version(read_runs(spark, root))
    return read_state_version(spark, root, version)


def write_run(row: DataFrame, root: str) -> None:
    """Commit a run. Written last: without this row, a run's state version is never read."""
    write_partitions(to_schema(row, RUNS), f"{root}/runs", ["run_id"], rebalance=False)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/runs", RUNS)


def latest_version(runs: DataFrame) -> int:
    """Greatest committed state version, 0 if there is none."""
    return runs.agg(F.max("state_version")).first()[0] or 0


def versions_of(runs: DataFrame, run_id: str) -> tuple[int, int]:
    """The state version a run starts from and the one it writes.

    A new run follows the latest one. A run committed before gets the versions it had.
    """
    own = F.when(F.col("run_id") == run_id, F.col("state_version"))
    latest, written = runs.agg(F.max("state_version"), F.max(own)).first()
    if written is None:
        return latest or 0, (latest or 0) + 1
    return latest_version(runs.where(F.col("state_version") < written)), written


def hash_form(spark: SparkSession, root: str, wanted: str | None = None) -> str:
    """The form of set hash a warehouse uses: recorded by its first run, the same ever after."""
    path = f"{root}/settings"
    recorded = read_table(spark, path, SETTINGS, format="json").first()
    if recorded is None:
        form = LISTED if wanted is None else wanted
        if form not in (LISTED, DIGEST):
            raise ValueError(f"no such form of hash: {form}")
        spark.createDataFrame([(form,)], SETTINGS).coalesce(1).write.mode("overwrite").json(path)
        return form
    if wanted is not None and wanted != recorded["hash_form"]:
        raise ValueError(f"this warehouse uses the {recorded['hash_form']} hash")
    return recorded["hash_form"]


def versions(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """The log of committed runs with the state version of each, those up to ``upto`` if given.

    A snapshot that came in parts has one row per run that brought one, each with the hash of the members
    known by then; the row of the greatest version tells how the snapshot is.
    """
    runs = read_runs(spark, root).select(F.col("run_id").alias("_run"), F.col("state_version").alias("version"))
    if upto is not None:
        runs = runs.where(F.col("version") <= upto)
    log = read_log(spark, root).withColumnRenamed("current_hash", "set_hash")
    return log.join(runs, F.col("run_id") == F.col("_run")).drop("_run")


def latest_versions(found: DataFrame) -> DataFrame:
    """Each snapshot as its last version has it, with column ``stored``."""
    last = F.struct("set_hash", "run_id", F.col("member_count").cast("bigint").alias("member_count"), "version",
                    is_stored(F.col("decision")).alias("stored"))
    return found.groupBy(*_SNAPSHOT).agg(F.max_by(last, F.struct("version")).alias("_v")).select(*_SNAPSHOT, "_v.*")


def stored_under(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """Where the members of ``wanted`` snapshots (keys, set_hash) lie: adds ``from_run`` and ``from_ts``.

    That is the version last stored with that hash at or before the snapshot's own time: the snapshot's own, or
    of an earlier one that it was equal to when it came and that it therefore was not stored beside.
    """
    names = [*GROUP_KEYS, "set_hash", "run_ts"]
    kept = found.where(is_stored(F.col("decision"))).select(
        *names, "version", F.struct(F.col("run_id").alias("from_run"), F.col("run_ts").alias("from_ts")).alias("_at")
    )
    asked = wanted.select(*names, F.lit(None).cast("bigint").alias("version"), F.lit(None).cast(kept.schema["_at"].dataType).alias("_at"))
    before = (
        Window.partitionBy(*GROUP_KEYS, "set_hash")
        .orderBy("run_ts", F.col("version").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = kept.unionByName(asked).withColumn("_from", F.last("_at", ignorenulls=True).over(before))
    return placed.where(F.col("version").isNull()).select(*names, "_from.*")


def members_from(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The member rows of ``places`` (see ``stored_under``), as rows of the snapshots that asked."""
    asked = places.select(
        "group_id", "season", F.col("from_run").alias("run_id"), F.col("from_ts").alias("run_ts"),
        F.col("run_ts").alias("_at"), F.col("set_hash").alias("_hash"),
    )
    found = match_keys(rows.drop("set_hash"), asked, [*GROUP_KEYS, "run_id", "run_ts"], "inner")
    return found.withColumn("run_ts", F.col("_at")).withColumn("set_hash", F.col("_hash")).select(*rows.columns)


def ordered_members(spark: SparkSession, root: str) -> DataFrame:
    """Raw rows of every snapshot that changed its group, in the order of run times.

    The order in which snapshots arrived, and in how many parts, makes no difference: each counts as its last version
    has it, a late one where it belongs, one that turns out unchanged is left out, and one that was
    not stored because it equalled an earlier snapshot, but no longer its predecessor, is given that
    snapshot's members. Runs that did not commit are not seen.
    """
    found = versions(spark, root)
    history = decide_history(latest_versions(found))
    wanted = history.where(is_write(F.col("decision")))
    return members_from(read_members(spark, root), stored_under(found, wanted))


def save_mart(df: DataFrame, root: str, name: str, version: str) -> DataFrame:
    """Rebuild a mart in full under a new version, then point readers and its view there.

    The pointer is written last, so a version is read only when it is complete. Pointers count up, so
    the last one written is the latest version, whatever it is called.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{root}/marts/{name}/version={version}")
    last = _pointers(spark, root, name).agg(F.max("number")).first()[0] or 0
    pointer = spark.createDataFrame([(last + 1, version)], POINTER)
    write_partitions(pointer, f"{root}/mart_pointers/{name}", ["number"], rebalance=False)
    mart = read_mart(spark, root, name)
    mart.createOrReplaceTempView(name)
    return mart


def _pointers(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root}/mart_pointers/{name}", POINTER)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The version of a mart that was completed last."""
    latest = _pointers(spark, root, name).orderBy(F.desc("number")).first()
    if latest is None:
        raise ValueError(f"no complete version of {name}")
    return spark.read.parquet(f"{root}/marts/{name}/version={latest['version']}")


def register(spark: SparkSession, root: str) -> None:
    """Make the warehouse tables available to SQL. Of a run that has not committed they show nothing."""
    committed(read_members(spark, root), root).createOrReplaceTempView("raw_members")
    read_state(spark, root).createOrReplaceTempView("group_state")
    committed(read_log(spark, root), root).createOrReplaceTempView("change_log")
    read_runs(spark, root).createOrReplaceTempView("runs")


def query(spark: SparkSession, root: str, sql: str) -> DataFrame:
    """Run ad-hoc SQL over the warehouse; the result stays lazy."""
    register(spark, root)
    return spark.sql(sql)
