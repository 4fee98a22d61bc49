"""One ingestion run: documents to bronze, raw table, change log and state."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.functions.codes import DEFAULT_SOURCE
from snaphist.functions.times import moment
from snaphist.operators.changes import (
    GROUP_KEYS,
    change_log,
    decide_against_state,
    is_stored,
    state_from_log,
)
from snaphist.operators.flatten import parse_documents, to_members, with_lineage
from snaphist.functions.seasons import season_of
from snaphist.operators.sethash import hash_sets
from snaphist.operators.skew import match_keys
from snaphist.session import materialize, spread
from snaphist.sources import bronze, warehouse
from snaphist.sources import ledger as landing
from snaphist.sources.tracked import keep_tracked

_SNAPSHOT = [*GROUP_KEYS, "run_ts"]


def ingest(
    docs: DataFrame,
    root: str,
    run_id: str,
    run_ts: datetime.datetime | None = None,
    *,
    source: str = DEFAULT_SOURCE,
    tracked: DataFrame | None = None,
    existing: DataFrame | None = None,
    force: bool = False,
    keep_raw: bool = False,
    hash_form: str | None = None,
    ledger: bool = False,
) -> DataFrame:
    """Ingest ``docs`` (group_id, season, payload; optionally run_ts, landed_at, problem) as run ``run_id``.

    Only groups whose member set changed are stored and loaded; the log and the state cover
    all of them. Snapshots are decided and stored whole: where earlier runs brought other parts of one, their
    members join those of this run first (see ``assemble``). Late snapshots are stored as well but leave the
    state; ``warehouse.ordered_members`` puts them in their place. A group of which any document cannot be
    read writes nothing and keeps its state. Without a season a document belongs to that of its run time;
    without ``run_ts`` the run has the latest landing time. ``hash_form`` (listed or digest) is fixed by a
    warehouse's first run. Every write replaces the run's own partitions and the run commits with its
    last write, so after a crash at any point, or by mistake, the same run can be repeated
    and leaves the same tables. Runs of one warehouse must not overlap.

    With ``ledger`` the run records what has landed, and a document that an earlier run had for the same snapshot,
    under whatever name, is not parsed again. Documents without a run time of their own are new each time.

    Returns one status row per group: success, failed (no members), error, or repeated (no new document).
    """
    spark = docs.sparkSession
    optional = {"run_ts": "timestamp_ntz", "landed_at": "timestamp_ntz", "problem": "string"}
    for name, kind in optional.items():
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    if tracked is not None:
        docs = keep_tracked(docs, tracked)
    # Read once: members and payloads then come from the same version of each file.
    docs = materialize(
        spread(docs.select(*_SNAPSHOT, "payload", "landed_at", "problem")), "documents"
    )
    if run_ts is None:
        run_ts = docs.agg(F.max("landed_at")).first()[0]
        if run_ts is None:
            raise ValueError("a run needs a time, or documents with a landing time")
    now = moment(run_ts)
    form = warehouse.hash_form(spark, root, hash_form)
    docs = docs.withColumn("run_ts", F.coalesce("run_ts", now)).withColumn(
        "season", F.coalesce("season", season_of(F.col("run_ts")))
    ).drop("landed_at")

    before, version = warehouse.versions_of(warehouse.read_runs(spark, root), run_id)
    repeats = None
    if ledger:
        docs, repeats = landing.split_repeats(landing.with_digest(docs), root, before)
        docs = materialize(docs, "landed")
        # Fixed now: the statuses are read when the run, which this depends on, has been written.
        repeats = materialize(repeats.select(*GROUP_KEYS).distinct(), "repeats")
        landing.write_ledger(docs.where(F.col("problem").isNull()), root, run_id)
        docs = docs.drop("digest")

    # Parsed once; hashing later reads four of the columns, storing the changed groups only.
    readable = docs.withColumn("payload", F.when(F.col("problem").isNull(), F.col("payload")))
    rows = parse_documents(readable, keep_raw=keep_raw)
    parsed = with_lineage(rows, run_id, F.col("run_ts"), source)
    staged = materialize(parsed, "parsed")
    unreadable = staged.where("is_corrupt").select(*GROUP_KEYS).distinct()
    members = match_keys(to_members(staged), unreadable, GROUP_KEYS, "left_anti")

    state = warehouse.read_state_version(spark, root, before)

    members, snapshots = assemble(members, root, form, before)
    decisions = decide_against_state(snapshots, state, existing, force, whole=True).drop("known_hash")
    warehouse.write_log(change_log(decisions.withColumn("run_id", F.lit(run_id))), root)
    log = warehouse.read_log(spark, root, run_id)

    written = log.where(is_stored(F.col("decision"))).select(
        *_SNAPSHOT, "run_id", F.col("current_hash").alias("set_hash"), "member_count"
    )
    keys = written.select(*_SNAPSHOT, "set_hash")
    stored = match_keys(members.drop("set_hash"), keys, _SNAPSHOT, "inner")
    bronze.write_bronze(bronze.enrich(stored, now), root)
    payloads = match_keys(docs.drop("problem"), keys.select(*_SNAPSHOT), _SNAPSHOT, "left_semi")
    bronze.write_payloads(payloads.withColumn("run_id", F.lit(run_id)), root)
    bronze.write_manifest(bronze.manifest(written, root, source), root)
    warehouse.load_members(bronze.read_bronze(spark, root, run_id), root, now)

    batch = state_from_log(log).withColumn("updated_at", now)
    warehouse.update_state(batch, root, before, version)

    statuses = group_statuses(staged, log, tracked, repeats)
    warehouse.write_run(run_summary(statuses, run_id, run_ts, version), root)
    return statuses


def assemble(members: DataFrame, root: str, form: str, before: int) -> tuple[DataFrame, DataFrame]:
    """Members and hashes (keys, set_hash, member_count, known_hash) of the snapshots of a run, whole.

    ``members`` are those that the run brings. Of a snapshot that committed runs up to state version ``before``
    have seen, the members known by then are added, unless the run brings just these again. They
    come from where they were stored; those of a part that was not stored, as it equalled an earlier snapshot, are that
    snapshot's, and so are their attributes outside the hash. Only known snapshots are read and hashed anew.
    """
    spark = members.sparkSession
    brought = hash_sets(members, _SNAPSHOT, form)
    if before == 0:
        return members, brought.withColumn("known_hash", F.lit(None).cast("string"))
    brought = materialize(brought, "hashes")
    found = warehouse.versions(spark, root, before)
    # Late parts follow their snapshot soon, so the range of times leaves little of the log to read.
    first, last = brought.agg(F.min("run_ts"), F.max("run_ts")).first()
    in_reach = found.where(F.col("run_ts").between(F.lit(first), F.lit(last)))
    known = warehouse.latest_versions(match_keys(in_reach, brought.select(*_SNAPSHOT), _SNAPSHOT, "left_semi"))
    known = materialize(known, "known")
    hashes = match_keys(
        brought, known.select(*_SNAPSHOT, F.col("set_hash").alias("known_hash")), _SNAPSHOT, "left"
    )
    grown = hashes.where(F.col("known_hash").isNotNull() & (F.col("set_hash") != F.col("known_hash"))).select(*_SNAPSHOT)
    if grown.isEmpty():
        return members, hashes
    wanted = match_keys(known, grown, _SNAPSHOT, "left_semi")
    found = match_keys(found, grown.select(*GROUP_KEYS).distinct(), GROUP_KEYS, "left_semi")
    earlier = warehouse.members_from(bronze.read_bronze(spark, root), warehouse.stored_under(found, wanted))
    own = members.select("run_id", "source").limit(1).first()
    earlier = earlier.withColumns({"run_id": F.lit(own["run_id"]), "source": F.lit(own["source"])})
    members = materialize(members.unionByName(earlier.select(*members.columns)), "members")
    again = hash_sets(match_keys(members, grown, _SNAPSHOT, "left_semi"), _SNAPSHOT, form)
    whole = match_keys(again, known.select(*_SNAPSHOT, F.col("set_hash").alias("known_hash")), _SNAPSHOT, "left")
    return members, match_keys(hashes, grown, _SNAPSHOT, "left_anti").unionByName(whole)


def group_statuses(
    staged: DataFrame, log: DataFrame, tracked: DataFrame | None = None, repeats: DataFrame | None = None
) -> DataFrame:
    """What happened to each group of a run; tracked groups without a document are errors.

    Groups of which all documents are among ``repeats`` are just that.
    """
    groups = staged.groupBy(*GROUP_KEYS).agg(
        F.count("member").cast("bigint").alias("member_count"),
        F.max("is_corrupt").alias("_corrupt"),
        F.max("problem").alias("_problem"),
    )
    groups = groups.withColumn("_again", F.lit(False))
    if repeats is not None:
        again = match_keys(repeats, groups, GROUP_KEYS, "left_anti")
        none = {"member_count": F.lit(0).cast("bigint"), "_corrupt": F.lit(False), "_problem": F.lit(None).cast("string")}
        groups = groups.unionByName(again.withColumns({**none, "_again": F.lit(True)}))
    writes = log.groupBy(*GROUP_KEYS).agg(
        F.max_by("current_hash", F.col("run_ts")).alias("set_hash"),
        F.max(is_stored(F.col("decision"))).alias("wrote_bronze"),
    )
    if tracked is not None:
        absent = tracked.join(groups, "group_id", "left_anti").select(
            "group_id", F.lit(None).cast("string").alias("season"),
            F.lit(0).cast("bigint").alias("member_count"),
            F.lit(None).cast("boolean").alias("_corrupt"),
            F.lit(None).cast("string").alias("_problem"),
            F.lit(False).alias("_again"),
        )
        groups = groups.unionByName(absent)
    failed = F.when(F.col("_corrupt").isNull(), F.lit("no document")).when(
        F.col("_corrupt"), F.coalesce("_problem", F.lit("document cannot be parsed"))
    )
    return match_keys(groups, writes, GROUP_KEYS, "left").select(
        *GROUP_KEYS,
        F.when(F.col("_again"), F.lit("repeated"))
        .when(F.coalesce("_corrupt", F.lit(True)), F.lit("error"))
        .when(F.col("member_count") == 0, F.lit("failed"))
        .otherwise(F.lit("success"))
        .alias("status"),
        "member_count",
        "set_hash",
        F.coalesce("wrote_bronze", F.lit(False)).alias("wrote_bronze"),
        F.coalesce(
            failed, F.when(~F.col("_again") & (F.col("member_count") == 0), F.lit("no members found"))
        ).alias("error"),
    )


def summarize(statuses: DataFrame) -> DataFrame:
    """Groups attempted, members seen, groups stored, and groups that failed or were in error."""
    return statuses.agg(
        F.count("*").cast("bigint").alias("total_groups"),
        F.coalesce(F.sum("member_count"), F.lit(0)).cast("bigint").alias("total_members"),
        F.count_if("wrote_bronze").cast("bigint").alias("groups_with_bronze"),
        F.count_if(F.col("status") == "failed").cast("bigint").alias("groups_failed"),
        F.count_if(F.col("status") == "error").cast("bigint").alias("groups_in_error"),
    )


def run_summary(
    statuses: DataFrame, run_id: str, run_ts: datetime.datetime, version: int
) -> DataFrame:
    return summarize(statuses).select(
        F.lit(run_id).alias("run_id"),
        moment(run_ts).alias("run_ts"),
        F.lit(version).cast("bigint").alias("state_version"),
        "*",
    )


