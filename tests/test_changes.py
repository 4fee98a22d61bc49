"""Decisions over a history, run by run, and the state they leave."""

import pytest
from pyspark.sql import functions as F

from snaphist import fixtures
from snaphist.operators import changes
from snaphist.operators.sethash import set_hash
from snaphist.schemas import STATE, to_schema
from tests.helpers import at, rows, same

KEYS = ["group_id", "season", "run_ts"]


@pytest.fixture(scope="module")
def snapshots(spark):
    members = fixtures.group_snapshots(spark, "/root/testdata/sf0.001")
    return set_hash(members, KEYS, ["member"]).cache()


def state_of(log):
    return to_schema(
        changes.state_from_log(log).withColumn("updated_at", F.col("last_ingested")), STATE
    )


def log_of(decisions):
    return changes.change_log(decisions.withColumn("run_id", F.date_format("run_ts", "yyyyMMdd")))


def test_run_by_run_equals_history(spark, snapshots):
    history = changes.decide_history(snapshots)
    state = spark.createDataFrame([], STATE)
    logs = None
    for (run,) in sorted(tuple(r) for r in snapshots.select("run_ts").distinct().collect()):
        batch = snapshots.where(F.col("run_ts") == F.lit(run).cast("timestamp_ntz"))
        decided = changes.decide_against_state(batch, state).cache()
        log = log_of(decided)
        logs = log if logs is None else logs.unionByName(log)
        state = spark.createDataFrame(
            changes.upsert_state(state, state_of(log)).collect(), STATE
        )
    assert same(log_of(history), logs)
    assert same(state_of(logs), state)


def test_many_runs_at_once_equal_history(spark, snapshots):
    state = spark.createDataFrame([], STATE)
    assert same(changes.decide_history(snapshots), changes.decide_against_state(snapshots, state))


def snapshot(spark, *data):
    return spark.createDataFrame(
        list(data),
        "group_id STRING, season STRING, run_ts TIMESTAMP_NTZ, set_hash STRING, member_count BIGINT",
    )


def test_every_outcome(spark):
    state = spark.createDataFrame(
        [(g, "2025", "h1", at(5), "r", 3, at(5)) for g in ("same", "other", "lost", "late")], STATE
    )
    batch = snapshot(
        spark,
        ("same", "2025", at(6), "h1", 3),
        ("other", "2025", at(6), "h2", 3),
        ("lost", "2025", at(6), "h1", 3),
        ("late", "2025", at(4), "h9", 3),
        ("fresh", "2025", at(6), "h1", 3),
        ("stored", "2025", at(6), "h1", 3),
    )
    existing = spark.createDataFrame(
        [("same", "2025"), ("other", "2025"), ("late", "2025"), ("stored", "2025")],
        "group_id STRING, season STRING",
    )
    got = changes.decide_against_state(batch, state, existing)
    assert dict(rows(got, "group_id", "decision")) == {
        "same": "unchanged",
        "other": "changed",
        "lost": "new",  # has state, but its snapshots are gone
        "late": "late",
        "fresh": "new",
        "stored": "changed",  # has snapshots, but no state
    }
    forced = changes.decide_against_state(batch, state, existing, force=True)
    assert set(dict(rows(forced, "group_id", "decision")).values()) == {"new", "late"}
    log = log_of(got)
    assert dict(rows(log, "group_id", "changed"))["late"] is False
    after = changes.upsert_state(state, state_of(log))
    assert dict(rows(after, "group_id", "current_hash")) == {
        "same": "h1", "other": "h2", "lost": "h1", "late": "h1", "fresh": "h1", "stored": "h1",
    }
    assert dict(rows(after, "group_id", "last_ingested"))["same"] == at(6)  # last seen


def test_change_back_and_forth(spark):
    runs = snapshot(spark, *[("g", "2025", at(d), h, 1) for d, h in ((1, "a"), (2, "b"), (3, "b"), (4, "a"))])
    got = changes.decide_history(runs)
    assert [r[1] for r in rows(got, "run_ts", "decision")] == ["new", "changed", "unchanged", "changed"]


def test_same_run_again_changes_no_state(spark):
    runs = snapshot(spark, ("g", "2025", at(1), "a", 1), ("g", "2025", at(2), "b", 2))
    state = state_of(log_of(changes.decide_history(runs)))
    again = changes.decide_against_state(runs, state)
    assert {r["decision"] for r in again.collect()} == {"late"}
    assert same(state, changes.upsert_state(state, state_of(log_of(again))))


def test_lookup_and_listing(spark):
    state = spark.createDataFrame(
        [(g, "2025", "h", at(1), "r", 1, at(1)) for g in ("b", "a", "c")], STATE
    )
    wanted = spark.createDataFrame([("a", "2025"), ("x", "2025")], "group_id STRING, season STRING")
    assert rows(changes.lookup_state(state, wanted), "group_id") == [("a",)]
    assert [r["group_id"] for r in changes.list_state(state).collect()] == ["a", "b", "c"]
