"""Whole runs over landed documents, in batch and as a stream."""

import datetime
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snaphist.operators import changes
from snaphist.plans import dims, ingest as plan_ingest, report, staging
from snaphist.sources import bronze, warehouse
from snaphist.sources.documents import read_documents, stream_documents
from snaphist.sources.tracked import read_tracked
from snaphist.streaming.ingest_stream import ingest_stream
from tests.helpers import at, plan, rows, same


def document(*names, section="forwards"):
    members = [
        {"id": i, "firstName": {"default": n}, "sweaterNumber": i, "positionCode": "C"}
        for i, n in enumerate(names, 1)
    ]
    return json.dumps({section: members})


def land(root, day, **groups):
    for group, payload in groups.items():
        folder = root / "season=20252026" / f"group={group}" / f"run=202401{day:02d}T000000"
        folder.mkdir(parents=True)
        (folder / "doc.json").write_text(payload)


RUNS = {
    1: dict(AAA=document("Ann", "Bo"), BBB=document("Cy"), CCC="{}", DDD='{"forwards": ['),
    2: dict(AAA=document("Bo", "Ann", section="goalies"), BBB=document("Cy", "Di")),
    3: dict(AAA=document("Ann"), BBB=document("Cy", "Di")),
}


def run(spark, root, landing, day, **options):
    docs = read_documents(spark, str(landing)).where(F.dayofmonth("run_ts") == day)
    return plan_ingest.ingest(docs.drop("landed_at"), root, f"run-{day}", at(day), **options)


@pytest.fixture
def landing(tmp_path):
    path = tmp_path / "landing"
    for day, groups in RUNS.items():
        land(path, day, **groups)
    return path


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    path = tmp_path_factory.mktemp("landed")
    for day, groups in RUNS.items():
        land(path, day, **groups)
    return path


@pytest.fixture(scope="module")
def three_runs(spark, landed, tmp_path_factory):
    """A warehouse after all runs; tests only read it."""
    path = str(tmp_path_factory.mktemp("three"))
    for day in RUNS:
        run(spark, path, landed, day)
    return path


@pytest.fixture(scope="module")
def two_runs(spark, landed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("two"))
    for day in (1, 2):
        run(spark, path, landed, day)
    return path


def tables(spark, root):
    return {
        "log": warehouse.read_log(spark, root),
        "state": warehouse.read_state(spark, root),
        "raw": warehouse.read_members(spark, root),
        "bronze": bronze.read_bronze(spark, root),
        "manifest": bronze.read_manifest(spark, root),
        "payloads": bronze.read_payloads(spark, root),
        "runs": warehouse.read_runs(spark, root),
    }


def contents(spark, root):
    return {name: rows(df) for name, df in tables(spark, root).items()}


def test_documents_from_paths(spark, landing):
    docs = read_documents(spark, str(landing))
    assert rows(docs, "group_id", "season", "run_ts")[0] == ("AAA", "2025", at(1))
    assert docs.count() == 8


def test_first_run(spark, landing, root):
    statuses = run(spark, root, landing, 1)
    assert rows(statuses, "group_id", "status", "member_count", "wrote_bronze", "error") == [
        ("AAA", "success", 2, True, None),
        ("BBB", "success", 1, True, None),
        ("CCC", "failed", 0, False, "no members found"),
        ("DDD", "error", 0, False, "document cannot be parsed"),
    ]
    got = tables(spark, root)
    assert rows(got["runs"], "total_groups", "total_members", "groups_with_bronze", "groups_failed",
                "groups_in_error", "state_version") == [(4, 3, 2, 1, 1, 1)]
    assert rows(got["state"], "group_id", "season", "member_count", "last_ingested") == [
        ("AAA", "2025", 2, at(1)),
        ("BBB", "2025", 1, at(1)),
    ]
    raw = got["raw"].first()
    assert raw["set_hash"] is not None and raw["bronze_loaded_at"] == at(1) and raw["source"]
    assert rows(got["payloads"], "group_id", "payload_kind") == [("AAA", "json"), ("BBB", "json")]


def test_only_changes_are_stored(spark, three_runs):
    got = tables(spark, three_runs)
    assert rows(got["log"], "run_id", "group_id", "decision", "changed") == [
        ("run-1", "AAA", "new", True),
        ("run-1", "BBB", "new", True),
        ("run-2", "AAA", "changed", True),  # order does not matter, but numbers swapped
        ("run-2", "BBB", "changed", True),
        ("run-3", "AAA", "changed", True),
        ("run-3", "BBB", "unchanged", False),
    ]
    assert got["raw"].count() == 2 + 1 + 2 + 2 + 1
    assert same(got["raw"].select("run_id", "group_id", "member_id"),
                got["bronze"].select("run_id", "group_id", "member_id"))
    assert rows(bronze.latest_run(got["manifest"]), "group_id", "run_id", "member_count") == [
        ("AAA", "run-3", 1),
        ("BBB", "run-2", 2),
    ]
    runs = bronze.list_runs(got["manifest"], "AAA", "2025").collect()
    assert [r["run_id"] for r in runs] == ["run-1", "run-2", "run-3"]
    assert bronze.list_runs(got["manifest"], "XXX").count() == 0
    assert rows(bronze.latest_hash(got["bronze"]), "group_id", "set_hash") == rows(
        got["state"], "group_id", "current_hash"
    )
    assert rows(got["state"], "group_id", "last_run_id") == [("AAA", "run-3"), ("BBB", "run-3")]
    from_log = changes.state_from_log(got["log"])
    assert same(from_log, got["state"].select(*from_log.columns))


def test_repeating_a_run_adds_nothing(spark, landed, two_runs):
    before = contents(spark, two_runs)
    for day in (2, 1):
        run(spark, two_runs, landed, day)
        assert contents(spark, two_runs) == before


@pytest.mark.parametrize("step", ["write_bronze", "load_members", "write_run"])
def test_a_crash_is_healed_by_repeating_the_run(spark, landing, root, two_runs, monkeypatch, step):
    run(spark, root, landing, 1)
    module = bronze if hasattr(bronze, step) else warehouse

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(module, step, crash)
        with pytest.raises(RuntimeError, match="crash"):
            run(spark, root, landing, 2)
    assert {r["last_run_id"] for r in warehouse.read_state(spark, root).collect()} == {"run-1"}
    run(spark, root, landing, 2)
    healed, plain = contents(spark, root), contents(spark, two_runs)
    for name in ("log", "state", "raw", "bronze", "payloads", "runs"):
        assert healed[name] == plain[name], name


def test_late_run_is_stored_and_leaves_the_state(spark, landing, root):
    run(spark, root, landing, 2)
    before = contents(spark, root)
    run(spark, root, landing, 1)
    after = contents(spark, root)
    assert after["state"] == before["state"]
    log = warehouse.read_log(spark, root).where("run_id = 'run-1'")
    assert rows(log, "group_id", "decision") == [("AAA", "late"), ("BBB", "late")]
    raw = warehouse.read_members(spark, root).where("run_id = 'run-1'")
    assert rows(raw, "group_id", "full_name") == [("AAA", "Ann"), ("AAA", "Bo"), ("BBB", "Cy")]


def test_arrival_order_makes_no_difference(spark, landing, root, tmp_path):
    """A, B, A: the last was unchanged when the middle one had not arrived yet."""
    land(landing, 4, AAA=document("Bo", "Ann"), BBB=document("Cy"))
    land(landing, 5, AAA=document("Bo", "Ann"))
    columns = ("group_id", "run_ts", "full_name", "set_hash")
    want = None
    for i, days in enumerate(((1, 2, 3, 4, 5), (1, 5, 4, 3, 2), (5, 2, 4, 1, 3))):
        where = f"{root}{i}"
        for day in days:
            run(spark, where, landing, day)
        got = rows(warehouse.ordered_members(spark, where), *columns)
        want = want or got
        assert got == want
    assert len([r for r in want if r[1] == at(4)]) == 3


def test_unreadable_paths_become_statuses(spark, root, tmp_path):
    landing = tmp_path / "landing"
    land(landing, 1, AAA=document("Ann"), BBB=document("Bo"))
    bad = landing / "season=20252026" / "group=BBB" / "run=bad"
    bad.mkdir(parents=True)
    (bad / "doc.json").write_text(document("Cy"))
    stray = landing / "season=2025" / "run=20240101T000000"
    stray.mkdir(parents=True)
    (stray / "doc.json").write_text(document("Di"))
    statuses = plan_ingest.ingest(read_documents(spark, str(landing)), root, "r", at(2))
    got = {(r.group_id, r.status, r.error) for r in statuses.collect()}
    assert got == {
        ("AAA", "success", None), ("BBB", "error", "run folder cannot be read"),
        (None, "error", "no group in the path"),
    }
    assert rows(warehouse.read_state(spark, root), "group_id") == [("AAA",)]


def test_half_read_group_writes_nothing(spark, landing, root):
    docs = read_documents(spark, str(landing)).where(F.dayofmonth("run_ts") == 1)
    broken = docs.where("group_id = 'AAA'").withColumn("payload", F.lit("{"))
    statuses = plan_ingest.ingest(docs.union(broken), root, "r", at(2))
    assert rows(statuses.where("group_id = 'AAA'"), "status", "wrote_bronze") == [("error", False)]
    for table in (warehouse.read_state, warehouse.read_log, warehouse.read_members):
        assert table(spark, root).where("group_id = 'AAA'").isEmpty()


def test_form_of_hash_is_fixed_by_the_first_run(spark, landing, root):
    run(spark, root, landing, 1, hash_form="digest")
    run(spark, root, landing, 2)
    run(spark, root, landing, 3)
    assert warehouse.hash_form(spark, root) == "digest"
    decisions = rows(warehouse.read_log(spark, root), "run_ts", "group_id", "decision")
    assert (at(2), "BBB", "changed") in decisions and (at(3), "BBB", "unchanged") in decisions
    with pytest.raises(ValueError):
        run(spark, root, landing, 3, hash_form="listed")


def test_force_stores_unchanged_groups(spark, landing, root):
    run(spark, root, landing, 2)
    run(spark, root, landing, 3, force=True)
    assert warehouse.read_log(spark, root).where("NOT changed").isEmpty()


def test_tracked_groups(spark, landing, root, tmp_path):
    (tmp_path / "codes.txt").write_text("AAA\n\n  ZZZ \t\n")
    tracked = read_tracked(spark, str(tmp_path / "codes.txt"))
    statuses = run(spark, root, landing, 1, tracked=tracked)
    assert rows(statuses, "group_id", "status", "error") == [
        ("AAA", "success", None),
        ("ZZZ", "error", "no document"),
    ]
    assert read_tracked(spark).count() == 32


def test_marts_from_ingested_rows(spark, three_runs):
    root = three_runs
    raw = warehouse.read_members(spark, root)
    staged = staging.create_staging_view(raw, "2025")
    groups = warehouse.save_mart(dims.dim_group(raw, as_of=F.lit(at(9))), root, "dim_group", "1")
    members = warehouse.save_mart(dims.dim_member_latest(raw, "2025"), root, "dim_member", "1")
    assert rows(groups, "group_sk", "group_id", "group_name", "active_flag") == [
        (1, "AAA", "AAA", 1),
        (2, "BBB", "BBB", 1),
    ]
    assert spark.sql("SELECT COUNT(*) FROM stg_members").first()[0] == staged.count() == 4
    assert spark.sql("SELECT COUNT(*) FROM dim_member").first()[0] == members.count()
    warehouse.save_mart(groups.where("group_id = 'AAA'"), root, "dim_group", "2")
    assert warehouse.read_mart(spark, root, "dim_group").count() == 1
    counts = dict(rows(report.warehouse_counts(raw, groups, members)))
    assert counts["raw_groups"] == 2 and counts["raw_records"] == 8
    assert dict(rows(report.approximate_counts(raw)))["raw_members"] == counts["raw_members"]
    stored = warehouse.query(spark, root, "SELECT COUNT(*) AS n FROM group_state").first()["n"]
    assert stored == 2


def test_load_counts_and_aligns(spark, root):
    df = spark.createDataFrame([("G", "2025", "r1", 7, "x")], "group_id STRING, season STRING, run_id STRING, number INT, other STRING")
    assert warehouse.load_members(df, root) == 1
    assert warehouse.load_members(df.limit(0), root) == 0
    row = warehouse.read_members(spark, root).first()
    assert row["number"] == "7" and row["full_name"] is None and row["load_ts"] is not None


def test_layout_by_group(spark, root):
    df = spark.createDataFrame([("G", "2025", "r1", "Ann")], "group_id STRING, season STRING, run_id STRING, full_name STRING")
    bronze.write_bronze(df, root, by_group=True)
    assert rows(bronze.read_bronze(spark, root), "group_id", "season", "run_id") == [("G", "2025", "r1")]


def test_empty_warehouse(spark, root):
    assert all(df.isEmpty() for df in tables(spark, root).values())


def test_stream_equals_one_run(spark, landing, root, tmp_path):
    docs = read_documents(spark, str(landing)).drop("landed_at")
    plan_ingest.ingest(docs, root, "all", datetime.datetime(2024, 1, 9))
    streamed = str(tmp_path / "streamed")
    ingest_stream(
        stream_documents(spark, str(landing)), streamed, str(tmp_path / "cp")
    ).awaitTermination()
    one, other = tables(spark, root), tables(spark, streamed)
    for name, lineage in (("log", ["run_id"]), ("raw", ["run_id", "load_ts", "bronze_loaded_at"]),
                          ("state", ["last_run_id", "updated_at"])):
        assert same(one[name].drop(*lineage), other[name].drop(*lineage)), name


def test_stream_takes_up_new_documents(spark, root, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    for day in (1, 3, 2):
        land(landing, day, **RUNS[day])
        ingest_stream(stream_documents(spark, str(landing)), root, checkpoint).awaitTermination()
    log = warehouse.read_log(spark, root)
    assert rows(log, "run_ts", "group_id", "decision") == [
        (at(1), "AAA", "new"),
        (at(1), "BBB", "new"),
        (at(2), "AAA", "late"),
        (at(2), "BBB", "late"),
        (at(3), "AAA", "changed"),
        (at(3), "BBB", "changed"),
    ]
    assert {r["last_ingested"] for r in warehouse.read_state(spark, root).collect()} == {at(3)}
    assert warehouse.read_runs(spark, root).count() == 3


def test_season_filter_prunes_partitions(spark, three_runs):
    staged = staging.stg_members(warehouse.read_members(spark, three_runs), "2025")
    filters = plan(staged).split("PartitionFilters: [")[1].split("]")[0]
    assert "season" in filters and staged.count() == 4


def test_state_rebuilt_from_manifests(spark, two_runs):
    state = warehouse.read_state(spark, two_runs)
    rebuilt = bronze.state_of(bronze.read_manifest(spark, two_runs))
    assert same(rebuilt, state)


def test_state_is_written_by_touched_buckets(spark, landing, root):
    for day in (1, 2, 3):
        run(spark, root, landing, day)
    state = contents(spark, root)["state"]
    written = [d.name for d in Path(root, "state").glob("version=*3/bucket=*")]
    assert len(written) <= 2
    warehouse.drop_old_states(spark, root)
    assert contents(spark, root)["state"] == state
    run(spark, root, landing, 3)
    assert contents(spark, root)["state"] == state
    assert len(list(Path(root, "state_index").glob("version=*"))) == 2


def test_scratch_folders(spark, tmp_path):
    from snaphist import session

    table = session.materialize(spark.range(3), "three")
    folder = Path(table.inputFiles()[0].split(":", 1)[1]).parent
    session.remove_table(table)
    assert not folder.exists()

    class Context:
        applicationId = "app"
        def __init__(self, master, given=None): self.master, self.given = master, given
        def getCheckpointDir(self): return self.given

    class Session:
        def __init__(self, master, named=None, given=None):
            self.sparkContext, self.named = Context(master, given), named
            self.conf = self
        def get(self, key, default): return self.named

    assert session.shared_dir(Session("yarn", "hdfs://a/b/")) == "hdfs://a/b"
    assert session.shared_dir(Session("yarn", "file:/a/b", "file:/a/b/uuid")) == "file:/a/b"
    assert session.shared_dir(Session("yarn", "hdfs://a/b", "hdfs://other/c")) == "hdfs://other/c"
    with pytest.raises(ValueError):
        session.shared_dir(Session("local-cluster[3,2,1000]"))
