"""Snapshots that come in parts, over several runs and in any order."""

import json
import random

import pytest
from pyspark.sql import functions as F

from snaphist.plans import ingest as plan_ingest
from snaphist.sources import warehouse
from tests.helpers import at, rows

SCHEMA = "group_id string, season string, run_ts timestamp_ntz, payload string"
MEMBERS = ("group_id", "run_ts", "full_name", "number", "set_hash")
STATE = ("group_id", "season", "current_hash", "last_ingested", "member_count")


def part(group, day, *names):
    listed = [{"id": n, "firstName": {"default": n}, "sweaterNumber": 1, "positionCode": "C"} for n in names]
    return (group, "2024", at(day), json.dumps({"forwards": listed}))


def ingest(spark, root, *runs, **options):
    for i, parts in enumerate(runs):
        plan_ingest.ingest(spark.createDataFrame(list(parts), SCHEMA), root, f"r{i}", at(28, i), **options)


def outcome(spark, root):
    return rows(warehouse.ordered_members(spark, root), *MEMBERS), rows(warehouse.read_state(spark, root), *STATE)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")


def test_part_of_an_unchanged_snapshot_is_not_lost(spark, root, tmp_path):
    """Day 2 is unchanged when its first part comes; with the second it is not."""
    first, same, more = part("G", 1, "A", "B"), part("G", 2, "A", "B"), part("G", 2, "C")
    ingest(spark, root, [first], [same], [more])
    one = str(tmp_path / "one")
    ingest(spark, one, [first, same, more])
    assert outcome(spark, root) == outcome(spark, one)
    got = rows(warehouse.ordered_members(spark, root).where(F.dayofmonth("run_ts") == 2), "full_name")
    assert got == [("A",), ("B",), ("C",)]
    log = rows(warehouse.read_log(spark, root), "run_id", "decision", "member_count")
    assert log == [("r0", "new", 2), ("r1", "unchanged", 2), ("r2", "changed", 3)]


def test_late_part_changes_what_follows(spark, root, tmp_path):
    """Day 3 equalled the first part of day 2, and no longer equals the whole of it."""
    parts = [part("G", 1, "A", "B"), part("G", 2, "A"), part("G", 3, "A"), part("G", 2, "B")]
    ingest(spark, root, *[[p] for p in parts])
    one = str(tmp_path / "one")
    ingest(spark, one, parts)
    assert outcome(spark, root) == outcome(spark, one)
    assert rows(warehouse.ordered_members(spark, root), "run_ts", "full_name") == [
        (at(1), "A"), (at(1), "B"), (at(3), "A"),
    ]


def test_repeated_snapshot_is_no_part(spark, root):
    whole = [part("G", 1, "A", "B")], [part("G", 2, "A")], [part("G", 1, "A", "B")], [part("G", 2, "A")]
    ingest(spark, root, *whole)
    assert [r["decision"] for r in warehouse.read_log(spark, root).orderBy("run_id").collect()] == [
        "new", "changed", "unchanged", "unchanged",
    ]
    assert warehouse.read_members(spark, root).count() == 3


@pytest.mark.parametrize("seed, form", [(1, "listed"), (2, "digest")])
def test_any_split_equals_one_run(spark, root, tmp_path, seed, form):
    draw = random.Random(seed)
    parts = []
    for group in ("G", "H", None):
        names = list("ABCDEF")
        for day in range(1, 6):
            if draw.random() < 0.5:
                names = draw.sample("ABCDEF", 4)
            cut = draw.randrange(1, len(names))
            parts += [part(group, day, *names[:cut]), part(group, day, *names[cut:])]
    one = str(tmp_path / "one")
    ingest(spark, one, parts, hash_form=form)
    draw.shuffle(parts)
    cuts = sorted(draw.sample(range(1, len(parts)), 3))
    split = [parts[a:b] for a, b in zip([0, *cuts], [*cuts, len(parts)])]
    ingest(spark, root, *split, hash_form=form)
    assert outcome(spark, root) == outcome(spark, one)
    # Repeating a run in the middle leaves everything as it was.
    before = outcome(spark, root)
    again = spark.createDataFrame(split[1], SCHEMA)
    plan_ingest.ingest(again, root, "r1", at(28, 1), hash_form=form)
    assert outcome(spark, root) == before


def test_sql_shows_committed_runs_only(spark, root, monkeypatch):
    ingest(spark, root, [part("G", 1, "A")])

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "write_run", crash)
        with pytest.raises(RuntimeError, match="crash"):
            plan_ingest.ingest(spark.createDataFrame([part("G", 2, "A", "B")], SCHEMA), root, "half", at(28, 5))
    assert warehouse.read_members(spark, root).count() == 3
    for name, n in (("raw_members", 1), ("change_log", 1), ("group_state", 1)):
        assert warehouse.query(spark, root, f"SELECT * FROM {name}").count() == n
    assert outcome(spark, root)[0] == [("G", at(1), "A", "1", outcome(spark, root)[0][0][4])]


def test_state_adds_and_folds(spark, root, monkeypatch):
    """Versions add a batch's rows; every few versions these are folded into the buckets they touch."""
    from pathlib import Path

    schema = "group_id string, season string, current_hash string, last_ingested timestamp_ntz, last_run_id string, member_count int, updated_at timestamp_ntz"
    monkeypatch.setattr(warehouse, "FOLD_AFTER", 3)
    want = {}
    for version in range(1, 9):
        batch = [(f"g{i}", "2024", f"h{version}", at(1 + version), f"r{version}", i, at(1)) for i in range(version % 5, 300, 41)]
        late = [("g0", "2024", "late", at(1), "r", 0, at(1))]
        warehouse.update_state(spark.createDataFrame(batch + (late if version == 6 else []), schema), root, version - 1, version)
        want |= {r[0]: r for r in batch}
        if version == 6:
            want.setdefault("g0", late[0])
        got = warehouse.read_state_version(spark, root, version).collect()
        assert sorted(tuple(r) for r in got) == sorted(want.values())
    folded = sorted(p.name for p in Path(root, "state").glob("version=*"))
    assert folded == ["version=000000000003", "version=000000000006"]
