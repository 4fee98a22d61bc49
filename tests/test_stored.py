"""Stored trees, uniqueness over runs, and tables in buckets."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from snaphist import fixtures
from snaphist.operators.latest import latest_per_key
from snaphist.operators.scd2 import scd2
from snaphist.operators.skew import no_splits
from snaphist.sources import colocated, trees, uniqueness
from tests.helpers import plan, rows, same


def test_changes_are_read_from_differing_leaves(spark, tmp_path):
    schema = "group_id STRING, member STRING, number STRING"
    old = [(None, f"m{i}", "1") for i in range(400)] + [("B", "x", "1"), ("B", "x", "1")]
    new = [r if r[1] != "m7" else (None, "m7", "2") for r in old[:-1] if r[1] != "m9"] + [(None, "new", "1")]
    root = str(tmp_path)
    for run, data in (("a", old), ("b", new)):
        for _ in range(2):  # a repeated run replaces its own
            trees.save_tree(spark.createDataFrame(data, schema), root, run, ["group_id"], ["member", "number"], "member")
    kind = spark.createDataFrame(old, schema).schema
    got = trees.stored_changes(spark, root, "a", "b", kind, ["group_id"])
    assert rows(got, "status", "member", "number") == [
        ("joined", "m7", "2"), ("joined", "new", "1"), ("left", "m7", "1"), ("left", "m9", "1"), ("left", "x", "1"),
    ]
    # Four leaves differ: their folders and row groups alone are read.
    assert "PartitionFilters: [digit IN (" in plan(got) and "In(path, [" in plan(got)
    assert trees.stored_changes(spark, root, "a", "a", kind, ["group_id"]).isEmpty()
    assert trees.stored_changes(spark, root, "none", "a", kind, ["group_id"]).count() == len(old)


def test_uniqueness_over_runs(spark, tmp_path, monkeypatch):
    draw, root, seen = random.Random(8), str(tmp_path), []
    for run in range(4):
        values = [draw.randrange(6000) for _ in range(700)] + [None, None]
        seen += [v for v in values if v is not None]
        frame = spark.createDataFrame([(v,) for v in values], "k BIGINT")
        if run == 2:
            with monkeypatch.context() as patch:
                patch.setattr(uniqueness, "write_partitions", lambda *_, **__: 1 / 0)
                try:
                    uniqueness.check_run(frame, "k", root, f"r{run}")
                except ZeroDivisionError:
                    pass
        want = sum(seen.count(v) > 1 for v in set(seen))
        assert uniqueness.check_run(frame, "k", root, f"r{run}") == want
    assert uniqueness.check_run(frame, "k", root, "r3") == want
    assert uniqueness.check_run(frame.limit(0), "k", root, "r4") == want


def test_filters_lose_nothing_and_spare_most(spark):
    held = spark.range(5000).select(F.concat(F.lit("v"), "id").alias("value"))
    asked = spark.range(4000, 9000).select(F.concat(F.lit("v"), "id").alias("value"))
    maybe = {r["value"] for r in uniqueness.possible_repeats(asked, uniqueness.build_filters(held)).collect()}
    assert {f"v{i}" for i in range(4000, 5000)} <= maybe and len(maybe) < 1100
    assert uniqueness.possible_repeats(asked, uniqueness.build_filters(held.limit(0))).isEmpty()


def test_buckets_spare_the_exchange(spark, tmp_path):
    raw = fixtures.raw_members(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "raw")
    colocated.save_bucketed(raw, "by_member", path, "member_id", "run_ts", buckets=4)
    spark.sql("DROP TABLE by_member")
    stored = colocated.open_bucketed(spark, raw.schema, "by_member", path, "member_id", "run_ts", buckets=4)
    assert len(list(Path(path).glob("*.parquet"))) == 4
    latest = latest_per_key(stored, ["group_id", "member_id"], "run_ts", ["run_id", "position", "number"])
    versions = scd2(stored, "member_id", "run_ts", ["group_id"], tiebreak=["group_id", "position"], splits=no_splits(["member_id"], "run_ts"))
    for df in (latest, versions):
        assert "Exchange" not in plan(df) and "Window" in plan(df)
    plain = latest_per_key(raw, ["group_id", "member_id"], "run_ts", ["run_id", "position", "number"])
    assert "Exchange" in plan(plain) and same(latest, plain)
    spark.sql("DROP TABLE by_member")
