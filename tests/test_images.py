"""Stored histories by period, member sketches, landed documents, and the rows behind failed tests."""

import random

import pytest
from pyspark.sql import functions as F

from snaphist.operators import temporal
from snaphist.operators.quality import ModelTests, failing_rows, run_suite
from snaphist.operators.scd2 import scd2
from snaphist.plans import ingest as plan_ingest, sketches
from snaphist.sources import images, ledger, warehouse
from tests.helpers import at, plan, rows, same
from tests.test_parts import SCHEMA, part


@pytest.mark.parametrize("per_period", [7, 10_000])
def test_any_moment_is_read_from_one_period(spark, tmp_path, per_period):
    draw, root = random.Random(4), str(tmp_path / "images")
    data = [(m, at(day, draw.randrange(24)), draw.choice("XYZ")) for m in "abcde" for day in draw.sample(range(1, 28), 9)]
    data.append(("f", None, "X"))
    versions = scd2(spark.createDataFrame(data, "member STRING, ts TIMESTAMP_NTZ, group_id STRING"), "member", "ts", ["group_id"])
    images.save_images(versions, root, per_period)
    starts = [r["effective_date"] for r in versions.select("effective_date").collect() if r["effective_date"]]
    for moment in [at(1), min(starts), max(starts), draw.choice(starts), at(14, 5), at(28)]:
        got = images.read_as_of(spark, root, moment, versions.schema)
        assert same(got, temporal.as_of(versions, moment))
        assert len({f.rsplit("/", 2)[1] for f in got.inputFiles()}) <= 1
    if per_period == 7:
        assert len(list((tmp_path / "images" / "periods").glob("period=*"))) > 3
        assert "PushedFilters: [IsNotNull(effective_date)" in plan(images.read_as_of(spark, root, str(at(14)), versions.schema))


def test_images_of_nothing(spark, tmp_path):
    versions = scd2(spark.createDataFrame([], "member STRING, ts TIMESTAMP_NTZ, g STRING"), "member", "ts", ["g"])
    images.save_images(versions, str(tmp_path / "none"))
    assert images.read_as_of(spark, str(tmp_path / "none"), at(3), versions.schema).isEmpty()


def test_sketches_merge_within_their_error(spark, tmp_path):
    root = str(tmp_path)
    ids = F.pmod(F.xxhash64("id"), F.lit(9000)).cast("string")
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("group_id"), F.lit("2024").alias("season"),
        F.lit(at(1)).alias("run_ts"), F.concat(F.lit("r"), (F.col("id") % 4).cast("string")).alias("run_id"), ids.alias("member_id"),
    )
    for _ in range(2):  # a repeated run replaces its own sketches
        sketches.write_sketches(sketches.sketch_members(frame), root)
    stored = sketches.read_sketches(spark, root)
    exact = {r["group_id"]: r["n"] for r in frame.groupBy("group_id").agg(F.count_distinct("member_id").alias("n")).collect()}
    for r in sketches.estimate_members(stored).collect():
        n = exact[r["group_id"]]
        assert abs(r["members_estimate"] - n) <= 4 * sketches.relative_error() * n
    total = sketches.estimate_members(stored, by=[]).first()
    assert total["member_rows"] == 30_000 and abs(total["members_estimate"] - 9000) < 600
    nobody = sketches.estimate_members(stored.limit(0), by=[]).first()
    assert (nobody["members_estimate"], nobody["member_rows"]) == (0, 0)


def test_landed_again_is_not_parsed_again(spark, tmp_path):
    root, first, more = str(tmp_path), part("G", 1, "A"), part("G", 1, "B")
    frame = lambda *parts: spark.createDataFrame(list(parts), SCHEMA)
    plan_ingest.ingest(frame(first, part("H", 1, "C")), root, "r0", at(28), ledger=True)
    before = rows(ledger.read_ledger(spark, root))
    statuses = plan_ingest.ingest(frame(first, more, part("H", 1, "C")), root, "r1", at(28, 1), ledger=True)
    once = rows(statuses)
    assert rows(statuses, "group_id", "status", "member_count", "error") == [("G", "success", 1, None), ("H", "repeated", 0, None)]
    assert rows(warehouse.ordered_members(spark, root), "group_id", "full_name") == [("G", "A"), ("G", "B"), ("H", "C")]
    assert len(rows(ledger.read_ledger(spark, root))) == len(before) + 1
    # A repeated run finds the same documents new.
    again = plan_ingest.ingest(frame(first, more, part("H", 1, "C")), root, "r1", at(28, 1), ledger=True)
    assert rows(again) == once


def test_rows_behind_failures(spark):
    frame = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, None), (4, "b", "x")], "id INT, k STRING, v STRING")
    tests = ModelTests(not_null=("k", "v"), unique=("k", "v"))
    assert rows(failing_rows(frame, "m", tests, ["id"]), "column_name", "test", "id") == [
        ("k", "not_null", 3), ("k", "unique", 1), ("k", "unique", 2), ("v", "not_null", 1), ("v", "not_null", 3),
        ("v", "unique", 2), ("v", "unique", 4),
    ]
    report = run_suite({"m": frame, "e": frame.limit(0)}, {"m": tests, "e": tests})
    assert rows(report, "model", "column_name", "test", "failures") == [
        *[("e", c, t, 0) for c in "kv" for t in ("not_null", "unique")],
        ("m", "k", "not_null", 1), ("m", "k", "unique", 1), ("m", "v", "not_null", 2), ("m", "v", "unique", 1),
    ]
