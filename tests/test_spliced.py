"""A history brought up to date by batches, and keys whose numbers last."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snaphist import fixtures
from snaphist.operators.scd2 import scd2
from snaphist.plans import dims, staging
from snaphist.sources import history, keys
from tests.helpers import at, rows, same

SCHEMA = "member STRING, ts TIMESTAMP_NTZ, group_id STRING, number STRING"


def some_rows(seed, members=6, days=25):
    draw = random.Random(seed)
    out = []
    for m in [f"m{i}" for i in range(members)] + [None]:
        for day in sorted(draw.sample(range(1, days), 12)):
            out.append((m, at(day), draw.choice("XXY"), draw.choice("12")))
            if draw.random() < 0.2:
                out.append((m, at(day), draw.choice("YZ"), "3"))  # a tie in time
    return list({(r[0], r[1], r[2]): r for r in out}.values()) + [("m0", None, "X", "9")]


@pytest.mark.parametrize("seed, collapse, buckets", [(1, True, 4), (3, False, 4)])
def test_batches_in_any_order_equal_a_rebuild(spark, tmp_path, seed, collapse, buckets, monkeypatch):
    monkeypatch.setattr(history, "FOLD_AFTER", 3)
    draw, data, root = random.Random(seed), some_rows(seed), str(tmp_path / "history")
    draw.shuffle(data)
    cuts = sorted(draw.sample(range(1, len(data)), 4))
    done = []
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(data)])):
        done += data[a:b]
        batch = spark.createDataFrame(data[a:b], SCHEMA)
        for _ in range(2 if i == 2 else 1):  # a repeated batch adds nothing
            history.merge_history(
                batch, root, f"b{i}", "member", "ts", ["group_id"], collapse=collapse, tiebreak=["group_id"], buckets=buckets
            )
        rebuilt = scd2(
            spark.createDataFrame(done, SCHEMA), "member", "ts", ["group_id"], collapse=collapse, tiebreak=["group_id"]
        )
        assert same(history.read_history(spark, root, batch.schema), rebuilt)


def test_untouched_buckets_are_not_read(spark, tmp_path):
    root = str(tmp_path / "history")
    data = [(f"m{i}", at(1 + i % 9), "X", "1") for i in range(200)]
    first = spark.createDataFrame(data, SCHEMA)
    history.merge_history(first, root, "a", "member", "ts", ["group_id"], buckets=16)
    for file in Path(root).glob("*/number=000000000001/bucket=*/*.parquet"):
        touched = spark.createDataFrame([("m5", at(2), "Y", "1")], SCHEMA).select(history._bucket("member", 16)).first()[0]
        if f"bucket={touched}/" not in str(file):
            file.write_bytes(b"unreadable")
    history.merge_history(spark.createDataFrame([("m5", at(2), "Y", "1")], SCHEMA), root, "b", "member", "ts", ["group_id"])
    assert len(list(Path(root, "versions", "number=000000000002").glob("bucket=*"))) == 1


def test_a_batch_that_broke_off_is_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "history")
    a, b = [("m", at(3), "X", "1")], [("m", at(2), "Y", "1"), ("n", at(1), "X", "1")]
    args = (root, "b", "member", "ts", ["group_id"])
    history.merge_history(spark.createDataFrame(a, SCHEMA), root, "a", "member", "ts", ["group_id"])
    with monkeypatch.context() as patch:
        patch.setattr(history, "write_partitions", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            history.merge_history(spark.createDataFrame(b, SCHEMA), *args)
    frame = spark.createDataFrame(b, SCHEMA)
    assert history.read_history(spark, root, frame.schema).count() == 1
    history.merge_history(frame, *args)
    want = scd2(spark.createDataFrame(a + b, SCHEMA), "member", "ts", ["group_id"])
    assert same(history.read_history(spark, root, frame.schema), want)


def test_empty_history_and_batch(spark, tmp_path):
    root = str(tmp_path / "history")
    none = spark.createDataFrame([], SCHEMA)
    assert history.read_history(spark, root, none.schema).isEmpty()
    history.merge_history(none, root, "a", "member", "ts", ["group_id"])
    assert history.read_history(spark, root, none.schema).isEmpty()


def test_numbers_last(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "keys")
    frame = lambda *names: spark.createDataFrame([(n,) for n in names], "member_id STRING")
    got = keys.number_keys(frame("b", "d", "b", None), root, "member_id", "r1")
    assert rows(got, "member_nk", "member_id") == [(1, "b"), (2, "d"), (3, None)]
    with monkeypatch.context() as patch:
        patch.setattr(keys, "write_partitions", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            keys.number_keys(frame("x"), root, "member_id", "r2")
    for _ in range(2):
        got = keys.number_keys(frame("a", "c", "d", None), root, "member_id", "r2")
        assert rows(got, "member_nk", "member_id") == [(1, "b"), (2, "d"), (3, None), (4, "a"), (5, "c")]
    assert keys.number_keys(frame("a"), root, "member_id", "r3").count() == 5


def test_natural_key_is_equal_across_rebuilds(spark, tmp_path):
    raw = fixtures.raw_members(spark, "/root/testdata/sf0.001")
    staged = staging.stage_rows(raw)
    half = staged.where("member_id % 2 = 0 AND day(run_ts) < 15")
    root = str(tmp_path / "keys")
    early = dims.dim_member(half, keys=keys.number_keys(half, root, "member_id", "r1"))
    late = dims.dim_member(staged, keys=keys.number_keys(staged, root, "member_id", "r2"))
    first = dict(rows(early.select("member_id", "member_nk").distinct()))
    second = dict(rows(late.select("member_id", "member_nk").distinct()))
    assert first and all(second[m] == n for m, n in first.items())
    assert sorted(second.values()) == list(range(1, len(second) + 1))
    assert late.columns == dims.dim_member(staged).columns
    assert rows(late.select("member_sk")) == rows(dims.dim_member(staged).select("member_sk"))
    assert late.where(F.col("member_nk").isNull()).isEmpty()
