"""Type 2 histories, temporal questions, and the split of hot keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from snaphist.operators import temporal
from snaphist.operators.ordered import carry_forward
from snaphist.operators.scd2 import scd2
from snaphist.operators.skew import PART, no_splits, split_hot_keys, with_part
from snaphist.plans import dims, staging
from snaphist import fixtures
from tests.helpers import at, plan, rows, same

SCHEMA = "member STRING, ts TIMESTAMP_NTZ, group_id STRING, number STRING"


@pytest.fixture(scope="module")
def skewed(spark):
    """Events of which one member holds a third, and some belong to no member."""
    events = fixtures.member_history(spark, "/root/testdata/sf0.001")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("member"))
    none = F.when(F.col("event_id") % 20 != 1, hot)
    return events.withColumn("member", none).cache()


def hot_splits(df, rows_per_part=3, order="ts", key="member"):
    splits = split_hot_keys(df, [key], order, rows_per_part=rows_per_part)
    assert splits.cuts is not None
    return splits


def test_no_hot_key_means_plain_windows(spark, skewed):
    splits = split_hot_keys(skewed, ["member"], "ts")
    assert splits.cuts is None and splits.partition == ["member"]
    assert split_hot_keys(skewed.limit(0), ["member"], "ts").cuts is None


def test_superset_spares_the_measure(spark, skewed):
    splits = split_hot_keys(None, ["member"], "ts", superset=skewed)
    assert splits.cuts is None


def test_parts_are_small_ordered_and_many(spark, skewed):
    splits = hot_splits(skewed)
    parts = with_part(skewed, splits).groupBy("member", PART).agg(
        F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")
    )
    assert parts.agg(F.max("n")).first()[0] <= 12
    assert parts.where("member = 7").count() > 64  # more than one block of cut points
    w = Window.partitionBy("member").orderBy(PART)
    assert parts.withColumn("before", F.lag("hi").over(w)).where("before >= lo").isEmpty()


@pytest.mark.parametrize("collapse", [True, False])
def test_split_history_equals_plain_history(spark, skewed, collapse):
    args = (skewed, "member", "ts", ["group_id"])
    split = scd2(*args, collapse=collapse, splits=hot_splits(skewed))
    assert same(split, scd2(*args, collapse=collapse, splits=no_splits(["member"], "ts")))


def test_split_changes_equal_plain_changes(spark, skewed):
    args = (skewed, "member", "ts", ["group_id", "number"])
    plain = temporal.attribute_changes(*args, splits=no_splits(["member"], "ts"))
    assert same(plain, temporal.attribute_changes(*args, splits=hot_splits(skewed)))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_as_of_join_equals_range_join(spark, skewed, how):
    errors = skewed.where("group_id = 'error' AND member IS NOT NULL")
    versions = scd2(errors, "member", "ts", ["number"]).select(
        "member", F.col("number").alias("v_number"), "effective_date", "end_date"
    )
    facts = skewed.select("event_id", "member", "ts")
    f, v = facts.alias("f"), versions.alias("v")
    want = f.join(
        v,
        F.expr("f.member = v.member AND v.effective_date <= f.ts AND f.ts < v.end_date"),
        how,
    ).select("f.*", "v_number", "effective_date", "end_date")
    assert same(want, temporal.as_of_join(facts, versions, "member", "ts", how=how))
    split = temporal.as_of_join(facts, versions, "member", "ts", how=how, splits=hot_splits(facts))
    assert same(want, split)


def test_split_carry_forward(spark, skewed):
    df = skewed.withColumn("value", F.when(F.col("event_id") % 11 == 0, F.col("event_id")))
    splits = hot_splits(df)
    plain = carry_forward(df, no_splits(["member"], "ts"), "value", "carried")
    assert same(plain, carry_forward(with_part(df, splits), splits, "value", "carried").drop(PART))


@pytest.mark.parametrize("collapse", [True, False])
def test_split_closing_equals_plain_closing(spark, collapse):
    df = fixtures.daily_membership(spark, "/root/testdata/sf0.001")
    args = dict(collapse=collapse, runs=df.select("run_ts"))
    call = (df, "member", "run_ts", ["group_id"])
    plain = scd2(*call, **args, splits=no_splits(["member"], "run_ts"))
    split = scd2(*call, **args, splits=hot_splits(df, 2, "run_ts"))
    assert same(plain, split)
    assert not plain.where("NOT is_current").isEmpty()


def test_versions_tile_time(spark, skewed):
    versions = scd2(skewed, "member", "ts", ["group_id"], splits=hot_splits(skewed))
    w = Window.partitionBy("member").orderBy("effective_date")
    checked = versions.select(
        "*",
        F.lead("effective_date").over(w).alias("next"),
        F.lag("hash_diff").over(w).alias("before"),
    )
    assert checked.where("next IS NOT NULL AND end_date <> next").isEmpty()
    assert checked.where("is_current <> (next IS NULL)").isEmpty()
    assert checked.where("before = hash_diff").isEmpty()
    current = versions.where("is_current").groupBy("member").count()
    assert current.where("count <> 1").isEmpty()
    assert versions.where("is_current AND end_date <> timestamp_ntz'9999-12-31'").isEmpty()


def test_as_of_equals_latest_row(spark, skewed):
    versions = scd2(skewed, "member", "ts", ["group_id"])
    for day in (3, 11, 25):
        want = (
            skewed.where(F.col("ts") <= F.lit(at(day)).cast("timestamp_ntz"))
            .groupBy("member")
            .agg(F.max_by("group_id", "ts").alias("group_id"))
        )
        assert same(want, temporal.as_of(versions, at(day)).select("member", "group_id"))


def test_as_of_filter_reaches_the_scan(spark, skewed, tmp_path):
    scd2(skewed, "member", "ts", ["group_id"]).write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert "LessThanOrEqual(effective_date" in plan(temporal.as_of(stored, "2024-01-10"))


def test_collapse_and_ties(spark):
    df = spark.createDataFrame(
        [
            ("m", at(1), "A", "1"),
            ("m", at(2), "A", "1"),
            ("m", at(3), "B", "1"),
            ("m", at(3), "C", "1"),
            ("m", at(4), "A", None),
            ("m", at(5), "A", ""),
        ],
        SCHEMA,
    )
    got = scd2(df, "member", "ts", ["group_id", "number"], tiebreak=["group_id"])
    forever = at(1).replace(year=9999, month=12, day=31)
    assert rows(got, "effective_date", "group_id", "end_date", "is_current") == [
        (at(1), "A", at(3), False),
        (at(3), "B", at(3), False),
        (at(3), "C", at(4), False),
        (at(4), "A", forever, True),
    ]


def test_member_who_leaves_and_returns(spark):
    df = spark.createDataFrame(
        [("m", at(1), "A", "1"), ("m", at(4), "A", "1"), ("n", at(2), "A", "1"), ("n", at(3), "A", "1")],
        SCHEMA,
    )
    forever = at(1).replace(year=9999, month=12, day=31)
    open_ended = scd2(df, "member", "ts", ["group_id"])
    assert rows(open_ended, "member", "effective_date", "end_date") == [
        ("m", at(1), forever),
        ("n", at(2), forever),
    ]
    closed = scd2(df, "member", "ts", ["group_id"], runs=df.select("ts"))
    assert rows(closed, "member", "effective_date", "end_date", "is_current") == [
        ("m", at(1), at(2), False),
        ("m", at(4), forever, True),
        ("n", at(2), at(4), False),
    ]


def test_history_plan_has_one_exchange_and_one_sort(spark, skewed):
    text = plan(scd2(skewed, "member", "ts", ["group_id"]))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1
    assert "SinglePartition" not in text and "md5" not in text.split("Exchange")[1]


def test_attribute_changes(spark):
    df = spark.createDataFrame(
        [("m", at(1), "A", None), ("m", at(2), "A", "9"), ("m", at(3), "B", None)], SCHEMA
    )
    got = temporal.attribute_changes(df, "member", "ts", ["group_id", "number"])
    assert rows(got, "changed_at", "attribute", "old_value", "new_value") == [
        (at(2), "number", None, "9"),
        (at(3), "group_id", "A", "B"),
        (at(3), "number", "9", None),
    ]


def test_membership_moves(spark):
    df = spark.createDataFrame(
        [("a", at(1), "G", "1"), ("b", at(1), "G", "1"), ("b", at(2), "G", "1"), ("a", at(3), "G", "1"),
         ("a", at(3), "G", "2"), ("a", at(2), "H", "1")],
        SCHEMA,
    )
    got = temporal.membership_diff(df, run="ts")
    assert rows(got, "group_id", "ts", "member", "status") == [
        ("G", at(1), "a", "joined"),
        ("G", at(1), "b", "joined"),
        ("G", at(2), "a", "left"),
        ("G", at(2), "b", "stayed"),
        ("G", at(3), "a", "joined"),
        ("G", at(3), "b", "left"),
        ("H", at(2), "a", "joined"),
    ]


def test_dimension_keys(spark, sf_dir):
    raw = fixtures.raw_members(spark, sf_dir)
    staged = staging.stg_members(raw, "2023")
    dim = dims.dim_member(staged, collapse=False)
    assert dim.columns == [*dims.DIM_MEMBER_COLUMNS, "member_key"]
    assert same(dim, dims.dim_member_latest(raw, "2023"))
    keys = dim.groupBy("member_id").agg(F.count_distinct("member_key").alias("n"))
    assert keys.where("n <> 1").isEmpty()


def test_staging_reads_both_season_forms(spark, sf_dir):
    raw = fixtures.raw_members(spark, sf_dir)
    long_form = raw.withColumn("season", F.lit("20232024"))
    assert same(staging.stg_members(raw, "2023"), staging.stg_members(long_form, "2023"))
    assert staging.stg_members(raw, "2022").isEmpty()


def test_staging_keeps_members_without_id_apart(spark):
    columns = "group_id STRING, season STRING, run_id STRING, run_ts TIMESTAMP_NTZ, member_id STRING, full_name STRING"
    raw = spark.createDataFrame(
        [
            ("G", "2025", "r", at(1), None, "Ann Lee"),
            ("G", "2025", "r", at(2), "", "Bo Ray"),
            ("G", "2025", "r", at(3), None, "Ann Lee"),
        ],
        columns,
    )
    from snaphist.sources.warehouse import aligned

    full = aligned(raw)
    assert rows(staging.stg_members(full, "2025"), "member_id", "run_ts") == [
        ("unknown_Ann_Lee", at(3)),
        ("unknown_Bo_Ray", at(2)),
    ]
    assert rows(staging.stg_members(full, "2025", by_raw_id=True), "member_id", "run_ts") == [
        ("unknown_Ann_Lee", at(3)),
        ("unknown_Bo_Ray", at(2)),
    ]


def test_shuffled_members_used(spark):
    rng = random.Random(3)
    data = [(f"m{rng.randrange(9)}", at(1), f"g{rng.randrange(3)}", "x") for _ in range(200)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("season", F.lit("2025"))
    want = sorted(
        (g, "2025", len({m for m, _, h, _ in data if h == g})) for g in {d[2] for d in data}
    )
    assert rows(temporal.members_used(df)) == want


def tied(seed: int):
    """Rows of few times, some without time or tiebreak, most of one member or of none."""
    draw = random.Random(seed)
    out = []
    for i in range(120):
        member = draw.choice(["h", "h", "h", None, f"m{draw.randrange(5)}"])
        ts = draw.choice([None, at(1), at(1), at(2), at(3)])
        out.append((member, ts, draw.choice(["a", "b"]), draw.choice(["1", "2", None]), i if i != 7 * seed else None))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ties_and_nulls_split_like_plain_windows(spark, seed):
    df = spark.createDataFrame(tied(seed), SCHEMA + ", n INT")
    split = split_hot_keys(df, ["member"], "ts", rows_per_part=4, tiebreak=["n"])
    plain = no_splits(["member"], "ts")
    parts = with_part(df.where("member = 'h' AND ts IS NOT NULL"), split).groupBy("ts").agg(F.count_distinct(PART).alias("k"))
    assert parts.agg(F.max("k")).first()[0] > 1  # rows of one time lie in several parts
    for collapse in (True, False):
        history = [scd2(df, "member", "ts", ["group_id"], collapse=collapse, tiebreak=["n"], splits=s) for s in (plain, split)]
        assert same(*history)
    changes = [temporal.attribute_changes(df, "member", "ts", ["group_id", "number"], tiebreak=["n"], splits=s) for s in (plain, split)]
    assert same(*changes)
    versions = scd2(df.where("ts IS NOT NULL AND member IS NOT NULL").dropDuplicates(["member", "ts"]), "member", "ts", ["group_id"])
    versions = versions.select("member", F.col("group_id").alias("v"), "effective_date", "end_date")
    facts = df.select("member", "ts", "n")
    by_time = split_hot_keys(facts, ["member"], "ts", rows_per_part=4)
    for how in ("inner", "left"):
        joined = [temporal.as_of_join(facts, versions, "member", "ts", how=how, splits=s) for s in (plain, by_time)]
        assert same(*joined)
        assert joined[0].where("member IS NULL AND v IS NOT NULL").isEmpty()
        if how == "left":
            assert joined[0].count() == facts.count()


def test_closing_looks_at_the_group_alone(spark):
    """B is stored once and unchanged after; only A's members can leave at A's next stored run."""
    data = [("x", at(1), "A"), ("y", at(1), "A"), ("z", at(1), "B"), ("x", at(2), "A"), ("w", at(3), "C")]
    df = spark.createDataFrame(data, "member STRING, ts TIMESTAMP_NTZ, group_id STRING")
    out = scd2(df, "member", "ts", ["group_id"], runs=df.select("group_id", "ts"), scope=["group_id"])
    assert rows(out, "member", "is_current") == [("w", True), ("x", True), ("y", False), ("z", True)]
    assert "SinglePartition" not in plan(out)
