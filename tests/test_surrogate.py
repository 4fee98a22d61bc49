from pyspark.sql import Window
from pyspark.sql import functions as F

from snaphist import fixtures
from snaphist.operators.latest import latest_per_key
from snaphist.operators.scd2 import scd2
from snaphist.operators.skew import no_splits
from snaphist.operators.surrogate import surrogate_key
from snaphist.plans import staging
from tests.helpers import plan, rows, same


def test_numbers_like_a_global_window(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    hot = orders.withColumn("k", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 5))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        numbered = surrogate_key(hot, ["k", "o_orderdate", "o_orderkey"], "sk")
        parts = numbered.select(F.max("sk")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = [F.col(c).asc_nulls_last() for c in ("k", "o_orderdate", "o_orderkey")]
    want = hot.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("sk"), "*"
    )
    assert parts == hot.count() and same(want, numbered)
    assert "SinglePartition" not in plan(numbered)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "k STRING")
    assert surrogate_key(empty, ["k"], "sk").count() == 0
    assert rows(surrogate_key(spark.createDataFrame([("a",)], "k STRING"), ["k"], "sk")) == [(1, "a")]


def test_latest_per_key_limits_before_the_shuffle(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    text = plan(latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]))
    before_exchange = text.split("Exchange")[1]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_latest_puts_missing_times_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 5, 2), ("n", None, 3)], "k STRING, ts INT, v INT")
    assert rows(latest_per_key(df, ["k"], "ts")) == [("k", 5, 2), ("n", None, 3)]


def test_history_and_numbering_share_one_exchange(spark):
    raw = fixtures.raw_members(spark, "/root/testdata/sf0.001")
    staged = staging.stage_rows(raw, "2023")
    splits = no_splits(["member_id"], "run_ts")
    ranged = scd2(staged, "member_id", "run_ts", ["group_id"], tiebreak=["group_id"], splits=splits, ranged=True)
    order = ["member_id", "effective_date", "group_id"]
    shown = plan(ranged.sortWithinPartitions(*order))
    assert shown.count("Exchange") == 1 and "rangepartitioning" in shown
    plain = scd2(staged, "member_id", "run_ts", ["group_id"], tiebreak=["group_id"], splits=splits)
    assert same(ranged, plain)
