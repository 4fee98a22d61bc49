"""Hash trees of member sets."""

import random

import pytest
from pyspark.sql import functions as F

from snaphist.operators import settree
from tests.helpers import at, rows

SCHEMA = "group_id STRING, run_ts TIMESTAMP_NTZ, member STRING, number STRING"
KEYS = ["group_id", "run_ts"]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_equal_sets_have_equal_roots(spark, depth):
    names = [f"m{i}" for i in range(60)]
    a = [("A", at(1), n, "1") for n in names]
    b = [("B", at(1), n, "1") for n in random.Random(1).sample(names, 60)]
    c = [("C", at(1), n, "2" if n == "m7" else "1") for n in names]
    d = a[:-1]
    blank = [("D", at(1), " ", "1"), ("D", at(1), None, "1"), ("E", at(1), "", "9")]
    twice = [("F", at(1), n, "1") for n in [*names, "m7"]]
    data = a + b + c + [("G", *r[1:]) for r in d] + blank + twice
    got = {r["group_id"]: r for r in settree.set_hash_tree(frame(spark, data), KEYS, ["member", "number"], depth).collect()}
    assert got["A"]["set_hash"] == got["B"]["set_hash"]
    assert len({got[g]["set_hash"] for g in "ACDFG"}) == 5
    assert got["D"]["set_hash"] == got["E"]["set_hash"] and got["D"]["member_count"] == 2
    assert got["A"]["member_count"] == 60 and got["F"]["member_count"] == 61


def test_descent_finds_the_leaves_that_differ(spark):
    old = [(None, at(1), f"m{i}", "1") for i in range(300)]
    new = [r if r[2] not in ("m5", "m9") else (*r[:3], "2") for r in old[:-1]] + [(None, at(1), "x", "1")]
    trees = [
        settree.tree_nodes(frame(spark, r), KEYS, ["member", "number"], "member", 3).cache() for r in (old, new)
    ]
    leaves = rows(settree.differing_leaves(*trees, KEYS, 3), "path")
    named = spark.createDataFrame([(m,) for m in ("m5", "m9", "m299", "x")], "member STRING")
    assert leaves == rows(named.select(settree.leaf_of(F.col("member"), 3).alias("path")).distinct())
    assert settree.differing_leaves(trees[0], trees[0], KEYS, 3).isEmpty()
    # A tree that one side lacks differs in all its leaves.
    nothing = trees[0].limit(0)
    assert settree.differing_leaves(nothing, trees[1], KEYS, 3).count() == trees[1].where("length(path) = 3").count()


def test_no_members(spark):
    empty = frame(spark, [])
    assert settree.set_hash_tree(empty, KEYS, ["member"]).isEmpty()
    nodes = settree.tree_nodes(empty, KEYS, ["member"], "member")
    assert settree.membership_changes(empty.withColumn("path", settree.leaf_of(F.col("member"))), nodes).isEmpty()
