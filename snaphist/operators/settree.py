"""Hash trees over member sets: leaves in parallel, nodes of few children, differences by descent.

A member belongs to the leaf named by the first hex digits of its md5, so a leaf is a range of hashes and the
shape of the tree depends on nothing but its depth. A leaf's hash is that of its sorted members, a node's that of its
children, at most 16. No task ever holds a whole snapshot, and two trees differ only below nodes that differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaphist.functions.hashing import MEMBER_SEPARATOR, as_text, member_text
from snaphist.functions.text import strip
from snaphist.operators.skew import match_keys
from snaphist.session import materialize

# 16 ** DEPTH leaves. A snapshot of n members has n / 16 ** depth in a leaf, so huge ones want a deeper tree.
DEPTH = 2

PATH = "path"


def leaf_of(identity: Column, depth: int = DEPTH) -> Column:
    return F.substring(F.md5(identity), 1, depth)


def tree_nodes(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    identity: str | None = None,
    depth: int = DEPTH,
) -> DataFrame:
    """All nodes (keys, path, set_hash, member_count) of the tree of each snapshot; the root's path is empty.

    ``identity`` names the column that places a member, so that a change of its other fields stays in its leaf;
    without it all fields do. As in the set hash, members whose first field is blank are counted but not hashed.
    """
    names = [f"_f{i}" for i in range(len(fields))]
    texts = df.select(
        *keys,
        *[as_text(F.col(f)).alias(n) for f, n in zip(fields, names)],
        (F.lit(None).cast("string") if identity is None else as_text(F.col(identity))).alias("_id"),
    )
    named = strip(F.col(names[0])) != ""
    members = texts.select(*keys, "_id", F.when(named, member_text([F.col(n) for n in names])).alias("_text"))
    placed = members.withColumn(PATH, leaf_of(F.coalesce("_id", "_text", F.lit("")), depth))
    leaves = placed.groupBy(*keys, PATH).agg(
        F.md5(F.array_join(F.array_sort(F.collect_list("_text")), MEMBER_SEPARATOR)).alias("set_hash"),
        F.count("*").cast("bigint").alias("member_count"),
        F.count("_text").alias("_named"),
    )
    # Written once: every level above is computed from the one below.
    levels = [materialize(leaves, "leaves")]
    for size in range(depth - 1, -1, -1):
        child = F.when(F.col("_named") > 0, F.concat_ws(":", PATH, "set_hash"))
        above = levels[-1].withColumn("_up", F.substring(PATH, 1, size))
        levels.append(
            above.groupBy(*keys, F.col("_up").alias(PATH)).agg(
                F.md5(F.array_join(F.array_sort(F.collect_list(child)), MEMBER_SEPARATOR)).alias("set_hash"),
                F.sum("member_count").alias("member_count"),
                F.sum("_named").alias("_named"),
            )
        )
    return reduce(DataFrame.unionByName, levels).drop("_named")


def set_hash_tree(df: DataFrame, keys: Sequence[str], fields: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """Hash and member count per snapshot: the root of its tree. Equal sets have equal roots, in any order."""
    return tree_nodes(df, keys, fields, depth=depth).where(F.col(PATH) == "").drop(PATH)


def differing_leaves(old: DataFrame, new: DataFrame, keys: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """(keys, path) of the leaves in which two trees differ, found from the roots down.

    Both sides are nodes of trees with the same ``keys``; a tree that one side lacks differs everywhere.
    Below a node that is equal on both sides nothing is looked at.
    """
    on = [*keys, PATH]
    frontier = None
    for size in range(depth + 1):
        sides = []
        for side in (old, new):
            level = side.where(F.length(PATH) == size).select(*on, "set_hash")
            if frontier is not None:
                up = frontier.withColumnRenamed(PATH, "_up")
                level = match_keys(level.withColumn("_up", F.substring(PATH, 1, size - 1)), up, [*keys, "_up"], "left_semi")
            sides.append(level)
        # A node occurs once on each side: it is equal if both have it with one hash.
        both = sides[0].select(*on, "set_hash").unionByName(sides[1].select(*on, "set_hash"))
        frontier = (
            both.groupBy(*on)
            .agg(F.count("*").alias("_n"), F.min("set_hash").alias("_lo"), F.max("set_hash").alias("_hi"))
            .where((F.col("_n") < 2) | (F.col("_lo") != F.col("_hi")))
            .select(*on)
        )
    return frontier


def membership_changes(
    rows: DataFrame,
    nodes: DataFrame,
    group: str = "group_id",
    run: str = "run_ts",
    member: str = "member",
    depth: int = DEPTH,
) -> DataFrame:
    """Who joined or left at each run of a group, from trees over its runs.

    ``nodes`` are the trees of (group, run), members placed and hashed by ``member``. Members of the first run of a group
    have joined. Only the members of differing leaves are read from ``rows``, which carry their leaf in ``path``.
    """
    runs = nodes.where(F.col(PATH) == "").select(group, run)
    by_group = Window.partitionBy(group).orderBy(run)
    pairs = runs.withColumn("_before", F.lag(run).over(by_group))

    def at_run_before(df: DataFrame) -> DataFrame:
        """Rows of the run before, as rows of the run."""
        asked = pairs.where(F.col("_before").isNotNull()).select(group, F.col(run).alias("_run"), F.col("_before").alias(run))
        return match_keys(df, asked, [group, run], "inner").withColumn(run, F.col("_run")).drop("_run")

    leaves = materialize(differing_leaves(at_run_before(nodes), nodes, [group, run], depth), "differing")
    keys = [group, run, PATH]
    listed = rows.select(*keys, member)
    old = match_keys(at_run_before(listed), leaves, keys, "left_semi").withColumn("_old", F.lit(1))
    new = match_keys(listed, leaves, keys, "left_semi").withColumn("_old", F.lit(0))
    sides = old.unionByName(new).groupBy(group, run, member).agg(F.min("_old").alias("_lo"), F.max("_old").alias("_hi"))
    return sides.where(F.col("_lo") == F.col("_hi")).select(
        group, run, member, F.when(F.col("_lo") == 1, F.lit("left")).otherwise(F.lit("joined")).alias("status")
    )
