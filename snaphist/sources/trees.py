"""Stored hash trees: nodes and members of a run, members in folders by the first digit of their leaf.

Two runs are compared by their nodes; members are read from the folders of differing leaves only, and in these from
the row groups whose range of leaves holds one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from snaphist.operators.settree import DEPTH, PATH, differing_leaves, leaf_of, tree_nodes
from snaphist.operators.skew import match_keys
from snaphist.session import materialize
from snaphist.sources.tables import read_table

# So many differing leaves are named in the filter of the scan; with more the join alone finds them.
MAX_NAMED = 10_000


def _nodes_path(root: str, run: str) -> str:
    return f"{root}/nodes/run={run}"


def _members_path(root: str, run: str) -> str:
    return f"{root}/members/run={run}"


def save_tree(
    members: DataFrame, root: str, run: str, keys: Sequence[str], fields: Sequence[str], identity: str, depth: int = DEPTH
) -> None:
    """Store the tree of each snapshot (``keys``) of a run and its members; a repeated run replaces its own.

    ``run`` names a folder. ``identity`` places a member, ``fields`` are hashed (see ``tree_nodes``). Nodes are written last.
    """
    placed = members.withColumn(PATH, leaf_of(F.coalesce(F.col(identity).cast("string"), F.lit("")), depth))
    rows = placed.withColumn("digit", F.substring(PATH, 1, 1)).hint("rebalance", "digit")
    rows = rows.sortWithinPartitions("digit", PATH, *keys)
    rows.write.mode("overwrite").partitionBy("digit").parquet(_members_path(root, run))
    nodes = tree_nodes(members, keys, fields, identity, depth)
    nodes.write.mode("overwrite").parquet(_nodes_path(root, run))


def read_nodes(spark: SparkSession, root: str, run: str, keys: StructType) -> DataFrame:
    schema = StructType(
        [*keys, StructField(PATH, StringType()), StructField("set_hash", StringType()), StructField("member_count", LongType())]
    )
    return read_table(spark, _nodes_path(root, run), schema)


def stored_changes(
    spark: SparkSession, root: str, old: str, new: str, members: StructType, keys: Sequence[str], depth: int = DEPTH
) -> DataFrame:
    """The members that only one of two stored runs has: their columns, and ``status`` joined or left.

    ``members`` is the schema they were stored with. A member whose fields changed has left as it was and joined as it is.
    Repeats count: of a member listed twice before and once now, one row has left.
    """
    kinds = StructType([members[k] for k in keys])
    trees = [read_nodes(spark, root, run, kinds) for run in (old, new)]
    leaves = materialize(differing_leaves(*trees, keys, depth), "differing")
    # At most 16 ** depth names, each of a leaf.
    named = sorted(r[PATH] for r in leaves.select(PATH).distinct().limit(MAX_NAMED + 1).collect())
    schema = StructType([*members, StructField(PATH, StringType())])

    def read(run: str) -> DataFrame:
        digits = sorted({p[:1] for p in named}) if len(named) <= MAX_NAMED else list("0123456789abcdef")
        have = read_table(spark, _members_path(root, run), StructType([*schema, StructField("digit", StringType())]))
        rows = have.where(F.col("digit").isin(digits)) if digits else have.limit(0)
        if digits and len(named) <= MAX_NAMED:
            rows = rows.where(F.col(PATH).isin(named))
        return match_keys(rows, leaves, [*keys, PATH], "left_semi").select(*members.names)

    before, after = read(old), read(new)
    left = before.exceptAll(after).withColumn("status", F.lit("left"))
    return left.unionByName(after.exceptAll(before).withColumn("status", F.lit("joined")))
