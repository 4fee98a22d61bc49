"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.llm.store import table


def _is_done(edges: DataFrame) -> bool:
    """Whether each node points straight at a root, that is at one node that points nowhere."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    seen = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where("out > 1 or (out > 0 and into > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not itself the smallest of its component.

    ``edges`` has longs a and b. Rounds of large and small stars: every round links each node's
    neighbours to its smallest one, which takes about log squared rounds whatever the shape. Each
    round is written, so a lost executor repeats that round only.
    """
    edges = table(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while not _is_done(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        low = low.select("n", F.least("n", "m").alias("m"))
        large = (
            both.where("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("n"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("n").alias("a"), F.col("m").alias("b"))
        )
        edges = table(small.where("a <> b").distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
