"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source lie in a seeded random order and are cut into blocks of it; the blocks are permuted. The
words wanted of a source are whole passes over its permuted blocks and a last pass that stops within one block, there
within one document, so they are met exactly. Each source's quota is so many draws of its blocks, one after
another. The quotas of all sources are split over a binary tree of output shards: each node draws how many
of each source's draws go left from the multivariate hypergeometric distribution. A shard thus gets disjoint
intervals of each source's draws, and what is taken of a document is what the shards have drawn of its block; its
documents are shuffled there. The driver sees a few numbers per source, nothing per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaphist.llm import words as W
from snaphist.llm.store import small, table

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3

_BITS = 60
# Places within a block, below the number of the block's place in the permutation.
_PLACE_BITS = 32
# Cells of blocks by which the end of the last pass is searched first: then a cell has few blocks.
_CELLS = 1 << 20


def _counts(text: pa.Array) -> pa.Array:
    column = pa.RecordBatch.from_arrays([text], names=["text"])
    counts = [W.words(W.texts(part.column(0))).counts() for part in W.slices(column, "text")]
    return pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64())


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, none if it is null."""
    return F.arrow_udf(_counts, "long")(text)


def targets(sizes: list[int], weights=WEIGHTS, most: int = MAX_REPEATS) -> list[float]:
    """Shares of all sizes by weight, each at most ``most`` times its size, the excess reshared."""
    share = [weights[i % len(weights)] for i in range(len(sizes))]
    found = [0.0] * len(sizes)
    left, weight = sum(sizes), sum(share)
    # Sources reach their limit in this order as the shares grow.
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / share[i])
    for i in order:
        if most * sizes[i] * weight <= left * share[i]:
            found[i] = float(most * sizes[i])
            left -= most * sizes[i]
        else:
            found[i] = left * share[i] / weight
            continue
        weight -= share[i]
    return found


def _marked(docs: DataFrame, seed: int) -> DataFrame:
    """Add each row's size and its place in the random order of its source, 60 bits."""
    place = F.shiftrightunsigned(
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce("text", F.lit("")), F.col("source")), 64 - _BITS
    )
    return docs.withColumns({"_h": place, "_size": word_count(F.col("text"))})


def _permuted(blocks: Column) -> tuple[Column, Column]:
    """The place of a row's block in the permutation of its source's blocks, and the row's place after that.

    A block is a range of the random order; block b comes at ``step * b + shift``, and ``step`` has no divisor in common
    with the number of blocks.
    """
    block = F.least(blocks - 1, F.floor(F.col("_h") / F.lit(float(2**_BITS)) * blocks))
    at = F.pmod(F.col("step") * block + F.col("shift"), blocks)
    return at, F.shiftleft(at, _PLACE_BITS) + F.col("_h").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def _cut_points(rows: DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
    """Where each source's last pass stops: the place, and the words its document still gives.

    Searched by cells of blocks, then by blocks, then by rows: only the one cell and block in which a pass stops
    are looked at more closely.
    """
    spark = rows.sparkSession

    def boundary(df: DataFrame, step: str) -> DataFrame:
        order = Window.partitionBy("sid").orderBy(step)
        summed = df.groupBy("sid", step).agg(
            F.sum("_size").alias("words"), F.count("*").alias("n"), F.first("rest").alias("rest")
        )
        found = (
            summed.withColumn("before", F.sum("words").over(order) - F.col("words"))
            .where("before <= rest and rest < before + words")
            .select("sid", F.col(step).alias("_found"), (F.col("rest") - F.col("before")).alias("rest"), "n")
        )
        return table(found, "mix-boundary")

    def within(df: DataFrame, found: DataFrame, step: str) -> DataFrame:
        near = small(found.select(F.col("sid").alias("_sid"), "_found", "rest"))
        return df.drop("rest").join(near, (F.col("sid") == F.col("_sid")) & (F.col(step) == F.col("_found"))).drop("_sid", "_found")

    wanted = table(spark.createDataFrame(plan[["sid", "rest"]], "_sid int, rest long"), "mix-rest")
    at, place = _permuted(F.col("blocks"))
    width = F.ceil(F.col("blocks") / F.lit(_CELLS))
    celled = rows.join(small(wanted), F.col("sid") == F.col("_sid")).select(
        "sid", "_size", "rest", F.floor(at / width).alias("_cell"), at.alias("_at"), place.alias("_place")
    )
    in_cell = within(celled, boundary(celled, "_cell"), "_cell")
    in_block = within(in_cell, boundary(in_cell, "_at"), "_at")
    return boundary(in_block, "_place").withColumnRenamed("_found", "_place").toPandas().set_index("sid")


def plan_sources(rows: DataFrame, block_words: int, weights=WEIGHTS) -> pd.DataFrame:
    """One line per source: sizes, target, passes, blocks and where the last pass stops."""
    found = rows.groupBy("source").agg(F.sum("_size").alias("size"), F.count("*").alias("n")).toPandas()
    found["order"] = [(s is None, s or "") for s in found["source"]]
    found = found.sort_values("order").drop(columns="order").reset_index(drop=True)
    found["sid"] = np.arange(len(found), dtype=np.int32)
    sizes = [int(x) for x in found["size"]]
    found["target"] = targets(sizes, weights)
    want = [min(round(t), MAX_REPEATS * s) for t, s in zip(found["target"], sizes)]
    found["passes"] = [w // s if s else 0 for w, s in zip(want, sizes)]
    found["rest"] = [w % s if s else 0 for w, s in zip(want, sizes)]
    # Blocks of about so many words; fewer than 10^8 in all, which the drawing needs.
    block_words = max(block_words, sum(want) // 10**8 + 1)
    found["blocks"] = [max(1, math.ceil(s / block_words)) for s in sizes]
    return found


def _tree(quotas: np.ndarray, shards: int, seed: int, first: int, last: int) -> pd.DataFrame:
    """Leaves ``first`` to ``last`` of the splitting tree: (sid, shard, start, n) of each."""
    total = int(quotas.sum())
    room = lambda lo, hi: total * hi // shards - total * lo // shards
    out = []

    def walk(lo, hi, quota, start):
        if hi <= first or lo >= last:
            return
        if hi - lo == 1:
            own = np.flatnonzero(quota)
            out.append(pd.DataFrame({"sid": own, "shard": lo, "start": start[own], "n": quota[own]}))
            return
        mid = (lo + hi) // 2
        draw = np.random.default_rng([seed, lo, hi])
        left = draw.multivariate_hypergeometric(quota, room(lo, mid), method="marginals")
        walk(lo, mid, left, start)
        walk(mid, hi, quota - left, start + left)

    walk(0, shards, quotas, np.zeros(len(quotas), np.int64))
    empty = pd.DataFrame({"sid": [], "shard": [], "start": [], "n": []})
    return pd.concat(out or [empty]).astype(np.int64)


def _coprime(draw: np.random.Generator, n: int) -> int:
    while n > 1:
        step = int(draw.integers(1, n))
        if math.gcd(step, n) == 1:
            return step
    return 1


def _shards_of_blocks(spark, plan: pd.DataFrame, shards: int, seed: int) -> DataFrame:
    """(sid, at, dealt): the draws (epoch, shard) of the block at each place of its source's permutation."""
    quotas = plan["quota"].to_numpy(np.int64)
    leaves = 256

    def subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in batch["id"]:
                yield _tree(quotas, shards, seed, i * leaves, min(shards, (i + 1) * leaves))

    sources = table(spark.createDataFrame(plan[["sid", "blocks"]], "_sid long, _blocks long"), "mix-quotas")
    drawn = (
        spark.range(-(-shards // leaves))
        .mapInPandas(subtrees, "sid long, shard long, start long, n long")
        .join(small(sources), F.col("sid") == F.col("_sid"))
        .withColumn("j", F.explode(F.expr("sequence(start, start + n - 1)")))
    )
    # Draw j of a source is that of the block at place j mod blocks, in pass j div blocks.
    draw = F.struct(F.floor(F.col("j") / F.col("_blocks")).alias("epoch"), "shard")
    placed = drawn.withColumn("_drawn_at", F.col("j") % F.col("_blocks"))
    return table(
        placed.groupBy(F.col("sid").cast("int").alias("_drawn_sid"), "_drawn_at").agg(
            F.array_sort(F.collect_list(draw)).alias("_dealt")
        ),
        "mix-blocks",
    )


def mix(
    docs: DataFrame,
    seed: int = 1,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = 1 << 14,
    shard_words: int = 1 << 20,
) -> DataFrame:
    """``docs`` with size, source_size, target, taken and draws (epoch, shard, words).

    A document's size is its number of words ``[^\\x20\\x09-\\x0D]+``; null or empty text has none
    and is never taken. Sources in code-point order, null last, have ``weights`` in turn and share all
    words; a target stops at three times its source's size. ``taken`` is the words taken of a
    row, ``draws`` one entry per draw of its block that takes any; that at which the last pass ends may take only a
    part of a document. The words taken of a source are its target, rounded. Rows that agree in doc_id, text and source
    are treated alike: if a pass stops among them, they give equal parts. Columns of ``docs``
    named like a result are replaced. The same rows, seed and size of blocks give the same result in any order
    and partitioning. An empty table gives no rows. One row per source reaches the driver.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "draws")]
    marked = _marked(docs.select(*kept), seed)
    rows = table(marked.select("source", "_h", "_size"), "mix-sizes")
    plan = plan_sources(rows, block_words, weights)
    draw = np.random.default_rng(seed)
    plan["step"] = [_coprime(draw, int(b)) for b in plan["blocks"]]
    plan["shift"] = [int(draw.integers(0, int(b))) for b in plan["blocks"]]
    known = spark.createDataFrame(
        plan[["source", "sid", "size", "target", "passes", "blocks", "step", "shift"]],
        "_source string, sid int, source_size long, target double, passes long, blocks long, step long, shift long",
    )
    known = table(known, "mix-sources")
    by_source = F.col("source").eqNullSafe(F.col("_source"))
    numbered = rows.join(small(known.select("_source", "sid", "blocks", "step", "shift")), by_source)
    cuts = _cut_points(numbered, plan)
    ends, parts = cuts["_place"].to_dict(), (cuts["rest"] // cuts["n"]).to_dict()
    # Whole numbers throughout: places do not fit a double.
    plan["cut"] = np.array([ends.get(i, 0) for i in plan["sid"]], np.int64)
    plan["part"] = np.array([parts.get(i, 0) for i in plan["sid"]], np.int64)
    last_draws = np.where(plan["rest"] > 0, (plan["cut"].to_numpy() >> _PLACE_BITS) + 1, 0)
    plan["quota"] = plan["passes"] * plan["blocks"] + last_draws
    words_wanted = int((plan["passes"] * plan["size"] + plan["rest"]).sum())
    shards = max(1, -(-words_wanted // shard_words))
    blocks = _shards_of_blocks(spark, plan, shards, seed)
    cut = spark.createDataFrame(plan[["sid", "cut", "part"]], "_cut_sid int, cut long, part long")
    cut = table(cut, "mix-cuts")
    at, place = _permuted(F.col("blocks"))
    # The last pass takes what lies before its end, and of the document there its part.
    last = F.when(F.col("_place") < F.col("cut"), F.col("_size")).when(F.col("_place") == F.col("cut"), F.col("part")).otherwise(F.lit(0))
    draws = F.transform(
        F.coalesce("_dealt", F.array()),
        lambda d: F.struct(
            d.epoch.cast("int").alias("epoch"),
            d.shard.alias("shard"),
            F.when(d.epoch < F.col("passes"), F.col("_size")).otherwise(last).alias("words"),
        ),
    )
    placed = (
        marked.join(small(known), by_source)
        .join(small(cut), F.col("sid") == F.col("_cut_sid"))
        .withColumns({"_at": at, "_place": place})
        .join(small(blocks), (F.col("sid") == F.col("_drawn_sid")) & (F.col("_at") == F.col("_drawn_at")), "left")
    )
    return placed.select(
        *kept,
        F.col("_size").alias("size"),
        "source_size",
        "target",
        F.filter(draws, lambda d: d.words > 0).alias("draws"),
    ).withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d.words))


def deal(mixed: DataFrame, columns: list[str], seed: int = 1) -> DataFrame:
    """The mix itself: a row per draw, gathered by shard and shuffled within it.

    Texts stay whole. The document at which a source's last pass stops is taken if at least half of its
    words were to be, and left out otherwise.
    """
    drawn = mixed.select("*", F.explode("draws").alias("_draw")).where(2 * F.col("_draw.words") >= F.col("size"))
    order = F.xxhash64(F.lit(seed), F.col("_draw.shard"), F.col("_draw.epoch"), F.col("doc_id"), F.col("text"))
    return (
        drawn.withColumn("_order", order)
        .repartition("_draw.shard")
        .sortWithinPartitions("_draw.shard", "_order")
        .select(*columns)
    )
