"""N-gram Jaccard join as a blocked sparse product of document and n-gram incidence.

The columns, n-grams, are dealt by hash to more parts than two sets that meet the similarity bound can differ
in, so that they are equal in some part. Parts as they are in a set are put in one order, rare ones first, and of the
first few, as many as the sizes allow, one is common to both. Several columns equal in a part is rarely chance, however
many documents there are; a single column often is. Documents that share none are discarded unseen. The
others are gathered, and only among them the incidence rows are multiplied, block of columns by block of
columns, where the sizes of two blocks of rows allow a link: overlap counts add up, and pairs whose count
cannot reach the size-derived bound any more are discarded. Equal sets count once. No pair of documents
ever becomes a row: a task returns a spanning forest of its links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaphist.llm import words as W
from snaphist.llm.graph import components
from snaphist.llm.store import fetch, same, small, table

# Bounds of one task's product.
BLOCK_DOCS = 1024
BLOCK_NGRAMS = 1 << 20
COLUMNS = 1024

# So many times the parts that two sets can differ in, and one, are made; those spared are the frequent and the light ones.
SPARE = 1.25

# Parts or columns met in several sets that are known to the tasks, the most frequent ones. Any order gives the same
# links, so this bounds what is broadcast and nothing else.
MAX_KNOWN = 4_000_000

# Digests of sets that a task remembers, to pass over equal sets.
MAX_SEEN = 1_000_000

_SETS = "doc_id long, n long, d1 long, d2 long"


def sets_of(t: W.Texts, k: int) -> list[np.ndarray]:
    """Sorted distinct ``k``-word hashes of each text; of fewer words, their whole sequence."""
    w = W.words(t)
    h = W.hash_spans(t.buf, w.starts, w.ends)
    at, n = W.run_starts(w.first, k)
    grams = W.runs(h, k)[at]
    ends = np.cumsum(n)
    out = []
    for i, words in enumerate(w.counts()):
        if words >= k:
            out.append(np.unique(grams[ends[i] - n[i] : ends[i]]))
        elif words:
            out.append(W.runs(h[w.first[i] : w.first[i + 1]], int(words)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(grams: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(raw, np.int64).tolist())


def counted_share(num: int, den: int) -> float:
    """Share of all columns, by hash, whose frequency is counted: well above what is taken of a set."""
    return min(1.0, 2.5 * (den - num) / den)


def _below(share: float) -> np.uint64:
    return np.uint64(min(2**64 - 1, int(share * 2**64)))


def _first(
    keys: np.ndarray, row: np.ndarray, weight: np.ndarray, want: np.ndarray, known: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """(keys, rows): the first ``want`` keys of each row in the common order; keys of a row stand together.

    The order is: those of a weight before others, rare before frequent by ``known`` (sorted keys and the power
    of two of their frequency; all others are met once), then by weight, large before small, and by hash.
    """
    level = np.zeros(len(keys), np.uint8)
    often, power = known
    if len(often):
        at = np.minimum(np.searchsorted(often, keys), len(often) - 1)
        hit = often[at] == keys
        level[hit] = power[at[hit]]
    level[weight == 0] = 255
    order = np.lexsort((keys, -weight, level, row))
    size = np.bincount(row, minlength=len(want))
    place = np.arange(len(keys)) - np.repeat(np.cumsum(size) - size, size)
    order = order[place < np.repeat(want, size)]
    return keys[order], row[order]


def first_columns(
    sets: list[np.ndarray], num: int, den: int, known: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """(columns, how many of each set): the first columns of each set in the common order.

    A set of n shares ``ceil(num * n / den)`` columns at least with any that meets the bound, so the first
    ``n - ceil(num * n / den) + 1`` of both, in whatever common order, have one in common. Columns that
    are not counted come last.
    """
    size = np.array([len(s) for s in sets], np.int64)
    grams = np.concatenate([np.zeros(0, np.uint64), *sets])
    want = np.where(size > 0, size - -(-num * size // den) + 1, 0)
    weight = (grams < _below(counted_share(num, den))).astype(np.int64)
    return _first(grams, np.repeat(np.arange(len(sets)), size), weight, want, known)[0], want


def has_parts(num: int, den: int) -> bool:
    """Whether sets are compared by parts: only if a part that two similar sets share has several columns."""
    return num >= 3 * (den - num)


def parts_of(
    sets: list[np.ndarray], num: int, den: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, row, weight, set of each row, how many keys of each row are wanted).

    Sets of n and m columns that meet the bound differ in ``(den - num) * (n + m) / (den + num)`` columns at
    most, and so in as many parts. How many parts are made goes by the power of two below the size of
    the smaller one: a set has a row for that of its own size and one for each that a smaller partner can have. A
    key names the columns of a set in one part, its weight is their number. Of an order of all parts that is common to the
    sets, the first ones, one more than can differ, have an equal one. An empty part is a key, of no weight, if
    a row has too few others.
    """
    size = np.array([len(s) for s in sets], np.int64)
    grams = np.concatenate([np.zeros(0, np.uint64), *sets])
    # The exponent of the power of two above a size.
    top, low = (np.frexp(x.astype(np.float64))[1] for x in (size, -(-num * size // den)))

    def differ(n, m):
        return (den - num) * (n + m) // (den + num)

    owner, level, most = [], [], []
    for step in range(int((top - low).max(initial=0)) + 1):
        at = np.flatnonzero((size > 0) & (top - step >= low))
        # Unless it is the smaller one, its partner is below the next power of two.
        other = den * size[at] // num if step == 0 else (1 << (top[at] - step).astype(np.int64)) - 1
        d = differ(size[at], other)
        # Sets that cannot differ are equal.
        owner.append(at[d > 0])
        level.append((top[at] - step)[d > 0].astype(np.int64))
        most.append(d[d > 0])
    owner, level, want = np.concatenate(owner), np.concatenate(level), np.concatenate(most) + 1
    largest = (1 << level) - 1
    parts = np.ceil(SPARE * (differ(largest, den * largest // num) + 1)).astype(np.uint64)

    n = size[owner]
    row = np.repeat(np.arange(len(owner)), n)
    column = grams[np.arange(len(row)) + np.repeat((np.cumsum(size) - size)[owner] - (np.cumsum(n) - n), n)]
    # Sets are sorted by hash, so the columns of a part stand together.
    part = ((column >> np.uint64(32)) * parts[row]) >> np.uint64(32)
    begins = np.ones(len(row), bool)
    begins[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
    begins = np.flatnonzero(begins)
    weight = np.diff(np.r_[begins, len(row)])
    total = np.add.reduceat(W.mix(column), begins) if len(begins) else np.zeros(0, np.uint64)
    row, part = row[begins], part[begins]
    found = np.bincount(row, minlength=len(owner))
    few = np.flatnonzero(found < want)
    if len(few):
        last = np.cumsum(found)
        empty = [np.setdiff1d(np.arange(parts[r], dtype=np.uint64), part[last[r] - found[r] : last[r]]) for r in few]
        row = np.concatenate([row, np.repeat(few, [len(x) for x in empty])])
        part = np.concatenate([part, *empty])
        total, weight = (np.pad(x, (0, len(row) - len(x))) for x in (total, weight))
        order = np.argsort(row, kind="stable")
        row, part, total, weight = row[order], part[order], total[order], weight[order]
    place = W.mix((level[row].astype(np.uint64) << np.uint64(56)) + part + np.uint64(1))
    return W.mix(total ^ place), row, weight, owner, want


def incidence(docs: DataFrame, k: int, lower: bool) -> DataFrame:
    """(doc_id, n, d1, d2) of each row: set size and set digest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", W.SMALL_SLICE_BYTES):
                sets = sets_of(W.texts(part.column(1), lower), k)
                d1, d2 = zip(*map(digest, sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(d1, pa.int64()),
                        pa.array(d2, pa.int64()),
                    ],
                    names=["doc_id", "n", "d1", "d2"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return table(rows.mapInArrow(W.giving_back(read), _SETS), "sets")


def _columns(docs, k, lower, num, den, known=None) -> DataFrame:
    """(key, node): first parts, or columns, of each set; a node is the first half of the set's digest.

    Without ``known``, all whose frequency is counted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        limit = _below(counted_share(num, den))
        for batch in batches:
            for part in W.slices(batch, "text", W.SMALL_SLICE_BYTES):
                new: dict[tuple[int, int], np.ndarray] = {}
                for s in sets_of(W.texts(part.column(0), lower), k):
                    name = digest(s)
                    if name not in seen and len(s):
                        new[name] = s
                if len(seen) > MAX_SEEN:
                    seen.clear()
                seen.update(new)
                if has_parts(num, den):
                    columns, row, weight, owner, want = parts_of(list(new.values()), num, den)
                    if shared.value is None:
                        columns, row = columns[weight > 0], row[weight > 0]
                    else:
                        columns, row = _first(columns, row, weight, want, shared.value)
                    n = np.bincount(owner[row], minlength=len(new))
                    columns = columns[np.argsort(owner[row], kind="stable")]
                elif shared.value is None:
                    parts = [s[: np.searchsorted(s, limit)] for s in new.values()]
                    n = [len(x) for x in parts]
                    columns = np.concatenate([np.zeros(0, np.uint64), *parts])
                else:
                    columns, n = first_columns(list(new.values()), num, den, shared.value)
                nodes = np.repeat(np.array([d for d, _ in new], np.int64), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.signed(columns)), pa.array(nodes)], names=["key", "node"]
                )

    return docs.select("text").mapInArrow(W.giving_back(read), "key long, node long")


def _clusters(docs: DataFrame, k: int, lower: bool, num: int, den: int) -> DataFrame:
    """(node, root): nodes linked through shared first parts or columns."""
    counted = _columns(docs, k, lower, num, den).groupBy("key").agg(F.count("*").alias("n"))
    often = table(counted.where("n > 1"), "frequent")
    top = fetch(
        often.orderBy(F.desc("n"), "key")
        .limit(MAX_KNOWN)
        .select("key", F.floor(F.log2("n")).cast("byte").alias("power"))
    )
    columns, power = top["key"].to_numpy().view(np.uint64), top["power"].to_numpy().astype(np.uint8)
    order = np.argsort(columns)
    keys = _columns(docs, k, lower, num, den, (columns[order], power[order]))
    # The frame grows from the first row, so nothing of a key's rows is held in memory.
    order = Window.partitionBy("key").orderBy("node").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = keys.withColumn("root", F.first("node").over(order)).where("root < node")
    return components(edges.select(F.col("node").alias("a"), F.col("root").alias("b")))


def linked(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Labels of the components among ``sets`` by the product of their incidence rows."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), size)
    shared = count[column] > 1
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = size[:, None] + size[None, :]
    need = -(-num * total // (num + den))
    left = np.bincount(row, minlength=m)
    overlap = np.zeros((m, m), np.float32)
    columns = int(column[-1]) + 1 if len(column) else 0
    off = ~np.eye(m, dtype=bool)
    for start in range(0, columns, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        block = np.zeros((m, COLUMNS), np.float32)
        block[row[a:b], column[a:b] - start] = 1
        overlap += block @ block.T
        left = left - np.bincount(row[a:b], minlength=m)
        # What is still to come bounds what a pair can reach.
        if not ((overlap + np.minimum(left[:, None], left[None, :]) >= need) & off).any():
            return np.arange(m)
    links = (overlap >= need) & off
    label = np.full(m, -1)
    for i in range(m):
        if label[i] < 0:
            front = np.zeros(m, bool)
            front[i] = True
            while front.any():
                label[front] = i
                front = links[front].any(axis=0) & (label < 0)
    return label


def _placements(members: DataFrame, num: int, den: int) -> DataFrame:
    """(cluster, left, right, id, p1, p2): the products that each class of a cluster takes part in."""
    # By size, so that few pairs of blocks have sizes that allow a link.
    order = Window.partitionBy("root").orderBy("n", "id")
    blocked = table(
        members.select(
            F.col("root").alias("cluster"), "id", "d1", "d2", "n",
            (
                F.floor(F.sum("n").over(order) / F.lit(BLOCK_NGRAMS))
                + F.floor((F.row_number().over(order) - 1) / F.lit(BLOCK_DOCS))
            ).alias("block"),
        ),
        "row-blocks",
    )
    present = blocked.groupBy("cluster", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    pairs = (
        present.alias("x")
        .join(present.alias("y"), F.col("x.cluster") == F.col("y.cluster"))
        .where(f"x.block <= y.block and {num} * y.least <= {den} * x.most")
        .select(
            F.col("x.cluster").alias("_cluster"),
            F.col("x.block").alias("left"),
            F.col("y.block").alias("right"),
            F.explode(F.array_distinct(F.array("x.block", "y.block"))).alias("_block"),
        )
    )
    placed = blocked.join(
        pairs, (F.col("cluster") == F.col("_cluster")) & (F.col("block") == F.col("_block"))
    )
    return table(
        placed.select("cluster", "left", "right", "id", F.col("d1").alias("p1"), F.col("d2").alias("p2")),
        "placements",
    )


def _links(grams: DataFrame, placements: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) among the classes of each cluster, from products of pairs of row blocks."""
    rows = (
        grams.join(small(placements), (F.col("g1") == F.col("p1")) & (F.col("g2") == F.col("p2")))
        .select("cluster", "left", "right", "id", "grams")
        .repartition("cluster", "left", "right")
        .sortWithinPartitions("cluster", "left", "right", "id")
    )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, sets = None, [], []

        def finish():
            if len(ids) < 2:
                return None
            label = linked(sets, num, den)
            edge = np.flatnonzero(label != np.arange(len(ids)))
            name = np.array(ids, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(name[edge]), pa.array(name[label[edge]])], names=["a", "b"]
            )

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["cluster"], r["left"], r["right"])
                if key != current:
                    if (out := finish()) is not None:
                        yield out
                    current, ids, sets = key, [], []
                if ids and ids[-1] == r["id"]:
                    continue  # a row that repeats a doc_id and text
                ids.append(r["id"])
                sets.append(np.frombuffer(r["grams"], np.uint64))
        if (out := finish()) is not None:
            yield out

    return rows.mapInArrow(W.giving_back(multiply), "a long, b long")


def join(
    docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, lower: bool = True
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs``.

    A document's set holds its distinct ``k``-word sequences (words ``[^\\x20\\x09-\\x0D]+``, A-Z
    lower-cased if ``lower``); of fewer words, their whole sequence. Documents link when
    ``den * intersection >= num * union``; ``component_id`` is the smallest doc_id reachable by links. Null text or text
    without words has an empty set and links with nothing. A null doc_id is passed over in favour of
    any other in its component. Repeated rows link like others. Other columns, whatever their
    names, are ignored. An empty table gives no rows.
    """
    found = incidence(docs, k, lower)
    classes = table(
        found.where("n > 0")
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("low"), F.first("n").alias("n"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    clusters = _clusters(docs, k, lower, num, den)
    nodes = table(
        clusters.unionByName(clusters.select(F.col("root").alias("node"), "root").distinct()), "clusters"
    )
    members = table(
        classes.join(nodes, F.col("d1") == F.col("node")).drop("node"),
        "members",
    )
    edges = _links(_grams(docs, members, k, lower), _placements(members, num, den), num, den)
    roots = components(edges)
    of_class = table(
        classes.select("id", "d1", "d2", "low")
        .join(roots, F.col("id") == F.col("node"), "left")
        .select("d1", "d2", "low", F.coalesce("root", "id").alias("root")),
        "class-roots",
    )
    lowest = of_class.groupBy("root").agg(F.min("low").alias("component_id"))
    named = of_class.join(lowest, "root").select(
        F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "component_id"
    )
    return found.select("doc_id", "n", "d1", "d2").join(
        named, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")), "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _grams(docs: DataFrame, members: DataFrame, k: int, lower: bool) -> DataFrame:
    """(g1, g2, grams): set digest and set of the documents that stand for the gathered classes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", W.SMALL_SLICE_BYTES):
                sets = sets_of(W.texts(part.column(1), lower), k)
                d1, d2 = zip(*map(digest, sets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["g1", "g2", "grams"],
                )

    wanted = small(table(members.select(F.col("low").alias("_id")).distinct(), "wanted"))
    rows = same(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), wanted, {"doc_id": "_id"}, "inner")
    return rows.select("doc_id", "text").mapInArrow(W.giving_back(read), "g1 long, g2 long, grams binary")


def keep(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id, with all its columns.

    Documents without words stay all. Where rows share a doc_id, those with different texts stay or go
    together, staying if one of them does, and of those with equal texts one stays. A group whose
    ids are all null counts as sharing one.
    """
    joined = table(joined.where("n_shingles > 0").select("doc_id", "component_id"), "join-result")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = joined.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(stays).alias("_stays"), F.count("*").alias("_n")
    )
    marked = table(ids.where("not _stays or _n > 1"), "join-dropped")
    empty = ~F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    on = {"doc_id": "_id"}
    rest = same(docs.where(~empty), small(marked.select("_id")), on, "left_anti")
    again = marked.where("_stays")
    if not again.isEmpty():
        rows = same(docs.where(~empty), again.select("_id"), on, "left_semi")
        rest = rest.unionByName(rows.dropDuplicates(["doc_id", "text"]))
    return docs.where(empty).unionByName(rest)
