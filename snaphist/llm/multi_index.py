"""Approximate nearest neighbours by inner product with an inverted multi-index.

Each half of a vector is quantised with a codebook of its own; a pair of codewords is a cell, and every row
is indexed in its cell. A query visits cells by the sum of its two half distances, taken from a heap, until the cells visited
hold a given share of all rows, and the rows of these cells are ranked by their exact inner products. The
share is not guessed: a bounded number of queries is answered exactly first, and the share is the
one at which the traversal would have met ``target`` of their true neighbours.

Cells are gathered in shards of about ``shard_rows`` rows; a larger cell is dealt to several. A shard's rows and the
blocks of queries that visit any of its cells meet in one task, which holds one shard and one block at a time.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.llm.store import fetch, table

# Codewords per half: about one per 4 rows' root, so that a cell holds some 16 rows, and at most so many.
ROWS_PER_CELL = 16
MAX_CODEWORDS = 1024
# Rows that the codebooks are fitted to, and queries that are answered exactly to find the share.
SAMPLE = 1 << 15
CALIBRATION = 256
_FIT_ROUNDS = 12
_SLACK = 1e-12

_ROW = "row long, id long, asks boolean, cell int, data binary"
_BLOCK = "block long, n int, rows binary, ids binary, known binary, data binary"
_MEET = "shard int, kind int, cell int, row long, id long, data binary, block long, rows binary, ids binary, known binary, at binary, cells binary"
_LIST = "block long, lane int, at binary, q_id binary, q_known binary, score binary, id binary, known binary, row binary, cell binary"
_KINDS = {
    "at": np.int64, "q_id": np.int64, "q_known": bool, "score": np.float64, "id": np.int64, "known": bool,
    "row": np.int64, "cell": np.int32,
}


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves and where each cell's rows are: ``first`` shard and number of shards."""

    dim: int
    books: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    @property
    def half(self) -> int:
        return self.dim // 2

    @property
    def words(self) -> int:
        return len(self.books[1])


def _matrix(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    """Vectors from their bytes, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dim))
    for i, raw in enumerate(column.to_pylist()):
        v = np.frombuffer(raw, kind)
        out[i, : len(v)] = v
    return out


def _distances(v: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances to all codewords; what is beyond doubles counts as very far."""
    with np.errstate(over="ignore", invalid="ignore"):
        found = (v**2).sum(1)[:, None] - 2 * (v @ book.T) + (book**2).sum(1)
    return np.nan_to_num(found, nan=1e300, posinf=1e300, neginf=-1e300)


def fit(v: np.ndarray, words: int, seed: int) -> np.ndarray:
    """A codebook of at most ``words`` codewords by k-means on the rows of a sample."""
    draw = np.random.default_rng(seed)
    if not len(v):
        return np.zeros((1, v.shape[1]))
    book = v[draw.choice(len(v), min(words, len(v)), replace=False)].copy()
    for _ in range(_FIT_ROUNDS):
        own = _distances(v, book).argmin(1)
        n = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, v)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return np.nan_to_num(book)


def _cells(v: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    half = books[0].shape[1]
    a, b = _distances(v[:, :half], books[0]).argmin(1), _distances(v[:, half:], books[1]).argmin(1)
    return (a * len(books[1]) + b).astype(np.int32)


def traverse(a: np.ndarray, b: np.ndarray, counts: np.ndarray, need: int) -> Iterator[tuple[int, int]]:
    """Non-empty cells by summed distance, each with the number of rows in the cells before it.

    ``a`` and ``b`` are the distances of the two halves to their codewords. Ends once ``need`` rows lie in
    the cells given.
    """
    by_a, by_b = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
    a, b, width, seen = a[by_a].tolist(), b[by_b].tolist(), len(by_b), 0
    # A column is entered when the one before it is, so each pair is pushed once.
    heap = [(a[0] + b[0], 0, 0)]
    while heap and seen < need:
        _, i, j = heapq.heappop(heap)
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        if j + 1 < width:
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        cell = by_a[i] * width + by_b[j]
        if counts[cell]:
            yield cell, seen
            seen += counts[cell]


def _index(rows: DataFrame, kind: str, dim: int, books, shard_rows: int) -> tuple[DataFrame, Index]:
    """Every row with its cell, written, and the index over them."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            values, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            raw = pa.array([values[s:e].tobytes() for s, e in zip(starts, starts[1:])], pa.binary())
            cells = _cells(_matrix(raw, kind, dim), books)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(cells, pa.int32()), raw],
                names=["id", "asks", "cell", "data"],
            )

    placed = rows.mapInArrow(place, "id long, asks boolean, cell int, data binary")
    placed = table(placed.select(F.monotonically_increasing_id().alias("row"), "*"), "index-rows")
    cells = len(books[0]) * len(books[1])
    counts = np.zeros(cells, np.int64)
    found = fetch(placed.groupBy("cell").agg(F.count("*").alias("n")))
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    # Cells in order fill shards; a cell of more rows than a shard has several to itself.
    first, parts = np.zeros(cells, np.int32), np.ones(cells, np.int32)
    shard, room = 0, shard_rows
    for cell in np.flatnonzero(counts):
        n = int(counts[cell])
        if n > room and room < shard_rows:
            shard, room = shard + 1, shard_rows
        first[cell] = shard
        if n > shard_rows:
            parts[cell] = -(-n // shard_rows)
            shard, room = shard + int(parts[cell]), shard_rows
        else:
            room -= n
    return placed, Index(dim, books, counts, first, parts)


def _blocks(asking: DataFrame, kind: str, dim: int, block_rows: int) -> DataFrame:
    """Query rows packed in blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                ids = part.column(1)
                yield pa.RecordBatch.from_pydict(
                    {
                        # A row's own number is as good as any for its block.
                        "block": [part.column(0)[0].as_py()],
                        "n": pa.array([part.num_rows], pa.int32()),
                        "rows": [part.column(0).to_numpy().tobytes()],
                        "ids": [ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes()],
                        "known": [ids.is_valid().to_numpy(zero_copy_only=False).tobytes()],
                        "data": [_matrix(part.column(2), kind, dim).tobytes()],
                    }
                )

    return asking.select("row", "id", "data").mapInArrow(pack, _BLOCK)


def _probes(blocks: DataFrame, index: Index, need: int | None) -> DataFrame:
    """Per block and shard: the queries, and the (place, cell) pairs to look at. All cells without ``need``."""
    dim, half = index.dim, index.half

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = index.counts.tolist()
        every = np.flatnonzero(index.counts)
        for batch in batches:
            for r in batch.to_pylist():
                q = np.frombuffer(r["data"]).reshape(r["n"], dim)
                at, cells = [], []
                a, b = _distances(q[:, :half], index.books[0]), _distances(q[:, half:], index.books[1])
                for i in range(r["n"]):
                    own = every if need is None else [c for c, _ in traverse(a[i], b[i], counts, need)]
                    at.append(np.full(len(own), i, np.int32))
                    cells.append(np.asarray(own, np.int32))
                at, cells = np.concatenate(at), np.concatenate(cells)
                # A cell in several shards is looked at in each of them.
                again = index.parts[cells]
                nth = np.arange(int(again.sum())) - np.repeat(np.cumsum(again) - again, again)
                at, cells = np.repeat(at, again), np.repeat(cells, again)
                shards = index.first[cells] + nth
                order = np.lexsort((at, cells, shards))
                at, cells, shards = at[order], cells[order], shards[order]
                edges = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1], True]) if len(shards) else [0]
                for s, e in zip(edges, edges[1:]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shards[s]], pa.int32()),
                            pa.array([1], pa.int32()),
                            pa.array([None], pa.int32()),
                            pa.array([None], pa.int64()),
                            pa.array([None], pa.int64()),
                            pa.array([r["data"]], pa.binary()),
                            pa.array([r["block"]], pa.int64()),
                            *[pa.array([r[c]], pa.binary()) for c in ("rows", "ids", "known")],
                            pa.array([at[s:e].tobytes()], pa.binary()),
                            pa.array([cells[s:e].tobytes()], pa.binary()),
                        ],
                        names=[f.split()[0] for f in _MEET.split(", ")],
                    )

    return blocks.mapInArrow(visit, _MEET)


def _sharded(placed: DataFrame, index: Index) -> DataFrame:
    """Rows with their shard; the rows of a large cell are dealt to its shards by their number."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cell = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            # Numbers of one task are consecutive: their own remainder deals them evenly.
            shard = index.first[cell] + (row % index.parts[cell]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), batch.column(2), batch.column(0), batch.column(1), batch.column(3)],
                names=["shard", "cell", "row", "id", "data"],
            )

    dealt = placed.select("row", "id", "cell", "data").mapInArrow(
        deal, "shard int, cell int, row long, id long, data binary"
    )
    empty = {c: F.lit(None).cast(t) for c, t in (f.split() for f in _MEET.split(", ")[6:])}
    return dealt.select("shard", F.lit(0).alias("kind"), "cell", "row", "id", "data").withColumns(empty)


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added from the first component to the last, in doubles."""
    out = np.zeros(len(q))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(q.shape[1]):
            out += q[:, d] * v[:, d]
    return out


def _rank(r: dict, shard: dict, k: int, lane: int) -> pa.RecordBatch | None:
    """The best ``k`` rows of a shard for each query of a block, among the cells it visits."""
    at, cells = np.frombuffer(r["at"], np.int32), np.frombuffer(r["cells"], np.int32)
    v, e_cell = shard["data"], shard["cell"]
    q = np.frombuffer(r["data"]).reshape(-1, v.shape[1])
    score, looked = np.zeros((len(q), len(v))), np.zeros((len(q), len(v)), bool)
    edges = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1], True])
    with np.errstate(over="ignore", invalid="ignore"):
        for s, e in zip(edges, edges[1:]):
            lo, hi = np.searchsorted(e_cell, (cells[s], cells[s] + 1))
            if lo < hi:
                score[at[s:e], lo:hi] = q[at[s:e]] @ v[lo:hi].T
                looked[at[s:e], lo:hi] = True
        looked &= np.frombuffer(r["rows"], np.int64)[:, None] != shard["row"]
        score = np.where(looked, np.nan_to_num(score, nan=-np.inf, posinf=np.inf, neginf=-np.inf), -np.inf)
        if len(v) > k:
            # Products of a whole cell may differ in their last digits from those added one by one.
            limit = np.partition(score, len(v) - k, axis=1)[:, len(v) - k]
            room = _SLACK * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max()
            looked &= score >= np.nan_to_num(limit - room, nan=-np.inf, posinf=np.inf, neginf=-np.inf)[:, None]
    at, row = np.nonzero(looked)
    if not len(at):
        return None
    own = {
        "at": at.astype(np.int64),
        "q_id": np.frombuffer(r["ids"], np.int64)[at],
        "q_known": np.frombuffer(r["known"], bool)[at],
        "score": exact(q[at], v[row]),
        "id": shard["id"][row],
        "known": shard["known"][row],
        "row": shard["row"][row],
        "cell": e_cell[row],
    }
    return _pack(r["block"], lane, _best([own], k))


def _best(lists: list[dict[str, np.ndarray]], k: int) -> dict[str, np.ndarray]:
    """The best k of each query: by score, then smaller id, unknown ids last."""
    v = {n: np.concatenate([x[n] for x in lists]) for n in _KINDS}
    low = np.where(np.isnan(v["score"]), np.inf, -v["score"])
    order = np.lexsort((v["row"], v["id"], ~v["known"], low, v["at"]))
    rank = _places(v["at"][order])
    keep = order[rank < k]
    return {n: x[keep] for n, x in v.items()}


def _places(at: np.ndarray) -> np.ndarray:
    """The place of each entry among those of its query; ``at`` is sorted."""
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
    return np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))


def _pack(block: int, lane: int, v: dict[str, np.ndarray]) -> pa.RecordBatch:
    lists = {n: [np.ascontiguousarray(v[n], kind).tobytes()] for n, kind in _KINDS.items()}
    return pa.RecordBatch.from_pydict({"block": [block], "lane": pa.array([lane], pa.int32()), **lists})


def _unpack(r: dict) -> dict[str, np.ndarray]:
    return {n: np.frombuffer(r[n], kind) for n, kind in _KINDS.items()}


def _meet(entries: DataFrame, probes: DataFrame, kind: str, dim: int, k: int, lanes: int) -> DataFrame:
    """Lists of each block and lane: rows of a shard come first, then the blocks that visit it."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, shard = None, [], None
        for batch in batches:
            for start, stop, number, is_probe in _stretches(batch):
                if number != current:
                    current, held, shard = number, [], None
                part = batch.slice(start, stop - start)
                if not is_probe:
                    held.append(part.select(["cell", "row", "id", "data"]))
                    continue
                if shard is None:
                    shard = _shard(held, kind, dim)
                    held = []
                for i in range(part.num_rows):
                    found = _rank(part.slice(i, 1).to_pylist()[0], shard, k, number % lanes)
                    if found is not None:
                        yield found

    both = entries.unionByName(probes).repartition("shard").sortWithinPartitions("shard", "kind", "cell")
    return both.mapInArrow(meet, _LIST)


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, bool]]:
    shard, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    edges = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]), True])
    for s, e in zip(edges, edges[1:]) if len(shard) else ():
        yield int(s), int(e), int(shard[s]), bool(kind[s])


def _shard(held: list[pa.RecordBatch], kind: str, dim: int) -> dict[str, np.ndarray]:
    rows = pa.Table.from_batches(held).combine_chunks()
    ids = rows.column("id").combine_chunks()
    return {
        "cell": rows.column("cell").to_numpy(),
        "row": rows.column("row").to_numpy(),
        "id": ids.fill_null(0).to_numpy(zero_copy_only=False),
        "known": ids.is_valid().to_numpy(zero_copy_only=False),
        "data": _matrix(rows.column("data").combine_chunks(), kind, dim),
    }


def _merged(lists: DataFrame, keys: list[str], k: int, finish, schema: str) -> DataFrame:
    """Merge the lists of each key, a few held at a time."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                own = tuple(r[c] for c in keys)
                if key is not None and key != own:
                    yield finish(key, _best(held, k))
                    held = []
                key = own
                held.append(_unpack(r))
                if len(held) >= 16:
                    held = [_best(held, k)]
        if key is not None:
            yield finish(key, _best(held, k))

    return lists.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merge, schema)


def _answers(entries, blocks, index: Index, need, kind: str, k: int) -> DataFrame:
    """One merged list per block, over two levels, so that no task merges the lists of all shards."""
    shards = int((index.first + index.parts).max(initial=1))
    lanes = max(1, math.isqrt(shards))
    lists = _meet(entries, _probes(blocks, index, need), kind, index.dim, k, lanes)
    return _merged(lists, ["block", "lane"], k, lambda key, v: _pack(key[0], 0, v), _LIST)


def _share(entries, asking, index: Index, n: int, kind: str, k: int, target: float) -> float:
    """The share of all rows to visit so that ``target`` of the true neighbours of some queries are met."""
    # Any bounded choice does; a hash deals it over all queries.
    asks = asking.count()
    if not asks:
        return 0.0
    cut = int(min(1.0, 1.5 * CALIBRATION / asks) * 2**32)
    drawn = asking.where(F.shiftrightunsigned(F.xxhash64("row", F.lit(1)), 32) < cut).limit(CALIBRATION)
    blocks = table(_blocks(drawn.coalesce(1), kind, index.dim, CALIBRATION), "index-calibration")
    found = _merged(
        _answers(entries, blocks, index, None, kind, k), ["block"], k, lambda key, v: _pack(key[0], 0, v), _LIST
    )
    queries = {r["block"]: r for r in blocks.collect()}
    counts, half, before = index.counts.tolist(), index.half, []
    for r in found.collect():
        v = _unpack(r.asDict())
        q = np.frombuffer(queries[r["block"]]["data"]).reshape(-1, index.dim)
        a, b = _distances(q[:, :half], index.books[0]), _distances(q[:, half:], index.books[1])
        for i in np.unique(v["at"]):
            want = set(v["cell"][v["at"] == i].tolist())
            seen = {}
            for cell, rows in traverse(a[i], b[i], counts, n):
                if cell in want:
                    seen[cell] = rows
                    if len(seen) == len(want):
                        break
            before += [seen[c] + 1 for c in v["cell"][v["at"] == i].tolist()]
    before.sort()
    return before[max(0, math.ceil(target * len(before)) - 1)] / n if before else 0.0


def search(
    df: DataFrame,
    is_query: Column,
    id_column: str,
    vector: str,
    k: int = 20,
    target: float = 0.96,
    shard_rows: int = 2048,
    block_rows: int = 256,
    seed: int = 1,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query row, by inner product.

    Every row is indexed and is a candidate, but for the query's own row. The codebooks are fitted to about 32768 rows chosen by
    hash; the share of rows that a query visits is measured on at most 256 queries, so that ``target`` of their
    true neighbours would be met, and is at least what ``k`` results need: each query gets ``k`` rows,
    or all if there are fewer. Scores are inner products of the vectors as given, in doubles, added from the first
    component on; equal scores go to the smaller id, null ids and products that are no number come last.

    Vectors that are null, empty or zero, or hold null, infinite or NaN components, take no part; shorter
    vectors are filled up with zeros. Repeated rows are separate rows. An empty table, or one without queries,
    gives no rows. Other columns are ignored, whatever their names.
    """
    floats = df.schema[vector].dataType.simpleString() == "array<float>"
    kind, held = ("<f4", "array<float>") if floats else ("<f8", "array<double>")
    rows = df.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector).cast(held).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(usable(F.col("v")))
    n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    dim, half = dim or 1, (dim or 1) // 2
    words = max(1, min(MAX_CODEWORDS, round(math.sqrt(n / ROWS_PER_CELL))))
    cut = int(min(1.0, SAMPLE / max(1, n)) * 2**32)
    some = rows.where(F.shiftrightunsigned(F.xxhash64("id", "v", F.lit(seed)), 32) < cut).limit(2 * SAMPLE)
    sample = np.zeros((0, dim))
    if n:
        given = fetch(some.select("v")).column("v").to_pylist()
        sample = np.array([x + [0.0] * (dim - len(x)) for x in sorted(given)], float).reshape(-1, dim)
    books = fit(sample[:, :half], words, seed), fit(sample[:, half:], words, seed + 1)
    placed, index = _index(rows, kind, dim, books, shard_rows)
    asking = placed.where("asks")
    # Dealt to shards and sorted once per use; the calibration and the search read the same written rows.
    entries = _sharded(placed, index)
    share = _share(entries, asking, index, n, kind, k, target) if n else 0.0
    need = max(k + 1, math.ceil(share * n))
    answers = _answers(entries, _blocks(asking, kind, dim, block_rows), index, need, kind, k)

    def finish(key, v):
        rank = _places(v["at"]) + 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array(v["q_id"], pa.int64(), mask=~v["q_known"]),
                pa.array(rank, pa.int32()),
                pa.array(v["id"], pa.int64(), mask=~v["known"]),
                pa.array(v["score"], pa.float64()),
            ],
            names=["query_id", "rank", "vec_id", "score"],
        )

    return _merged(answers, ["block"], k, finish, "query_id long, rank int, vec_id long, score double")
