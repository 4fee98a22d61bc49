"""Exact top-k by inner product: tiles of queries times tiles of vectors.

Vectors become integers and are packed into tiles, in order of id within a tile. The tiles are dealt to lanes
of bounded size, a task holds those of a lane, and all query tiles pass by: each pair of a query
tile and a vector tile gives one matrix product and, for each query, the best k of that tile. The lists of
a lane are merged as they come, those of the lanes over a tree, ``fan_in`` at a time, so no task holds more
than that of one query tile. Tiles meet by a shuffle; nothing is broadcast or sent to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.llm.store import table

# Bytes of the tiles that a task holds, on average.
LANE_BYTES = 32 << 20

_TILE = "tile long, n int, dim int, ids binary, known binary, asks binary, data binary"
_QUERY = "q_tile long, q_n int, q_dim int, q_ids binary, q_known binary, q_place binary, q_data binary"
_LIST = "q_tile long, lane int, at binary, q_id binary, q_known binary, score binary, id binary, known binary, row binary"
_RESULT = "query_id long, rank int, vec_id long, score long"
_BLOCK = ["tile", "n", "dim", "ids", "known", "place", "data"]
_LONG = np.iinfo(np.int64)
# By bytes of a component.
_STORED = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}
_KINDS = {
    "at": np.int64, "q_id": np.int64, "q_known": bool, "score": np.int64, "id": np.int64,
    "known": bool, "row": np.int64,
}


def quantise(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and integer components of the vectors that take part."""
    places, vectors = [], []
    values = column.values.cast(pa.float64())
    starts = column.offsets.to_numpy()
    bad = np.zeros(len(values) + 1, np.int64)
    raw = values.to_numpy(zero_copy_only=False)
    np.cumsum(~np.isfinite(raw) | values.is_null().to_numpy(zero_copy_only=False), out=bad[1:])
    present = column.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(present & (bad[starts[1:]] == bad[starts[:-1]])):
        places.append(i)
        vectors.append(np.floor(raw[starts[i] : starts[i + 1]]))
    return np.array(places, np.int64), vectors


def stored(data: np.ndarray) -> bytes:
    """Components as the smallest integers that hold all of them."""
    most = np.abs(data).max(initial=0)
    kind = next((k for k in (np.int8, np.int16, np.int32) if most <= np.iinfo(k).max), np.float64)
    return data.astype(kind).tobytes()


def loaded(data: bytes, n: int, dim: int) -> np.ndarray:
    """What ``stored`` was given, as integers if it made such."""
    if not n * dim:
        return np.zeros((n, dim))
    return np.frombuffer(data, _STORED[len(data) // (n * dim)]).reshape(n, dim)


def tiles(df: DataFrame, rows: int) -> DataFrame:
    """Pack (id, v, asks) into tiles of ``rows`` rows; a null id comes last and is marked unknown."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, asks, held = 0, [], [], []
        part = TaskContext.get().partitionId()

        def tile(ids, asks, held):
            nonlocal made
            order = np.lexsort(([i or 0 for i in ids], [i is None for i in ids]))
            dim = max(len(v) for v in held)
            data = np.zeros((len(held), dim))
            for row, i in enumerate(order):
                data[row, : len(held[i])] = held[i]
            made += 1
            return pa.RecordBatch.from_pydict(
                {
                    "tile": [(part << 32) + made - 1],
                    "n": pa.array([len(ids)], pa.int32()),
                    "dim": pa.array([dim], pa.int32()),
                    "ids": [np.array([ids[i] or 0 for i in order], np.int64).tobytes()],
                    "known": [np.array([ids[i] is not None for i in order], bool).tobytes()],
                    "asks": [np.array([asks[i] for i in order], bool).tobytes()],
                    "data": [stored(data)],
                }
            )

        for batch in batches:
            places, vectors = quantise(batch.column(1))
            ids += batch.column(0).take(pa.array(places)).to_pylist()
            asks += batch.column(2).take(pa.array(places)).to_pylist()
            held += vectors
            while len(held) >= rows:
                yield tile(ids[:rows], asks[:rows], held[:rows])
                ids, asks, held = ids[rows:], asks[rows:], held[rows:]
        if held:
            yield tile(ids, asks, held)

    return table(df.mapInArrow(pack, _TILE), "tiles")


def _queries(vectors: DataFrame) -> DataFrame:
    """The query rows of each tile, with their places in it."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                place = np.flatnonzero(np.frombuffer(r["asks"], bool))
                if not len(place):
                    continue
                data = loaded(r["data"], r["n"], r["dim"])[place]
                yield pa.RecordBatch.from_pydict(
                    {
                        "q_tile": [r["tile"]],
                        "q_n": pa.array([len(place)], pa.int32()),
                        "q_dim": pa.array([r["dim"]], pa.int32()),
                        "q_ids": [np.frombuffer(r["ids"], np.int64)[place].tobytes()],
                        "q_known": [np.frombuffer(r["known"], bool)[place].tobytes()],
                        "q_place": [place.astype(np.int64).tobytes()],
                        "q_data": [data.tobytes()],
                    }
                )

    return table(vectors.mapInArrow(pick, _QUERY), "queries")


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; beyond the range of a long the nearest long."""
    dim = max(q.shape[1], v.shape[1])
    q, v = (np.pad(m.astype(np.float64), ((0, 0), (0, dim - m.shape[1]))) for m in (q, v))
    bound = dim * float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0))
    if bound < 2.0**53:
        return (q @ v.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (q, v)]
    return np.clip(whole[0] @ whole[1].T, _LONG.min, _LONG.max).astype(np.int64)


def best(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of each row; columns are in order of preference."""
    n = score.shape[1]
    if n > k:
        # Everything above the k-th score stays, and the first of those that equal it.
        limit = np.partition(score, n - k, axis=1)[:, n - k, None]
        over, equal = score > limit, score == limit
        room = k - over.sum(1)
        chosen = over | (equal & (np.cumsum(equal, axis=1) <= room[:, None]))
    else:
        chosen = np.ones(score.shape, bool)
    return np.nonzero(chosen)


def _pack(q_tile: int, lane: int, values: dict[str, np.ndarray]) -> pa.RecordBatch:
    lists = {n: [np.ascontiguousarray(values[n], k).tobytes()] for n, k in _KINDS.items()}
    return pa.RecordBatch.from_pydict(
        {"q_tile": [q_tile], "lane": pa.array([lane], pa.int32()), **lists}
    )


def _merge(lists: list[dict[str, np.ndarray]], k: int) -> dict[str, np.ndarray]:
    """The best k of each query: by score, then smaller id, unknown ids last, then place."""
    v = {n: np.concatenate([x[n] for x in lists]) for n in _KINDS}
    # ~score falls as score grows, over the whole range of a long.
    order = np.lexsort((v["row"], v["id"], ~v["known"], ~v["score"], v["at"]))
    at = v["at"][order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
    rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    keep = order[rank < k]
    return {n: x[keep] for n, x in v.items()}


def _merge_level(lists: DataFrame, k: int, fan_in: int, last: bool) -> DataFrame:
    """Merge the lists of each (q_tile, lane), at most ``fan_in`` held at a time."""

    def finish(key, held):
        v = _merge(held, k)
        if not last:
            return _pack(*key, v)
        first = np.flatnonzero(np.r_[True, v["at"][1:] != v["at"][:-1]][: len(v["at"])])
        rank = np.arange(len(v["at"])) - np.repeat(first, np.diff(np.r_[first, len(v["at"])])) + 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array(v["q_id"], pa.int64(), mask=~v["q_known"]),
                pa.array(rank, pa.int32()),
                pa.array(v["id"], pa.int64(), mask=~v["known"]),
                pa.array(v["score"], pa.int64()),
            ],
            names=["query_id", "rank", "vec_id", "score"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if key is not None and key != (r["q_tile"], r["lane"]):
                    yield finish(key, held)
                    held = []
                key = (r["q_tile"], r["lane"])
                held.append({n: np.frombuffer(r[n], kind) for n, kind in _KINDS.items()})
                if len(held) > fan_in:
                    held = [_merge(held, k)]
        if key is not None:
            yield finish(key, held)

    return (
        lists.repartition("q_tile", "lane")
        .sortWithinPartitions("q_tile", "lane")
        .mapInArrow(merge, _RESULT if last else _LIST)
    )


def search(
    df: DataFrame,
    is_query: Column,
    id_column: str,
    vector: str,
    k: int,
    scale: float = 64.0,
    tile_rows: int = 4096,
    fan_in: int = 16,
) -> DataFrame:
    """The k best of all other rows for each query row: (query_id, rank, vec_id, score).

    Components become ``floor(scale * x)``; the score is the integer inner product, shorter vectors
    being filled up with zeros. Equal scores go to the smaller id; a null id comes after all
    others. Rows whose vector is null or holds null or non-finite components take no part;
    an empty vector scores 0. Repeated rows are separate rows, and a query leaves out its own row
    only. An empty table gives no rows. Other columns are ignored. A score beyond the range
    of a long is given as the nearest long.
    """
    rows = df.select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(F.col(vector).cast("array<double>"), lambda x: F.lit(scale) * x).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # Small input partitions are put together, so that tiles are full and pairs of tiles few.
    vectors = tiles(rows.coalesce(max(1, -(-df.count() // tile_rows))), tile_rows)
    queries = _queries(vectors)
    n, size = vectors.agg(F.count("*"), F.coalesce(F.sum(F.length("data")), F.lit(0))).first()
    lanes = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // LANE_BYTES))
    lanes = max(1, min(n, lanes, 4096))
    # The query set is dealt to each lane of vector tiles: a stated set, in blocks, against all rows.
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.lit(1).alias("asked"),
        *(F.col(f"q_{c}").alias(c) for c in _BLOCK if c != "tile"), F.col("q_tile").alias("tile"),
    )
    lane = F.pmod(F.xxhash64("tile"), F.lit(lanes)).cast("int")
    held = vectors.withColumn("place", F.lit(None).cast("binary"))
    blocks = held.select(lane.alias("lane"), F.lit(0).alias("asked"), *_BLOCK).unionByName(asked)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["lane"] != lane:
                    lane, held = r["lane"], []
                ids, known = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["known"], bool)
                data = loaded(r["data"], r["n"], r["dim"])
                if not r["asked"]:
                    held.append((r["tile"], ids, known, data))
                    continue
                place = np.frombuffer(r["place"], np.int64)
                lists = []
                for tile, v_ids, v_known, v in held:
                    own = r["tile"] == tile
                    score = products(data, v)
                    at, col = best(score, k + own)
                    if own:
                        other = col != place[at]
                        at, col = at[other], col[other]
                    lists.append(
                        {
                            "at": at, "q_id": ids[at], "q_known": known[at], "score": score[at, col],
                            "id": v_ids[col], "known": v_known[col], "row": col,
                        }
                    )
                    if len(lists) > fan_in:
                        lists = [_merge(lists, k)]
                if lists:
                    yield _pack(r["tile"], lane, _merge(lists, k))

    lists = (
        blocks.repartitionById(lanes, "lane").sortWithinPartitions("lane", "asked", "tile").mapInArrow(multiply, _LIST)
    )
    while lanes > 1:
        lists = _merge_level(lists, k, fan_in, last=False)
        lists = lists.withColumn("lane", F.floor(F.col("lane") / F.lit(fan_in)).cast("int"))
        lanes = -(-lanes // fan_in)
    return _merge_level(lists, k, fan_in, last=True)
