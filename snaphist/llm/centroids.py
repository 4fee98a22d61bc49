"""Centroid clustering in integers, filtered by PCA-rotated coordinates.

Vectors become integers and are kept in tiles together with their leading coordinates in the rotation that
puts most variance first, and the norm of the rest. The squared distance of the leading coordinates plus
the squared difference of the norms is at most the squared distance, so a centroid whose bound is above the distance
to another needs no exact look. What survives is compared in integers: the rotation decides about the
work only, never about the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.llm.store import fetch, table

_TILE = "n int, ids binary, known binary, kind string, data binary, lead binary, rest binary"
_SUM = "cluster int, n long, sums array<decimal(38,0)>"
_MOMENTS = "n double, sums binary, products binary"
_RESULT = "vec_id long, cluster int, distance long"

# Components further out count as this far out, so that a component always fits a long.
MOST = 1 << 62
# Squared distances of smaller components fit a long; larger ones are compared as Python integers.
_EXACT = 1 << 27
_LONG = np.iinfo(np.int64)
# The bound is computed in doubles; it counts as lower by this share of the squared norms.
_SLACK = 1e-9


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has exactly ``dim`` components, none null, infinite or NaN."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dim) & finite, F.lit(False))


def quantise(raw: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * raw), -float(MOST), float(MOST)).astype(np.int64)


def _matrix(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    return quantise(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), scale)


def _smallest(data: np.ndarray) -> np.ndarray:
    for kind in (np.int8, np.int16, np.int32):
        room = np.iinfo(kind)
        if len(data) == 0 or (data.min() >= room.min and data.max() <= room.max):
            return data.astype(kind)
    return data


def rotation(rows: DataFrame, dim: int, scale: float) -> np.ndarray:
    """Principal axes of all vectors, by falling variance, as columns.

    Each task sums up its products, and two steps add these up, so the driver sees at most 64 matrices.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0.0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            v = _matrix(batch.column(1), dim, scale).astype(float)
            n, sums, products = n + len(v), sums + v.sum(0), products + v.T @ v
        if n:
            yield _moments(n, sums, products)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0.0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            for a, b, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n, sums = n + a, sums + np.frombuffer(b)
                products = products + np.frombuffer(c).reshape(dim, dim)
        if n:
            yield _moments(n, sums, products)

    parts = rows.mapInArrow(moments, _MOMENTS)
    found = fetch(parts.repartition(64).mapInArrow(add, _MOMENTS)).to_pylist()
    n = sum(r["n"] for r in found)
    if not n:
        return np.eye(dim)
    mean = sum(np.frombuffer(r["sums"]) for r in found) / n
    products = sum(np.frombuffer(r["products"]).reshape(dim, dim) for r in found) / n
    return np.linalg.eigh(products - np.outer(mean, mean))[1][:, ::-1].copy()


def _moments(n: float, sums: np.ndarray, products: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"n": [n], "sums": [sums.tobytes()], "products": [products.tobytes()]})


def _tiles(rows: DataFrame, dim: int, scale: float, axes: np.ndarray, leading: int, tile_rows: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, tile_rows):
                part = batch.slice(start, tile_rows)
                v = _matrix(part.column(1), dim, scale)
                turned, data = v.astype(float) @ axes, _smallest(v)
                ids = part.column(0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "n": pa.array([len(v)], pa.int32()),
                        "ids": [ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes()],
                        "known": [ids.is_valid().to_numpy(zero_copy_only=False).tobytes()],
                        "kind": [data.dtype.str],
                        "data": [data.tobytes()],
                        "lead": [np.ascontiguousarray(turned[:, :leading]).tobytes()],
                        "rest": [np.linalg.norm(turned[:, leading:], axis=1).tobytes()],
                    }
                )

    return table(rows.mapInArrow(pack, _TILE), "centroid-tiles")


def nearest(
    v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, axes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, exact squared distance) of each vector; the smaller number on a tie."""
    leading = lead.shape[1]
    turned = centroids.astype(float) @ axes
    c_lead, c_rest = turned[:, :leading], np.linalg.norm(turned[:, leading:], axis=1)
    far = max(int(abs(v).max(initial=0)), int(abs(centroids).max(initial=0))) >= _EXACT
    if far:
        # The squares may be beyond doubles' exact range by far: every centroid is compared, as integers.
        whole = v.astype(object)
        every = np.stack([((whole - c) ** 2).sum(1) for c in centroids.astype(object)], axis=1)
        best = every.argmin(1)
        return best, every[np.arange(len(v)), best]
    norms = (lead**2).sum(1) + rest**2
    c_norms = (c_lead**2).sum(1) + c_rest**2
    bound = norms[:, None] + c_norms - 2 * (lead @ c_lead.T) - 2 * rest[:, None] * c_rest
    bound -= _SLACK * (norms[:, None] + c_norms) + _SLACK
    best = bound.argmin(1)
    wide = v.astype(np.int64)
    distance = ((wide - centroids[best]) ** 2).sum(1)
    first = best.copy()
    for j, c in enumerate(centroids):
        # Distances fall as centroids are looked at, and with them the number of survivors.
        left = np.flatnonzero((bound[:, j] <= distance) & (first != j))
        exact = ((wide[left] - c) ** 2).sum(1)
        closer = (exact < distance[left]) | ((exact == distance[left]) & (j < best[left]))
        best[left[closer]], distance[left[closer]] = j, exact[closer]
    return best, distance


def _read(r: dict, dim: int, leading: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = np.frombuffer(r["data"], r["kind"]).reshape(-1, dim)
    return v, np.frombuffer(r["lead"]).reshape(len(v), leading), np.frombuffer(r["rest"])


def _replaced(tiles: DataFrame, centroids: np.ndarray, axes: np.ndarray, leading: int) -> np.ndarray:
    """One round: every centroid becomes the floored mean of its vectors; one without any stays."""
    k, dim = centroids.shape

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), object)
        for batch in batches:
            for r in batch.to_pylist():
                v, lead, rest = _read(r, dim, leading)
                cluster, _ = nearest(v, lead, rest, centroids, axes)
                wide = v.astype(object if v.dtype == np.int64 else np.int64)
                for j in np.unique(cluster):
                    own = wide[cluster == j]
                    n[j] += len(own)
                    sums[j] += own.sum(0).astype(object)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found, pa.int32()),
                pa.array(n[found], pa.int64()),
                pa.array(
                    [[Decimal(int(x)) for x in sums[j]] for j in found], pa.list_(pa.decimal128(38, 0))
                ),
            ],
            names=["cluster", "n", "sums"],
        )

    parts = tiles.select("data", "kind", "lead", "rest").mapInArrow(total, _SUM)
    summed = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(dim)]
    new = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *summed).collect():
        new[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dim)]
    return new


def cluster(
    df: DataFrame,
    id_column: str,
    vector: str,
    k: int = 16,
    rounds: int = 3,
    dim: int = 64,
    scale: float = 64.0,
    seed: int = 1,
    leading: int = 16,
    tile_rows: int = 4096,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that takes part.

    Vectors with exactly ``dim`` components, none null, infinite or NaN, take part; a component x counts as
    the integer floor(scale * x), beyond +-2^62 as that. The first centroids are the ``k`` vectors of
    smallest sha256 of ``seed:id``, fewer if there are fewer; of rows with one id the smaller
    vector goes first, null ids come last. Each round assigns every vector to the nearest centroid, the smaller
    number on a tie, and replaces every centroid that has vectors by their floored mean; the result is one more
    assignment. Equal vectors are equal rows, repeated rows are separate rows, and a null id stays null.
    Distances and their sums beyond the range of a long are given as the largest long. A table without
    usable vectors gives no rows. Other columns are ignored, whatever their names.

    Passes over the data: two over ``df`` for the axes and the tiles, one over the tiles per round, one for the result. What
    reaches the driver and all tasks is k centroids and dim^2 numbers.
    """
    rows = df.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")
    ).where(usable(F.col("v"), dim))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    raw = np.array([r["v"] for r in first], float).reshape(-1, dim)
    centroids, leading = quantise(raw, scale), min(leading, dim)
    axes = rotation(rows, dim, scale)
    tiles = _tiles(rows, dim, scale, axes, leading, tile_rows)
    for _ in range(rounds if len(first) else 0):
        centroids = _replaced(tiles, centroids, axes, leading)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                best, distance = nearest(*_read(r, dim, leading), centroids, axes)
                if distance.dtype == object:
                    distance = np.array([min(d, _LONG.max) for d in distance], np.int64)
                ids, known = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["known"], bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=~known), pa.array(best, pa.int32()), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

    assigned = table(tiles.mapInArrow(assign, _RESULT), "centroid-result")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    parts = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    # One row per centroid.
    sums = {r["cluster"]: int(r["sum"]) for r in parts.collect()}
    total = min(sum(sums.values()), _LONG.max)
    known = df.sparkSession.createDataFrame(
        [(j, min(n, _LONG.max), total, digests[j]) for j, n in sums.items()],
        "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(known), F.col("cluster") == F.col("_cluster")).drop("_cluster")
