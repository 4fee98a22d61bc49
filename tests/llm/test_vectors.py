"""Centroid clustering, importance resampling and the multi-index against brute force, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snaphist.llm import catalog, centroids, importance, multi_index
from tests.conftest import SF_DIR
from tests.llm import brute, odd

CLASHING = "n long, row string, cell int, cluster string, score string, asks int, block long, key long, kind string"


def vectors(spark, rows):
    """Rows (vec_id, embedding) with extra columns named like those that operators use."""
    return spark.createDataFrame(
        [(i, v, 1, "x", 2, None, "s", 0, None, 7, "k") for i, v in rows], f"vec_id long, embedding array<double>, {CLASHING}"
    )


def some_vectors(n=90, dim=64, seed=2, spread=1.0):
    draw = random.Random(seed)
    base = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = [(i, [x + draw.gauss(0, spread) for x in base[i % 4]]) for i in range(n)]
    rows += [(n + i, list(rows[0][1])) for i in range(12)]  # equal vectors
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, [0.5] * dim)]  # repeated rows, null ids
    bad = [None, [], [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [math.nan] * dim, [math.inf] * dim]
    return rows + [(1000 + i, v) for i, v in enumerate(bad)]


def clusters(rows, k=16, rounds=3, dim=64, scale=64.0, most=centroids.MOST):
    """The clustering in plain integers."""
    kept = [
        (i, [max(-most, min(most, math.floor(max(-1e200, min(1e200, scale * x))))) for x in v], v)
        for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted(
        kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2])
    )
    c = [list(v) for _, v, _ in named[:k]]
    far = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w))
    for step in range(rounds + 1):
        own = [min((far(v, w), j) for j, w in enumerate(c)) for _, v, _ in kept]
        for j in range(len(c)) if step < rounds else ():
            mine = [v for (_, v, _), (_, at) in zip(kept, own) if at == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    top = 2**63 - 1
    each = Counter()
    for d, j in own:
        each[j] += min(d, top)
    digest = [hashlib.sha256(",".join(map(str, w)).encode()).hexdigest() for w in c]
    total = min(top, sum(each.values()))
    return Counter(
        (i, j, min(d, top), min(top, each[j]), total, digest[j]) for (i, _, _), (d, j) in zip(kept, own)
    )


CLUSTERED = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("size", ["ordinary", "few", "large", "beyond"])
def test_clusters(spark, size):
    rows = some_vectors()
    if size == "few":
        rows = rows[:7] + rows[-6:]
    if size in ("large", "beyond"):
        rows = [(i, v and [x and x * (1e9 if size == "large" else 1e40) for x in v]) for i, v in rows]
    got = centroids.cluster(vectors(spark, rows).repartition(3), "vec_id", "embedding", tile_rows=16)
    assert got.columns == CLUSTERED
    assert Counter(tuple(r) for r in got.collect()) == clusters(rows)


def test_clusters_without_vectors(spark):
    empty = vectors(spark, some_vectors()).limit(0)
    assert centroids.cluster(empty, "vec_id", "embedding").count() == 0
    unusable = vectors(spark, some_vectors()[-6:])
    assert centroids.cluster(unusable, "vec_id", "embedding").columns == CLUSTERED
    assert centroids.cluster(unusable, "vec_id", "embedding").count() == 0


def test_bound_is_below_the_distance_and_filters():
    """The filter never changes the answer, and on vectors of few directions it spares most comparisons."""
    draw = np.random.default_rng(3)
    v = (draw.normal(size=(500, 3)) @ draw.normal(size=(3, 64)) * 40).astype(np.int64)
    c = v[:16]
    axes = np.linalg.eigh(np.cov(v.T))[1][:, ::-1]
    turned = v @ axes
    lead, rest = np.ascontiguousarray(turned[:, :16]), np.linalg.norm(turned[:, 16:], axis=1)
    got = centroids.nearest(v, lead, rest, c, axes)
    every = ((v[:, None] - c) ** 2).sum(2)
    assert (got[0] == every.argmin(1)).all() and (got[1] == every.min(1)).all()
    bound = ((lead[:, None] - (c @ axes)[:, :16]) ** 2).sum(2) + (rest[:, None] - np.linalg.norm((c @ axes)[:, 16:], axis=1)) ** 2
    assert (bound <= every * (1 + 1e-9) + 1).all()
    assert (bound > every.min(1)[:, None] + 1).mean() > 0.9


def resampled(docs, target, longest=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(t))

    def features(t):
        w = words(t)
        runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
    out = []
    for d, text in docs:
        f = features(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        name = f"{seed}:{'' if d is None else d}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(f), weight, score, None, len(words(text)) >= min_words])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = place
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("longest, buckets, percent, least", [(1, 10_000, 10, 20), (3, 70_000, 50, 1), (2, 50, 100, 0)])
def test_resampling(spark, longest, buckets, percent, least):
    docs = odd.TEXTS + [(200 + i, " ".join(random.Random(i).choices("aa bb cc dd é ee 1f".split(), k=i))) for i in range(40)]
    docs += [(300, "aa-bb cc"), (301, "AA bb CC\x00dd"), (210, "aa bb")]
    target = ["aa bb cc aa", None, "", "é 1f"]
    frame = spark.createDataFrame([(t, "x", 1) for t in target], "text string, weight string, n_words int")
    got = importance.resample(odd.documents(spark, docs), frame, longest, buckets, percent, least)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == resampled(docs, target, longest, buckets, percent, least)


def test_resampling_without_rows(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    assert importance.resample(odd.empty(spark), target).count() == 0
    rows = importance.resample(odd.documents(spark), target.limit(0)).collect()
    assert Counter(tuple(r) for r in rows) == resampled(odd.TEXTS, [])


def neighbours(rows, k):
    """Counter of (query_id, rank, vec_id, score) by full comparison."""
    usable = [
        (i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = Counter()
    for a, (i, q) in enumerate(usable):
        if i is None or i % 20:
            continue
        scored = []
        for b, (j, v) in enumerate(usable):
            if a != b:
                total = 0.0
                for x, y in zip(q, v):
                    total += x * y
                scored.append((-total, j is None, j or 0))
        for rank, (low, unknown, j) in enumerate(sorted(scored)[:k], 1):
            out[i, rank, None if unknown else j, -low] += 1
    return out


@pytest.mark.parametrize("k, shard_rows, block_rows", [(5, 8, 3), (20, 8192, 256), (500, 16, 2)])
def test_neighbours(spark, k, shard_rows, block_rows):
    """With every query calibrated and all true neighbours asked for, the answer is exact."""
    rows = some_vectors() + [(40, [0.0] * 64), (60, [1.0, -2.0]), (2000, [1e3] * 64), (2001, [3.0])]
    got = multi_index.search(
        vectors(spark, rows).repartition(5), F.col("vec_id") % 20 == 0, "vec_id", "embedding", k, 1.0, shard_rows, block_rows
    )
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == neighbours(rows, k)


def test_neighbours_hot_vector(spark):
    """A third of all rows in one cell, and equal: dealt to several shards, ties to smaller ids."""
    rows = some_vectors(150, 8) + [(5000 + i, [2.0] * 8) for i in range(120)]
    got = multi_index.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, "vec_id", "embedding", 7, 1.0, 16, 4)
    assert Counter(tuple(r) for r in got.collect()) == neighbours(rows, 7)


def test_neighbours_of_nothing(spark):
    frame = vectors(spark, some_vectors())
    ask = F.col("vec_id") % 20 == 0
    assert multi_index.search(frame.limit(0), ask, "vec_id", "embedding").count() == 0
    assert multi_index.search(frame, F.lit(None).cast("boolean"), "vec_id", "embedding").count() == 0
    one = frame.where("vec_id = 20")
    assert multi_index.search(one, ask, "vec_id", "embedding").count() == 0


def test_traversal_is_by_summed_distance():
    draw = np.random.default_rng(5)
    a, b = draw.random(9), draw.random(7)
    counts = draw.integers(0, 3, 63)
    found = list(multi_index.traverse(a, b, counts.tolist(), int(counts.sum())))
    sums = (a[:, None] + b).ravel()
    want = [c for c in np.argsort(sums, kind="stable") if counts[c]]
    assert [c for c, _ in found] == want
    assert [n for _, n in found] == (np.cumsum(counts[want]) - counts[want]).tolist()
    short = list(multi_index.traverse(a, b, counts.tolist(), 10))
    assert [c for c, _ in short] == want[: len(short)]
    assert sum(counts[c] for c, _ in short) >= 10 > sum(counts[c] for c, _ in short[:-1])


def test_recall_of_the_query(spark):
    rows = catalog.op13_multi_index(spark, SF_DIR).collect()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in table])
    v = np.array([r.embedding for r in table], float)
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = v @ v[q]
        score[q] = -9
        own = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == ids[q])
        assert [r for r, _, _ in own] == list(range(1, 21))
        hits += len({x for _, x, _ in own} & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()
