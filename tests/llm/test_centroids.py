from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from inkwell.llm import queries as Q
from inkwell.llm.centroids import centroid_clusters, integer_vectors, nearest, sort_means

SCHEMA = "vec_id bigint, embedding array<float>"
COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def plain(rows, k=8, rounds=10, dims=64):
    """The contract word for word, every distance worked out in Python integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]
    distance = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    assign = lambda: [min((distance(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    of = [sum(d for d, c in near if c == j) for j in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, of[c], sum(of), sha[c]) for (i, _), (d, c) in zip(kept, near)), key=str)


def vectors(n, dims=64, seed=1, grid=None):
    rng = random.Random(seed)
    middle = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    out = []
    for i in range(n):
        v = [float(np.float32(x + rng.gauss(0, 0.4))) for x in rng.choice(middle)]
        out.append((i * 3, [round(x * grid) / grid for x in v] if grid else v))
    return out


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_rounds_are_exact(spark):
    rows = vectors(200)
    assert found(centroid_clusters(spark.createDataFrame(rows, SCHEMA).repartition(4))) == plain(rows)


def test_ties_and_empty_centroids(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]), rng.choice([0.0, 1.0])]) for i in range(60)] + [(7, [0.0, 1.0])] * 5
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(centroid_clusters(docs, dims=2)) == plain(rows, dims=2)
    same = [(i, [0.5, 0.5]) for i in range(20)]
    assert found(centroid_clusters(spark.createDataFrame(same, SCHEMA), dims=2)) == plain(same, dims=2)


def test_odd_tables(spark):
    big, nan, inf = 1 << 60, float("nan"), float("inf")
    good = vectors(6)
    rows = [(i, v) for i, (_, v) in zip((big + 1, None, big + 3, big + 3, None, 2), good)]
    rows += [(10, None), (11, []), (12, good[0][1][:63]), (13, good[0][1] + [1.0]), (14, [None] + good[0][1][1:]), (15, [nan] + good[0][1][1:]), (16, [-inf] + good[0][1][1:])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", cluster string, v int")
    assert found(centroid_clusters(docs)) == plain(rows)
    assert centroid_clusters(docs.limit(0)).count() == 0
    assert found(centroid_clusters(docs.filter("vec_id = 2"))) == plain(rows[5:6])
    with pytest.raises(Exception, match="squared distances"):
        centroid_clusters(spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)).collect()


def test_scan_stops_early_and_finds_the_nearest():
    rng = np.random.default_rng(3)
    middle = rng.integers(-5000, 5000, (12, 16))
    v = middle[rng.integers(0, 12, 3000)] + rng.integers(-300, 300, (3000, 16))
    start = rng.integers(0, 12, 3000)
    every = ((v[:, None, :] - middle[None, :, :]) ** 2).sum(axis=2)
    for before, most in ((start, 36_000), (every.argmin(axis=1), 3500)):
        at, distance, tried = nearest(v, before, middle)
        assert (at == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all() and tried <= most


def test_centroids_come_back(spark):
    rows, centroids = sort_means(integer_vectors(spark.createDataFrame(vectors(50), SCHEMA)), k=3, rounds=2)
    assert centroids.shape == (3, 64) and rows.columns == ["vec_id", "v", "cluster", "distance"] and rows.count() == 50


def test_query_is_registered():
    assert Q.QUERIES.keys() >= {"op11_token_alignment", "op12_sharding", "op13_centroid_clusters"}
