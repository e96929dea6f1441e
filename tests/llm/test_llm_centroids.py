"""Centroid clustering against plain distances, on ties, repeated rows and vectors that are left out."""

import hashlib
import math

import numpy as np
import pytest

from opsframe.llm.centroids import Lists, centroid_clusters

SCHEMA = "vec_id long, embedding array<float>, cluster int, v string"


def plain(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    at = [v for _, v in start[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for n in range(len(at)):
            mine = [v for (_, v), (_, c) in zip(kept, near) if c == n]
            if mine:
                at[n] = [sum(x) // len(mine) for x in zip(*mine)]
    near = assign()
    out = []
    for (i, _), (d, c) in zip(kept, near):
        out.append((i, c, d, sum(x for x, y in near if y == c), sum(x for x, _ in near), at[c]))
    return sorted(out, key=str)


@pytest.mark.parametrize("k,dims,spread", [(1, 3, 1.0), (7, 3, 0.02), (12, 5, 1.0), (40, 5, 1e-3)])
def test_against_plain_version(spark, k, dims, spread):
    made = np.random.default_rng(k)
    rows = [(i, [float(x) for x in made.normal(0, spread, dims)]) for i in range(150)]
    rows += rows[:5] + [(3, [0.0] * dims), (None, [0.5] * dims), (900, [0.0] * dims), (901, [0.0] * dims)]
    rows += [(910, None), (911, []), (912, [1.0] * (dims - 1)), (913, [None] + [1.0] * (dims - 1)), (914, [math.nan] * dims), (915, [math.inf] * dims)]
    found = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA).repartition(5)
    got = centroid_clusters(found, k=k, rounds=3, dims=dims)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, k, 3, dims)


def test_walk_finds_the_nearest_and_stops_early():
    made = np.random.default_rng(5)
    vectors, centroids = made.integers(-50, 50, (3000, 4)), made.integers(-50, 50, (200, 4))
    lists = Lists(centroids.tolist())
    chosen, best = lists.nearest(vectors)
    exact = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (best == exact.min(axis=1)).all() and (chosen == exact.argmin(axis=1)).all()
    assert [len(x) for x in lists.nearest(vectors[:0])] == [0, 0]


def test_no_rows_and_large_components(spark):
    assert centroid_clusters(spark.createDataFrame([], SCHEMA), dims=2).count() == 0
    alone = centroid_clusters(spark.createDataFrame([(None, [1.0, 2.0], 1, "")], SCHEMA), dims=2)
    assert alone.count() == 0
    with pytest.raises(Exception, match="too large"):
        centroid_clusters(spark.createDataFrame([(1, [1e30, 2.0], 1, "")], SCHEMA), dims=2).collect()
