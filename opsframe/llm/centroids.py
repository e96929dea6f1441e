"""Centroid clustering whose nearest centroids are found by the threshold algorithm.

Each dimension keeps the centroids sorted by their value.  A vector enters every list at its own value and walks outward,
one centroid a step; a centroid met for the first time gets its exact distance.  What no list has shown yet is at least
as far as the frontiers of all lists together, so the walk ends when their squared distances sum to strictly more than
the best exact distance: an unseen centroid can then neither be nearer nor tie.

Vectors are whole numbers, so distances, sums and means are exact and no order of tasks changes them.  The centroids
are a table of ``k`` rows: they travel with the tasks, and each round brings back one row per centroid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.storage import cut_lineage

#: Larger components could make a squared distance of 64 of them pass 64 bits.
MOST = 1 << 27
#: Vectors that walk together.
WALKERS = 1024


def whole_vectors(rows: DataFrame, dims: int, scale: int, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v``: the vectors of exactly ``dims`` components, none null or not finite, as floor(scale * x)."""
    x = F.col(vector)
    usual = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    kept = rows.select(F.col(vec_id).alias("vec_id"), x.cast("array<double>").alias("x"))
    kept = kept.filter((F.size("x") == dims) & F.forall("x", usual))
    small = lambda c: F.when(F.abs(c) < MOST / scale, F.floor(c * scale)).otherwise(
        F.raise_error(F.concat(F.lit("a component is too large for exact distances: "), c.cast("string"))).cast("long")
    )
    return kept.select("vec_id", F.transform("x", small).cast("array<int>").alias("v"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().reshape(-1, dims).astype(np.int64)


class Lists:
    """The centroids, and for each dimension their numbers in the order of their values."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, np.int64)
        self.order = np.argsort(self.centroids, axis=0, kind="stable").T
        self.values = np.take_along_axis(self.centroids.T, self.order, axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid, of equally near ones the smallest number."""
        parts = [self._walk(vectors[at : at + WALKERS]) for at in range(0, len(vectors), WALKERS)]
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (empty, empty)

    def _walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count, dims = vectors.shape
        k, every = len(self.centroids), np.arange(dims)
        right = np.stack([np.searchsorted(self.values[d], vectors[:, d]) for d in range(dims)], axis=1)
        left = right - 1
        seen = np.zeros((count, k), bool)
        best, chosen = np.full(count, np.iinfo(np.int64).max), np.full(count, k)
        going = np.arange(count)
        for _ in range(k):
            x, low, high = vectors[going], left[going], right[going]
            # A list that has ended on one side goes on at the other; after k steps all have ended.
            below = np.where(low >= 0, x - self.values[every, np.maximum(low, 0)], MOST * 4)
            above = np.where(high < k, self.values[every, np.minimum(high, k - 1)] - x, MOST * 4)
            down = below <= above
            met = np.where(down, self.order[every, np.maximum(low, 0)], self.order[every, np.minimum(high, k - 1)])
            left[going], right[going] = low - down, high + ~down
            new = np.zeros((len(going), k), bool)
            new[np.arange(len(going))[:, None], met] = True
            new &= ~seen[going]
            seen[going] |= new
            at, number = np.nonzero(new)
            exact = np.full((len(going), k), np.iinfo(np.int64).max)
            exact[at, number] = ((x[at] - self.centroids[number]) ** 2).sum(axis=1)
            nearest = exact.argmin(axis=1)  # the first of equal ones
            distance = exact[np.arange(len(going)), nearest]
            better = (distance < best[going]) | ((distance == best[going]) & (nearest < chosen[going]))
            best[going] = np.where(better, distance, best[going])
            chosen[going] = np.where(better, nearest, chosen[going])
            frontier = (np.minimum(below, above) ** 2).sum(axis=1)
            going = going[(frontier <= best[going]) & ~seen[going].all(axis=1)]
            if not len(going):
                break
        return chosen, best


def _moved(vectors: DataFrame, lists: Lists, dims: int) -> list[list[int]]:
    """The centroids after one round: the means, rounded down, of the vectors nearest to them."""

    def assign(batches) -> Iterator[pa.RecordBatch]:
        k = len(lists.centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            rows = _matrix(batch, dims)
            chosen, _ = lists.nearest(rows)
            counts += np.bincount(chosen, minlength=k)
            order = np.argsort(chosen, kind="stable")
            firsts = np.flatnonzero(np.diff(chosen[order], prepend=-1))
            if len(firsts):
                sums[chosen[order][firsts]] += np.add.reduceat(rows[order], firsts, axis=0)
        some = np.flatnonzero(counts)
        held = pa.array(sums[some].tolist(), pa.list_(pa.int64()))
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(counts[some]), held], names=["cluster", "n", "sums"])

    found = vectors.select("v").mapInArrow(assign, "cluster int, n bigint, sums array<bigint>")
    totals = [F.sum(F.get("sums", F.lit(d))).alias(f"s{d}") for d in range(dims)]
    moved = [list(map(int, c)) for c in lists.centroids]
    for row in found.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():  # one row for each centroid
        moved[row["cluster"]] = [row[f"s{d}"] // row["n"] for d in range(dims)]
    return moved


def centroid_clusters(
    rows: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    seed: int = 2,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector that is kept.

    Kept are vectors of exactly ``dims`` components without null, NaN or infinity; each component becomes the whole
    number floor(scale * x).  The first centroids are the vectors whose ids, as ``<seed>:<id>``, have the smallest
    SHA-256; each of ``rounds`` rounds moves them to the means, rounded down, of what is nearest, and a last
    assignment follows.  A centroid that nothing is nearest to stays.  Distances are squared; ties go to the smaller
    number.

    Rows that repeat an id are vectors of their own; among equal ids the smaller vector comes first.  A null id starts
    no centroid but its vector is assigned.  With fewer than ``k`` vectors with ids there are fewer centroids, and with
    none, or without rows, no row.  Components of 2**27 / scale and more raise an error, as distances would not be
    exact.  Other columns are left out, whatever their names.
    """
    vectors = cut_lineage(whole_vectors(rows, dims, scale, vec_id, vector), "vectors")
    named = vectors.filter("vec_id is not null")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    centroids = [list(r["v"]) for r in named.orderBy(place, "v").limit(k).collect()]  # k rows
    schema = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {schema}, cluster int, distance bigint"
    if not centroids:
        nothing = vectors.limit(0).selectExpr("vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia")
        return nothing.withColumn("centroid", F.array().cast("array<bigint>"))
    for _ in range(rounds):
        centroids = _moved(vectors, Lists(centroids), dims)
    lists = Lists(centroids)

    def assign(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, distance = lists.nearest(_matrix(batch, dims))
            yield pa.record_batch([batch.column("vec_id"), pa.array(chosen, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = cut_lineage(vectors.mapInArrow(assign, schema), "assigned")
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows

    def of_cluster(values: list, kind: str) -> Column:
        return F.get(F.from_json(F.lit(str(values)), f"array<{kind}>"), F.col("cluster"))

    return assigned.select(
        "*",
        of_cluster([inertia.get(c, 0) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(centroids, "array<bigint>").alias("centroid"),
    )


def centroid_digest(centroid: Column) -> Column:
    """SHA-256 of a centroid's components, as decimal numbers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda c: c.cast("string")), ","), 256)
