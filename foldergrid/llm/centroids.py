"""Centroid clustering of whole-number vectors by a bisector tournament.

Whether a vector is nearer to centroid i or j is the sign of one linear function: for i < j,
x . 2(cj - ci) - (|cj|^2 - |ci|^2). Normals and thresholds of all pairs are computed once a
round; a vector then meets the centroids in ascending order, every test eliminates one, and zero
leaves the smaller number in. After k - 1 tests the one left is the nearest. Only the
distance to it is computed, exactly.

Everything is whole-number arithmetic. A round is one pass over the written vectors: each task adds up
its own clusters, the sums are added per cluster and component, and k x dims numbers reach the
driver. Tasks are stateless, so a lost executor costs its tasks only.

Edge cases: null vectors, those of another length, and those with a null or non-finite component are left
out. A null id is kept, but is no starting centroid before any other. Repeated rows are vectors of their own. With fewer
vectors than k there are fewer centroids; an empty table gives no rows. Ties of the starting hash
(one id several times) go by the vector. A component whose whole number reaches 2^26 in size ends the job with a
message: distances of such vectors need not fit a long. Other columns are not read and may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldergrid.session import cut_lineage, forget

MAX_SIZE = 1 << 26  # products of 64 components and normals stay below 2^63


def whole_vectors(vectors: DataFrame, vec_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the vectors that take part; v holds floor(scale * x)."""
    x = F.col(f"`{vector}`")
    usable = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))

    def whole(c):
        scaled = scale * c.cast("double")
        too_large = F.raise_error(F.concat(F.lit("A component is too large to cluster: "), c.cast("string"))).cast("int")
        return F.when(F.abs(scaled) < MAX_SIZE, F.floor(scaled).cast("int")).otherwise(too_large)

    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(f"`{vec_id}`").alias("id"), F.transform(x, whole).alias("v"))


class Bisectors:
    """The hyperplanes between all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, np.int64)
        squares = (self.centroids * self.centroids).sum(axis=1)
        self.normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, points: np.ndarray) -> np.ndarray:
        left = np.zeros(len(points), np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("nd,nd->n", points, self.normals[left, rival]) - self.thresholds[left, rival]
            left = np.where(side > 0, rival, left)
        return left

    def distances(self, points: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        apart = points - self.centroids[numbers]
        return np.einsum("nd,nd->n", apart, apart)


def _points(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("v")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def starting_centroids(points: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of `seed:id`, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = points.select(digest.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k)
    return [list(row["v"]) for row in first.collect()]


def moved(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floor of the mean of their vectors; empty ones stay."""
    bisectors = Bisectors(centroids)

    def sums(batches):
        k, dims = bisectors.centroids.shape
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            points = _points(batch)
            number = bisectors.nearest(points)
            counts += np.bincount(number, minlength=k)
            for c in range(k):
                totals[c] += points[number == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), pa.array(counts), pa.array(totals.tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"],
        )

    partial = points.mapInArrow(sums, "cluster int, n bigint, total array<bigint>").where("n > 0")
    exact = partial.select("cluster", "n", F.posexplode("total").alias("dim", "part"))
    added = exact.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(28,0)")).alias("total"))
    after = [list(c) for c in centroids]
    for row in added.collect():
        after[row["cluster"]][row["dim"]] = int(row["total"]) // row["n"]
    return after


def assign(points: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance) of every vector, the distance squared."""
    bisectors = Bisectors(centroids)
    id_type = points.schema["id"].dataType.simpleString()

    def assigned(batches):
        for batch in batches:
            points = _points(batch)
            number = bisectors.nearest(points)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(number.astype(np.int32)), pa.array(bisectors.distances(points, number))],
                names=["id", "cluster", "distance"],
            )

    return points.mapInArrow(assigned, f"id {id_type}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 8,
    rounds: int = 10, scale: int = 1024, seed: int = 3,
) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every vector that takes part, and the final centroids.

    A round that moves no centroid is the last: the ones after it would not either.
    """
    points = cut_lineage(whole_vectors(vectors, vec_id, vector, dims, scale))
    centroids = starting_centroids(points, k, seed)
    if not centroids:
        return points.selectExpr("id", "0 AS cluster", "0L AS distance").withColumnRenamed("id", vec_id), []
    for _ in range(rounds):
        before, centroids = centroids, moved(points, centroids)
        if centroids == before:
            break
    assigned = cut_lineage(assign(points, centroids))
    forget(points)
    return assigned.withColumnRenamed("id", vec_id), centroids


def with_digests(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """`assigned` with the inertia of each cluster and of all, and a digest of the centroid.
    One row per cluster is collected and joined: k rows at any size of the table."""
    total = F.sum(F.col("distance").cast("decimal(28,0)"))
    inertia = {row[0]: int(row[1]) for row in assigned.groupBy("cluster").agg(total).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    rows = [(c, inertia[c], sum(inertia.values()), digest(centroids[c])) for c in inertia]
    clusters = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster")
