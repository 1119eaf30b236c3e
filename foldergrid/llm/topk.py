"""Exact top-k by inner product over a pivot-distance index.

A coordinate more turns the largest inner product into the smallest distance: with m the
largest norm, |q|^2 + m^2 - 2 q.x is the squared distance of (q, 0) and (x, sqrt(m^2 - |x|^2)).
Every vector is keyed by its nearest pivot and the distance to it, and the distances of a
pivot are cut into sorted annuli. A query first looks at the annuli closest to it until they
hold k vectors; the k-th score found is a radius. By the triangle inequality an annulus can
hold something better only if the query's distance to the pivot is within that radius of the
annulus, and only those are read in the second step.

Pivots are fitted on a bounded sample; every vector is indexed and results are exact. An
annulus that holds very many vectors (copies have one distance) is split into parts, queries
go in blocks, and a task joins one part to one block.

Edge cases: vectors that are null, or hold null or non-finite components, and rows without an
id take no part. Missing components of shorter vectors are zero. A query's own id is no
candidate; other repeated rows count as often as they occur, and of several query rows with
one id the largest vector asks. With fewer than k candidates all are returned; without vectors or
queries there are no rows. Other columns are not read and may have any names. Products of 2^63 and more raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldergrid.llm.common import bounded_sample, small_batches
from foldergrid.session import cut_lineage

PIVOTS = 48
SAMPLE_ROWS = 4096       # vectors that pivots are chosen from
BUCKETS = 256            # distance steps per pivot: the directory has PIVOTS * BUCKETS entries at most
PART_ROWS = 1024         # vectors of an annulus, and of a part of one
BLOCK_QUERIES = 1024
_EXACT = 1 << 53


def quantise(vector: Column) -> Column:
    """floor(256 x) of every component as double; null unless all components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("bigint")))


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those chosen."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen = [0]
    distance = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)) and distance.max() > 0:
        chosen.append(int(np.argmax(distance)))
        distance = np.minimum(distance, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def best_of_cell(queries, query_ids, vectors, ids, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of the k best of every query, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    top = max(int(np.abs(queries).max(initial=0)), 1) * max(int(np.abs(vectors).max(initial=0)), 1)
    exact = top * max(vectors.shape[1], 1) < _EXACT  # else whole numbers, at a lower speed
    if top * max(vectors.shape[1], 1) >= 1 << 63:
        raise OverflowError("Scores of these vectors do not fit a long.")
    turned = (vectors.astype(np.float64) if exact else vectors).T
    found = [], [], []
    for at in range(0, len(queries), 256):
        own = query_ids[at : at + 256]
        block = queries[at : at + 256]
        scores = ((block.astype(np.float64) if exact else block) @ turned).astype(np.int64)
        valid = own[:, None] != ids[None, :]
        lowest = np.iinfo(np.int64).min
        ranked = np.where(valid, scores, lowest)
        cut = np.partition(ranked, -k, axis=1)[:, -k] if ranked.shape[1] > k else np.full(len(own), lowest)
        row, column = np.nonzero((ranked >= cut[:, None]) & valid)
        value = scores[row, column]
        placed = np.lexsort((column, -value, row))  # columns are in the order of ids
        row, column, value = row[placed], column[placed], value[placed]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        for out, part in zip(found, (own[row[keep]], ids[column[keep]], value[keep])):
            out.append(part)
    return tuple(np.concatenate(part) if part else np.zeros(0, np.int64) for part in found)


class Directory:
    """The annuli of every pivot: (pivot, nearest and farthest distance, rows, parts)."""

    def __init__(self, counts: list[tuple[int, int, int, float, float]]):
        """`counts`: (pivot, step, rows, nearest, farthest), in order."""
        self.of_step: dict[tuple[int, int], int] = {}
        rings: list[list] = []
        for pivot, step, rows, near, far in counts:
            if rings and rings[-1][0] == pivot and rings[-1][3] + rows <= PART_ROWS:
                rings[-1][2], rings[-1][3] = far, rings[-1][3] + rows
            else:
                rings.append([pivot, near, far, rows])
            self.of_step[pivot, step] = len(rings) - 1
        self.pivot = np.array([r[0] for r in rings], np.int64)
        self.near = np.array([r[1] for r in rings])
        self.far = np.array([r[2] for r in rings])
        self.rows = np.array([r[3] for r in rings], np.int64)
        self.parts = -(-self.rows // PART_ROWS)

    def bounds(self, to_pivots: np.ndarray) -> np.ndarray:
        """For every query and annulus the least distance that a vector of it can have."""
        d = to_pivots[:, self.pivot]
        return np.maximum(np.maximum(d - self.far[None, :], self.near[None, :] - d), 0)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best vectors for every row of `queries`, which
    has the same columns. The queries are not assumed to fit anywhere."""
    spark = small_batches(vectors.sparkSession)
    pick = lambda df: df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), quantise(F.col(f"`{vector}`")).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    rows, asked = pick(vectors), pick(queries).groupBy("id").agg(F.max("v").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    width, largest = rows.agg(F.max(F.size("v")), F.max(norm)).first()
    query_width, n_queries = asked.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if largest is None or not n_queries:
        return empty
    width = max(width, query_width, 1)
    sample = bounded_sample(rows, "id", SAMPLE_ROWS).select("v").collect()
    points = _lifted(_matrix(pa.array([r["v"] for r in sample], pa.list_(pa.int64())), width), largest)
    anchors = spark.sparkContext.broadcast(choose_pivots(points, pivots))
    reach = 2 * float(np.sqrt(largest)) or 1.0

    def keyed(place):
        @F.arrow_udf("struct<pivot: int, distance: double, step: int>")
        def key(column: pa.Array) -> pa.Array:
            distances = _distances(place(_matrix(column, width)), anchors.value)
            nearest = distances.argmin(1)
            own = distances[np.arange(len(distances)), nearest]
            step = np.minimum((own * (BUCKETS / reach)).astype(np.int32), BUCKETS - 1)
            return pa.StructArray.from_arrays([pa.array(nearest.astype(np.int32)), pa.array(own), pa.array(step)], ["pivot", "distance", "step"])

        return key("v")

    index = cut_lineage(rows.withColumn("k", keyed(lambda v: _lifted(v, largest))).select("id", "v", "k.*"))
    directory = Directory(_counts(index))
    placed = _dealt(index, [(p, s, r, int(directory.parts[r])) for (p, s), r in directory.of_step.items()], "ring")
    shared = spark.sparkContext.broadcast(directory)
    # queries of a block lie near the same pivots at like distances: the more queries, the fewer annuli a block asks for
    places = cut_lineage(asked.withColumn("k", keyed(_query)).select("id", "v", "k.*"))
    asked = _dealt(places, _blocks(_counts(places)), "number").select("id", "v", F.struct("number", "part").alias("block"))

    @F.arrow_udf("array<int>")
    def first_rings(column: pa.Array) -> pa.Array:
        own = _matrix(column, width)
        bounds = shared.value.bounds(_distances(_query(own), anchors.value))
        rings = []
        for row in np.argsort(bounds, axis=1, kind="stable"):
            needed = int(np.searchsorted(np.cumsum(shared.value.rows[row]), k + 1)) + 1
            rings.append(row[:needed].tolist())
        return pa.array(rings, pa.list_(pa.int32()))

    @F.arrow_udf("array<int>")
    def other_rings(column: pa.Array, kth: pa.Array) -> pa.Array:
        own = _matrix(column, width)
        bounds = shared.value.bounds(_distances(_query(own), anchors.value))
        square = (own.astype(np.float64) ** 2).sum(1) + largest
        scores = kth.to_numpy(zero_copy_only=False).astype(np.float64)  # null, of fewer than k found, is no bound
        radius = np.sqrt(np.maximum(square - 2 * np.where(np.isnan(scores), -np.inf, scores), 0))
        near = bounds <= radius[:, None] + 1e-6 * reach  # room for rounding; equal scores are looked at too
        return pa.array([np.flatnonzero(row).tolist() for row in near], pa.list_(pa.int32()))

    first = cut_lineage(asked.withColumn("rings", first_rings("v")))
    near = cut_lineage(_scored(first, placed, width, k))
    rest = first.join(_kth(near, k), "id", "left").withColumn("rings", F.array_except(other_rings("v", "kth"), "rings"))
    every = near.unionByName(_scored(rest, placed, width, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _counts(index: DataFrame) -> list[tuple]:
    """(pivot, step, rows, nearest, farthest) in order: a row per pivot and distance step, PIVOTS * BUCKETS at most."""
    counted = index.groupBy("pivot", "step").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far"))
    return [tuple(r) for r in counted.orderBy("pivot", "step").collect()]


def _dealt(index: DataFrame, of_step: list[tuple[int, int, int, int]], name: str) -> DataFrame:
    """The rows of an index with their number in `of_step` (pivot, step, number, parts), and their part of it."""
    numbers = index.sparkSession.createDataFrame(of_step, f"pivot int, step int, {name} int, parts int")
    return index.join(F.broadcast(numbers), ["pivot", "step"]).select(
        "id", "v", name, F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    )


def _blocks(counts: list[tuple]) -> list[tuple[int, int, int, int]]:
    """(pivot, step, block, parts): steps in order, as many to a block as hold BLOCK_QUERIES queries."""
    found, number, held = [], 0, 0
    for pivot, step, rows, *_ in counts:
        if held and held + rows > BLOCK_QUERIES:
            number, held = number + 1, 0
        held += rows
        found.append((pivot, step, number, -(-rows // BLOCK_QUERIES)))
    return found


def _kth(near: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(
        F.col("query_id").alias("id"), F.col("score").alias("kth")
    )


def _lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    own = vectors.astype(np.float64)
    return np.hstack([own, np.sqrt(np.maximum(largest - (own**2).sum(1), 0))[:, None]])


def _query(vectors: np.ndarray) -> np.ndarray:
    return np.hstack([vectors.astype(np.float64), np.zeros((len(vectors), 1))])


def _scored(asked: DataFrame, placed: DataFrame, width: int, k: int) -> DataFrame:
    """The k best of every (query, part of an annulus it asks for)."""
    wanted = asked.select("id", "v", "block", F.explode("rings").alias("ring"))
    # which blocks ask for an annulus: at most one row per annulus and block
    cells = wanted.select("ring", "block").distinct()
    theirs = placed.join(cells, "ring").select("ring", "part", "block", F.lit(False).alias("asks"), "id", "v")
    parts = placed.select("ring", "part").distinct()
    asking = wanted.join(parts, "ring").select("ring", "part", "block", F.lit(True).alias("asks"), "id", "v")

    def best(cell: pa.Table) -> pa.Table:
        asks = cell.column("asks").to_numpy()
        ids, v = cell.column("id").to_numpy(), _matrix(cell.column("v"), width)
        query, vector, score = best_of_cell(v[asks], ids[asks], v[~asks], ids[~asks], k)
        return pa.table({"query_id": query, "vec_id": vector, "score": score})

    return theirs.unionByName(asking).groupBy("ring", "part", "block").applyInArrow(best, "query_id bigint, vec_id bigint, score bigint")
