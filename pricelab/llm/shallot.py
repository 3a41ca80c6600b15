"""Exact k-means over integer vectors by Shallot search.

Method: every vector keeps the numbers of its nearest and second-nearest centroid,
an upper bound of the distance to the first and a lower bound of the distance to all
others. Bounds drift with the centroids; a vector whose bounds still part the two is
not touched. For the others the exact distances to both remembered centroids are
taken, and the scan starts at the closer one: its neighbours are read in order of
their distance from it, up to the distance to the start plus that to the second
nearest found so far. Whenever a closer second is found the ball shrinks. Bounds are
floating point with slack; what they leave over is compared in integers, ties going
to the smaller number, so the result is that of a full scan.

Spark holds the vectors: each round maps the written table of the round before
(vector, the two numbers, the two bounds) and writes the next one; new centroids are
grouped sums, of which ``k`` rows come to the driver. ``k`` is a parameter, and the
centroids (k x dims integers) are all that tasks are sent.

Defined results: a vector that is null, has another number of components, or holds a
null or non-finite one is not kept and not returned. Repeated rows and ids are vectors
of their own; a null vec_id takes part and is returned, but starts no centroid before
all others. Seeds with equal hashes are taken in the order of their components. With
fewer than ``k`` kept vectors there are fewer centroids; an empty table gives an empty
result. A component beyond 2^27 after scaling raises an error: its squared distances
would not fit the result's long. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelab.llm import common as C

K, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
MAX_COMPONENT = 1 << 27
SLACK = 1e-9

_STATE = "vec_id long, q array<int>, cluster int, second int, upper double, lower double, distance long"
_STATE_ARROW = pa.schema([("vec_id", pa.int64()), ("q", pa.list_(pa.int32())), ("cluster", pa.int32()), ("second", pa.int32()),
                          ("upper", pa.float64()), ("lower", pa.float64()), ("distance", pa.int64())])


def kept_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, q)``: vectors of ``dims`` finite components as integers floor(scale * x)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    beyond = F.exists("s", lambda x: F.abs(x) > F.lit(float(MAX_COMPONENT)))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where(F.size("embedding") == dims).where(finite)
            .select("vec_id", scaled.alias("s"))
            .select("vec_id", F.when(beyond, F.raise_error(F.lit("a scaled component is beyond 2^27")).cast("array<int>"))
                    .otherwise(F.transform("s", lambda x: F.floor(x).cast("int"))).alias("q")))


class Centroids:
    """Centroids of one round with the geometry that the scan needs."""

    def __init__(self, points: np.ndarray, before: np.ndarray | None = None):
        self.points = points
        k = len(points)
        self.gap = np.sqrt(np.array([((points - p) ** 2).sum(1) for p in points], np.float64).reshape(k, k))
        self.order = [np.array([j for j in np.argsort(self.gap[c], kind="stable") if j != c]) for c in range(k)]
        self.half = np.array([self.gap[c][self.order[c][0]] / 2 if k > 1 else np.inf for c in range(k)])
        moved = np.zeros(k) if before is None else np.sqrt(((points - before) ** 2).sum(1).astype(np.float64))
        self.moved = moved
        # the farthest that any centroid but the own one has moved
        self.others = np.array([np.delete(moved, c).max(initial=0.0) for c in range(k)])

    def square(self, q: np.ndarray, c) -> np.ndarray:
        """Exact squared distances of the rows of ``q`` to centroid(s) ``c``."""
        d = q - self.points[c]
        return (d * d).sum(1)


def search(q: np.ndarray, cs: Centroids, cluster, second, upper, lower):
    """One assignment of the rows of ``q`` (int64): new ``(cluster, second, upper, lower)``
    and how many exact distances were taken."""
    k = len(cs.points)
    cluster, second, upper, lower = cluster.copy(), second.copy(), upper + cs.moved[cluster], lower - cs.others[cluster]
    if k == 1:
        return cluster, second, np.sqrt(cs.square(q, cluster).astype(np.float64)), lower, len(q)
    open_ = lambda at: upper[at] * (1 + SLACK) + SLACK >= np.maximum(lower[at], cs.half[cluster[at]])
    at = np.flatnonzero(open_(slice(None)))
    first = cs.square(q[at], cluster[at])
    upper[at] = np.sqrt(first.astype(np.float64))
    taken = len(at)
    still = open_(at)
    at, first = at[still], first[still]
    if not len(at):
        return cluster, second, upper, lower, taken
    a, b = cluster[at], second[at]
    other = cs.square(q[at], b)
    taken += len(at)
    swap = (other < first) | ((other == first) & (b < a))
    near, near_d = np.where(swap, b, a), np.where(swap, other, first)
    next_, next_d = np.where(swap, a, b), np.where(swap, first, other)
    start, known = near.copy(), next_.copy()
    reach = np.sqrt(near_d.astype(np.float64))
    for c in np.unique(start):
        rows = np.flatnonzero(start == c)
        for j in cs.order[c]:
            # neighbours come by distance, so a row that one lies beyond is done
            ball = reach[rows] + np.sqrt(next_d[rows].astype(np.float64))
            rows = rows[cs.gap[c][j] <= ball * (1 + SLACK) + SLACK]
            if not len(rows):
                break
            new = rows[known[rows] != j]
            d = cs.square(q[at[new]], j)
            taken += len(new)
            closer = (d < near_d[new]) | ((d == near_d[new]) & (j < near[new]))
            closest, better = new[closer], new[~closer & (d < next_d[new])]
            next_[closest], next_d[closest] = near[closest], near_d[closest]
            near[closest], near_d[closest] = j, d[closer]
            next_[better], next_d[better] = j, d[~closer & (d < next_d[new])]
    cluster[at], second[at] = near, next_
    upper[at], lower[at] = np.sqrt(near_d.astype(np.float64)), np.sqrt(next_d.astype(np.float64))
    return cluster, second, upper, lower, taken


def _assigned(state: DataFrame, cs: Centroids, last: bool) -> DataFrame:
    """``state`` after one assignment; ``distance`` is filled in by the last one."""
    fresh = "cluster" not in state.columns

    def run(batches):
        for t in batches:
            n = t.num_rows
            if not n:
                continue
            flat = t.column(1).flatten()
            q = flat.to_numpy().reshape(n, -1).astype(np.int64)
            if fresh:
                was = np.zeros(n, np.int64), np.full(n, min(1, len(cs.points) - 1)), np.full(n, np.inf), np.zeros(n)
            else:
                was = tuple(t.column(i).to_numpy().astype(d) for i, d in ((2, np.int64), (3, np.int64), (4, np.float64), (5, np.float64)))
            cluster, second, upper, lower, _ = search(q, cs, *was)
            distance = pa.array(cs.square(q, cluster)) if last else pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([t.column(0), pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * q.shape[1], pa.int32()), flat.cast(pa.int32())),
                                              pa.array(cluster, pa.int32()), pa.array(second, pa.int32()), pa.array(upper), pa.array(lower), distance], schema=_STATE_ARROW)

    return state.mapInArrow(run, _STATE)


def _means(state: DataFrame, points: np.ndarray) -> np.ndarray:
    """Exact componentwise floor(sum / count) of every cluster; empty ones stay."""
    dims = points.shape[1]
    sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("q")[i].cast("long")).alias(f"s{i}") for i in range(dims)])
    out = points.copy()
    for r in sums.collect():    # k rows
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per kept vector
    of ``vectors (vec_id, embedding)`` after ``rounds`` rounds and a last assignment."""
    spark = vectors.sparkSession
    C.prepare(spark)
    state = C.written(kept_vectors(vectors, dims, scale))
    seeds = (state.select("q", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("h"))
             .orderBy(F.col("h").asc_nulls_last(), "q").limit(k).collect())
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not seeds:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    points, before = np.array([r["q"] for r in seeds], np.int64), None
    for i in range(rounds + 1):
        state = C.written(_assigned(state, Centroids(points, before), last=i == rounds))
        if i < rounds:
            before, points = points, _means(state, points)
    parts = {r["cluster"]: r["d"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [(c, parts.get(c, 0), sum(parts.values()), hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest()) for c, p in enumerate(points)]
    return (state.select("vec_id", "cluster", "distance").join(F.broadcast(spark.createDataFrame(digests, schema)), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
