"""Shallot k-means against full scans in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from pricelab.llm import common as C, shallot

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string"


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(64 * float(x)) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    seeds = sorted(kept, key=lambda r: ((1, "") if r[0] is None else (0, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()), r[1]))[:k]
    cents = [list(q) for _, q in seeds]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(cents)) for _, q in kept]

    for _ in range(rounds):
        of = assign()
        for j in range(len(cents)):
            mine = [q for (_, q), (_, c) in zip(kept, of) if c == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    of = assign()
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    part = [sum(d for d, c in of if c == j) for j in range(len(cents))]
    return sorted(((i, c, d, part[c], sum(part), sha[c]) for (i, _), (d, c) in zip(kept, of)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


@pytest.mark.parametrize("k", [1, 2, 7])
def test_equals_full_scan(spark, k):
    rng = np.random.default_rng(k)
    rows = [(int(i), np.round(rng.normal(size=4) + 3 * (i % 5), 1).astype(np.float32).tolist()) for i in range(150)]   # coarse: many ties
    df = spark.createDataFrame([(i, e, 0, "x") for i, e in rows], SCHEMA)
    assert got(shallot.cluster(df, k=k, dims=4)) == brute(rows, k, 3, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (1, [0.5, -0.5]), (2, None), (3, []), (4, [1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [None, 1.0]),
            (None, [2.0, 2.0]), (8, [-0.0, 0.0]), (9, [0.01, -0.01]), (1, [7.0, 7.0])]
    df = spark.createDataFrame([(i, e, None, None) for i, e in rows], SCHEMA)
    for k in (3, 16):
        assert got(shallot.cluster(df, k=k, dims=2)) == brute(rows, k, 3, 2)
    assert got(shallot.cluster(df.where("vec_id = 2"), dims=2)) == []
    assert got(shallot.cluster(spark.createDataFrame([], SCHEMA))) == []


def test_component_too_large_for_a_long(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0], 0, "")], SCHEMA)
    with pytest.raises(Exception, match="2\\^27"):
        shallot.cluster(df, dims=2).collect()


def test_scan_takes_fewer_distances(spark):
    """The ball search leaves most distances out on grouped vectors, also from scratch."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-5000, 5000, (32, 8))
    q = (centres[rng.integers(0, 32, 4000)] + rng.integers(-40, 40, (4000, 8))).astype(np.int64)
    cs = shallot.Centroids(centres.astype(np.int64))
    n = len(q)
    cluster, second, upper, lower, taken = shallot.search(q, cs, np.zeros(n, np.int64), np.ones(n, np.int64), np.full(n, np.inf), np.zeros(n))
    full = np.stack([cs.square(q, j) for j in range(32)])
    assert (cluster == full.argmin(0)).all() and taken < 32 * n
    *_, again = shallot.search(q, cs, cluster, second, upper, lower)
    assert again < 0.1 * n
