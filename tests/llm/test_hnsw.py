"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from pricelab.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, w int"


def brute(rows):
    ok = lambda e: e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(x != 0 for x in e)
    n, up = len(rows), list(range(len(rows)))
    unit = [hnsw.unit(np.array([e], np.float32))[0] if ok(e) else None for _, e in rows]

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * n
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    low = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            low[find(i)] = min(low.get(find(i), v), v)
    return sorted(((v, links[i], low.get(find(i)), v == low.get(find(i))) for i, (v, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(v, e, 1, "r", 2) for v, e in rows], SCHEMA)


def planted(seed, n, d, groups):
    """Unrelated vectors, chains of near copies (not all linked with each other), exact and scaled copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d))
    rows = list(base)
    for g in range(groups):
        x = hnsw.unit(base[g:g + 1])[0]
        for k in range(int(rng.integers(2, 40))):
            x = hnsw.unit((x + rng.normal(size=d) * rng.choice([0.0, 0.02, 0.25]) / np.sqrt(d))[None])[0]
            rows.append(x * rng.choice([1.0, 3.0]))
    order = rng.permutation(len(rows))
    return [(int(i), np.asarray(rows[k], np.float32).tolist()) for i, k in enumerate(order)]


@pytest.mark.parametrize("shard_rows,min_shards", [(65_536, 1), (200, 3)])
def test_equals_all_pairs(spark, shard_rows, min_shards):
    rows = planted(1, 700, 16, 12)
    assert got(hnsw.near_duplicates(frame(spark, rows), shard_rows=shard_rows, min_shards=min_shards)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [None, 1.0]), (None, [1.0, 0.01]),
            (None, None), (8, [-0.0, 1.0]), (9, [0.0, 2.0]), (10, [1.0]), (11, [3.0]), (12, [1e30, 1e30]), (13, [1e-30, 1e-30]), (None, [-1.0, 0.0]), (None, [-2.0, 0.0])]
    assert got(hnsw.near_duplicates(frame(spark, rows))) == brute(rows)
    assert got(hnsw.near_duplicates(frame(spark, []))) == []
    assert got(hnsw.near_duplicates(frame(spark, rows[2:4]))) == brute(rows[2:4])


def test_large_group_beyond_any_beam(monkeypatch):
    """Near copies by the hundred are all found, followed hit by hit or scanned."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(1, 24)) + 0.1 * rng.normal(size=(900, 24)), rng.normal(size=(1500, 24))])
    v = hnsw.unit(x[rng.permutation(len(x))])
    graph = hnsw.Graph(v)
    assert all(((a < graph.n).sum(1) <= hnsw.CAP).all() for a in graph.adj)
    for follow in (10, 100_000):
        monkeypatch.setattr(hnsw, "FOLLOW", follow)
        found = set()
        for lo in range(0, len(v), hnsw.BATCH):
            r, k = hnsw.links_of(graph, v[lo:lo + hnsw.BATCH], hnsw.EF_QUERY, 0.95)
            found |= set(zip((lo + r).tolist(), k.tolist()))
        r, k = hnsw.scan(graph, v, 0.95)
        true = set(zip(r.tolist(), k.tolist()))
        assert found <= true and len(found) >= 0.99 * len(true)


def test_audit_widens_until_recall(spark, monkeypatch):
    """With graphs that lost nearly all links the audits still end in the right result."""
    def broken(self):
        pass
    monkeypatch.setattr(hnsw.Graph, "_build", broken)
    rows = planted(3, 150, 8, 6)
    monkeypatch.setattr(hnsw, "AUDIT_EVERY", 1)
    v = hnsw.unit(np.array([e for _, e in rows], np.float32))
    assert hnsw.probed_beam(hnsw.Graph(v), 0.95) >= len(v)
    import pyarrow as pa
    t = pa.table({"rid": np.arange(len(v)), "embedding": pa.array([e for _, e in rows], pa.list_(pa.float32())), "w": np.ones(len(v), np.int64)})
    index = hnsw._index(0.95)((pa.scalar(8), pa.scalar(0)), t)
    out = hnsw._query(0.95)(None, t, index)
    n = {r["a"]: r["n"] for r in out.to_pylist() if r["b"] is None}
    full = (v @ v.T >= 0.95).sum(1) - 1
    assert [n.get(i, 0) for i in range(len(v))] == full.tolist()


def test_spanning_joins_the_same():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 300, 400), rng.integers(0, 300, 400)
    keep = hnsw.spanning(a, b)

    def parts(a, b):
        up = {i: i for i in range(300)}
        def find(i):
            while up[i] != i:
                i = up[i]
            return i
        for x, y in zip(a, b):
            up[find(int(x))] = find(int(y))
        return {frozenset(j for j in range(300) if find(j) == r) for r in {find(i) for i in range(300)}}

    assert parts(a, b) == parts(a[keep], b[keep]) and len(keep) == 300 - len(parts(a, b))
