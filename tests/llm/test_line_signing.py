"""op2: lines are signed once, copies alone bring no keys, and listed pairs are all pairs of a tile."""
import itertools

import numpy as np
import pyarrow as pa

from pricelab.llm import common as C, line_dedup as L


def _packed(rows: list[tuple[int, str]]) -> pa.Table:
    tab = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, tab.schema) as out:
        out.write_table(tab)
    return pa.table({"g": pa.array([0], pa.int32()), "blob": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _answers(groups: dict[int, pa.Table]) -> dict[int, pa.Table]:
    sent = [C.bucket_rows(*L._group_values(C.group_rows(t)), g, 0) for g, t in groups.items()]
    out = C.answer_shared(pa.concat_tables(sent))
    return {g: out.filter(pa.compute.equal(out.column("g"), g)) for g in groups}


def test_candidates_sign_no_line_again(monkeypatch):
    base = "the price of an ounce of gold rose again in early trading on monday morning"
    packed = {0: _packed([(1, base + "\nonly here, and nowhere else at all\ncopied word for word"), (2, base)]),
              1: _packed([(3, base + " x"), (4, "copied word for word")])}
    signed = {g: L._signed((pa.scalar(g),), t) for g, t in packed.items()}
    answers = _answers(signed)
    for name in ("shingle_hashes", "line_keys", "distinct_counts"):
        monkeypatch.setattr(L, name, lambda *a: (_ for _ in ()).throw(AssertionError("signed twice")))
    found = {}
    for g, t in packed.items():
        cand = L._candidates((pa.scalar(g),), t, L._linking((pa.scalar(g),), signed[g], answers[g]))
        for r in cand.to_pylist():
            found[r["doc_id"], r["no"]] = r
    assert set(found) == {(1, 0), (1, 2), (3, 0), (4, 0)}
    assert found[1, 0]["payload"].decode() == base and found[3, 0]["payload"].decode() == base + " x"
    assert found[1, 0]["n"] == len({base[i:i + 8] for i in range(len(base) - 7)})
    assert set(found[1, 0]["keys"]) == set(found[3, 0]["keys"]) != set()
    # copies of one text meet by their hash: no key and no text has to travel for them
    assert found[1, 2]["keys"] == found[4, 0]["keys"] == [] and found[1, 2]["payload"] is None
    assert found[1, 2]["line"] == found[4, 0]["line"]


def test_tile_pairs_are_all_pairs(monkeypatch):
    monkeypatch.setattr(C, "PAIR_ROWS", 7)
    sizes = np.array([1, 4, 2, 5, 4, 2])
    starts = np.cumsum(sizes) - sizes
    got = [p for x, y in C.tile_pairs(starts, sizes) for p in zip(x.tolist(), y.tolist())]
    want = [p for lo, n in zip(starts.tolist(), sizes.tolist()) for p in itertools.combinations(range(lo, lo + n), 2)]
    assert sorted(got) == sorted(want)


def test_components_equal_brute_force(spark):
    """Sets in small and large tiles (both ways of a lot), each under several keys with the same members."""
    rng = np.random.default_rng(5)
    base = [rng.choice(1 << 40, 60, replace=False).astype(np.uint64) for _ in range(12)]
    sets, keys = [], []
    for sid in range(150):
        at = sid % 12 if sid < 90 else 0
        own = base[at].copy()
        own[rng.choice(60, rng.integers(0, 14), replace=False)] = rng.choice(1 << 40, 1)
        sets.append(np.unique(own))
        keys.append([at, at + 100, at + 200, 300 + sid % 3])
    rows = [(sid, len(s), k, C.pack_u64(s)) for sid, (s, k) in enumerate(zip(sets, keys))]
    C.prepare(spark)
    df = C.written(spark.createDataFrame(rows, "sid long, n int, keys array<long>, payload binary"))

    def values(payloads):
        v = [C.unpack_u64(x) for x in payloads]
        return np.concatenate(v), np.concatenate([[0], np.cumsum([len(x) for x in v])])

    comp = list(range(150))
    for a, b in itertools.combinations(range(150), 2):
        if set(keys[a]) & set(keys[b]) and C.jaccard_80(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])) and comp[a] != comp[b]:
            lo, hi = sorted((comp[a], comp[b]))
            comp = [lo if x == hi else x for x in comp]
    for rounds in (1, 5):
        got = {r.sid: r.comp for r in C.link_components(df, C.jaccard_80, values, rounds=rounds).collect()}
        assert [got.get(x, x) for x in range(150)] == comp
