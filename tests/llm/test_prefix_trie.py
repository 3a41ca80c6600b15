"""Prefix trie against a dictionary of all prefixes."""

import hashlib
import zlib

import numpy as np
import pytest

from pricelab.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"


def key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), key(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    conv = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        conv[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:])
    nodes = {}
    for c in sorted(conv):
        for d in range(len(conv[c]) + 1):
            nodes.setdefault(conv[c][:d], []).append(c)
    kids = {p: [] for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
    return sorted((nodes[p][0], len(p), nodes[p[:-1]][0] if p else -1, len(nodes[p]), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in nodes[p] if conv[c] == p).encode()).hexdigest()) for p in nodes)


def got(df):
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.select(*cols).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 7) for r in rows], SCHEMA)


@pytest.mark.parametrize("shards,letters,longest", [(1, 2, 40), (9, 2, 40), (30, 3, 8), (5, 1, 60)])
def test_equals_dictionary(spark, shards, letters, longest):
    rng = np.random.default_rng(shards)
    rows = []
    for c in range(260):
        for t in range(int(rng.integers(1, longest))):
            # few texts, the later ones mostly equal: deep shared paths
            rows.append((int(c * 7 % 601), t, "user", "abcÜ"[int(rng.integers(letters)) if rng.random() < 0.3 else 0] * (1 + t % 3)))
    assert got(T.trie(frame(spark, rows), min_shards=shards)) == brute(rows)


def test_equal_conversations_over_shards(spark, monkeypatch):
    """One conversation of a third of all rows is cut by conv_id, its end list streamed in pieces."""
    monkeypatch.setattr(T, "CHUNK_IDS", 7)
    rows = [(c, t, "u", f"same {t}") for c in range(6, 900, 3) for t in range(8)] + [(c, t, "u", f"{c}") for c in range(5, 900, 3) for t in range(3)]
    assert got(T.trie(frame(spark, rows), min_shards=12)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (100, None, None, None), (100, 0, "user", None), (100, 0, "user", "x"), (100, 0, "user", "x"), (101, 5, "", "x" * 100_000),
            (102, 0, "a", "b"), (103, 1, "user", "only"), (-105, 0, "user", "neg"), (-100, 0, "user", "base"), (104, None, "", ""), (104, None, "", ""), (1 << 60, 0, "u", "big")]
    assert got(T.trie(frame(spark, rows), min_shards=4)) == brute(rows)
    assert got(T.trie(frame(spark, []))) == []
    assert got(T.trie(frame(spark, [(None, 1, "a", "b")]))) == []
    assert got(T.trie(frame(spark, [(7, 1, "a", "b")]))) == brute([(7, 1, "a", "b")])


def test_lex_order(spark):
    rng = np.random.default_rng(3)
    rows = [tuple(rng.integers(0, 2, int(n)).tolist()) for n in rng.integers(0, 50, 200)] + [()] * 3 + [(1,) * 70] * 4
    conv = rng.permutation(len(rows))
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    order, shared = T.lex_order(np.array([x for r in rows for x in r], np.int64), ptr, conv)
    assert order.tolist() == sorted(range(len(rows)), key=lambda i: (rows[i], conv[i]))
    for i in range(1, len(rows)):
        a, b = rows[order[i - 1]], rows[order[i]]
        n = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[i] == n
