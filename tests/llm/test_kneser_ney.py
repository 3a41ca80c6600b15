"""Modified Kneser-Ney probabilities and perplexities against the formulas written out."""

import collections
import math

import pytest

from pricelab.llm import common as C, quality_lm as Q

TRUSTED = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "ünïcode ünï 😀😀 end", "the cat sat on the mat", "abc", ""]
OTHER = ["the bat sat", "zzzz zzzz", "😀x😀x"]


def grams(text, k=4):
    c = [min(ord(x), 0xFFFF) for x in text]
    return [tuple(c[i:i + k]) for i in range(len(c) - k + 1)]


def discounts(counts):
    n = [sum(1 for c in counts.values() if c == k) for k in (1, 2, 3, 4)]
    if not n[0] or not n[1]:
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return [min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d)]


def model():
    seen = {g for t in TRUSTED + OTHER for g in grams(t)}
    tables = {4: collections.Counter({g: 0 for g in seen})}
    for t in TRUSTED:
        tables[4].update(grams(t))
    for k in (3, 2, 1):
        tables[k] = collections.Counter()
        for g, n in tables[k + 1].items():
            tables[k][g[1:]] += n > 0
    p = {(): 1 / len(tables[1])}
    for k in (1, 2, 3, 4):
        d = discounts(tables[k])
        total, kinds = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
        for g, n in tables[k].items():
            if n:
                total[g[:-1]] += n
                kinds[g[:-1]][min(n, 3) - 1] += 1
        new = {}
        for g, n in tables[k].items():
            c = g[:-1]
            off = d[min(n, 3) - 1] if n else 0.0
            left = sum(a * b for a, b in zip(d, kinds[c])) / total[c] if total[c] else 1.0
            new[g] = (max(n - off, 0) / total[c] if total[c] else 0.0) + left * p[g[1:]]
        p.update(new)
    return {g: v for g, v in p.items() if len(g) == 4}


def number(g):
    out = 0
    for x in g:
        out = out << 16 | x
    return out


def test_probabilities_and_perplexities(spark):
    C.prepare(spark)
    rows = [(i, "xx", t, True) for i, t in enumerate(TRUSTED)] + [(100 + i, "xx", t, False) for i, t in enumerate(OTHER)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, trusted boolean")
    logp = Q.probabilities(Q.gram_counts(docs))
    got = {r.gram % (1 << 64): r.logp for r in logp.collect()}
    want = {number(g): math.log(v) for g, v in model().items()}
    assert set(got) == set(want)
    for g, v in want.items():
        assert got[g] == pytest.approx(v, rel=1e-9)
    scored = {r.doc_id: r for r in Q.perplexities(docs, logp).collect()}
    for i, _, t, _ in rows:
        own = grams(t)
        assert scored[i].n_grams == len(own)
        if own:
            assert scored[i].perplexity == pytest.approx(math.exp(-sum(want[number(g)] for g in own) / len(own)), rel=1e-5)
        else:
            assert scored[i].perplexity is None
