"""Line rules: what the field learns from sequences that switch."""

import numpy as np

from pricelab.llm import line_rules


def sequences(seed, n):
    """Documents of content and of boilerplate lines whose features overlap."""
    rng = np.random.default_rng(seed)
    docs, quality = [], []
    for i in range(n):
        q, k = i % 2, int(rng.integers(3, 25))
        bins = np.stack([np.clip(np.round(rng.normal((0.35 + 0.3 * q) * (s - 1), 0.25 * (s - 1) + 1e-9, k)), 0, s - 1) for s in line_rules.SIZES], 1).astype(int)
        docs.append(bins)
        quality.append(q)
    return docs, quality


def test_splices_switch_and_ignore_the_order():
    docs, quality = sequences(0, 60)
    lines, labels = line_rules.spliced(docs, quality)
    assert all(len(a) == len(b) for a, b in zip(lines, labels)) and len(lines) == 60
    mixed = [y for y in labels if 0 < y.mean() < 1]
    assert len(mixed) >= 25 and all((np.diff(y) != 0).sum() <= 2 for y in mixed)
    back = line_rules.spliced(docs[::-1], quality[::-1])
    assert all((a == b).all() for a, b in zip(lines, back[0])) and all((a == b).all() for a, b in zip(labels, back[1]))


def test_transitions_are_learned_and_find_planted_runs():
    docs, quality = sequences(1, 400)
    w, trans = line_rules.train(docs, quality)
    assert trans[0, 0] + trans[1, 1] > trans[0, 1] + trans[1, 0]          # labels stick, as in the sequences
    lines, labels = line_rules.spliced(*sequences(2, 200), seed=5)
    lengths = np.array([len(x) for x in lines])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    score = line_rules.emissions(np.concatenate(lines), w)
    y = np.concatenate(labels)
    chain = line_rules.viterbi(score, trans, starts, lengths)
    alone = score.argmax(1)
    assert (chain == y).mean() > (alone == y).mean() and (chain == y).mean() > 0.85
