"""Quality rules by line sequence labelling.

Base counts over a whole text (words ``[^\\x20\\x09-\\x0D]+``, symbols, repeated lines,
words in repeated 3-word windows) give the base verdict. For the rest a binary
linear-chain conditional random field labels the lines with a word as content or
boilerplate (Viterbi over the whole text); a document is kept if at least half of
its words are in content lines.

The field is trained here by maximum likelihood on a bounded sample of labelled
documents (``max_labelled``, chosen by a hash, each quality up to half): lines of good
documents are content, lines of bad ones boilerplate, as weak labels. Half of the documents
get a run of lines of one of the other kind spliced in at some place, so the training
sequences switch between content and boilerplate and the transitions are learned from them.

Features and counts are computed on the bytes of whole batches, Viterbi runs over
all texts of a chunk at once.

Defined results: null text has no words (all counts 0, base_failed, not kept);
without labels of both kinds every line is content; null labels or ids do not
train; a document labelled twice takes the lower quality; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelab.llm import common as C

MAX_LABELLED = 3000
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!|{}[]=_/\\~^"]] = True
_U = np.uint64


def _per(mask: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(mask)])
    return c[hi] - c[lo]


def parse(raw: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts per row, and features of the lines with a word."""
    n_rows = len(offs) - 1
    starts, ends, ptr = C.word_spans(raw, offs)
    h = C.span_hashes(raw, starts, ends)
    row = np.repeat(np.arange(n_rows), np.diff(ptr))
    out = {"n_words": np.diff(ptr), "n_symbols": _per(SYMBOLS[raw], offs[:-1], offs[1:])}
    inside = C.SPACE_WORD[raw] & ((raw & 0xC0) != 0x80)          # code points, not bytes
    out["word_chars"] = _per(inside, offs[:-1], offs[1:])

    # words in 3-word windows that occur twice or more in their row
    hit = np.zeros(len(h) + 3, np.int64)
    if len(h) >= 3:
        tri = C.mix(h[:-2] * _U(3) + C.mix(h[1:-1] * _U(5) + C.mix(h[2:])))
        at = np.flatnonzero(row[:-2] == row[2:])
        key = C.mix(tri[at] + row[at].astype(_U) * _U(0x9E3779B97F4A7C15))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[count[back] > 1]
        hit[twice] += 1
        hit[twice + 3] -= 1
    out["n_repeat_words"] = _per(np.cumsum(hit)[:len(h)] > 0, ptr[:-1], ptr[1:])

    # lines: borders at newlines and row ends
    nl = np.flatnonzero(raw == 10)
    lo = np.concatenate([offs[:-1], nl + 1])
    hi = np.concatenate([nl, offs[1:]])
    lo, hi = np.sort(lo), np.sort(hi)
    line_row = np.searchsorted(offs, lo, "right") - 1
    line_row = np.minimum(line_row, n_rows - 1)
    first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
    full = last > first
    lo, hi, first, last, line_row = (a[full] for a in (lo, hi, first, last, line_row))
    words = last - first
    whole = C.span_hashes(raw, lo, hi) + line_row.astype(_U) * _U(0x9E3779B97F4A7C15)
    order = np.argsort(whole, kind="stable")
    same = np.zeros(len(whole), bool)
    same[order[1:]] = whole[order[1:]] == whole[order[:-1]]        # equal to an earlier line of the row
    out["n_dup_lines"] = np.bincount(line_row[same], minlength=n_rows)

    size = (hi - lo).astype(float)
    letters = np.maximum(_per(_LETTER[raw], lo, hi), 1)
    twin = np.concatenate([[False], h[1:] == h[:-1]]) if len(h) else np.zeros(0, bool)
    ratio = [
        _per(SYMBOLS[raw], lo, hi) / size, _per(_UPPER[raw], lo, hi) / letters, _per(_MARK[raw], lo, hi) / size,
        _per(_DIGIT[raw], lo, hi) / size, _per(twin, first, last) / words, _per(_END[raw], lo, hi) / words,
    ]
    edges = [[0.001, 0.02, 0.08, 0.2], [0.001, 0.1, 0.3, 0.6], [0.001, 0.02, 0.08, 0.2], [0.001, 0.05, 0.2, 0.5],
             [0.001, 0.1, 0.3, 0.6], [0.001, 0.1, 0.3, 0.6]]
    tail = raw[ends[last - 1] - 1] if len(last) else np.zeros(0, np.uint8)
    bins = [np.searchsorted(e, r, "right") for e, r in zip(edges, ratio)]
    bins += [np.searchsorted([2, 4, 8, 16, 32, 64], words, "right"), _END[tail].astype(int), SYMBOLS[tail].astype(int), same.astype(int)]
    out["bins"] = np.stack(bins, 1) if len(words) else np.zeros((0, len(SIZES)), int)
    out["line_row"], out["line_words"] = line_row, words
    return out


SIZES = [5, 5, 5, 5, 5, 5, 7, 2, 2, 2]
_BASE = np.concatenate([[0], np.cumsum(SIZES)[:-1]])
N_FEATURES = sum(SIZES)


def emissions(bins: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of (boilerplate, content) for every line."""
    return weights[bins + _BASE].sum(1)


def viterbi(score: np.ndarray, trans: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best binary label sequences of many chains, longest first (active prefix)."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    back = np.zeros(score.shape, np.int8)
    best = np.zeros((len(lengths), 2))
    for t in range(steps):
        n = active[t]
        at = starts[:n] + t
        if t:
            via = best[:n, :, None] + trans[None]
            back[at] = via.argmax(1)
            best[:n] = via.max(1)
        best[:n] += score[at]
    label = np.zeros(len(score), np.int8)
    cur = best.argmax(1).astype(np.int8)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        label[at] = cur[:n]
        if t:
            cur[:n] = back[at, cur[:n]]
    return label


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """``(weights, transitions)`` or None without labels of both kinds."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r["quality"]: r["count"] for r in marks.groupBy("quality").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    share = {q: int(1_000_000 * min(1.0, max_labelled / 2 / counts[q])) + 1 for q in (0, 1)}
    picked = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.when(F.col("quality") == 1, share[1]).otherwise(share[0]))
    sample = C.rows_of(docs.select("doc_id", "text"), picked, max_labelled).select("text", F.col("quality").cast("int"))

    def features(batches):
        for b in batches:
            q = b.column(1).to_numpy()
            for lo, raw, offs in C.chunks(b.column(0)):
                p = parse(raw, offs)
                keep = np.flatnonzero(np.bincount(p["line_row"], minlength=len(offs) - 1))
                cuts = np.searchsorted(p["line_row"], np.arange(len(offs)))
                yield pa.RecordBatch.from_arrays([pa.array([p["bins"][cuts[r]:cuts[r + 1]].astype(np.int8).tobytes() for r in keep], pa.binary()),
                                                  pa.array(q[lo + keep].astype(np.int32))], ["bins", "quality"])

    rows = sample.mapInArrow(features, "bins binary, quality int").collect()
    if not rows:
        return None
    return train([np.frombuffer(r["bins"], np.int8).reshape(-1, len(SIZES)).astype(int) for r in rows], [r["quality"] for r in rows])


def spliced(docs: list[np.ndarray], quality: list[int], seed: int = 11) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """``(lines, labels)`` per training sequence: every second document with a run of lines of
    one of the other quality in it; the order of ``docs`` does not matter."""
    order = sorted(range(len(docs)), key=lambda i: (quality[i], docs[i].tobytes()))
    rng = np.random.default_rng(seed)
    of = {q: [docs[i] for i in order if quality[i] == q] for q in (0, 1)}
    lines, labels = [], []
    for q in (0, 1):
        other = of[1 - q]
        for k, d in enumerate(of[q]):
            if k % 2 and other:
                guest = other[int(rng.integers(len(other)))]
                lo = int(rng.integers(len(guest)))
                guest = guest[lo:lo + int(rng.integers(1, len(guest) - lo + 1))]
                at = int(rng.integers(len(d) + 1))
                lines.append(np.concatenate([d[:at], guest, d[at:]]))
                labels.append(np.concatenate([np.full(at, q), np.full(len(guest), 1 - q), np.full(len(d) - at, q)]))
            else:
                lines.append(d)
                labels.append(np.full(len(d), q))
    return lines, labels


def train(docs: list[np.ndarray], quality: list[int], epochs: int = 120, rate: float = 0.3, l2: float = 1e-4):
    """Maximum likelihood of the binary field over sequences that switch (``spliced``)."""
    from pricelab.llm.langid import forward_backward, pair_sums

    docs, labels = spliced(docs, quality)
    lengths = np.array([len(d) for d in docs])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    bins = np.concatenate(docs) + _BASE
    y = np.concatenate(labels).astype(int)
    # documents weigh the same whatever their number of lines
    weight = np.repeat(1.0 / lengths, lengths)
    weight /= np.array([weight[y == k].sum() for k in (0, 1)])[y] * 2
    first = np.zeros(len(y), bool)
    first[starts] = True
    inner = np.flatnonzero(~first)
    w, tr = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    gw, gt = np.full_like(w, 1e-8), np.full_like(tr, 1e-8)
    onehot = np.eye(2)[y]
    gold = np.zeros((2, 2))
    np.add.at(gold, (y[inner - 1], y[inner]), weight[inner])
    for _ in range(epochs):
        m, *rest = forward_backward(w[bins].sum(1), tr, starts, lengths)
        diff = (m - onehot) * weight[:, None]
        g = np.stack([np.bincount(bins.ravel(), np.repeat(diff[:, k], bins.shape[1]), N_FEATURES) for k in (0, 1)], 1) + l2 * w
        h = pair_sums(*rest, inner, weight[inner]) - gold + l2 * 100 * tr
        gw += g ** 2
        gt += h ** 2
        w -= rate * g / np.sqrt(gw)
        tr -= rate * h / np.sqrt(gt)
    return w, tr


_OUT = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                  ("base_failed", pa.bool_()), ("content_share", pa.float64()), ("kept", pa.bool_())])


def judge(docs: DataFrame, model, min_share: float = 0.5) -> DataFrame:
    """Per row: the base counts, base_failed, share of words in content lines, kept."""

    def run(batches):
        for b in batches:
            for lo, raw, offs in C.chunks(b.column(1)):
                p = parse(raw, offs)
                n = len(offs) - 1
                label = np.ones(len(p["line_row"]), np.int8)
                if model is not None and len(label):
                    count = np.bincount(p["line_row"], minlength=n)
                    with_lines = np.flatnonzero(count)
                    starts = np.searchsorted(p["line_row"], with_lines)
                    label = viterbi(emissions(p["bins"], model[0]), model[1], starts, count[with_lines])
                content = np.bincount(p["line_row"], p["line_words"] * label, n)
                share = content / np.maximum(p["n_words"], 1)
                failed = (p["n_words"] < 50) | (100 * p["n_repeat_words"] > 50 * p["n_words"])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, n).cast(pa.int64()),
                    *[pa.array(p[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    pa.array(failed), pa.array(np.round(share, 6)), pa.array(~failed & (share >= min_share))], schema=_OUT)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                                        "n_repeat_words long, base_failed boolean, content_share double, kept boolean")
