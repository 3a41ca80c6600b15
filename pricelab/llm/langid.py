"""Language ID by a linear-chain conditional random field over words.

Words are runs of letters, lower-cased; every word of a text is labelled, with
affix, character-trigram and lexicon features and learned transitions, so a text
may switch language. Marginals come from forward-backward over the whole text;
the document's language has the largest share of their sum, which is the score.

Training: a bounded sample of labelled documents (``per_language`` each, chosen by
a hash), whose words are spliced into sequences that switch language, so that
transitions are learned; maximum likelihood on the driver. Features are hashed
into a fixed table, so the model has one size whatever the data.

Defined results: ``und`` with score 0.0 for null text or one without a letter, and
for every text if nothing can be learned; null or empty lang is not learned; null
doc_id does not train and counts as not held out; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from pricelab.llm import common as C

PER_LANGUAGE = 120
DIM = 1 << 15
WORD = re.compile(r"[^\W\d_]+")
UND = "und"


def words_of(text: str | None) -> list[str]:
    return [w for w in WORD.findall((text or "").lower())]


def word_features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed features: bias, affixes, trigrams, whole word, lexicon language."""
    names = ["b"] + [f"p{k}{word[:k]}" for k in (1, 2, 3)] + [f"s{k}{word[-k:]}" for k in (1, 2, 3, 4)]
    edged = f"<{word}>"
    names += [f"t{edged[i:i + 3]}" for i in range(len(edged) - 2)]
    names.append("w" + word)
    if word in lexicon:
        names.append(f"l{lexicon[word]}")
    return [zlib.crc32(n.encode()) % DIM for n in names]


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray          # DIM x languages
    trans: np.ndarray            # languages x languages, log scale
    lexicon: dict[str, int]

    def emission(self, word: str) -> np.ndarray:
        return self.weights[word_features(word, self.lexicon)].sum(0)


def forward_backward(score: np.ndarray, trans: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Node marginals, and what pair marginals need: forward, backward, emission and
    transition factors. Forward-backward over many chains at once: row ``starts[i] + t`` of ``score`` is
    step t of chain i. Chains are taken longest first, so the chains that still run
    at step t are a prefix; each step is one small matrix product."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    e = np.exp(score - score.max(1, keepdims=True))
    move = np.exp(trans - trans.max())
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    fwd, bwd = np.empty_like(e), np.ones_like(e)
    cur = None
    for t in range(steps):
        at = starts[:active[t]] + t
        cur = e[at] if t == 0 else (cur[:active[t]] @ move) * e[at]
        cur /= cur.sum(1, keepdims=True)
        fwd[at] = cur
    cur = np.ones((len(lengths), e.shape[1]), e.dtype)
    for t in range(steps - 1, 0, -1):
        at = starts[:active[t]] + t
        n = active[t]
        nxt = (cur[:n] * e[at]) @ move.T
        nxt /= nxt.sum(1, keepdims=True)
        cur[:n] = nxt
        bwd[at - 1] = nxt
    out = fwd * bwd
    return out / out.sum(1, keepdims=True), fwd, bwd, e, move


def marginals(score: np.ndarray, trans: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return forward_backward(score, trans, starts, lengths)[0]


def pair_sums(fwd, bwd, e, move, inner: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted sum of the pair marginals (step i-1, step i) over the steps ``inner``."""
    pair = fwd[inner - 1][:, :, None] * move[None] * (e[inner] * bwd[inner])[:, None, :]
    return (pair * (weight / pair.sum((1, 2)))[:, None, None]).sum(0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Crf | None:
    """Learn from text and lang of the documents that are not held out."""
    train = docs.where((F.crc32(F.col("doc_id").cast("string")) % 4 != 2) & F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    if not counts:
        return None
    langs = sorted(counts)
    limit = F.create_map(*[x for l in langs for x in (F.lit(l), F.lit(int(1_000_000 * min(1.0, per_language / counts[l])) + 1))])
    rows = (train.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < limit[F.col("lang")])
            .select("lang", "text").collect())
    return train_crf([(r["lang"], words_of(r["text"])) for r in rows], langs)


def train_crf(samples: list[tuple[str, list[str]]], langs: list[str], span: int = 64, epochs: int = 60, rate: float = 0.15, l2: float = 1e-5) -> Crf:
    """Maximum likelihood on spliced sequences of ``span`` words (Adagrad, full batch)."""
    rng = np.random.default_rng(7)
    index = {l: i for i, l in enumerate(langs)}
    n_lang = len(langs)
    seen: dict[str, np.ndarray] = {}
    pool = {i: [] for i in range(n_lang)}
    for lang, words in samples:
        i = index[lang]
        at = 0
        while at < len(words):                       # runs of 8 to 40 words
            k = int(rng.integers(8, 41))
            pool[i].append(words[at:at + k])
            at += k
        for w in words:
            seen.setdefault(w, np.zeros(n_lang, np.int64))[i] += 1
    lexicon = {w: int(c.argmax()) for w, c in seen.items() if c.sum() >= 5 and c.max() >= 0.9 * c.sum()}
    runs = [(i, r) for i in pool for r in pool[i]]
    rng.shuffle(runs)
    flat = [(w, i) for i, r in runs for w in r]
    if not flat:
        return Crf(langs, np.zeros((DIM, n_lang), np.float32), np.zeros((n_lang, n_lang), np.float32), {})
    vocab = {w: j for j, w in enumerate(dict.fromkeys(w for w, _ in flat))}
    feats = [word_features(w, lexicon) for w in vocab]
    col = np.concatenate([np.asarray(f) for f in feats])
    row = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    x = np.array([vocab[w] for w, _ in flat])
    y = np.array([i for _, i in flat])
    starts = np.arange(0, len(flat), span)
    lengths = np.minimum(span, len(flat) - starts)
    first = np.zeros(len(flat), bool)
    first[starts] = True
    inner = np.flatnonzero(~first)
    gold_trans = np.zeros((n_lang, n_lang))
    np.add.at(gold_trans, (y[:-1][~first[1:]], y[1:][~first[1:]]), 1)
    w, tr = np.zeros((DIM, n_lang)), np.zeros((n_lang, n_lang))
    gw, gt = np.full_like(w, 1e-6), np.full_like(tr, 1e-6)
    onehot = np.eye(n_lang)[y]
    for _ in range(epochs):
        emit = np.stack([np.bincount(row, w[col, k], len(feats)) for k in range(n_lang)], 1)
        score = emit[x]
        m, *rest = forward_backward(score, tr, starts, lengths)
        diff = m - onehot
        per_word = np.stack([np.bincount(x, diff[:, k], len(feats)) for k in range(n_lang)], 1)
        g = np.stack([np.bincount(col, per_word[row, k], DIM) for k in range(n_lang)], 1) / len(flat) + l2 * w
        h = (pair_sums(*rest, inner, np.ones(len(inner))) - gold_trans) / len(flat) + l2 * tr
        gw += g ** 2
        gt += h ** 2
        w -= rate * g / np.sqrt(gw)
        tr -= rate * h / np.sqrt(gt)
    return Crf(langs, w.astype(np.float32), tr.astype(np.float32), lexicon)


def predictor(model: Crf | None):
    """Arrow UDF text -> (lang_pred, score)."""
    key = None if model is None else zlib.crc32(model.weights.tobytes())

    @pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, share = [UND] * len(texts), np.zeros(len(texts))
        if model is None:
            return pd.DataFrame({"lang_pred": langs, "score": share})
        ids, table = C.worker_store(("langid", key), lambda: ({}, []))
        if len(ids) > 300_000:
            ids.clear()
            table.clear()
        flat, rows, lengths = [], [], []
        for r, text in enumerate(texts):
            words = words_of(text)
            if not any(c.isalpha() for w in words for c in w):
                continue
            for w in words:
                at = ids.get(w)
                if at is None:
                    at = ids[w] = len(table)
                    table.append(model.emission(w))
                flat.append(at)
            rows.append(r)
            lengths.append(len(words))
        if rows:
            used, place = np.unique(np.asarray(flat, np.int32), return_inverse=True)
            score = np.stack([table[i] for i in used])[place]
            lengths = np.asarray(lengths)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            p = np.add.reduceat(marginals(score, model.trans, starts, lengths), starts, 0) / lengths[:, None]
            for r, best, top in zip(rows, p.argmax(1), p.max(1)):
                langs[r], share[r] = model.langs[best], min(1.0, float(top))
        return pd.DataFrame({"lang_pred": langs, "score": share})

    return predict


def identify(docs: DataFrame, model: Crf | None) -> DataFrame:
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predictor(model)("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", F.round("p.score", 6).alias("score")))
