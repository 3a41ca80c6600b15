"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Grades: 0 clean, 1 toxic, 2 strongly toxic. The labels only say clean or toxic;
a toxic training document is graded 2 when the number of its signal words (words
with a toxic-marked feature) reaches the median over toxic documents.

Features of a document: over its distinct words, the word itself and its prefixes
of 4, 5 and 6 letters (an affix covers compounds that no lexicon lists); a
feature's value is the number of distinct words that have it. The model is
P(grade <= k) = sigmoid(theta_k - w.x) with ordered thresholds that share w.
A document's score is a sum of per-word weights, so prediction is one Arrow pass.

Fitting uses a bounded sample of labelled documents (``max_labelled``, chosen by a
hash of doc_id); features are counted on the executors and only the selected
ones (at most ``max_features``) of the sample's documents reach the driver.

Defined results: null, empty or wordless text scores as an empty document; with no
usable labels (none, or one class only) every document is clean with severity 0;
a document labelled more than once counts as toxic if any label says so; null
labels and null doc_ids do not train; extra columns pass through untouched.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from pricelab.llm import common as C

MAX_LABELLED = 6000
MAX_FEATURES = 2000
MIN_DOCS = 5
MIN_Z = 4.0
WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return ["w:" + word] + [f"p{k}:{word[:k]}" for k in (4, 5, 6) if len(word) > k]


def document_words(text: str | None) -> set[str]:
    """Distinct lower-case words of a whole text."""
    return set(WORD.findall((text or "").lower()))


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, float] = (50.0, 60.0)

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        below = [1 / (1 + np.exp(-np.clip(t - score, -60, 60))) for t in self.thresholds]
        return np.stack([below[0], below[1] - below[0], 1 - below[1]], 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(text, toxic, weight)`` of at most about ``max_labelled`` labelled documents. Where there
    are more, the rarer class fills up to half of them, and weights give each class the
    share that it has of all labels."""
    marks = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marks = marks.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    count = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not count:
        return docs.select("text", F.lit(0).alias("toxic"), F.lit(1.0).alias("weight")).limit(0)
    rare = min(count, key=count.get)
    quota = {rare: min(count[rare], max_labelled // 2)}
    quota |= {k: min(n, max_labelled - quota[rare]) for k, n in count.items() if k != rare}
    of = lambda values: F.when(F.col("toxic") == 1, F.lit(values.get(1))).otherwise(F.lit(values.get(0)))
    picked = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < of({k: int(1_000_000 * quota[k] / n) for k, n in count.items()}))
    weight = of({k: n / quota[k] for k, n in count.items()})
    return C.rows_of(docs.select("doc_id", "text"), picked, max_labelled).select("text", "toxic", weight.alias("weight"))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    sample = C.cut(labelled_sample(docs, labels, max_labelled))
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_tox, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_tox or not n_clean:
        return OrdinalModel()

    def count(batches):
        for pdf in batches:
            tox, all_ = Counter(), Counter()
            for text, t in zip(pdf["text"], pdf["toxic"]):
                feats = {f for w in document_words(text) for f in word_features(w)}
                all_.update(feats)
                if t:
                    tox.update(feats)
            yield pd.DataFrame({"feature": list(all_), "tox": [tox[f] for f in all_], "total": list(all_.values())})

    # two-proportion z of each feature; the strongest ones that speak for toxicity are
    # kept, so a text without any of them is clean whatever else it says
    p1, p0 = F.col("tox") / n_tox, (F.col("total") - F.col("tox")) / n_clean
    pool = F.col("total") / (n_tox + n_clean)
    z = (p1 - p0) / F.sqrt(pool * (1.0000001 - pool) * (1 / n_tox + 1 / n_clean))
    strong = (sample.mapInPandas(count, "feature string, tox long, total long").groupBy("feature")
              .agg(F.sum("tox").alias("tox"), F.sum("total").alias("total")).where(F.col("total") >= MIN_DOCS)
              .withColumn("z", z).where(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "feature").limit(MAX_FEATURES).collect())
    names = [r["feature"] for r in strong]
    if not names:
        return OrdinalModel()
    index = {f: i for i, f in enumerate(names)}

    def vectors(batches):
        for pdf in batches:
            ids, vals, hits = [], [], []
            for text in pdf["text"]:
                c, hit = Counter(), 0
                for w in document_words(text):
                    own = [f for f in word_features(w) if f in index]
                    c.update(index[f] for f in own)
                    hit += bool(own)
                ids.append(list(c))
                vals.append(list(c.values()))
                hits.append(hit)
            yield pd.DataFrame({"ids": ids, "vals": vals, "hits": hits, "toxic": pdf["toxic"], "weight": pdf["weight"]})

    rows = sample.mapInPandas(vectors, "ids array<int>, vals array<int>, hits int, toxic int, weight double").toPandas()
    x = np.zeros((len(rows), len(names)), np.float32)
    for r, (i, v) in enumerate(zip(rows["ids"], rows["vals"])):
        x[r, np.asarray(i, int)] = v
    toxic = rows["toxic"].to_numpy() > 0
    y = np.where(toxic, np.where(rows["hits"].to_numpy() >= np.median(rows["hits"][toxic]), 2, 1), 0)
    w, thresholds = fit_ordinal(x, y, rows["weight"].to_numpy(float))
    return OrdinalModel({f: float(w[i]) for f, i in index.items()}, thresholds)


def fit_ordinal(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, steps: int = 400, rate: float = 0.05, l2: float = 1e-3):
    """Maximum (weighted) likelihood of the three-grade cumulative-link model (Adam, full batch)."""
    n, f = x.shape
    share = np.full(n, 1 / n) if weight is None else weight / weight.sum()
    p = np.zeros(f + 2)
    p[f], p[f + 1] = 1.0, 0.5          # theta_0 and log(theta_1 - theta_0)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        s = x @ p[:f]
        gap = np.exp(np.clip(p[f + 1], -10, 10))
        c0 = 1 / (1 + np.exp(-np.clip(p[f] - s, -40, 40)))
        c1 = 1 / (1 + np.exp(-np.clip(p[f] + gap - s, -40, 40)))
        d0, d1 = c0 * (1 - c0), c1 * (1 - c1)
        like = np.choose(y, [c0, c1 - c0, 1 - c1]).clip(1e-12)
        g0 = share * np.choose(y, [d0, -d0, 0 * d0]) / like        # d log-likelihood / d theta_0
        g1 = share * np.choose(y, [0 * d1, d1, -d1]) / like
        grad = np.concatenate([x.T @ (g0 + g1) + l2 * p[:f], [-(g0 + g1).sum(), -(g1 * gap).sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return p[:f], (float(p[f]), float(p[f] + np.exp(np.clip(p[f + 1], -10, 10))))


def scorer(model: OrdinalModel, name_rejected: float = 0.5):
    """Arrow UDF text -> (p0, p1, p2, severity, toxic)."""
    key = hash((model.thresholds, len(model.weights), sum(model.weights.values())))

    @pandas_udf("p_clean double, p_toxic double, p_severe double, severity double, toxic boolean")
    def score(texts: pd.Series) -> pd.DataFrame:
        cache = C.worker_store(("toxicity", key), dict)
        weights, total = model.weights, np.zeros(len(texts))
        for r, text in enumerate(texts):
            if not text:
                continue
            # split at white space first: the raw token -> words step is cached
            if len(cache) > 300_000:
                cache.clear()
            s, inner = 0.0, set()
            for token in set(text.lower().split()):
                have = cache.get(token)
                if have is None:
                    words = WORD.findall(token)
                    if len(words) == 1 and words[0] == token:
                        have = sum(weights.get(f, 0.0) for f in word_features(token))
                    else:
                        have = tuple(words)     # other forms of a word count once
                    cache[token] = have
                if type(have) is tuple:
                    inner.update(have)
                else:
                    s += have
            if inner:
                tokens = set(text.lower().split())
                for w in inner:
                    if w not in tokens:
                        s += sum(weights.get(f, 0.0) for f in word_features(w))
            total[r] = s
        p = model.probabilities(total)
        return pd.DataFrame({"p_clean": p[:, 0], "p_toxic": p[:, 1], "p_severe": p[:, 2],
                             "severity": p[:, 1] + 2 * p[:, 2], "toxic": p[:, 0] < name_rejected})

    return score


def predict(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Per row: doc_id, the grade probabilities, expected severity and the decision."""
    return (docs.select("doc_id", scorer(model)("text").alias("s"))
            .select("doc_id", *[F.round(f"s.{c}", 6).alias(c) for c in ("p_clean", "p_toxic", "p_severe", "severity")], "s.toxic"))


def keep_clean(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``docs`` without the documents that the model rejects, all columns as they were."""
    return docs.where(~scorer(model)("text")["toxic"])
