"""Quality classifier: interpolated modified Kneser-Ney character 4-grams.

The model is trained on the whole texts of trusted documents (label quality 1).
Tokens are characters (code points; those above U+FFFE share one symbol), so a
4-gram is one 64-bit number: its context is the upper 48 bits and its suffix the
lower 48. Counts of all distinct grams of the corpus, trusted ones with their
count, are gathered over all documents, grouped by gram; probabilities of every
gram come from equi-joins of the count tables with their contexts, order by
order (counts at the top, continuation counts below, discounts D1, D2, D3+ from
the counts of counts, uniform base).

Scoring: groups of documents join their distinct grams with the probabilities,
sharded by gram, and the answers return to the group, which sums them over each
whole text. A document is kept if its perplexity is at most ``slack`` times the
``quantile`` of the trusted documents of its language (of all trusted ones where a
language has none).

Defined results: a text of fewer than four characters, or null, has no 4-gram:
null perplexity, not kept; without trusted documents every text that can be
scored is kept and perplexity is null; a document labelled twice is trusted only
if every label is; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.llm import common as C

ORDER = 4
QUANTILE = 0.99
SLACK = 1.3
GROUP_BYTES = 12 << 20
BROADCAST_IDS = 2_000_000
_U = np.uint64


def gram_array(text: str) -> np.ndarray:
    """All 4-grams of a text as uint64, 16 bits a character."""
    c = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 0xFFFF).astype(_U)
    if len(c) < ORDER:
        return np.empty(0, _U)
    return (c[:-3] << _U(48)) | (c[1:-2] << _U(32)) | (c[2:-1] << _U(16)) | c[3:]


def _batches(texts: list, limit: int = 1 << 18):
    """Grams of consecutive texts, about ``limit`` at a time: ``(grams, row of each)``."""
    have, rows, size = [], [], 0
    for r, text in enumerate(texts):
        if text:
            g = gram_array(text)
            have.append(g)
            rows.append(np.full(len(g), r, np.int32))
            size += len(g)
        if size >= limit or (r == len(texts) - 1 and have):
            yield np.concatenate(have), np.concatenate(rows)
            have, rows, size = [], [], 0


TRUSTED_ID = "quality_lm:trusted_id"        # no column of the caller's


def trusted_ids(labels: DataFrame) -> DataFrame:
    return (labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
            .where("q >= 1").select(F.col("doc_id").alias(TRUSTED_ID)))


def with_trust(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` and whether each is trusted; the ids are broadcast only if few."""
    ids = C.cut(trusted_ids(labels))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    docs = docs.select(*columns)
    found = F.col(f"`{TRUSTED_ID}`")
    return docs.join(ids, docs["doc_id"] == found, "left").select(*columns, found.isNotNull().alias("trusted"))


def gram_counts(docs: DataFrame) -> DataFrame:
    """``(gram, n)``: every distinct 4-gram of ``docs (text, trusted)`` and its count in
    trusted text (0 if it only occurs elsewhere); each task sends a gram once."""
    def count(batches):
        grams, counts = np.empty(0, _U), np.empty(0, np.int64)
        for b in batches:
            trust = b.column(1).to_numpy(zero_copy_only=False)
            for g, row in _batches(b.column(0).to_pylist()):
                u, back = np.unique(g, return_inverse=True)
                n = np.bincount(back, trust[row].astype(float), len(u)).astype(np.int64)
                both = np.concatenate([grams, u])
                grams, back = np.unique(both, return_inverse=True)
                counts = np.bincount(back, np.concatenate([counts, n]).astype(float), len(grams)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(C.signed(grams)), pa.array(counts)], ["gram", "n"])

    return docs.select("text", "trusted").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts."""
    n = table.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in n)
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d))


def _level(table: DataFrame, context: Column, suffix: Column, lower: DataFrame | None, base: float) -> DataFrame:
    """Probabilities of one order. ``table (gram, n)``, n >= 0; ``lower (gram, p)`` holds
    the probability of every suffix. Returns ``(gram, p)`` for every gram."""
    d1, d2, d3 = _discounts(table)
    n = F.col("n")
    contexts = (table.where(n > 0).groupBy(context.alias("ctx"))
                .agg(F.sum("n").alias("total"), *[F.sum(c.cast("long")).alias(a) for a, c in (("k1", n == 1), ("k2", n == 2), ("k3", n > 2))]))
    left = F.coalesce((d1 * F.col("k1") + d2 * F.col("k2") + d3 * F.col("k3")) / F.col("total"), F.lit(1.0))
    off = F.when(n == 0, 0.0).when(n == 1, d1).when(n == 2, d2).otherwise(d3)
    own = F.coalesce((n - off) / F.col("total"), F.lit(0.0))
    rows = table.withColumn("ctx", context).withColumn("suf", suffix).join(contexts, "ctx", "left")
    if lower is None:
        return rows.select("gram", (own + left * base).alias("p"))
    return (rows.join(lower.select(F.col("gram").alias("suf"), F.col("p").alias("lp")), "suf")
            .select("gram", (own + left * F.col("lp")).alias("p")))


def probabilities(counts: DataFrame) -> DataFrame:
    """``(gram, logp)`` for every gram of ``counts (gram, n)``; lower orders use
    continuation counts: the number of distinct trusted grams that end so."""
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        mask = (1 << (16 * k)) - 1
        up = tables[k + 1]
        tables[k] = C.cut(up.groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum((F.col("n") > 0).cast("long")).alias("n")))
    base = 1.0 / max(1, tables[1].count())
    p = None
    for k in range(1, ORDER + 1):
        context = F.shiftrightunsigned("gram", 16) if k > 1 else F.lit(0).cast("long")
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (16 * (k - 1))) - 1)) if k > 1 else F.lit(0).cast("long")
        p = C.cut(_level(tables[k], context, suffix, p, base))
    return p.select("gram", F.log("p").alias("logp"))


def perplexities(docs: DataFrame, logp: DataFrame) -> DataFrame:
    """``docs (doc_id, lang, text, trusted)`` scored: n_grams and perplexity per row."""
    groups = C.group_count(docs, GROUP_BYTES)
    packed = C.text_groups(docs, groups)

    def ask(key, tab):
        seen = np.empty(0, _U)
        for g, _ in _batches(C.group_rows(tab).column("text").to_pylist()):
            seen = np.union1d(seen, g)
        return pa.table({"g": pa.array(np.full(len(seen), key[0].as_py(), np.int32)), "gram": pa.array(C.signed(seen))})

    answers = packed.groupBy("g").applyInArrow(ask, "g int, gram long").join(logp.withColumn("logp", F.col("logp").cast("float")), "gram")

    def score(left, right):
        rows = C.group_rows(left)
        gram, lp = right.column("gram").to_numpy().view(_U), right.column("logp").to_numpy().astype(float)
        order = np.argsort(gram)
        gram, lp = gram[order], lp[order]
        n, total = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows)
        for g, row in _batches(rows.column("text").to_pylist()):
            at, found = C.lookup(g, gram)
            n += np.bincount(row, minlength=len(n))
            total += np.bincount(row, np.where(found, lp[at], 0.0), len(n))
        ppl = np.exp(-total / np.maximum(n, 1))
        return pa.table({"doc_id": rows.column("doc_id"), "lang": rows.column("lang"), "trusted": rows.column("trusted"),
                         "n_grams": pa.array(n), "perplexity": pa.array(ppl, mask=n == 0)})

    return packed.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(score, "doc_id long, lang string, trusted boolean, n_grams long, perplexity double")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """Per row: doc_id, n_grams, perplexity, its language's threshold, kept."""
    C.prepare(docs.sparkSession)
    flagged = with_trust(docs, labels, ["doc_id", "lang", "text"])
    counts = C.cut(gram_counts(flagged))
    if counts.where("n > 0").isEmpty():
        size = F.greatest(F.char_length("text") - (ORDER - 1), F.lit(0))
        return docs.select("doc_id", F.coalesce(size, F.lit(0)).cast("long").alias("n_grams"), F.lit(None).cast("double").alias("perplexity"),
                           F.lit(None).cast("double").alias("threshold"), F.coalesce(size > 0, F.lit(False)).alias("kept"))
    scored = C.written(perplexities(flagged, probabilities(counts)))
    good = scored.where("trusted and perplexity is not null")
    cut = F.percentile_approx("perplexity", quantile, 10_000) * slack
    by_lang = good.where("lang is not null").groupBy(F.col("lang").alias("l")).agg(cut.alias("lang_cut"))
    overall = good.agg(cut.alias("c")).first()["c"]
    return (scored.join(by_lang, F.col("lang") == F.col("l"), "left").withColumn("threshold", F.coalesce("lang_cut", F.lit(overall)))
            .select("doc_id", "n_grams", F.round("perplexity", 6).alias("perplexity"), F.round("threshold", 6).alias("threshold"),
                    F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept")))
