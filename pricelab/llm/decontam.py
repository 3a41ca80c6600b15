"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``span`` consecutive words of a benchmark item (an item with fewer
words, but not none, is one window). Both sides hash their k-word grams
(k = min(5, span)) and keep, of every run of span - k + 1 grams, the smallest
hash. A window that a document shares has its smallest gram selected on both
sides, so joining the fingerprints finds every shared window. Each hit is then
extended over the whole window and compared word by word; hashes only propose.

The benchmark's fingerprints are counted first. Up to ``broadcast_rows`` of them
are broadcast and the documents' words travel along the scan; beyond that the
fingerprints are joined by a shuffle on narrow rows, and only documents with
candidate hits are read again for the extension.

Defined results: null or wordless text has no words, hits or items; a null item
or null item_id never matches; equal items (by text) each count under their
id; an item_id listed twice counts once; rows that repeat a doc_id or have none are
judged each by its own text (rows are known by doc_id and a hash of the text); extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.llm import common as C

SPAN = 10
GRAM = 5
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z only."""
    # lower() touches A-Z alone when every character is ASCII, and is much faster there
    small = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(small, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), ""), F.array().cast("array<string>"))


def _selected(w: Column, hashes: Column, span: int, gram: int) -> Column:
    """Positions (and hashes) of the grams that winnowing keeps: array<struct<p, h>>.

    A gram is kept if it is the smallest of some run; of equal hashes all are."""
    runs = span - gram + 1
    n_grams = F.size(w) - (gram - 1)
    grams = F.transform(F.sequence(F.lit(0), n_grams - 1), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(gram)]))
    if runs == 1:
        low = lambda g: g                                                       # noqa: E731
    else:
        low = lambda g: F.transform(F.sequence(F.lit(0), F.size(g) - runs),      # noqa: E731
                                    lambda i: F.least(*[F.get(g, i + k) for k in range(runs)]))
    # position p is in the runs p-runs+1 .. p: it is kept if the largest of their minima is its own hash
    def keep(g: Column, m: Column) -> Column:
        if runs == 1:
            return F.transform(g, lambda h, i: F.struct(i.alias("p"), h.alias("h")))
        top = lambda i: F.greatest(*[F.get(m, i - k) for k in range(runs)])      # noqa: E731
        return F.filter(F.transform(g, lambda h, i: F.when(top(i) == h, F.struct(i.alias("p"), h.alias("h")))), lambda s: s.isNotNull())

    found = _let(grams, lambda g: _let(low(g), lambda m: keep(g, m)))
    return F.when(F.size(w) >= span, found).otherwise(F.array().cast("array<struct<p:int,h:bigint>>"))


def _let(value: Column, body) -> Column:
    """Evaluate an array once and use it in ``body`` (a one-element transform)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def item_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """Distinct windows ``(win, words, len, items)`` with the fingerprint ``(h, o)``."""
    items = (benchmark.where("item_id is not null and text is not null")
             .select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
             .withColumn("len", F.least(F.size("w"), F.lit(span))))
    wins = (items.select("item_id", "len", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("len"))).alias("at"))
            .select("item_id", "len", F.expr("slice(w, at + 1, len)").alias("words")))
    return wins.distinct()


def _fingerprints(windows: DataFrame, length: int) -> DataFrame:
    """One selected gram per window of ``length`` words: the leftmost smallest."""
    gram = min(GRAM, length)
    wins = windows.where(F.col("len") == length).select("words").distinct()
    hashed = wins.select("words", _hashes(F.col("words")).alias("x"))
    grams = F.transform(F.sequence(F.lit(0), F.lit(length - gram)), lambda i: F.struct(
        F.xxhash64(*[F.get("x", i + k) for k in range(gram)]).alias("h"), i.alias("o")))
    return hashed.select("words", grams.alias("g")).select("words", F.array_min("g").alias("m")).select("words", "m.h", "m.o")


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return _judged(docs, benchmark, span, broadcast_rows).drop("text_id")


def _text_id() -> Column:
    """Tells rows of one doc_id (or of none) apart."""
    return F.xxhash64("text")


def _judged(docs: DataFrame, benchmark: DataFrame, span: int, broadcast_rows: int) -> DataFrame:
    """``contamination`` with the ``text_id`` of each row."""
    C.prepare(docs.sparkSession)
    windows = C.cut(item_windows(benchmark, span))
    lengths = [r["len"] for r in windows.select("len").distinct().collect()]     # at most span values
    small = windows.count() <= broadcast_rows
    text = docs.select("doc_id", _text_id().alias("text_id"), words(F.col("text")).alias("w"))
    hits = None
    for length in sorted(lengths):
        found = _hits(text, _fingerprints(windows, length), length, small)
        hits = found if hits is None else hits.unionByName(found)
    counted = text.select("doc_id", "text_id", F.size("w").cast("long").alias("n_words"))
    if hits is None:
        per_doc = counted.select("doc_id", "text_id", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items")).limit(0)
    else:
        per_doc = _per_document(C.written(hits), windows)
    none = F.array().cast("array<string>")
    items = F.array_join(F.sort_array(F.coalesce("items", none)), ",")
    return (counted.join(per_doc.withColumnsRenamed({"doc_id": "hit_doc", "text_id": "hit_text"}), _same_row("hit_doc", "hit_text"), "left")
            .select("doc_id", "text_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def _same_row(doc: str, text: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col("text_id") == F.col(text))


def _hits(text: DataFrame, prints: DataFrame, length: int, small: bool) -> DataFrame:
    """``(doc_id, text_id, at, words)``: every occurrence of a window of ``length`` words."""
    gram = min(GRAM, length)
    same = F.expr(f"slice(w, p - o + 1, {length})") == F.col("words")
    seeds = (text.where(F.size("w") >= length).withColumn("x", _hashes(F.col("w")))
             .select("doc_id", "text_id", "w", F.explode(_selected(F.col("w"), F.col("x"), length, gram)).alias("s"))
             .select("doc_id", "text_id", "w", "s.p", "s.h"))
    inside = (F.col("p") >= F.col("o")) & (F.col("p") - F.col("o") + length <= F.size("w"))
    if small:
        joined = seeds.join(F.broadcast(prints), "h")
    else:
        near = seeds.select("doc_id", "text_id", "p", "h").join(prints, "h").select("doc_id", "text_id", "p", "o", "words").distinct()
        joined = near.withColumnsRenamed({"doc_id": "d", "text_id": "t"}).join(text, _same_row("d", "t")).drop("d", "t")
    return joined.where(inside).where(same).select("doc_id", "text_id", (F.col("p") - F.col("o")).alias("at"), "words").distinct()


def _per_document(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Covered words and items of each document from its window occurrences."""
    spans = hits.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.size("words")).alias("end")))).alias("s"))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last"))
    covered = F.aggregate("s", zero, lambda a, x: F.struct(
        (a["sum"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["at"], a["last"]))).alias("sum"),
        F.greatest(a["last"], x["end"]).alias("last")))["sum"]
    of_window = windows.select("words", "item_id").distinct()
    items = (hits.select("doc_id", "text_id", "words").distinct().join(of_window, "words")
             .groupBy("doc_id", "text_id").agg(F.collect_set("item_id").alias("items")))
    return (spans.select("doc_id", "text_id", covered.alias("n_hit"))
            .join(items.withColumnsRenamed({"doc_id": "d", "text_id": "t"}), _same_row("d", "t")).drop("d", "t"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` without the rows whose text shares a window with the benchmark."""
    bad_id, bad_text = "decontam:bad_id", "decontam:bad_text"       # no column of the caller's
    bad = (_judged(docs, benchmark, span, BROADCAST_ROWS).where("contaminated")
           .select(F.col("doc_id").alias(bad_id), F.col("text_id").alias(bad_text)).distinct())
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(f"`{bad_id}`")) & (_text_id() == F.col(f"`{bad_text}`")), "left_anti")
