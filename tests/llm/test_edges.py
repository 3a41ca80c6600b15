"""Edge cases that earlier tests left out: clashing columns, empty tables, bounded samples, even shards."""

import numpy as np
import pytest

from pricelab.llm import common as C, decontam, langid, line_rules, packing, quality_lm, suffix_dedup, toxicity
from pricelab.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def test_clashing_column_names(spark):
    words = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, words, "en", 5, "x"), (2, "clean text", "en", 6, "y")], "doc_id long, text string, lang string, bad_id long, bad_text string")
    bench = spark.createDataFrame([("a", words)], "item_id string, text string")
    out = decontam.keep_uncontaminated(df, bench).collect()
    assert [r.asDict() for r in out] == [{"doc_id": 2, "text": "clean text", "lang": "en", "bad_id": 6, "bad_text": "y"}]
    named = df.withColumnsRenamed({"bad_id": "t_id", "bad_text": "trusted"})
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in quality_lm.classify(named, labels).collect()} == {1, 2}


def test_letters_anywhere_in_a_word(spark):
    samples = [("en", "the house and the garden with trees".split() * 20), ("de", "das haus und der garten mit bäumen".split() * 20)]
    model = langid.train_crf(samples, ["de", "en"])
    out = langid.predictor(model).func(__import__("pandas").Series(["²a", "²³", "12 _", None, "", "the garden"]))
    assert list(out["lang_pred"][1:5]) == ["und"] * 4 and out["lang_pred"][0] in ("de", "en") and out["lang_pred"][5] == "en"


def test_whole_words_have_trigrams():
    long = "ab" * 40 + "xyz"
    assert set(langid.word_features(long, {})) != set(langid.word_features(long[:40] + "c" + long[41:], {}))
    assert len(langid.word_features(long, {})) == len(long) + 1 + 8


def test_rare_toxicity_fills_the_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}", None, None, None) for i in range(4000)], DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 100 == 0)) for i in range(4000)], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(docs, labels, 400).collect()
    toxic = [r for r in sample if r.toxic]
    assert len(toxic) == 40 and len(sample) < 500
    total = {k: sum(r.weight for r in sample if r.toxic == k) for k in (0, 1)}
    assert total[1] == pytest.approx(40) and total[0] == pytest.approx(3960, rel=0.15)
    assert toxicity.labelled_sample(docs, labels.limit(0)).collect() == []


def test_sample_is_broadcast(spark, capsys):
    docs = spark.range(1000).select(C.F.col("id").alias("doc_id"), C.F.lit("t").alias("text"))
    C.rows_of(docs, spark.range(10).withColumnRenamed("id", "doc_id"), 10).explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
    C.rows_of(docs, spark.range(100).withColumnRenamed("id", "doc_id").repartition(3), 10).hint("merge").explain()
    assert C.rows_of(docs, spark.range(100).withColumnRenamed("id", "doc_id"), 10).count() == 100


def test_suffix_shards_are_even(spark):
    """Minimisers are least values of many hashes; the values that route them are not."""
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    m = np.concatenate([suffix_dedup.window_runs(raw, offs)[0] for _, raw, offs in C.chunks(C.pa.array(texts))])
    m = np.unique(m)
    size = np.bincount((m >> np.uint64(64 - 5)).astype(int), minlength=32)
    assert len(m) > 3000 and size.max() < 2 * size.mean()


def test_periodic_text_has_short_runs():
    raw = np.frombuffer(b"-" * 100_000 + b"=-" * 5000, np.uint8)
    m, start, end, row = suffix_dedup.window_runs(raw, np.array([0, 100_000, 110_000]))
    assert (end - start).max() <= suffix_dedup.RUN_WINDOWS + suffix_dedup.LENGTH - 1
    for r, lo, hi in ((0, 0, 100_000), (1, 100_000, 110_000)):
        windows = np.concatenate([np.arange(a, b - suffix_dedup.LENGTH + 1) for a, b in zip(start[row == r], end[row == r])])
        assert windows.tolist() == list(range(lo, hi - suffix_dedup.LENGTH + 1))


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert packing.pack_documents(none, tokenizer_path()).collect() == []
    assert toxicity.predict(none, toxicity.fit(none, labels)).collect() == []
    assert line_rules.judge(none, line_rules.fit(none, labels)).collect() == []
    assert quality_lm.classify(none, labels).collect() == []
    assert suffix_dedup.dedup_substrings(none).collect() == []
    import corpus_pipeline
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_suffix_dedup_odd_rows(spark):
    """Null ids, very long texts and extra columns."""
    line = "".join(chr(97 + i % 26) + str(i) for i in range(40))
    rows = [(None, line, 1), (None, line, 2), (3, line + "x" * 200_000, 3), (3, line, 4), (5, None, 5), (6, "x" * 60, 6)]
    out = sorted(((r.doc_id or -1, r.n_bytes, r.n_removed) for r in suffix_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string, shard int")).collect()))
    n = len(line)
    assert out == sorted([(-1, n, n), (-1, n, n), (3, n + 200_000, 0), (3, n, 0), (5, 0, 0), (6, 60, 60)])
