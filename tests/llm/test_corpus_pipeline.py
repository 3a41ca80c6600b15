"""The pipeline's stages: columns, effect of each decision, and the packed result."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P  # noqa: E402

from pricelab.llm import decontam, line_dedup, ngram_join, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    schema, kept = docs.columns, [docs.count()]
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    for i, (_, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == schema
        out.write.parquet(f"{scratch}/{i}")
        before, docs = docs, spark.read.parquet(f"{scratch}/{i}")
        kept.append(docs.count())
        ids = {r.doc_id for r in docs.collect()}
        if i == 0:
            bad = {r.doc_id for r in toxicity.predict(before, toxicity.fit(before, labels)).where("toxic").collect()}
            assert ids == {r.doc_id for r in before.collect()} - bad
        if i == 1:
            assert line_dedup.dedup_lines(docs).agg({"n_removed": "sum"}).first()[0] == 0
        if i == 2:
            assert not ngram_join.join_components(docs).where("component_id <> doc_id").count()
        if i == 3:
            assert not decontam.contamination(docs, bench).where("contaminated").count()
            assert all(r.doc_id in ids for r in decontam.contamination(before, bench).where("not contaminated").collect())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    assert P.ORACLE_SQL is None
