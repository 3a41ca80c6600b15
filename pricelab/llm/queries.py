"""Registered queries of the training-data operators (and SQL where it can express them).

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelab.llm import common as C
from pricelab.llm import decontam, hnsw, langid, line_dedup, line_rules, ngram_join, packing, prefix_trie, quality_lm, quotes, shallot, suffix_dedup, toxicity
from pricelab.llm.sql import CLUSTERING, NEAR_DEDUP, PREFIX_TRIE


def tokenizer_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, non-blank lines, removed lines and the text that stays."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op3_chat_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(C.table(spark, sf_dir, "conversations"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(C.table(spark, sf_dir, "documents"), tokenizer_path())


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(C.table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    docs = C.table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, C.table(spark, sf_dir, "labels")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    docs = C.table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.classify(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    docs = C.table(spark, sf_dir, "documents")
    return line_rules.judge(docs, line_rules.fit(docs, C.table(spark, sf_dir, "labels")))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(C.table(spark, sf_dir, "documents"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(C.table(spark, sf_dir, "embeddings"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(C.table(spark, sf_dir, "conversations"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.cluster(C.table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_chat_quotations": op3_chat_quotations,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_quality_rules": op9_quality_rules,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_centroid_clustering": op13_centroid_clustering,
}

#: None of the operators is given SQL unless listed here; the others are tested
#: against brute-force versions (tests/llm).
SQL: dict[str, str] = {
    "op11_embedding_near_dedup": NEAR_DEDUP,
    "op12_conversation_prefix_trie": PREFIX_TRIE,
    "op13_centroid_clustering": CLUSTERING,
}
