"""Corpus pipeline: toxicity, line dedup, near-duplicate join, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the next stage
reads what it wrote. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pricelab.llm import common, decontam, line_dedup, ngram_join, packing, toxicity
from pricelab.llm.queries import tokenizer_path
from pricelab.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the ordinal model rejects; the model is fitted on
    the labelled ones of the documents that came in."""
    common.prepare(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that another line stands for; emptied documents go."""
    common.prepare(spark)
    return line_dedup.drop_duplicate_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    common.prepare(spark)
    return ngram_join.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that share a window with the benchmark."""
    common.prepare(spark)
    return decontam.keep_uncontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, placed in sequences."""
    common.prepare(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: Ordinal regression, fuzzy lines and packing are not SQL; tests/llm holds the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written as Parquet and reread."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    home = f"{ensure_checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{i}")
        docs = spark.read.parquet(f"{home}/{i}")
    return docs
