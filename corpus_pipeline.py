"""Corpus pipeline over ``documents``: what is good, not a copy, not leaked, packed into training sequences.

Each stage reads what its predecessor kept, written as Parquet. All but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlens.llm import decontaminate, exact_dedup, jaccard, packing, quality
from seasonlens.llm.queries import table, tokenizer
from seasonlens.session import share_package, stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.good_rows(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id; documents without an id stay."""
    found = jaccard.near_duplicates(docs)
    gone = stage(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    return docs.join(jaccard.broadcast_if_small(gone), F.col("doc_id") == F.col("__gone"), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, in sequences."""
    return packing.packed_documents(docs, tokenizer("word_bpe_49k.json"))


def _anywhere(step):
    """The stage, also where the session's Python workers do not have the package yet."""

    @wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        share_package(spark)
        return step(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality classifier", _anywhere(keep_quality)),
    ("exact dedup", _anywhere(drop_copies)),
    ("n-gram Jaccard join", _anywhere(drop_near_copies)),
    ("benchmark decontamination", _anywhere(drop_leaks)),
    ("packing", _anywhere(pack)),
]

#: the classifier and the tokenizer cannot be written in SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from ``documents``; runs all but the last when it is called."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{i}")
    return docs
