"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Every stage takes the whole table that its predecessor kept and, but for the last, returns its columns. Null texts count
as empty and become empty once a stage rewrites texts; a null doc_id stays null and counts as the smallest id. Of equal
scores and fingerprints all share one fate, so ties never depend on order. Repeated rows stay repeated, unless they are
near-duplicates of a row with a smaller id. An empty table passes through every stage, and without labels of both kinds
the classifier gives every document the same score.
"""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from sedimark.llm import linededup, packing, quality, simhash, suffixdedup
from sedimark.llm.common import documents, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go: those with a score under its threshold. Empty texts are scored too."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that many documents repeat; the largest doc_id that holds a line keeps it. A document that loses all its lines stays, empty."""
    return linededup.dedup_lines(docs).select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest doc_id; all empty texts are one group."""
    return simhash.without_near_duplicates(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the strings of 50 bytes and more that a document of smaller doc_id has, whole copies included."""
    return suffixdedup.without_repeats(docs)


def vector_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences; an empty text is the closing token alone."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("vector_packing", vector_packing),
]

#: A trained classifier, XXH64 and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
