"""The corpus operators as registered queries, with SQL where SQL can express them."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from sedimark.llm import bpe, htmltext, linededup, media, mtree, packing, quality, sharding, simhash, suffixdedup
from sedimark.llm.common import documents


def op1_webp_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digests(linededup.dedup_lines(documents(spark, sf_dir)))


def op3_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digests(suffixdedup.remove_repeats(documents(spark, sf_dir)))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    "op1_webp_media": op1_webp_media,
    "op2_line_dedup": op2_line_dedup,
    "op3_minimax_sharding": op3_minimax_sharding,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_mtree_topk": op6_mtree_topk,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_vector_packing": op9_vector_packing,
    "op10_html_extraction": op10_html_extraction,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": linededup.ORACLE,
    "op4_suffix_array_dedup": suffixdedup.ORACLE,
    "op6_mtree_topk": mtree.ORACLE,
}
