"""Registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.llm import (exact_dedup, hard_negatives, host_quality, html_extract, lattice_dedup,
                            mixing, ngram_join, packing, quote_links, rff_quality, secret_scan,
                            url_filter, whitening)
from eventmarts.llm.common import read
from eventmarts.llm.oracle import ORACLES  # noqa: F401


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(read(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        mixing.words_taken(F.col("segments")).alias("taken"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "rule string, verdict string")
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


def op5_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.host_rules(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op8_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.conversations(read(spark, sf_dir, "conversations"))


def op9_lattice_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rff_quality.score_documents(read(spark, sf_dir, "documents"),
                                       read(spark, sf_dir, "labels"))


def op11_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings")).withColumn(
        "deviation", whitening.as_long("deviation"))


def op12_extendible_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, sf_dir, "documents"))


def op13_zone_map_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_source_mixing": op2_source_mixing,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_url_filter": op4_url_filter,
    "op5_host_quality_rules": op5_host_quality_rules,
    "op6_secret_scan": op6_secret_scan,
    "op7_html_extraction": op7_html_extraction,
    "op8_quote_linking": op8_quote_linking,
    "op9_lattice_near_dup": op9_lattice_near_dup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_spectrum_whitening": op11_spectrum_whitening,
    "op12_extendible_hash_dedup": op12_extendible_hash_dedup,
    "op13_zone_map_negatives": op13_zone_map_negatives,
}
