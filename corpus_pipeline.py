"""A training-corpus pipeline over ``documents``: five stages, each one operator.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns
of ``documents``.

1. ``quality_classifier``: documents that the classifier rejects go.
2. ``ngram_jaccard_join``: one document of each near-duplicate class stays, the one with
   the smallest id; rows without an id stay, since they cannot be named.
3. ``secret_scan``: spans are masked in the text, ``n_chars`` of a masked text follows.
4. ``source_mixing``: rows are the parts that the mix takes, repeats included.
5. ``best_fit_packing``: the pieces of the mixed rows and their places in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventmarts.llm import mixing, ngram_join, packing, rff_quality, secret_scan
from eventmarts.llm.common import prepare, read, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return rff_quality.keep_good(docs, read(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.keep_one(docs)


def secret_scanning(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scan", secret_scanning),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# The classifier, the tokenizer and the packing are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
