"""From raw documents to packed token sequences: reject, deduplicate, cut repeated spans, mix and pack.

Every stage reads what its predecessor kept and returns the columns of documents (the last one: packed pieces), so each can
run by itself. run() writes each result to the folder that all executors share and reads it back.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm import mixing, packing, quality, simhash, substrings
from noticelake.session import configure, shared_dir

CODER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labels, doesn't reject."""
    configure(spark)
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of equal or near texts (five-word shingles, similarity 0.8 or more)."""
    configure(spark)
    return simhash.near_duplicates(docs, size=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans of 50 words and more that an earlier document holds; n_chars follows the text."""
    configure(spark)
    cut = substrings.without_repeats(docs)
    return cut.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, in shuffled shards."""
    configure(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 1024 ids."""
    configure(spark)
    return packing.pack(docs, CODER)


STAGES = [("quality", classify), ("near_duplicates", deduplicate), ("substrings", cut_repeats), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{os.urandom(8).hex()}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
