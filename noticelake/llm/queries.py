"""The numbered operators as queries over the given tables, with the columns their contracts name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.session import configure

from . import chat, collocations, ctw, divergence, extraction, host_rules, mixing, oracles, packing, quality, simhash, substrings, topk, url_filter

#: The contract's tokenizer: its file, the same vocabulary as ranks, and the pattern of both.
CODER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
QUERIES: dict = {}
ORACLES: dict[str, str] = oracles.SQL


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scores(table(spark, sf_dir, "documents"), quality.fold(F.col("doc_id"), 7) == 2)


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    judged = quality.scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    score = F.col("score")
    return judged.select(
        "doc_id", (quality.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", F.when(score >= 0.3, 1).otherwise(0).alias("predicted")
    )


@query
def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.main_text(pages, extraction.fit_labeller(pages))


@query
def op4_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.quantized(table(spark, sf_dir, "embeddings"), 64), F.col("vec_id") % 20 == 0, k=20)


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.cut_documents(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), size=3, radius=2)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.with_digests(packing.pack(docs, CODER))


#: Fixed by the contract.
URL_RULES = [
    url_filter.Rule("com", "/", "allow"), url_filter.Rule("example.com", "/en/", "block"), url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"), url_filter.Rule("net", "/fr/", "block"),
]


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.host_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.col("host").alias("source"), F.round("host_rate", 9).alias("host_rate"),
    )


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


#: Fixed by the contract: what both turns of conversation -1 say.
MARKED = "</s>[INST] ok [/INST]"


@query
def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    marked = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(MARKED).alias("text"))
    return chat.digests(chat.formatted(turns.unionByName(marked)))


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))
