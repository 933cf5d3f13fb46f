"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymark.llm.byte_bpe import round_trip_digests
from tallymark.llm.common import documents
from tallymark.llm.conversations import REPAIR_SQL, repaired_conversations
from tallymark.llm.embedding_dedup import embedding_components
from tallymark.llm.line_chunks import LINE_DEDUP_SQL, line_dedup
from tallymark.llm.mixing import MIXING_SQL, mix
from tallymark.llm.packing import best_fit_packing
from tallymark.llm.quality_classifier import classify
from tallymark.llm.quality_rules import quality_rules
from tallymark.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from tallymark.llm.resampling import RESAMPLING_SQL, importance_resample
from tallymark.llm.shingle_join import jaccard_components
from tallymark.llm.suffix_dedup import suffix_dedup
from tallymark.llm.token_counts import token_counts
from tallymark.llm.url_lists import URL_LISTS_SQL, filtered_pages


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return token_counts(documents(spark, root), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    return best_fit_packing(documents(spark, root), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_line_dedup", LINE_DEDUP_SQL)
def op9_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    return line_dedup(documents(spark, root), fold=True).select("doc_id", "n_removed", "text")


@query("op3_mixing", MIXING_SQL)
def op3_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mix(documents(spark, root))


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root).select("doc_id", "text")
    return classify(spark, docs, spark.read.parquet(f"{root}/labels.parquet")).drop("text")


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    return jaccard_components(documents(spark, root))


@query("op10_embedding_dedup")
def op10_embedding_dedup(spark: SparkSession, root: str) -> DataFrame:
    return embedding_components(spark.read.parquet(f"{root}/embeddings.parquet"))


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    return quality_rules(documents(spark, root))


@query("op4_url_filter", URL_LISTS_SQL)
def op4_url_filter(spark: SparkSession, root: str) -> DataFrame:
    return filtered_pages(spark, root)


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    return suffix_dedup(documents(spark, root)).drop("kept")


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    return round_trip_digests(documents(spark, root), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN)


@query("op12_importance_resampling", RESAMPLING_SQL)
def op12_importance_resampling(spark: SparkSession, root: str) -> DataFrame:
    return importance_resample(documents(spark, root), spark.read.parquet(f"{root}/benchmark.parquet"))


@query("op13_conversation_repair", REPAIR_SQL)
def op13_conversation_repair(spark: SparkSession, root: str) -> DataFrame:
    return repaired_conversations(spark.read.parquet(f"{root}/conversations.parquet"))
