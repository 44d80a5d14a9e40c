"""The operators bound to the test tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    chat,
    decontaminate,
    embedding_dups,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    spelling,
    suffix_dedup,
    token_alignment,
    token_counts,
    url_filters,
)
from tidemark.llm.common import documents, importable

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    rows = chat.probe(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat.read_back(chat.format_conversations(rows))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan_licenses(documents(spark, sf_dir)))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated = mixing.mixed_rates(documents(spark, sf_dir).select("doc_id", "text"), labels)
    return rated.drop("text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), vocabulary())


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(documents(spark, sf_dir).select("doc_id", "text"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return suffix_dedup.summary(docs, suffix_dedup.removed_spans(docs))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contained_items(documents(spark, sf_dir), items)


def op10_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return embedding_dups.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filters.judge_urls(pages, url_filters.ENTRIES).drop("url")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return token_alignment.summary(docs, vocabulary("byte_bpe_50k.json"), vocabulary())


def queries() -> dict[str, Query]:
    named = (
        op1_language_id,
        op2_chat_format,
        op3_license_scan,
        op4_mixing,
        op5_token_counts,
        op6_ngram_join,
        op7_line_dedup,
        op8_suffix_dedup,
        op9_decontaminate,
        op10_embedding_dups,
        op11_url_filters,
        op12_spelling_variants,
        op13_token_alignment,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": chat.sql(),
        "op9_decontaminate": decontaminate.sql(),
        "op11_url_filters": url_filters.sql(),
    }
