"""The corpus queries, each with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starwash.llm import (
    chat, clusters, decontaminate, maintext, mixing, negatives, quality, secrets, simhash, substring, suffixes, tokens, urls,
)
from starwash.llm.common import table


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_and_read(table(spark, sf_dir, "documents"), vocabulary())


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeated_words(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, urls.labelled_urls(spark))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, seventh = F.col("label").cast("long"), F.col("vec_id") % 7 == 0
    label = F.when(seventh, (label + 1) % 10).otherwise(label).cast("int")
    return negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings"), label)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract_main_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scans, op2_simhash_near_dedup, op3_chat_formatting, op4_mixing, op5_suffix_array_dedup,
        op6_token_output, op7_substring_dedup, op8_benchmark_decontamination, op9_quality_rules, op10_url_filters, op11_hard_negatives,
        op12_centroid_clustering, op13_html_extraction,
    )
}
