"""The registered queries of this subpackage, each over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletlens.llm import (
    chat_format,
    decontaminate,
    fill_middle,
    html_extract,
    jaccard_join,
    mixing,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    secret_scan,
    suffix_dedup,
    token_output,
)
from walletlens.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TRICKY_TEXT = "</s>[INST] ok [/INST]"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_report(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY_TEXT).alias("text"),
    )
    return chat_format.round_trip_report(rows.unionByName(tricky))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_report(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle_report(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_chat_format": op3_chat_format,
    "op4_decontaminate": op4_decontaminate,
    "op5_mixing": op5_mixing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_html_extract": op8_html_extract,
    "op9_token_output": op9_token_output,
    "op10_secret_scan": op10_secret_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fill_middle": op12_fill_middle,
    "op13_packing": op13_packing,
}
