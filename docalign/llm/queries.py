"""The registered queries of the operators: each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docalign.llm import html_text, language, licenses, line_rules, mixing, phrases, prefix_trie, simhash, suffix_dedup
from docalign.llm import token_counts, token_files, topk
from docalign.llm.bpe import bpe_digests


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_counts(documents(spark, folder))


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_file_digests(documents(spark, folder), _vocabulary("byte_bpe_50k.json"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, folder))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(documents(spark, folder), _vocabulary("word_bpe_49k.json"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = _vocabulary("word_bpe_49k.json")
    return token_counts.document_token_counts(documents(spark, folder), vocabulary, end_id=49407)


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return html_text.extract_text(pages, html_text.labelled_weights(pages))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op9_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.line_rules(documents(spark, folder))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(documents(spark, folder)).drop("matches")


def op11_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.predict_held_out(documents(spark, folder))


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(documents(spark, folder))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


ALL = [
    op1_mixing, op2_topk, op3_token_files, op4_suffix_dedup, op5_bpe, op6_token_counts, op7_html_text, op8_simhash,
    op9_line_rules, op10_licenses, op11_language, op12_phrases, op13_prefix_trie,
]


def queries():
    return {q.__name__: q for q in ALL}
