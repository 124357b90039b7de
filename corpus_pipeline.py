"""A training corpus in stages, each on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. ``run`` writes each
stage as Parquet to the shared folder and reads it again, so a lost executor costs no
earlier stage.

Defined cases: null and empty texts and texts of under ten words are no training text and go
with the first stage; repeated rows are near copies, of which one stays; long texts are taken
whole; other columns come through to the last stage, whatever their names; an empty table
stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docalign.llm.bpe import encode_ids
from docalign.llm.common import Stash
from docalign.llm.line_rules import keep_by_rules
from docalign.llm.mixing import mix_documents
from docalign.llm.simhash import keep_one_of_near_copies
from docalign.llm.suffix_dedup import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_by_rules(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one_of_near_copies(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that start earlier too."""
    return remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: ``doc_id, source, n_tokens, ids``."""
    import public_tokenizers

    return encode_ids(docs, public_tokenizers.path("word_bpe_49k.json"), keep=("doc_id", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash", near_dedup),
    ("suffix dedup", suffix_dedup),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL cannot express byte-pair encoding; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    stash = Stash(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
