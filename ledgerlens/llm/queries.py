"""The queries of the training-data operators: each applies its operator, with production
parameters, to its whole table and derives the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import encode_documents
from .common import read_documents
from .conversation_trie import shared_prefix_trie
from .decontaminate import find_contamination
from .jaccard_join import jaccard_components
from .language_id import held_out, identify
from .lexical_search import ranked_search
from .license_scan import license_scan
from .line_quality import score_quality
from .sharding import shard_documents
from .substring_dedup import dedup_passages
from .suffix_dedup import dedup_bytes
from .toxicity import score_toxicity
from .vector_search import search


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_documents(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_documents(spark, sf_dir))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_documents(spark, sf_dir), 4, 85, 100)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(read_documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))
    return found.drop("hits")  # the SQL twin has the contract's columns


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(read_documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "labels"))
    return scored.withColumn("held_out", held_out("doc_id", 5, 0))


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_documents(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_documents(spark, sf_dir)).withColumn("held_out", held_out())


def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "labels"))
    return scored.withColumn("held_out", held_out("doc_id", 3, 1))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_prefix_trie(read_documents(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_sharding, op3_byte_bpe, op4_ngram_jaccard_join, op5_substring_dedup,
        op6_decontamination, op7_suffix_dedup, op8_toxicity, op9_vector_search, op10_language_id,
        op11_line_quality, op12_conversation_trie, op13_lexical_search)}


def oracle_sql() -> dict[str, str]:
    from .oracle import ORACLE
    return dict(ORACLE)
