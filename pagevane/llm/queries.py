"""The registered queries of this subpackage: one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagevane.session import ship_package

from . import archives, bpe, fingerprints, jaccard, licenses, lines, near_vectors, packing, personal, prefixes, repair
from . import substrings, toxicity
from .common import small_batches, table

Query = Callable[[SparkSession, str], DataFrame]
RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    small_batches(spark)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return table(spark, sf_dir, "documents")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.scored(docs, table(spark, sf_dir, "labels"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return bpe.encode_digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), CAPACITY)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(_documents(spark, sf_dir))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_documents(spark, sf_dir))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.span_digest(_documents(spark, sf_dir))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_documents(spark, sf_dir))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), "evidence")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digest(_documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return repair.repair_digest(table(spark, sf_dir, "conversations"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return prefixes.trie_digest(table(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return archives.archived(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_personal_data": op7_personal_data,
    "op8_fingerprints": op8_fingerprints,
    "op9_license_scan": op9_license_scan,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": lines.SQL,
    "op5_embedding_near_dedup": near_vectors.SQL,
    "op6_ngram_jaccard": jaccard.SQL,
    "op10_substring_dedup": substrings.SQL,
    "op11_conversation_repair": repair.SQL,
    "op12_prefix_trie": prefixes.SQL,
    "op13_warc": archives.SQL,
}
