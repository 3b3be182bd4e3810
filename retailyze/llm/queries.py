"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, fingerprints, langid, ngram_lm, orchard, packing, pieces, qda, rules, sharding,
               simhash, variants)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_path() -> str:
    """The public word-level BPE file; a parameter of every operator that reads it."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def piece_model_path() -> str:
    """The public SentencePiece model; a parameter of the operator that reads it."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op9_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op9(table(spark, sf_dir, "documents"))


@_query
def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op4(table(spark, sf_dir, "documents"), tokenizer_path())


@_query
def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op1(table(spark, sf_dir, "documents"), tokenizer_path())


@_query
def op3_decision_list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.op3(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op5_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qda.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op10_partial_matching_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op10(table(spark, sf_dir, "documents"))


@_query
def op2_simhash_deletion_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op2(table(spark, sf_dir, "documents"))


@_query
def op8_chat_incremental_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op8(spark, table(spark, sf_dir, "conversations"))


@_query
def op7_backoff_automaton_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.op7(table(spark, sf_dir, "documents"))


@_query
def op6_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.op6(spark, table(spark, sf_dir, "documents"))


@_query
def op11_kd_tree_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.op11(table(spark, sf_dir, "documents"))


@_query
def op12_prefix_table_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.op12(table(spark, sf_dir, "documents"), piece_model_path())


@_query
def op13_orchard_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.op13(table(spark, sf_dir, "embeddings"))


ORACLE["op13_orchard_clustering"] = orchard.ORACLE_SQL
