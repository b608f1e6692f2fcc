"""The named queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telepulse.llm import (
    bpe,
    chat,
    collocations,
    context_tree,
    cotraining,
    cross_polytope,
    fingerprints,
    mixing,
    partition_index,
    pii,
    repair,
    setsketch,
    token_counts,
)
from telepulse.llm.tables import read_table


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_texts(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op4_partition_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_index.nearest(read_table(spark, sf_dir, "embeddings"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(read_table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(read_table(spark, sf_dir, "conversations"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_rates(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


def op10_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_context_tree": op1_context_tree,
    "op2_token_counts": op2_token_counts,
    "op3_pii": op3_pii,
    "op4_partition_search": op4_partition_search,
    "op5_bpe": op5_bpe,
    "op6_chat": op6_chat,
    "op7_mixing": op7_mixing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_fingerprints": op9_fingerprints,
    "op10_cotraining": op10_cotraining,
    "op11_near_vectors": op11_near_vectors,
    "op12_collocations": op12_collocations,
    "op13_repair": op13_repair,
}

ORACLES: dict[str, str] = {
    "op6_chat": chat.chat_sql(),
    "op8_near_duplicates": setsketch.near_duplicates_sql(),
    "op11_near_vectors": cross_polytope.near_vectors_sql(),
    "op12_collocations": collocations.collocations_sql(),
    "op13_repair": repair.repair_sql(),
}
