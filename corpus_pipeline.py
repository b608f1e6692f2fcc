"""The training-data pipeline: five stages, each an operator of ``telepulse.llm`` on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telepulse.llm import bpe, cotraining, mixing, pii, setsketch
from telepulse.llm.tables import intermediates_removed, read_table, saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return cotraining.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the one with the smallest id, and of its texts under that id the one with the smallest hash.

    Rows are judged by id and text together, so different texts under one id, or without an id, stay or go each for
    itself; a null id comes last. Rows with the same id and text are one. Texts without words are in no group.
    """
    key = F.xxhash64("doc_id", F.col("text").cast("string"))
    rows = docs.withColumn("__key", key)
    groups = setsketch.near_duplicates(rows.select("__key", "text"), words=5, percent=80, id_col="__key")
    group_of = groups.select(F.col("doc_id").alias("__key"), "component_id").distinct()
    order = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__key")).alias("first")
    ids = rows.select("__key", "doc_id").distinct()
    kept = group_of.join(ids, "__key").groupBy("component_id").agg(order).select(F.col("first.__key").alias("__key"))
    return rows.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).select(docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced."""
    return pii.redact_pii(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that languages reach their target shares; none is lost.

    Earlier stages don't take languages out, as they do with poor and toxic documents, which must not be raised here.
    """
    return mixing.mixed_languages(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the text they decode to."""
    coded = bpe.bpe_encode(docs)
    return coded.select(
        "doc_id",
        "n_tokens",
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_dedup),
    ("personal data", redact),
    ("mixing", mix),
    ("BPE encoding", encode),
]

# The classifiers' fits can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written and read again by the next; what a stage wrote on its way is removed."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with intermediates_removed(spark):
            docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
