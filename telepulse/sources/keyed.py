"""Tables with one row a key: batches are merged into the partitions they touch.

A merge reads only those partitions, keeps the last row of each key and writes
them again. The new content is complete in a journal folder beside the table
before a partition of it is replaced, so a job that is lost on the way is
finished by the next merge. A batch that is merged again changes nothing.
Partitions are compacted by this: their number of files follows their size.

One writer at a time may merge into a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telepulse.sources.files import folders, path_exists, remove_folder


def _journal(path: str) -> str:
    return f"{path.rstrip('/')}__merging"


def _replace(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    (
        rows.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def finish_merges(spark: SparkSession, path: str, schema: str, partitions: Sequence[str]) -> int:
    """Carry out what lost merges had written down; how many there were. An incomplete journal is dropped."""
    done = 0
    for entry in folders(spark, _journal(path)):
        if path_exists(spark, f"{entry}/_SUCCESS"):
            _replace(spark.read.schema(schema).parquet(entry), path, partitions)
            done += 1
        remove_folder(spark, entry)
    return done


def in_partitions(values: list[tuple], partitions: Sequence[str]) -> Column:
    """Predicate on text partition columns that prunes folders; one lookup, however many values there are."""
    place = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in partitions])
    return place.isin(["/".join(v or "" for v in row) for row in values])


def last_per_key(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row a key, the first by ``order``; chosen in each task before the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__place", F.row_number().over(first)).where("__place = 1").drop("__place")


def merge(
    batch: DataFrame, path: str, schema: str, keys: Sequence[str], partitions: Sequence[str], *, newest: Sequence[Column] = ()
) -> None:
    """Merge ``batch`` (with all columns of ``schema``) into the table at ``path``.

    ``keys`` include the partition columns or determine them. Rows of the batch replace stored ones of their key;
    of several in a batch the one with the largest ``newest`` (columns of the batch, stored or not) stays, then the
    first by all columns, so ties have one outcome.
    """
    spark = batch.sparkSession
    finish_merges(spark, path, schema, partitions)
    names = [field.name for field in spark.createDataFrame([], schema).schema]
    kinds = dict(spark.createDataFrame([], schema).dtypes)
    age = [f"__newest_{i}" for i in range(len(newest))]
    rows = batch.select(
        *[F.col(name).cast(kinds[name]).alias(name) for name in names],
        *[column.alias(name) for column, name in zip(newest, age, strict=True)],
    )
    touched = [tuple(row) for row in rows.select(*partitions).distinct().collect()]  # a name a partition, no data
    if not touched:
        return
    rows = rows.withColumn("__stored", F.lit(False))
    if path_exists(spark, path):
        stored = spark.read.schema(schema).parquet(path).where(in_partitions(touched, partitions))
        rows = rows.unionByName(stored.withColumn("__stored", F.lit(True)), allowMissingColumns=True)
    sortable = [F.to_json(name) if kinds[name].startswith("map") else F.col(name) for name in names]
    order = [F.col("__stored"), *map(F.desc_nulls_last, age), *(F.asc_nulls_last(c) for c in sortable)]
    merged = last_per_key(rows, keys, *order).select(*names)
    entry = f"{_journal(path)}/{uuid.uuid4().hex}"
    merged.write.parquet(entry)
    _replace(spark.read.schema(schema).parquet(entry), path, partitions)
    remove_folder(spark, entry)
