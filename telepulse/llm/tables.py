"""Reading the tables, batch limits and intermediate tables shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from telepulse.session import shared_folder
from telepulse.sources.files import remove_folder

BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Arrow batches to Python end at ``size`` bytes, however long the rows are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


_MADE: list[str] = []  # folders of this process that hold intermediate tables


@contextmanager
def intermediates_removed(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``saved`` writes within, but for what is kept: for a result that has been written."""
    start = len(_MADE)
    try:
        yield
    finally:
        for path in _MADE[start:]:
            remove_folder(spark, path)
        del _MADE[start:]


def saved(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that its lineage ends here.

    The folder stays until a surrounding ``intermediates_removed`` ends; one to ``keep`` is left to the caller.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if not keep:
        _MADE.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``size`` bytes in each, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def texts(column: pa.Array) -> list[str]:
    """Texts of a column; null is the empty text."""
    return [text or "" for text in column.to_pylist()]
