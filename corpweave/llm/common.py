"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpweave.shipping import shipped

#: rows in an Arrow batch handed to Python; texts may be very long.  It is the same for every
#: operator, so it does not matter which plan was made last; it stays set in the session
BATCH_ROWS = 256

Emit = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Gives back what a worker's last task held; workers are used again."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _in_slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, in a session whose Arrow batches have at most `BATCH_ROWS` rows."""
    shipped(df.sparkSession).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def mapped(df: DataFrame, emit: Emit, schema: str | StructType, rows: int = BATCH_ROWS) -> DataFrame:
    """`df.mapInArrow(emit, schema)` on batches of at most `rows` rows, so that a worker's
    memory follows the length of a few texts, not of ten thousand; at its end a task
    gives its memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from emit(_in_slices(batches, rows))
        finally:
            release()

    return small_batches(df).mapInArrow(run, schema)
