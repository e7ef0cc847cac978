"""Helpers of this folder: inputs, the shared scratch folder, learning folds."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Ids are broadcast only up to this many (8 bytes each); beyond it Spark shuffles.
BROADCAST_IDS = 1_000_000
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to a new table in the shared checkpoint folder and read it back.

    The lineage ends there, so a lost executor repeats only the current step.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 0 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def small_or_shuffled(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint only where the counted rows are under the bound."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df


def give_back() -> None:
    """Return what a task has freed to the system: Python workers live on between stages,
    and what they keep for themselves counts against the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


#: Rows that a Python stage handles at a time, of however large an Arrow batch.
SLICE_ROWS = 512


def per_slice(f: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = SLICE_ROWS):
    """``f`` of each Arrow batch in slices of so many rows, for ``mapInArrow``: what a task
    holds beside the batch itself is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield f(batch.slice(at, rows))
            give_back()

    return run
