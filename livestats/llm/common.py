"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Later passes read the written rows, so a lost executor costs one scan of
    a file and not the whole lineage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/livestats-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(text: str = "text") -> Column:
    """The text column with NULL read as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def release() -> None:
    """Give the memory that a task or a fit has freed back to the system, as its Python worker or the driver lives on."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


#: Texts handled at once in a task, in bytes.
BATCH_BYTES = 16_000_000


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have ``most`` bytes at most, or are a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
