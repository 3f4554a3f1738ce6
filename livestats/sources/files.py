"""File-backed sources: delimited text lines (S4) and table reads."""

from __future__ import annotations

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text lines (column ``value``) from a folder, as a batch or a stream.

    Replaces the socket text source: files are replayable and the read is
    split across tasks.
    """
    if not stream:
        return spark.read.text(path)
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.text(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows when the scan yields fewer partitions than the
    cluster can run at once (one large unsplittable file).

    Only for CPU-heavy per-row work such as JSON text.  On a cluster reading
    many files the scan is already split and nothing is added.
    """
    spark = df.sparkSession
    try:
        want = min_partitions or spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except (AttributeError, PySparkNotImplementedError):  # a Spark Connect session: leave the scan as it is
        return df
    return df.repartition(want) if have < want else df
