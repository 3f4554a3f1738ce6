"""K3 on shared files: a table of Parquet files that a batch of keyed rows is merged into.

Rows lie in ``buckets`` buckets by the hash of their key.  A batch reads and
writes anew only the buckets that its keys fall into (copy on write), under
``data/batch=N/_keyed_bucket=K``; the others stay as they are.  ``manifests/batch=N``
then lists for each bucket the batch that wrote it last.  Its ``_SUCCESS``
marker publishes the batch, so a reader sees a batch whole or not at all, and
a retried batch that was published is left alone.  Batch ids ascend, as those
of a stream do; one writer at a time.

Defined cases: of rows with one key in a batch the one with the greatest
``latest`` columns stays, then the greatest by its other columns; NULL is a key
like any other; an empty batch publishes no new bucket; folders of batches that
are no longer listed stay for readers that still use them; a table without a
batch is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

BUCKETS = 64
#: The column and folder name of the bucket; callers' columns must not have it.
PLACE = "_keyed_bucket"
_MANIFEST = "bucket int, version bigint, buckets int"


def _batches(spark: SparkSession, base: str) -> list[int]:
    """The published batches, ascending."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/manifests")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    folders = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")]
    return sorted(int(f.getName().removeprefix("batch=")) for f in folders
                  if fs.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def _manifest(spark: SparkSession, base: str, batch: int) -> tuple[dict[int, int], int | None]:
    """The batch that wrote each bucket last, and the number of buckets: at most a row for each bucket."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{base}/manifests/batch={batch}").collect()
    return {r.bucket: r.version for r in rows if r.bucket >= 0}, next((r.buckets for r in rows), None)


def _read(spark: SparkSession, base: str, schema: StructType, versions: dict[int, int]) -> DataFrame:
    paths = [f"{base}/data/batch={v}/{PLACE}={k}" for k, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_keyed(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The table as of its last published batch."""
    base = base.rstrip("/")
    batches = _batches(spark, base)
    return _read(spark, base, schema, _manifest(spark, base, batches[-1])[0] if batches else {})


def upsert_batch(df: DataFrame, base: str, keys: Sequence[str], batch_id: int, latest: Sequence[str] = (),
                 buckets: int = BUCKETS) -> None:
    """Merge one batch into the table: its rows replace those of equal keys."""
    spark, base = df.sparkSession, base.rstrip("/")
    done = _batches(spark, base)
    if done and done[-1] >= batch_id:
        return
    versions, n = _manifest(spark, base, done[-1]) if done else ({}, None)
    n = n or buckets  # a table keeps the number of buckets that it began with
    rest = [c for c in df.columns if c not in keys]
    order = [*latest, *(c for c in rest if c not in latest)]
    if order:
        df_new = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("row")).select(
            *[F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns])
    else:
        df_new = df.dropDuplicates()
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    # written first, as a micro-batch's plan may not give the same rows twice
    incoming = f"{base}/incoming/batch={batch_id}"
    df_new.withColumn(PLACE, bucket).write.mode("overwrite").parquet(incoming)
    new = spark.read.schema(StructType(df_new.schema.fields).add(PLACE, IntegerType())).parquet(incoming)
    touched = [r[PLACE] for r in new.select(PLACE).distinct().collect()]  # at most one row for each bucket
    old = _read(spark, base, df_new.schema, {k: versions[k] for k in touched if k in versions})
    same = [old[k].eqNullSafe(new[k]) for k in keys]
    kept = old.join(new, same, "left_anti").withColumn(PLACE, bucket)
    if touched:
        (kept.unionByName(new).hint("rebalance", F.col(PLACE)).write.mode("overwrite").partitionBy(PLACE)
         .parquet(f"{base}/data/batch={batch_id}"))
    versions |= dict.fromkeys(touched, batch_id)
    rows = [(k, v, n) for k, v in sorted(versions.items())] or [(-1, batch_id, n)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
        f"{base}/manifests/batch={batch_id}")


def keyed_files(base: str, keys: Sequence[str], latest: Sequence[str] = (),
                buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """K3: a ``foreachBatch`` handler that merges every micro-batch, in place of a database's upsert."""
    def handle(batch_df: DataFrame, batch_id: int) -> None:
        upsert_batch(batch_df, base, keys, batch_id, latest, buckets)
    return handle
