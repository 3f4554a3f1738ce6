"""J1 as of a time: each row with the version of its key that was valid at the row's own time.

A change log holds inserts, updates and deletes of keys.  A row gets the last
change of its key at or before its time, and NULLs if there is none yet or the
key was deleted then.

Time is cut into buckets.  The version that is valid when a bucket starts is
carried forward to it, once for each (key, bucket) that has rows; inside a
bucket the changes themselves are the steps.  So rows meet their version by an
equality on (key, bucket) and a range within, which spreads a hot key over
its buckets, and no task sorts all rows, or all changes, of a key: the carry runs over
one row for each bucket of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import tumbling_start

HOUR_MS = 3_600_000


def steps(wanted: DataFrame, changes: DataFrame, key: str, time: str, order: str, cols: tuple[str, ...],
          bucket_ms: int = HOUR_MS, deleted: str = "deleted") -> DataFrame:
    """``_key, _bucket, _from, _until`` and ``cols``: the versions valid within each wanted bucket.

    ``wanted`` has ``_key, _bucket``.  Of changes of one key at one time the
    last by ``order`` counts, whatever the other columns.  Changes without a key or time are left out.
    """
    version = F.struct(F.coalesce(F.col(deleted), F.lit(0)).alias("_gone"), *cols)
    log = changes.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(time).cast("long").alias("_from"), F.col(order).alias("_order"),
        version.alias("_v"), tumbling_start(time, bucket_ms).alias("_bucket"))
    at = ["_key", "_bucket"]
    closing = log.groupBy(*at).agg(F.max_by("_v", F.struct("_from", "_order")).alias("_closing"),
                                   F.min("_from").alias("_first"))
    both = wanted.where("_key is not null and _bucket is not null").select(
        *at, F.lit(1).alias("_asked"), F.lit(None).cast(closing.schema["_closing"].dataType).alias("_closing"),
        F.lit(None).cast("long").alias("_first"))
    both = both.unionByName(closing.withColumn("_asked", F.lit(0))).groupBy(*at).agg(
        F.max("_asked").alias("_asked"), F.max("_closing").alias("_closing"), F.max("_first").alias("_first"))
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.withColumn("_v", F.last("_closing", ignorenulls=True).over(earlier)).where("_asked = 1")
    end = F.col("_bucket") + F.lit(int(bucket_ms))
    carried = carried.where("_v is not null").select(*at, F.col("_bucket").alias("_from"),
                                                     F.coalesce("_first", end).alias("_until"), "_v")
    inside = Window.partitionBy(*at).orderBy("_from", "_order")
    changed = log.withColumn("_until", F.coalesce(F.lead("_from").over(inside), end)).select(
        *at, "_from", "_until", "_v")
    return carried.unionByName(changed).where("_from < _until and _v._gone = 0").select(
        *at, "_from", "_until", *[F.col("_v")[c].alias(c) for c in cols])


def as_of_join(rows: DataFrame, changes: DataFrame, keys: tuple[str, str], times: tuple[str, str], order: str,
               cols: tuple[str, ...], bucket_ms: int = HOUR_MS, deleted: str = "deleted") -> DataFrame:
    """``rows`` with ``cols`` of the version valid at their time (left outer).

    ``keys`` and ``times`` name the columns of ``rows`` and of ``changes``.  A row
    without a key or a time gets NULLs.  A change at a row's own time counts.
    """
    (key, other_key), (time, other_time) = keys, times
    left = rows.withColumn("_bucket", tumbling_start(time, bucket_ms))
    wanted = left.select(F.col(key).alias("_key"), "_bucket").distinct()
    valid = steps(wanted, changes, other_key, other_time, order, cols, bucket_ms, deleted).withColumnRenamed(
        "_bucket", "_at")
    met = (left[key] == valid["_key"]) & (left["_bucket"] == valid["_at"]) & (
        left[time] >= valid["_from"]) & (left[time] < valid["_until"])
    return left.join(valid, met, "left").drop("_key", "_bucket", "_at", "_from", "_until")
