"""New users and launches (A1-A3, M2, M3, M5, K5 rows) and first-seen flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import composite_key, date_part, event_is, hour_part


def app_launches(events: DataFrame) -> DataFrame:
    """launch events only."""
    return events.where(event_is(schemas.APP_LAUNCH))


def new_user_count(launches: DataFrame) -> DataFrame:
    """A1 + F5: number of launches flagged new.  The HAVING-style filter on the
    grouping key is pushed below the aggregate by Catalyst."""
    return (launches.groupBy("is_new").agg(F.count(F.lit(1)).alias("new_users"))
                    .where(F.col("is_new") == 1))


def new_users_by_channel(launches: DataFrame) -> DataFrame:
    """A2 + F6: new users per release channel."""
    return (launches.where(F.col("is_new") == 1)
                    .groupBy(F.col("release_channel").alias("channel"))
                    .agg(F.count(F.lit(1)).alias("new_users")))


def launches_by_channel_device(launches: DataFrame, keep_parts: bool = False) -> DataFrame:
    """A3 + M2: launches per ``channel-deviceType`` (all launches, not only new)."""
    keys = [composite_key("release_channel", "device_type").alias("channel_device")]
    if keep_parts:
        keys += [F.col("release_channel"), F.col("device_type")]
    return launches.groupBy(*keys).agg(F.count(F.lit(1)).alias("launches"))


def launch_rows(events: DataFrame, flag_col: str = "is_new", zone: str = "UTC") -> DataFrame:
    """M5 + M3: the warehouse row of a launch (11 columns).

    ``flag_col`` picks which flag lands in the ``is_new`` column: the arriving
    ``is_new`` or the engine-computed first-seen ``is_n``.
    """
    return events.select(
        F.col("record_id").alias("id"), "device_id", F.col("event_name").alias("event_id"),
        F.col(flag_col).cast("int").alias("is_new"), F.col("os_name").alias("os"), "province",
        F.col("release_channel").alias("channel"), "device_type", F.col("ts_ms").alias("event_time"),
        date_part("ts_ms", zone).alias("date"), hour_part("ts_ms", zone).alias("hour"))


def rows_per_partition(rows: DataFrame, parts=("date", "hour")) -> DataFrame:
    """K5: how many rows each (date, hour) landing partition receives."""
    return rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("launches"))


def first_seen(events: DataFrame, keys=("device_id",), order=("ts_ms", "seq"),
               flag: str = "is_n") -> DataFrame:
    """flag = 1 on the first event of each key (by ``order``), else 0.

    Exact, unlike a Bloom filter.  The first (ts, seq) per key is a partial
    aggregate (one row per key per map task, so a device holding a third of
    the rows costs nothing extra), and it is joined back on (key, ts, seq):
    that join hashes on the full tuple, which spreads a hot device's rows over
    all tasks.  No task ever sorts all events of one key.

    A NULL key is a key of its own (the join is NULL-safe).  Events with a
    NULL in ``order`` have no place in the order and are never first.
    """
    keys, order = list(keys), list(order)
    timed = F.lit(True)
    for c in order:
        timed = timed & F.col(c).isNotNull()
    firsts = events.select(*keys, *order).where(timed).groupBy(*keys).agg(F.min(F.struct(*order)).alias("_f"))
    firsts = firsts.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           *[F.col("_f")[c].alias(f"_f_{c}") for c in order], F.lit(1).alias("_first"))
    cond = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col(c) == F.col(f"_f_{c}") for c in order]
    out = events.drop(flag)
    return out.join(firsts, cond, "left").select(*out.columns, F.coalesce(F.col("_first"), F.lit(0)).alias(flag))
