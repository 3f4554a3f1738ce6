"""Gifts: dimension snapshot (S3 merge), enrichment (J1), totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import drop_incomplete, event_is, prop
from .asof import HOUR_MS, as_of_join

ROOM = ["anchor_id", "room_id"]
# Holds every digit of points with up to ten decimals.
POINTS = "decimal(28,10)"


def gift_snapshot(log: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """S3 merge: the latest change per gift id; deleted gifts disappear.

    ``order`` is the change order (update time or a sequence).  A partial
    ``max_by`` aggregate, so re-reading rows already merged is harmless.
    """
    last = log.groupBy(key).agg(F.max_by(F.struct("name", "point", "deleted"), order).alias("_l"))
    return (last.where(F.coalesce(F.col("_l.deleted"), F.lit(0)) == 0)
                .select(key, F.col("_l.name").alias("name"), F.col("_l.point").alias("point")))


def rewards(events: DataFrame, metrics=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """F1 + M1: reward events with room and gift id (int, NULL if not a number), and ``keep`` columns.

    Rows without anchor or room are dropped; ``metrics`` (a name or an
    ``Observation``) counts them.
    """
    out = events.where(event_is(schemas.LIVE_REWARD)).select(
        "record_id", prop("anchor_id", df=events).alias("anchor_id"),
        prop("room_id", df=events).alias("room_id"),
        prop(schemas.GIFT_PROP, df=events).try_cast("int").alias("gift_id"), *keep)
    return drop_incomplete(out, ROOM, metrics)


def enrich(rewards_df: DataFrame, snapshot: DataFrame, key: str = "id") -> DataFrame:
    """J1 (+ A12 rows): each reward with its gift's name and points; unknown or
    deleted gifts give NULLs.  The planner broadcasts the snapshot when its
    measured size is small, else both sides are shuffled and a hot gift is
    split (adaptive execution); nothing is counted or forced here."""
    dim = snapshot.select(F.col(key).alias("_gid"), F.col("name").alias("gift_name"), "point")
    j = rewards_df.join(dim, rewards_df["gift_id"] == dim["_gid"], "left")
    return j.select("record_id", *ROOM, "gift_name", F.lit(1).alias("amount"), "point")


def enrich_as_of(rewards_df: DataFrame, log: DataFrame, key: str = "id", time: str = "changed_ms", order: str = "seq",
                 bucket_ms: int = HOUR_MS) -> DataFrame:
    """J1 as of the reward's time: the gift as it was then.  A reward before its
    gift's first change, or after its deletion, gets NULLs; a gift that changes
    later does not change the rewards before.  ``rewards_df`` carries ``ts_ms``."""
    named = log.withColumnRenamed("name", "gift_name")
    j = as_of_join(rewards_df, named, ("gift_id", key), ("ts_ms", time), order, ("gift_name", "point"), bucket_ms)
    return j.select("record_id", *ROOM, "gift_name", F.lit(1).alias("amount"), "point")


def gift_totals(enriched: DataFrame) -> DataFrame:
    """A8 + M4: gift count and points per room.

    Points are summed in a wide decimal that holds every digit of a price (so
    nothing is rounded and the order of the sum does not matter), then turned
    into a double; NULL points (unknown gifts) are skipped.
    """
    return enriched.groupBy(*ROOM).agg(
        F.count(F.lit(1)).alias("amount"),
        F.sum(F.col("point").cast(POINTS)).cast("double").alias("points"))


def count_by_gift(enriched: DataFrame) -> DataFrame:
    """Rewards per gift name."""
    return enriched.groupBy("gift_name").agg(F.count(F.lit(1)).alias("amount"))
