"""Live-room audience: running totals (A4), totals (A5), windowed deltas (A6,
W4), history (W5) and effective audience by stay time (A7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import drop_incomplete, event_in, floor_to, prop
from .windows import add_tumbling, with_history

ROOM = ["anchor_id", "room_id"]
# Default stay threshold (60 s) and processing window (5 s).
STAY_MS = 60_000
WINDOW_MS = 5_000
# Time bucket that splits a busy room's ordered work into independent tasks.
# One minute: a room holding a third of 100 TB over a month still gives
# sub-gigabyte sort tasks, and the bucket table (one row per room-minute) is
# bounded by time, not by data.  Measured no slower than one hour at sf0.1.
BUCKET_MS = 60_000


def live_events(events: DataFrame, metrics=None) -> DataFrame:
    """F2 + M1: enter/leave events with their room and session.

    Rows without anchor or room are dropped (they would stop the job);
    ``metrics`` (a name or an ``Observation``) counts them.
    """
    out = events.where(event_in([schemas.LIVE_ENTER, schemas.LIVE_LEAVE])).select(
        "record_id", "seq", "ts_ms", F.col("event_name").alias("event_id"),
        *[prop(k, df=events).alias(k) for k in schemas.LIVE_PROPS])
    return drop_incomplete(out, ["anchor_id", "room_id"], metrics)


def _enter():
    return (F.col("event_id") == schemas.LIVE_ENTER).cast("long")


def _delta():
    return F.when(F.col("event_id") == schemas.LIVE_ENTER, F.lit(1)).otherwise(F.lit(-1)).cast("long")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL keys meet each other."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, cond).drop(*[f"_r_{k}" for k in keys])


def running_audience(live: DataFrame, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """A4: after each event, the room's total enters and online count.

    Ordered by (ts, seq) inside a room.  Instead of one sort over a whole room,
    rows are cut into time buckets: each bucket's enters/delta are summed (a
    partial aggregate), a running sum over the few bucket rows gives each
    bucket's offset, and the running sum inside (room, bucket) adds it.  The
    join to the offsets and the per-bucket window share one shuffle on
    (room, bucket), so a busy room runs as many parallel tasks.  Events without
    a time come first, in a bucket of their own (the join is NULL-safe).
    """
    b = live.withColumn("_b", floor_to("ts_ms", bucket_ms)) \
            .withColumn("_e", _enter()).withColumn("_d", _delta())
    sums = b.groupBy(*ROOM, "_b").agg(F.sum("_e").alias("_se"), F.sum("_d").alias("_sd"))
    before = Window.partitionBy(*ROOM).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*ROOM, "_b", F.coalesce(F.sum("_se").over(before), F.lit(0)).alias("_oe"),
                          F.coalesce(F.sum("_sd").over(before), F.lit(0)).alias("_od"))
    inside = Window.partitionBy(*ROOM, "_b").orderBy("ts_ms", "seq") \
                   .rowsBetween(Window.unboundedPreceding, 0)
    j = _join_null_safe(b, offsets, ROOM + ["_b"])
    return j.select("record_id", *ROOM,
                    (F.col("_oe") + F.sum("_e").over(inside)).alias("total_audience"),
                    (F.col("_od") + F.sum("_d").over(inside)).alias("online_audience"))


def audience_totals(live: DataFrame) -> DataFrame:
    """A5: final total enters and online count per room."""
    return live.groupBy(*ROOM).agg(F.sum(_enter()).alias("total_audience"),
                                   F.sum(_delta()).alias("online_audience"))


def window_delta(live: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """A6 + W4: per room and tumbling window, enters and enters - leaves.

    Keyed by (anchor, room, window), not by anchor alone.
    """
    return (add_tumbling(live, size_ms, end=None).groupBy(*ROOM, "window_start")
            .agg(F.sum(_enter()).alias("enters"), F.sum(_delta()).alias("delta"))
            .withColumn("window_end", F.col("window_start") + F.lit(int(size_ms))))


def window_history(deltas: DataFrame) -> DataFrame:
    """Each window's values added to the room's history."""
    h = with_history(deltas, ROOM, "window_start", {"enters": "total_audience", "delta": "online_audience"})
    return h.select(*ROOM, "window_start", "total_audience", "online_audience")


def effective_audience(live: DataFrame, stay_ms: int = STAY_MS, metrics=None) -> DataFrame:
    """Per room, enters whose session stayed at least ``stay_ms``, and online.

    An enter counts unless the same session enters or leaves again sooner
    than ``stay_ms`` (exactly ``stay_ms`` counts; no later event counts).
    Events without a session are each a visit of their own: nothing follows
    them.  Events without a time have no place in the order; they count for
    ``online_audience`` only, and ``metrics`` counts them.

    ``lead`` per (room, session): a session is one visitor's, so its events
    are few, and the two shuffles are on (room, session) and on the room.
    """
    if metrics is not None:
        live = live.observe(metrics, F.count_if(F.col("ts_ms").isNull()).alias("untimed"),
                            F.count(F.lit(1)).alias("rows"))
    # events without a session or a time are spread by their record, not gathered as one key
    alone = F.col("live_session").isNull() | F.col("ts_ms").isNull()
    w = Window.partitionBy(*ROOM, "live_session", F.when(alone, F.col("record_id"))).orderBy("ts_ms", "seq")
    n = live.withColumn("next_ms", F.lead("ts_ms").over(w))
    stayed = (F.col("event_id") == schemas.LIVE_ENTER) & F.col("ts_ms").isNotNull() & (
        F.col("next_ms").isNull() | (F.col("next_ms") - F.col("ts_ms") >= F.lit(int(stay_ms))))
    return n.groupBy(*ROOM).agg(F.sum(stayed.cast("long")).alias("effective_audience"),
                                F.sum(_delta()).alias("online_audience"))


def stay_totals(stays: DataFrame) -> DataFrame:
    """A7 per room from the stream form's output (settled stays and online
    deltas, e.g. read back from their landing): the same columns as
    :func:`effective_audience`."""
    return stays.groupBy(*ROOM).agg(F.sum("effective").alias("effective_audience"),
                                    F.sum("delta").alias("online_audience"))
