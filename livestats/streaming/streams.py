"""Declarative stream forms: the batch operators re-expressed with event time,
watermarks and output modes.

All take and return streaming DataFrames in the model shape (``ts_ms`` epoch
ms).  The event-time column ``event_time`` is derived here, with a watermark
whose delay is a parameter (the jobs' default is zero).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import event_time, window_bounds_ms
from ..operators import audience, gifts, products, users

DEFAULT_DELAY = "0 seconds"


def with_event_time(df: DataFrame, delay: str = DEFAULT_DELAY, ms: str = "ts_ms") -> DataFrame:
    """Event time from epoch ms plus a bounded-out-of-orderness watermark."""
    return df.withColumn("event_time", event_time(ms)).withWatermark("event_time", delay)


def _ms(n: int) -> str:
    return f"{int(n)} milliseconds"


# ---- running aggregates (update mode, Q1) -----------------------------------------

def new_user_counts(events: DataFrame) -> DataFrame:
    """A1: running count of new launches (update mode)."""
    return users.new_user_count(users.app_launches(events))


def new_users_by_channel(events: DataFrame) -> DataFrame:
    """A2 (update mode)."""
    return users.new_users_by_channel(users.app_launches(events))


def launches_by_channel_device(events: DataFrame) -> DataFrame:
    """A3 (update mode)."""
    return users.launches_by_channel_device(users.app_launches(events))


def audience_totals(events: DataFrame, metrics: str | None = "live_events_incomplete") -> DataFrame:
    """A4/A5 on a stream: running total and online per room (update mode);
    each trigger emits the rooms that changed, which is A4 at batch grain.
    Rows without anchor or room are counted in the observed ``metrics``."""
    return audience.audience_totals(audience.live_events(events, metrics))


def audience_window_delta(events: DataFrame, size_ms: int = audience.WINDOW_MS,
                          delay: str = DEFAULT_DELAY) -> DataFrame:
    """A6 + W4: per room and window (append mode once the window closes)."""
    live = with_event_time(audience.live_events(events), delay)
    enter = (F.col("event_id") == schemas.LIVE_ENTER).cast("long")
    delta = F.when(F.col("event_id") == schemas.LIVE_ENTER, 1).otherwise(-1).cast("long")
    agg = live.groupBy(F.window("event_time", _ms(size_ms)).alias("window"), "anchor_id", "room_id") \
              .agg(F.sum(enter).alias("enters"), F.sum(delta).alias("delta"))
    start, end = window_bounds_ms("window")
    return agg.select("anchor_id", "room_id", start.alias("window_start"), "enters", "delta",
                      end.alias("window_end"))


def audience_batch_delta(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A6 + W4 by processing time: a ``foreachBatch`` handler that emits each
    room's enters and delta of the micro-batch.  With a trigger interval of the
    window's size a micro-batch is one processing-time window; nothing is late,
    so no event is dropped."""
    def handle(batch_df: DataFrame, batch_id: int) -> None:
        totals = audience.audience_totals(audience.live_events(batch_df)).withColumnsRenamed(
            {"total_audience": "enters", "online_audience": "delta"})
        write(totals.withColumn("window", F.lit(batch_id).cast("long")), batch_id)
    return handle


# ---- gifts -------------------------------------------------------------------------

def gift_enriched(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """J1 on a stream: stream-static left join to the gift snapshot.

    The static side is the snapshot as listed when the query starts; for one
    that changes during the stream see ``streaming.enrich``.
    """
    return gifts.enrich(gifts.rewards(events, "rewards_incomplete"), snapshot)


def gift_totals(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """A8 (update mode)."""
    return gifts.gift_totals(gift_enriched(events, snapshot))


# ---- hot products ---------------------------------------------------------------------

def product_window_counts(events: DataFrame, size_ms: int = products.WINDOW_MS,
                          slide_ms: int = products.SLIDE_MS, delay: str = DEFAULT_DELAY,
                          metrics: str | None = "product_events_incomplete") -> DataFrame:
    """A10 + M7 on a stream: sliding-window counts, final once the window closes
    (append mode).

    As in the batch form, rows are first counted per slide-sized slot, and
    only the slot counts are spread to the ``size/slide`` windows: two
    chained windowed aggregations, the second keyed on ``window_time`` of the
    first, so raw rows are never copied per window.
    """
    p = with_event_time(products.product_events(events, metrics), delay)
    keys = ["category_id", "product_id", "event_id"]
    if size_ms % slide_ms:
        slots = p.withColumn("_n", F.lit(1).cast("long"))
        t = "event_time"
    else:
        slots = p.groupBy(F.window("event_time", _ms(slide_ms)).alias("slot"), *keys) \
                 .agg(F.count(F.lit(1)).alias("_n"))
        slots = slots.select(F.window_time("slot").alias("slot_time"), *keys, "_n")
        t = "slot_time"
    agg = slots.groupBy(F.window(t, _ms(size_ms), _ms(slide_ms)).alias("window"), *keys) \
               .agg(F.sum("_n").alias("cnt"))
    start, end = window_bounds_ms("window")
    return agg.select(*keys, "cnt", start.alias("window_start"), end.alias("window_end"))


def top_n_per_batch(n: int, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """T1 on a stream: a ``foreachBatch`` handler ranking closed windows.

    In append mode each window reaches exactly one micro-batch with its final
    counts, so ranking inside the batch is exact and holds no group in state.
    """
    def handle(batch_df: DataFrame, batch_id: int) -> None:
        write(products.hot_goods(batch_df, n), batch_id)
    return handle


# ---- joins --------------------------------------------------------------------------------

def delay_ms(delay: str) -> int:
    """A delay such as ``5 seconds`` or ``1500 milliseconds`` in milliseconds."""
    number, unit = delay.split()
    units = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(number) * units[unit.rstrip("s")]


def _salted(df: DataFrame, row_key: list[str], salts: int) -> DataFrame:
    """Rows of the large side with a salt of the row itself, so a replayed row keeps it."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in row_key]), F.lit(salts)).cast("int") if salts > 1 else F.lit(0)
    return df.withColumn("_salt", salt)


def _side(df: DataFrame, key: str, cols, tag: str, size_ms: int, delay: str, salts: int) -> DataFrame:
    """The small side of a windowed join, a copy for each salt."""
    s = df.select(F.col(key).alias(f"_{tag}k"), F.col("ts_ms").alias(f"_{tag}ts"), *cols)
    s = s.withColumn(f"_{tag}et", event_time(f"_{tag}ts")).withWatermark(f"_{tag}et", delay) \
         .withColumn(f"_{tag}w", F.window(f"_{tag}et", _ms(size_ms)))
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))) if salts > 1 else F.lit(0)
    return s.withColumn(f"_{tag}salt", copies)


def _met(left: DataFrame, right: DataFrame, key: str, tag: str):
    return (left[key] == right[f"_{tag}k"]) & (left["_salt"] == right[f"_{tag}salt"]) & (left["_w"] == right[f"_{tag}w"])


def window_join_stream(left: DataFrame, right: DataFrame, key: tuple[str, str], size_ms: int,
                       delay: str = DEFAULT_DELAY, right_cols=(), salts: int = 1) -> DataFrame:
    """J2 on streams: left outer stream-stream join on (key, event-time window).

    Both sides carry a watermark; the window equality bounds the join state,
    and a left row without a partner is emitted with NULLs once its window
    closes.  Adaptive execution does not split stateful joins, so with ``salts``
    the rows of a hot key are dealt to so many tasks by a hash of the row, and the
    right side's rows, few for a key, are copied to each.  The number is part
    of the state: it must not change between restarts from one checkpoint.
    """
    lk, rk = key
    lw = _salted(with_event_time(left, delay).withColumn("_w", F.window("event_time", _ms(size_ms))), left.columns, salts)
    rw = _side(right, rk, right_cols, "r", size_ms, delay, salts)
    return lw.join(rw, _met(lw, rw, lk, "r"), "leftOuter").drop("_salt", "_rk", "_rts", "_ret", "_rw", "_rsalt")


def order_join_stream(lines: DataFrame, headers: DataFrame, size_ms: int = 10_000,
                      delay: str = DEFAULT_DELAY, salts: int = 1) -> DataFrame:
    """Order lines with the header of the same order and window."""
    j = window_join_stream(lines, headers, ("order_id", "order_id"), size_ms, delay,
                           ("total_money", "status"), salts)
    return j.drop("_w", "event_time")


def groupon_join_stream(detail: DataFrame, main: DataFrame, order: DataFrame, size_ms: int = 5_000,
                        delay: str = DEFAULT_DELAY, salts: int = 1) -> DataFrame:
    """J3 on streams: detail -> main -> order, both joins in the detail's window.

    The first join's output keeps the detail's event time and window, which
    the second join reuses (Spark allows chained stream-stream outer joins
    when every input carries a watermark); with ``salts`` also its salt.
    """
    lw = _salted(with_event_time(detail, delay).withColumn("_w", F.window("event_time", _ms(size_ms))), detail.columns, salts)
    m = _side(main, "groupon_id", [F.col("status").alias("groupon_status"), "category"], "m", size_ms, delay, salts)
    o = _side(order, "order_id", [F.col("status").alias("order_status"), "money"], "o", size_ms, delay, salts)
    j1 = lw.join(m, _met(lw, m, "groupon_id", "m"), "leftOuter")
    j2 = j1.join(o, _met(j1, o, "order_id", "o"), "leftOuter")
    return j2.select("user_id", "groupon_id", "order_id", "groupon_status", "category", "order_status", "money")


# ---- window history -------------------------------------------------------------------------

def running_sum(df: DataFrame, keys: list[str], value: str, out: str = "total") -> DataFrame:
    """W5 on a stream: the key's lifetime sum, re-emitted at every trigger
    (update mode); with a processing-time trigger this is the per-window
    history the app reports."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))

