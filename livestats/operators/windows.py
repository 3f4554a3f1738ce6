"""Event-time window helpers shared by the operators.

Windows are epoch-aligned, like ``pyspark.sql.functions.window``; bounds are
epoch milliseconds (M7).  Batch forms use exact integer arithmetic on the
millisecond column so that they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import floor_to


def tumbling_start(ms: str | Column, size_ms: int) -> Column:
    """Start of the tumbling window holding ``ms``."""
    return floor_to(ms, size_ms)


def add_tumbling(df: DataFrame, size_ms: int, time_col: str = "ts_ms",
                 start: str = "window_start", end: str | None = "window_end") -> DataFrame:
    out = df.withColumn(start, tumbling_start(time_col, size_ms))
    if end:
        out = out.withColumn(end, F.col(start) + F.lit(int(size_ms)))
    return out


def sliding_counts(df: DataFrame, keys: list[str], size_ms: int, slide_ms: int,
                   time_col: str = "ts_ms", count_col: str = "cnt") -> DataFrame:
    """W3 + A10: row count per key and sliding window (size, slide).

    Rows are first counted per (key, slide slot) -- a partial aggregate that
    shrinks the data before any row is copied -- and only the slot counts are
    spread to the ``size/slide`` windows that contain the slot.  Both
    aggregates shuffle on the full key (including the window), so a hot
    product is spread over its windows rather than landing in one task.
    """
    if size_ms % slide_ms:
        raise ValueError("window size must be a multiple of the slide")
    n = size_ms // slide_ms
    slots = (df.groupBy(*keys, tumbling_start(time_col, slide_ms).alias("_slot"))
               .agg(F.count(F.lit(1)).alias("_n")))
    starts = F.sequence(F.col("_slot") - F.lit(int((n - 1) * slide_ms)), F.col("_slot"), F.lit(int(slide_ms)))
    spread = slots.select(*keys, "_n", F.explode(starts).alias("window_start"))
    return (spread.groupBy(*keys, "window_start").agg(F.sum("_n").alias(count_col))
                  .withColumn("window_end", F.col("window_start") + F.lit(int(size_ms))))


def windowed_sum(df: DataFrame, keys: list[str], value: str | Column, size_ms: int,
                 time_col: str = "ts_ms", out: str = "value_sum") -> DataFrame:
    """Sum of ``value`` per key and tumbling window."""
    v = F.col(value) if isinstance(value, str) else value
    return (add_tumbling(df, size_ms, time_col, end=None)
            .groupBy(*keys, "window_start").agg(F.sum(v).alias(out))
            .withColumn("window_end", F.col("window_start") + F.lit(int(size_ms))))


# A block of a key's history: the windows that one task adds up one by one.
BLOCK_MS = 30 * 86_400_000


def with_history(df: DataFrame, keys: list[str], order: str, sums: dict[str, str],
                 block_ms: int = BLOCK_MS) -> DataFrame:
    """Add each window's value to the key's history (lifetime value at each window).

    Runs over one row per (key, window), never over data rows, in two levels:
    sums of blocks of ``order`` (window starts) are added up for each key, and the
    windows inside each block.  So no task sorts more of a key than the windows
    of a block, or one row for each of its blocks, however long the history.
    ``order`` NULL comes first, in a block of its own.
    """
    # one struct of key and block, equal also where parts are NULL: the windows inside and the join share a shuffle
    b = df.withColumn("_at", F.struct(*keys, floor_to(order, block_ms).alias("_block")))
    per_block = b.groupBy("_at").agg(*[F.sum(src).alias(dst) for src, dst in sums.items()])
    earlier = Window.partitionBy(*[F.col("_at")[c] for c in keys]).orderBy(F.col("_at")["_block"]).rowsBetween(
        Window.unboundedPreceding, -1)
    before = per_block.select("_at", *[F.sum(dst).over(earlier).alias(f"_before_{dst}") for dst in sums.values()])
    inside = Window.partitionBy("_at").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = b.withColumns({dst: F.sum(src).over(inside) for src, dst in sums.items()}).join(before, "_at")
    total = {dst: F.when(F.col(dst).isNull(), F.col(f"_before_{dst}")).otherwise(
        F.col(dst) + F.coalesce(F.col(f"_before_{dst}"), F.lit(0))) for dst in sums.values()}
    return joined.withColumns(total).drop("_at", *[f"_before_{dst}" for dst in sums.values()])


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per group by ``order``.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit ahead of
    the shuffle, so each map task sends at most ``n`` rows per group.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
