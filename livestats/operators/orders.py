"""Orders: windowed detail-to-header join (J2), late rows (W7), null right
side (M6), union (U1) and snapshot fallback (J4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import window_left_join
from .windows import tumbling_start

# The job's window (10 s) and watermark delay (0).
WINDOW_MS = 10_000
DELAY_MS = 0


def join_headers(lines: DataFrame, headers: DataFrame, size_ms: int = WINDOW_MS,
                 header_cols=("total_money", "status")) -> DataFrame:
    """Each line with the header of the same order **and** window (left outer)."""
    h = headers.select(F.col("order_id").alias("_hid"), F.col("ts_ms").alias("_hts"), *header_cols)
    j = window_left_join(lines, h, ("order_id", "_hid"), size_ms, "ts_ms", "_hts")
    return j.drop("_hid", "_hts", "_w")


def flag_late(lines: DataFrame, size_ms: int = WINDOW_MS, batch_col: str = "batch",
              delay_ms: int = DELAY_MS, out: str = "is_late") -> DataFrame:
    """W7 (batch form): mark rows whose window had closed when they arrived.

    ``batch_col`` numbers the arrival batches.  The watermark before batch b
    is max(event time over batches < b) - delay, as a micro-batch stream sees
    it; a row is late when its window end is <= that watermark.  The running
    max runs over one row per batch, never over data rows; that small table
    stays lazy and the planner picks its join.  A line without a batch or a
    time is on time.
    """
    per_batch = lines.where(F.col(batch_col).isNotNull()).groupBy(batch_col).agg(F.max("ts_ms").alias("_mx"))
    earlier = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -1)
    marks = per_batch.select(batch_col, (F.max("_mx").over(earlier) - F.lit(int(delay_ms))).alias("_wm"))
    end = tumbling_start("ts_ms", size_ms) + F.lit(int(size_ms))
    return (lines.join(marks, batch_col, "left")
                 .withColumn(out, F.coalesce(end <= F.col("_wm"), F.lit(False))).drop("_wm"))


def null_header(late: DataFrame, header_schema) -> DataFrame:
    """M6: give late lines an empty (NULL) right side of the header's types."""
    out = late
    for f in header_schema:
        out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out


def latest_headers(headers: DataFrame, header_cols=("total_money", "status")) -> DataFrame:
    """One header per order: the newest version (by time, then by its values)."""
    last = headers.groupBy("order_id").agg(F.max(F.struct("ts_ms", *header_cols)).alias("_h"))
    return last.select("order_id", "_h.*")


def rescue(joined: DataFrame | None, late: DataFrame, snapshot: DataFrame,
           header_cols=("total_money", "status")) -> DataFrame:
    """U1 + J4 (stream form): union the joined lines with the late ones (M6:
    NULL header), then look up every missing header in the order snapshot.

    ``joined`` may be ``None`` when the joined lines go to the same sink from
    another query (the union then happens in the sink).
    """
    types = {f.name: f.dataType for f in snapshot.schema if f.name in header_cols}
    u = null_header(late, [T.StructField(c, types[c]) for c in header_cols])
    if joined is not None:
        u = joined.unionByName(u, allowMissingColumns=True)
    s = latest_headers(snapshot, header_cols) if "ts_ms" in snapshot.columns else snapshot.dropDuplicates(["order_id"])
    s = s.select(F.col("order_id").alias("_sid"), *[F.col(c).alias(f"_s_{c}") for c in header_cols])
    j = u.join(s, u["order_id"] == s["_sid"], "left")
    return j.select(*[c for c in u.columns if c not in header_cols],
                    *[F.coalesce(F.col(c), F.col(f"_s_{c}")).alias(c) for c in header_cols])


def with_late_rescued(flagged: DataFrame, headers: DataFrame, size_ms: int = WINDOW_MS,
                      header_cols=("total_money", "status")) -> DataFrame:
    """W7 + J2 + U1 + J4 (batch form) in one join.

    On-time lines join their header inside the window, late lines get none,
    and any line still without a header takes it from the snapshot.  Because
    a snapshot holds one header per order, the in-window header, when it
    exists, is that same snapshot row; so a single join on the order id gives
    the union of both paths, plus ``joined_in_window``.  One shuffle, not two.
    Of several versions of a header the newest counts (:func:`latest_headers`),
    so lines are never doubled.
    """
    h = latest_headers(headers, header_cols).select(F.col("order_id").alias("_hid"), F.col("ts_ms").alias("_hts"), *header_cols)
    j = flagged.join(h, flagged["order_id"] == h["_hid"], "left")
    same_window = tumbling_start("ts_ms", size_ms) == tumbling_start("_hts", size_ms)
    inside = (~F.col("is_late")) & F.col("_hid").isNotNull() & same_window
    return j.select(*flagged.columns, F.coalesce(inside, F.lit(False)).alias("joined_in_window"),
                    *header_cols)
