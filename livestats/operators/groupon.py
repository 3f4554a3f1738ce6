"""Group-buying: detail -> main -> order, two chained windowed left joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import window_left_join

# The job's window (5 s).
WINDOW_MS = 5_000


def groupon_join(detail: DataFrame, main: DataFrame, order: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """Detail LEFT JOIN main (same group-buy, same window) LEFT JOIN order
    (same order, same window).  The second join reuses the detail's window,
    which is the window of the first join's result.

    The planner picks each join by the measured sizes of its sides.
    """
    m = main.select(F.col("groupon_id").alias("_gid"), F.col("ts_ms").alias("_mts"),
                    F.col("status").alias("groupon_status"), "category")
    o = order.select(F.col("order_id").alias("_oid"), F.col("ts_ms").alias("_ots"),
                     F.col("status").alias("order_status"), "money")
    j1 = window_left_join(detail, m, ("groupon_id", "_gid"), size_ms, "ts_ms", "_mts")
    j2 = window_left_join(j1, o, ("order_id", "_oid"), size_ms, "ts_ms", "_ots")
    return j2.select("user_id", "groupon_id", "order_id", "groupon_status", "category",
                     "order_status", "money")
