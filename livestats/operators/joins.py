"""Join helper: epoch-window equi joins."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .windows import tumbling_start


def window_left_join(left: DataFrame, right: DataFrame, key: tuple[str, str], size_ms: int,
                     left_time: str = "ts_ms", right_time: str = "ts_ms",
                     window_col: str = "_w") -> DataFrame:
    """Left outer join on (key, tumbling window) -- both in the same window.

    The window is just one more equi key, so the planner picks a hash or
    sort-merge join; no range condition is involved.  AQE splits a hot key
    of the left side (skew join).  ``window_col`` is kept on the output so a
    chained join (J3) can reuse the left row's window.
    """
    lk, rk = key
    lw = left if window_col in left.columns else left.withColumn(window_col, tumbling_start(left_time, size_ms))
    rw = right.withColumn("_rw", tumbling_start(right_time, size_ms))
    cond = (lw[lk] == rw[rk]) & (lw[window_col] == rw["_rw"])
    return lw.join(rw, cond, "left").drop("_rw")
