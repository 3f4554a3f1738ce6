"""Hot products: sliding-window counts (A10, M7) and the top-N per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import drop_incomplete, event_has_prefix, prop
from .windows import sliding_counts, top_n

# The job's default window (10 minutes, sliding by 1 minute) and N.
WINDOW_MS = 10 * 60 * 1000
SLIDE_MS = 60 * 1000
TOP_N = 3


def product_events(events: DataFrame, metrics=None) -> DataFrame:
    """F3 + M1: product events as (category_id, product_id, event_id, ts_ms).

    Rows without category or product are dropped (they would stop the job);
    ``metrics`` (a name or an ``Observation``) counts them.
    """
    out = (events.where(event_has_prefix(schemas.PRODUCT_PREFIX))
                 .select("record_id", prop("category_id", df=events).alias("category_id"),
                         prop("product_id", df=events).alias("product_id"),
                         F.col("event_name").alias("event_id"), "ts_ms"))
    return drop_incomplete(out, ["category_id", "product_id"], metrics)


def window_counts(products: DataFrame, size_ms: int = WINDOW_MS, slide_ms: int = SLIDE_MS) -> DataFrame:
    """A10 + M7: count per (category, product, event) and sliding window."""
    return sliding_counts(products, ["category_id", "product_id", "event_id"], size_ms, slide_ms)


def hot_goods(counts: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top ``n`` products per (window, category, event) by count.

    Ties go to the smaller product id, so the result is deterministic.
    """
    return top_n(counts, ["window_start", "window_end", "category_id", "event_id"],
                 [F.col("cnt").desc(), F.col("product_id")], n)
