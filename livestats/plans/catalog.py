"""The registered queries: name -> ``fn(spark, sf_dir) -> DataFrame``.

Each query reads the synthetic tables through ``testdata`` and runs one of the
library operators over them whole.  Window sizes are the ones FIXTURES.md
fixes for this data (the operators' defaults are the app's own).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import parse
from ..functions.columns import line_without, prop
from ..operators import audience, gifts, groupon, orders, products, users, windows
from ..sources import topic as sources_topic
from . import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


DAY_MS = 86_400_000


@query
def product_window_counts(spark, sf):
    """A10 + W3 + M7: counts per product in 10-minute windows sliding by 1 minute."""
    p = products.product_events(td.events(spark, sf, names="product"))
    return products.window_counts(p).select("category_id", "product_id", "event_id", "cnt",
                                            "window_start", "window_end")


@query
def hot_goods_top3(spark, sf):
    """T1 over A10: top 3 products per (window, category, event); 1-day windows
    sliding by 6 hours on this data, so that groups hold more than three products."""
    p = products.product_events(td.events(spark, sf, names="product"))
    counts = products.window_counts(p, size_ms=DAY_MS, slide_ms=DAY_MS // 4)
    return products.hot_goods(counts).select("category_id", "product_id", "event_id", "cnt",
                                             "window_start", "window_end")


# ---- sources and parsing --------------------------------------------------

@query
def record_id(spark, sf):
    """Every topic record gets ``topic-partition-offset``."""
    return sources_topic.with_record_id(td.topic_records(spark, sf)).select(
        "record_id", "topic", "partition", "offset")


@query
def parse_events(spark, sf):
    """JSON lines -> events; the cut lines are dropped."""
    e = parse.parse_events(td.event_lines(spark, sf))
    return _parsed_view(e)


@query
def parse_events_with_id(spark, sf):
    """The same, carrying the record id."""
    lines = sources_topic.with_record_id(td.event_lines(spark, sf))
    e = parse.parse_events(lines, keep=("record_id",))
    return _parsed_view(e, ("record_id",))


def _parsed_view(e, keep=()):
    return e.select(*keep, "id", "device_id", "device_type", F.col("event_name").alias("event_id"),
                    "release_channel", "os_name", "province", "ts_ms", "is_new",
                    *[prop(k).alias(k) for k in ("anchor_id", "room_id", "live_session",
                                                 "category_id", "product_id")],
                    prop("gift_id").try_cast("int").alias("gift_id"))


@query
def error_free_lines(spark, sf):
    """F4 + K4 rows: lines without ``error``, keyed by their record id."""
    lines = td.event_type_lines(spark, sf)
    return lines.where(line_without("error")).select(F.col("record_id").alias("key"), "value")


@query
def delimited_orders(spark, sf):
    """P5: ``ts,order,status,money`` lines -> typed columns."""
    return parse.split_delimited(td.order_lines_text(spark, sf), schemas.GROUPON_ORDER)


@query
def cdc_orders(spark, sf):
    """P3 + F7: order header envelopes, INSERT/UPDATE only."""
    r = parse.parse_cdc(td.order_cdc_text(spark, sf), schemas.ORDER_HEADER)
    return r.select("oid", F.unix_millis("create_time").alias("create_time"), "total_money", "status",
                    F.unix_millis("update_time").alias("update_time"), "province", "city", "op_type")


@query
def cdc_order_lines(spark, sf):
    """P4 + F7: order line envelopes, INSERT/UPDATE only."""
    r = parse.parse_cdc(td.order_line_cdc_text(spark, sf), schemas.ORDER_LINE)
    return r.select("id", "order_id", "category_id", F.col("categoryName").alias("category_name"), "sku",
                    "money", "amount", F.unix_millis("create_time").alias("create_time"),
                    F.unix_millis("update_time").alias("update_time"), "op_type")


# ---- filters --------------------------------------------------------------

@query
def app_launches(spark, sf):
    """F1."""
    return users.app_launches(td.events(spark, sf)).select(
        "record_id", "device_id", F.col("event_name").alias("event_id"), "ts_ms")


@query
def live_events(spark, sf):
    """F2 + M1."""
    return audience.live_events(td.events(spark, sf)).select(
        "record_id", "event_id", "anchor_id", "room_id", "live_session", "ts_ms")


@query
def product_events(spark, sf):
    """F3 + M1."""
    return products.product_events(td.events(spark, sf, names="product"))


# ---- users ----------------------------------------------------------------

def _launches(spark, sf):
    return users.app_launches(td.events(spark, sf))


@query
def new_user_count(spark, sf):
    """A1 + F5."""
    return users.new_user_count(_launches(spark, sf))


@query
def new_users_by_channel(spark, sf):
    """A2 + F6."""
    return users.new_users_by_channel(_launches(spark, sf))


@query
def launches_by_channel_device(spark, sf):
    """A3 + M2."""
    return users.launches_by_channel_device(_launches(spark, sf))


@query
def launch_rows(spark, sf):
    """M3 + M5 (arriving is_new flag)."""
    return users.launch_rows(_launches(spark, sf))


@query
def launch_rows_first_seen(spark, sf):
    """D2 over all events, then launches, M5 with the first-seen flag."""
    flagged = users.first_seen(td.events(spark, sf))
    return users.launch_rows(users.app_launches(flagged), flag_col="is_n")


@query
def launch_rows_per_hour(spark, sf):
    """K5: rows per (date, hour) landing partition."""
    return users.rows_per_partition(users.launch_rows(_launches(spark, sf)))


@query
def new_device_flag(spark, sf):
    """First event of each device."""
    return users.first_seen(td.events(spark, sf, gaps=True)).select("record_id", "device_id", "is_n")


@query
def new_device_by_type(spark, sf):
    """First event of each (device type, device)."""
    return users.first_seen(td.events(spark, sf, gaps=True), keys=("device_type", "device_id")).select(
        "record_id", "device_type", "device_id", "is_n")


# ---- audience -------------------------------------------------------------

def _live(spark, sf, gaps=False):
    return audience.live_events(td.events(spark, sf, gaps=gaps))


@query
def audience_running(spark, sf):
    """A4."""
    return audience.running_audience(_live(spark, sf, gaps=True))


@query
def audience_totals(spark, sf):
    """A5."""
    return audience.audience_totals(_live(spark, sf))


@query
def audience_window_delta(spark, sf):
    """A6 + W4 (1-day windows on this data)."""
    return audience.window_delta(_live(spark, sf), size_ms=DAY_MS)


@query
def audience_window_history(spark, sf):
    """W5 over A6 (1-day windows)."""
    return audience.window_history(audience.window_delta(_live(spark, sf), size_ms=DAY_MS))


@query
def effective_audience(spark, sf):
    """A7 with a 2-day stay threshold on this data."""
    return audience.effective_audience(_live(spark, sf, gaps=True), stay_ms=2 * DAY_MS)


# ---- gifts ----------------------------------------------------------------

def _enriched(spark, sf):
    snap = gifts.gift_snapshot(td.gift_log(spark, sf))
    return gifts.enrich(gifts.rewards(td.events(spark, sf)), snap)


@query
def gift_dim_current(spark, sf):
    """S3 merge: the current gift snapshot."""
    return gifts.gift_snapshot(td.gift_log(spark, sf))


@query
def gift_enriched(spark, sf):
    """J1 + A12."""
    return _enriched(spark, sf)


@query
def gift_totals(spark, sf):
    """A8 + M4."""
    return gifts.gift_totals(_enriched(spark, sf))


@query
def gift_count_by_name(spark, sf):
    """A9."""
    return gifts.count_by_gift(_enriched(spark, sf))


def _enriched_as_of(spark, sf):
    rewards = gifts.rewards(td.events(spark, sf), keep=("ts_ms",))
    return gifts.enrich_as_of(rewards, td.timed_gift_log(spark, sf))


@query
def gift_enriched_as_of(spark, sf):
    """J1 with every reward's gift as it was at the reward's time."""
    return _enriched_as_of(spark, sf)


@query
def gift_totals_as_of(spark, sf):
    """A8 with rewards valued as of their time."""
    return gifts.gift_totals(_enriched_as_of(spark, sf))


# ---- generic windows --------------------------------------------------------

def _pairs(spark, sf):
    return td.ev(spark, sf).select(F.col("event_type").alias("key"), F.col("k").alias("value"), "ts_ms")


@query
def window_sum(spark, sf):
    """Sum per key and 1-day window."""
    return windows.windowed_sum(_pairs(spark, sf), ["key"], "value", DAY_MS)


@query
def window_sum_history(spark, sf):
    """Each window's sum added to the key's history."""
    s = windows.windowed_sum(_pairs(spark, sf), ["key"], "value", DAY_MS)
    return windows.with_history(s, ["key"], "window_start", {"value_sum": "total"}).select(
        "key", "window_start", "window_end", "total")


# ---- orders ---------------------------------------------------------------

ORDER_WINDOW_MS = 30 * DAY_MS


@query
def order_join(spark, sf):
    """Lines x headers in 30-day windows."""
    j = orders.join_headers(td.order_lines(spark, sf).drop("batch"), td.order_headers(spark, sf),
                            ORDER_WINDOW_MS)
    return j.select("order_id", "line", "sku", "total_money", "status")


def _flagged(spark, sf):
    return orders.flag_late(td.order_lines(spark, sf), ORDER_WINDOW_MS)


@query
def late_order_lines(spark, sf):
    """The lines whose window had closed on arrival."""
    return _flagged(spark, sf).where("is_late").select("order_id", "line", "sku")


@query
def orders_with_late(spark, sf):
    """W7 + J2 + M6 + U1 + J4."""
    r = orders.with_late_rescued(_flagged(spark, sf), td.order_headers(spark, sf), ORDER_WINDOW_MS)
    return r.select("order_id", "line", "sku", "is_late", "joined_in_window", "total_money", "status")


@query
def groupon_join(spark, sf):
    """J3 in 365-day windows."""
    return groupon.groupon_join(td.groupon_detail(spark, sf), td.groupon_main(spark, sf),
                                td.groupon_order(spark, sf), size_ms=365 * DAY_MS)
