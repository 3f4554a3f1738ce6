"""Adapters from the synthetic tables to the app's data model.

The synthetic ``events`` table has (event_id, ts, user_id, event_type, value,
props).  These adapters derive the app's feeds from it and from the TPC-H-like
tables with column expressions only, so every derived feed grows with the
tables.  The mapping is fixed by FIXTURES.md part B; the DuckDB oracles in
``oracle.py`` use the same mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import epoch_ms_from_ntz, epoch_ms_sql, floor_to, ntz_text
from ..sources.files import spread

# Times of the synthetic tables are rounded to the nearest millisecond, the
# rule the oracle warehouse applies when it reads them as epoch milliseconds.
NEAREST = "nearest"

# Topic name and partition the events replay as.
EVENTS_TOPIC = "events"
EVENTS_PARTITION = 0

# event_type -> app event name (live namespace).
LIVE_NAMES = {"signup": "appLaunch", "view": "liveEnter", "click": "liveLeave",
              "purchase": "liveReward"}
# Event types that are product events (named product_<type>).
PRODUCT_TYPES = ("view", "click", "purchase")


def _s(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the synthetic set."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _live_case() -> str:
    arms = " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in LIVE_NAMES.items())
    return f"CASE event_type {arms} ELSE event_type END"


def _product_case() -> str:
    types = ", ".join(f"'{t}'" for t in PRODUCT_TYPES)
    return f"CASE WHEN event_type IN ({types}) THEN concat('product_', event_type) ELSE event_type END"


# The share of events without a time, a device or a session in the gapped feed.
GAPS = {"ts_ms": "event_id % 101 = 11", "device_id": "event_id % 37 = 5", "live_session": "event_id % 31 = 7"}


def ev(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """The flat ``ev`` view of FIXTURES.md (one row per event); with ``gaps``
    some events lack their time, device or session.

    Written as SQL expressions: one call per column instead of one per
    function, which keeps plan construction cheap.
    """
    e = table(spark, sf_dir, "events").selectExpr(
        "*", """try_cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS k""")
    flat = _flat(e)
    return flat.withColumns({c: F.expr(f"CASE WHEN {g} THEN NULL ELSE {c} END") for c, g in GAPS.items()}) if gaps else flat


def _flat(e: DataFrame) -> DataFrame:
    return e.selectExpr(
        "event_id",
        f"concat('{EVENTS_TOPIC}-{EVENTS_PARTITION}-', cast(event_id AS STRING)) AS record_id",
        f"{epoch_ms_sql('ts', NEAREST)} AS ts_ms",
        "concat('d', cast(user_id AS STRING)) AS device_id",
        "concat('type', cast(user_id % 4 AS STRING)) AS device_type",
        "event_type",
        f"{_live_case()} AS event_name",
        f"{_product_case()} AS product_event",
        "k",
        "concat('ch', cast(k % 5 AS STRING)) AS release_channel",
        "concat('a', cast(k % 10 AS STRING)) AS anchor_id",
        "concat('r', cast(k % 20 AS STRING)) AS room_id",
        "concat('s', cast(user_id AS STRING)) AS live_session",
        "concat('c', cast(k % 7 AS STRING)) AS category_id",
        "concat('p', cast(k AS STRING)) AS product_id",
        "cast(user_id * 10 + k % 10 AS INT) AS gift_id",
        "event_id % 2 AS is_new",
        "concat('os', cast(user_id % 2 AS STRING)) AS os_name",
        "concat('prov', cast(user_id % 6 AS STRING)) AS province",
    )


def events(spark: SparkSession, sf_dir: str, names: str = "live", gaps: bool = False) -> DataFrame:
    """Events in the model shape the operators consume.

    ``names`` picks the event-name namespace: ``live`` (appLaunch, liveEnter,
    ...) or ``product`` (product_view, ...).  Properties travel in a
    ``map<string,string>`` exactly as parsed from the feed, and also as flat
    columns, which the operators prefer (see ``functions.columns.prop``), so
    that the map is pruned from the plan.
    """
    name = "event_name" if names == "live" else "product_event"
    keys = ("anchor_id", "room_id", "live_session", "category_id", "product_id")
    pairs = ", ".join(f"'{k}', {k}" for k in keys)
    return ev(spark, sf_dir, gaps).selectExpr(
        "record_id", "event_id AS seq", "cast(event_id AS STRING) AS id", "ts_ms", "device_id", "device_type",
        f"{name} AS event_name", "release_channel", "os_name", "province",
        "cast(is_new AS INT) AS is_new", "0 AS is_n",
        f"map({pairs}, 'gift_id', cast(gift_id AS STRING)) AS properties",
        *keys, "cast(gift_id AS STRING) AS gift_id")


def topic_records(spark: SparkSession, sf_dir: str, names: str = "live") -> DataFrame:
    """``events`` replayed as topic records (topic, partition, offset, value)."""
    v = spread(ev(spark, sf_dir))
    return v.select(F.lit(EVENTS_TOPIC).alias("topic"), F.lit(EVENTS_PARTITION).alias("partition"),
                    F.col("event_id").alias("offset"), event_json(v, names).alias("value"))


def event_json(v: DataFrame, names: str = "live") -> Column:
    """One ``ev`` row as the JSON line the app produces (wire field names).

    Every tenth line or so writes its numbers as quoted texts.
    """
    name = "event_name" if names == "live" else "product_event"
    props = F.struct(F.col("anchor_id"), F.col("room_id"), F.col("live_session"),
                     F.col("category_id"), F.col("product_id"), F.col("gift_id"))
    def line(quoted: bool) -> Column:
        def number(c: Column) -> Column:
            return c.cast("string") if quoted else c
        return F.to_json(F.struct(
            F.col("event_id").cast("string").alias("id"), F.col("device_id").alias("deviceId"),
            F.col("device_type").alias("deviceType"), F.col(name).alias("eventId"),
            F.col("release_channel").alias("releaseChannel"), F.col("os_name").alias("osName"),
            F.col("province").alias("province"), number(F.col("ts_ms")).alias("timestamp"),
            number(F.col("is_new").cast("int")).alias("isNew"), props.alias("properties")))
    return F.when(F.col("event_id") % 10 == 3, line(True)).otherwise(line(False))


def event_lines(spark: SparkSession, sf_dir: str, cut_every: int = 50) -> DataFrame:
    """Topic records whose every ``cut_every``-th line is cut in half (malformed)."""
    r = topic_records(spark, sf_dir)
    cut = F.substring(F.col("value"), 1, (F.length("value") / 2).cast("int"))
    return r.withColumn("value", F.when(F.col("offset") % cut_every == 0, cut).otherwise(F.col("value")))


def event_type_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id,event_type`` text lines with their record id."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit(f"{EVENTS_TOPIC}-{EVENTS_PARTITION}-"), F.col("event_id").cast("string")).alias("record_id"),
        F.concat_ws(",", F.col("event_id").cast("string"), F.col("event_type")).alias("value"))


def order_lines_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as group-buy order lines ``epoch_ms,order id,status,price``."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat_ws(",", epoch_ms_from_ntz("o_orderdate", NEAREST).cast("string"),
                                F.col("o_orderkey").cast("string"), F.col("o_orderstatus"),
                                F.col("o_totalprice").cast("string")).alias("value"))


# Change type by key % 3.
CDC_TYPES = ("INSERT", "UPDATE", "DELETE")


def _cdc_type(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in CDC_TYPES]), (key % 3 + 1).cast("int"))


def _change(kind: Column, quoted: Column, row: list[Column]) -> Column:
    """A change-capture envelope; where ``quoted`` its numbers are quoted texts
    and its times have a fraction of seconds, as some capture tools write them."""
    def text(c: Column) -> Column:
        return F.to_json(F.struct(kind.alias("type"), F.array(c).alias("data")))
    return F.when(quoted, text(F.struct(*[c(True) for c in row]))).otherwise(text(F.struct(*[c(False) for c in row])))


def _number(value: Column, name: str):
    return lambda quoted: (value.cast("string") if quoted else value).alias(name)


def _text(value: Column, name: str):
    return lambda quoted: value.alias(name)


def _time(c: str, name: str):
    return lambda quoted: (F.concat(ntz_text(c), F.lit(".0")) if quoted else ntz_text(c)).alias(name)


def order_cdc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as change-capture envelopes, one order per envelope."""
    o = spread(table(spark, sf_dir, "orders"))
    status = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2)
    row = [_number(F.col("o_orderkey"), "oid"), _time("o_orderdate", "create_time"),
           _number(F.col("o_totalprice"), "total_money"), _number(status, "status"),
           _time("o_orderdate", "update_time"), _text(F.col("o_orderpriority"), "province"),
           _text(F.concat(F.lit("c"), F.col("o_custkey").cast("string")), "city")]
    return o.select(_change(_cdc_type(F.col("o_orderkey")), F.col("o_orderkey") % 5 == 2, row).alias("value"))


def order_line_cdc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as change-capture envelopes, one line per envelope."""
    li = spread(table(spark, sf_dir, "lineitem"))
    row = [_number(F.col("l_orderkey") * 10 + F.col("l_linenumber"), "id"), _number(F.col("l_orderkey"), "order_id"),
           _number((F.col("l_partkey") % 50).cast("int"), "category_id"),
           _text(F.col("l_returnflag"), "categoryName"), _number(F.col("l_partkey"), "sku"),
           _number(F.col("l_extendedprice"), "money"), _number(F.col("l_quantity").cast("int"), "amount"),
           _time("l_shipdate", "create_time"), _time("l_shipdate", "update_time")]
    return li.select(_change(_cdc_type(F.col("l_orderkey")), F.col("l_orderkey") % 5 == 2, row).alias("value"))


def gift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gift dimension's change log: (id, name, point, deleted, seq).

    Every part is a change of a gift; four parts in a row are changes of three
    gifts, so gifts and changes grow with ``part``.  The order of the changes
    is spread over the keys, and one change in seven deletes its gift.
    """
    p = table(spark, sf_dir, "part")
    return p.selectExpr(
        "p_partkey * 3 div 4 AS id", "p_name AS name", "p_retailprice / 100 AS point",
        "CASE WHEN p_partkey % 7 = 3 THEN 1 ELSE 0 END AS deleted", "p_partkey * 7919 % 104729 AS seq")


# Fixed values (FIXTURES.md): the change with number seq comes so long after the first event's month starts.
GIFT_EPOCH_MS, GIFT_STEP_MS = 1_704_067_200_000, 24_750


def timed_gift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log with the time of each change, spread over the events' month."""
    return gift_log(spark, sf_dir).withColumn("changed_ms", F.lit(GIFT_EPOCH_MS) + F.col("seq") * GIFT_STEP_MS)


# ---- orders ---------------------------------------------------------------

DAY_MS = 86_400_000
# Fixed values (FIXTURES.md): a line arrives (order key % 60) days after its
# event time, arrivals are cut into 90-day batches.
ARRIVAL_SPREAD_DAYS = 60
ARRIVAL_BATCH_MS = 90 * DAY_MS


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines (details): order_id, line, sku, ts_ms, and the arrival batch (NULL for a few)."""
    li = table(spark, sf_dir, "lineitem")
    ts = epoch_ms_from_ntz("l_shipdate", NEAREST)
    arrival = ts + (F.col("l_orderkey") % ARRIVAL_SPREAD_DAYS) * F.lit(DAY_MS)
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
                     F.col("l_partkey").alias("sku"), ts.alias("ts_ms"),
                     F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 97 != 3, (
                         floor_to(arrival, ARRIVAL_BATCH_MS) / F.lit(ARRIVAL_BATCH_MS)).cast("long")).alias("batch"))


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers (mains): order_id, ts_ms, total_money, status."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), epoch_ms_from_ntz("o_orderdate", NEAREST).alias("ts_ms"),
                    F.col("o_totalprice").alias("total_money"), F.col("o_orderstatus").alias("status"))


# ---- group-buying ---------------------------------------------------------

# Fixed values (FIXTURES.md): a group-buy main opens (partkey % 2500) days after 1995-01-01.
GROUPON_BASE_MS = 788_918_400_000
GROUPON_SPREAD_DAYS = 2500


def groupon_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    # three string keys per row: worth spreading a single-file scan first
    li = spread(table(spark, sf_dir, "lineitem"))
    return li.select(epoch_ms_from_ntz("l_shipdate", NEAREST).alias("ts_ms"),
                     _s("u", F.col("l_suppkey")).alias("user_id"),
                     _s("p", F.col("l_partkey")).alias("groupon_id"),
                     _s("o", F.col("l_orderkey")).alias("order_id"))


def groupon_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    ts = F.lit(GROUPON_BASE_MS) + (F.col("p_partkey") % GROUPON_SPREAD_DAYS) * F.lit(DAY_MS)
    return p.select(ts.alias("ts_ms"), _s("p", F.col("p_partkey")).alias("groupon_id"),
                    F.col("p_size").alias("status"), F.col("p_type").alias("category"))


def groupon_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(epoch_ms_from_ntz("o_orderdate", NEAREST).alias("ts_ms"), _s("o", F.col("o_orderkey")).alias("order_id"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("money"))
