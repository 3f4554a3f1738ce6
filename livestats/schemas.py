"""Schemas of the app's feeds.

The JSON field names are the wire format of the producers and stay camelCase;
parsers rename them to the snake_case model columns listed in ``EVENT_COLUMNS``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
TS = T.TimestampType()

# Event JSON fields as produced by the app (wire names).
EVENT_JSON_FIELDS = [
    ("id", S), ("deviceId", S), ("guid", S), ("account", S), ("appId", S),
    ("appVersion", S), ("carrier", S), ("deviceType", S), ("eventId", S),
    ("ip", S), ("netType", S), ("osName", S), ("osVersion", S),
    ("releaseChannel", S), ("resolution", S), ("sessionId", S),
    ("newSessionId", S), ("country", S), ("province", S), ("city", S),
    ("region", S), ("date", S), ("hour", S),
    ("latitude", D), ("longitude", D),
    ("timestamp", L), ("lastUpdate", L),
    ("isNew", I), ("isN", I),
    ("properties", T.MapType(S, S)),
]

# wire name -> model column.  ``eventId`` carries the event *name*
# (appLaunch, liveEnter, ...), so the model calls it ``event_name``; the
# ``timestamp`` field is epoch milliseconds and becomes ``ts_ms``.
_RENAMES = {"eventId": "event_name", "timestamp": "ts_ms"}


def _snake(name: str) -> str:
    out = []
    for ch in name:
        if ch.isupper():
            out.append("_" + ch.lower())
        else:
            out.append(ch)
    return "".join(out)


EVENT_COLUMNS = {w: _RENAMES.get(w, _snake(w)) for w, _ in EVENT_JSON_FIELDS}

CORRUPT_COL = "_corrupt_record"

EVENT_JSON = T.StructType([T.StructField(n, t) for n, t in EVENT_JSON_FIELDS])

# Property keys read by the jobs.
LIVE_PROPS = ("anchor_id", "room_id", "live_session")
GIFT_PROP = "gift_id"
PRODUCT_PROPS = ("category_id", "product_id")

# Event names.
APP_LAUNCH = "appLaunch"
LIVE_ENTER = "liveEnter"
LIVE_LEAVE = "liveLeave"
LIVE_REWARD = "liveReward"
PRODUCT_PREFIX = "product"

ORDER_HEADER = T.StructType([
    T.StructField("oid", L), T.StructField("create_time", TS),
    T.StructField("total_money", D), T.StructField("status", I),
    T.StructField("update_time", TS), T.StructField("province", S),
    T.StructField("city", S),
])

ORDER_LINE = T.StructType([
    T.StructField("id", L), T.StructField("order_id", L),
    T.StructField("category_id", I), T.StructField("categoryName", S),
    T.StructField("sku", L), T.StructField("money", D), T.StructField("amount", I),
    T.StructField("create_time", TS), T.StructField("update_time", TS),
])


def cdc_envelope(row_schema: T.StructType) -> T.StructType:
    """``{type, data: [row, ...]}`` as written by a binlog change capture."""
    return T.StructType([
        T.StructField("type", S),
        T.StructField("data", T.ArrayType(row_schema)),
        T.StructField(CORRUPT_COL, S),
    ])


GIFT = T.StructType([
    T.StructField("id", I), T.StructField("name", S), T.StructField("point", D),
    T.StructField("deleted", I), T.StructField("update_time", TS),
])

# Delimited feeds: (column, type) in field order.
GROUPON_DETAIL = [("ts_ms", "bigint"), ("user_id", "string"), ("groupon_id", "string"), ("order_id", "string")]
GROUPON_MAIN = [("ts_ms", "bigint"), ("groupon_id", "string"), ("status", "string"), ("category", "string")]
GROUPON_ORDER = [("ts_ms", "bigint"), ("order_id", "string"), ("status", "string"), ("money", "double")]
WORD_COUNT = [("key", "string"), ("value", "int")]
PERSON = [("id", "string"), ("name", "string"), ("age", "int")]
