"""DuckDB oracles: for each registered query, SQL over the base tables.

The driver registers only the base tables, so the derived views of
FIXTURES.md (``ev``, ``gift_log``, ``gift_dim``, ``late_flagged``) are inlined
as CTEs.  Casts pin the column types to the ones the Spark side produces.
"""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id, 'events-0-' || event_id AS record_id, epoch_ms(ts) AS ts_ms, 'd' || user_id AS device_id,
         'type' || (user_id % 4) AS device_type, event_type,
         CASE event_type WHEN 'signup' THEN 'appLaunch' WHEN 'view' THEN 'liveEnter' WHEN 'click' THEN 'liveLeave'
                         WHEN 'purchase' THEN 'liveReward' ELSE event_type END AS event_name,
         CASE WHEN event_type IN ('view','click','purchase') THEN 'product_' || event_type ELSE event_type END AS product_event,
         k, 'ch' || (k % 5) AS release_channel, 'a' || (k % 10) AS anchor_id, 'r' || (k % 20) AS room_id,
         's' || user_id AS live_session, 'c' || (k % 7) AS category_id, 'p' || k AS product_id, CAST(user_id * 10 + k % 10 AS INTEGER) AS gift_id,
         CAST(event_id % 2 AS INTEGER) AS is_new,
         'os' || (user_id % 2) AS os_name, 'prov' || (user_id % 6) AS province
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events))"""

# The same with gaps: some events lack their time, device or session.
EV_GAPS = EV + """,
evg AS (
  SELECT * REPLACE (CASE WHEN event_id % 101 <> 11 THEN ts_ms END AS ts_ms,
                    CASE WHEN event_id % 37 <> 5 THEN device_id END AS device_id,
                    CASE WHEN event_id % 31 <> 7 THEN live_session END AS live_session) FROM ev)"""

# The whole part table is the change log: four parts are changes of three gifts.
GIFT_LOG = """gift_log AS (
  SELECT p_partkey * 3 // 4 AS id, p_name AS name, p_retailprice / 100 AS point,
         CASE WHEN p_partkey % 7 = 3 THEN 1 ELSE 0 END AS deleted, p_partkey * 7919 % 104729 AS seq
  FROM part)"""

GIFT_DIM = """gift_dim AS (
  SELECT id, name, point FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM gift_log)
  WHERE rn = 1 AND deleted = 0)"""

# Every version of a gift with the time it is valid from and until.
GIFT_VERSIONS = """gift_versions AS (
  SELECT id, name, point, deleted, changed_ms,
         lead(changed_ms) OVER (PARTITION BY id ORDER BY changed_ms, seq) AS until_ms
  FROM (SELECT *, 1704067200000 + seq * 24750 AS changed_ms FROM gift_log))"""

LATE_FLAGGED = """x AS (SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS sku, epoch_ms(l_shipdate) AS ts_ms,
                  CASE WHEN (l_orderkey + l_linenumber) % 97 <> 3
                       THEN (epoch_ms(l_shipdate) + (l_orderkey % 60) * 86400000) // 7776000000 END AS b FROM lineitem),
     m AS (SELECT b, max(ts_ms) AS mx FROM x WHERE b IS NOT NULL GROUP BY b),
     wm AS (SELECT b, max(mx) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm FROM m),
     late_flagged AS (SELECT order_id, line, sku, ts_ms,
                             coalesce((ts_ms // 2592000000 + 1) * 2592000000 <= wm.wm, false) AS is_late
                      FROM x LEFT JOIN wm USING (b))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["product_window_counts"] = _with(EV) + """
SELECT category_id, product_id, product_event AS event_id, count(*) AS cnt, ws AS window_start, ws + 600000 AS window_end
FROM (SELECT *, ts_ms // 60000 * 60000 - unnest(range(10)) * 60000 AS ws FROM ev WHERE product_event LIKE 'product%')
GROUP BY ALL"""

ORACLE["hot_goods_top3"] = _with(EV, """c AS (
  SELECT category_id, product_id, product_event AS event_id, count(*) AS cnt, ws AS window_start, ws + 86400000 AS window_end
  FROM (SELECT *, ts_ms // 21600000 * 21600000 - unnest(range(4)) * 21600000 AS ws FROM ev WHERE product_event LIKE 'product%')
  GROUP BY ALL)""") + """
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY window_start, window_end, category_id, event_id
                                                       ORDER BY cnt DESC, product_id) AS rn FROM c) WHERE rn <= 3"""

# ---- sources and parsing --------------------------------------------------

ORACLE["record_id"] = """
SELECT 'events-0-' || event_id AS record_id, 'events' AS topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset"
FROM events"""

_PARSED = """CAST(event_id AS VARCHAR) AS id, device_id, device_type, event_name AS event_id, release_channel, os_name,
       province, ts_ms, is_new, anchor_id, room_id, live_session, category_id, product_id, gift_id"""

# Every 50th line is cut in half by the fixture and must be dropped.
ORACLE["parse_events"] = _with(EV) + f"SELECT {_PARSED} FROM ev WHERE event_id % 50 <> 0"

ORACLE["parse_events_with_id"] = _with(EV) + f"SELECT record_id, {_PARSED} FROM ev WHERE event_id % 50 <> 0"

ORACLE["error_free_lines"] = """
SELECT 'events-0-' || event_id AS key, event_id || ',' || event_type AS value
FROM events WHERE NOT contains(event_id || ',' || event_type, 'error')"""

ORACLE["delimited_orders"] = """
SELECT epoch_ms(o_orderdate) AS ts_ms, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status,
       o_totalprice AS money
FROM orders"""

_OP_TYPE = "CASE {k} % 3 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END"

ORACLE["cdc_orders"] = f"""
SELECT * FROM (
  SELECT o_orderkey AS oid, epoch_ms(o_orderdate) AS create_time, o_totalprice AS total_money,
         CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS status,
         epoch_ms(o_orderdate) AS update_time, o_orderpriority AS province, 'c' || o_custkey AS city,
         {_OP_TYPE.format(k='o_orderkey')} AS op_type
  FROM orders)
WHERE op_type IN ('INSERT', 'UPDATE')"""

ORACLE["cdc_order_lines"] = f"""
SELECT * FROM (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, CAST(l_partkey % 50 AS INTEGER) AS category_id,
         l_returnflag AS category_name, l_partkey AS sku, l_extendedprice AS money,
         CAST(trunc(l_quantity) AS INTEGER) AS amount, epoch_ms(l_shipdate) AS create_time,
         epoch_ms(l_shipdate) AS update_time, {_OP_TYPE.format(k='l_orderkey')} AS op_type
  FROM lineitem)
WHERE op_type IN ('INSERT', 'UPDATE')"""

# ---- filters --------------------------------------------------------------

ORACLE["app_launches"] = _with(EV) + """
SELECT record_id, device_id, event_name AS event_id, ts_ms FROM ev WHERE event_name = 'appLaunch'"""

ORACLE["live_events"] = _with(EV) + """
SELECT record_id, event_name AS event_id, anchor_id, room_id, live_session, ts_ms
FROM ev WHERE event_name IN ('liveEnter', 'liveLeave')"""

ORACLE["product_events"] = _with(EV) + """
SELECT record_id, category_id, product_id, product_event AS event_id, ts_ms FROM ev WHERE product_event LIKE 'product%'"""

# ---- users ----------------------------------------------------------------

ORACLE["new_user_count"] = _with(EV) + """
SELECT is_new, count(*) AS new_users FROM ev WHERE event_name = 'appLaunch' GROUP BY is_new HAVING is_new = 1"""

ORACLE["new_users_by_channel"] = _with(EV) + """
SELECT release_channel AS channel, count(*) AS new_users FROM ev WHERE event_name = 'appLaunch' AND is_new = 1 GROUP BY 1"""

ORACLE["launches_by_channel_device"] = _with(EV) + """
SELECT release_channel || '-' || device_type AS channel_device, count(*) AS launches FROM ev WHERE event_name = 'appLaunch' GROUP BY 1"""

_LAUNCH_ROW = """record_id AS id, device_id, event_name AS event_id, {flag} AS is_new, os_name AS os, province,
       release_channel AS channel, device_type, ts_ms AS event_time,
       strftime(make_timestamp(ts_ms * 1000), '%Y%m%d') AS date, strftime(make_timestamp(ts_ms * 1000), '%H') AS hour"""

ORACLE["launch_rows"] = _with(EV) + f"""
SELECT {_LAUNCH_ROW.format(flag='is_new')} FROM ev WHERE event_name = 'appLaunch'"""

# An event without a time is never first.
_FIRST = ("CASE WHEN ts_ms IS NOT NULL AND row_number() OVER (PARTITION BY {keys}, ts_ms IS NULL "
          "ORDER BY ts_ms, event_id) = 1 THEN 1 ELSE 0 END")

ORACLE["launch_rows_first_seen"] = _with(EV) + f"""
SELECT {_LAUNCH_ROW.format(flag='is_n')}
FROM (SELECT *, {_FIRST.format(keys='device_id')} AS is_n FROM ev) WHERE event_name = 'appLaunch'"""

ORACLE["launch_rows_per_hour"] = _with(EV) + f"""
SELECT date, hour, count(*) AS launches
FROM (SELECT {_LAUNCH_ROW.format(flag='is_new')} FROM ev WHERE event_name = 'appLaunch') GROUP BY ALL"""

ORACLE["new_device_flag"] = _with(EV_GAPS) + f"""
SELECT record_id, device_id, {_FIRST.format(keys='device_id')} AS is_n FROM evg"""

ORACLE["new_device_by_type"] = _with(EV_GAPS) + f"""
SELECT record_id, device_type, device_id, {_FIRST.format(keys='device_type, device_id')} AS is_n FROM evg"""

# ---- audience -------------------------------------------------------------

_LIVE = "ev WHERE event_name IN ('liveEnter', 'liveLeave')"
_LIVE_GAPS = "evg WHERE event_name IN ('liveEnter', 'liveLeave')"
_ENTER = "CASE WHEN event_name = 'liveEnter' THEN 1 ELSE 0 END"
_DELTA = "CASE WHEN event_name = 'liveEnter' THEN 1 ELSE -1 END"

ORACLE["audience_running"] = _with(EV_GAPS) + f"""
SELECT record_id, anchor_id, room_id,
       CAST(sum({_ENTER}) OVER w AS BIGINT) AS total_audience,
       CAST(sum({_DELTA}) OVER w AS BIGINT) AS online_audience
FROM {_LIVE_GAPS}
WINDOW w AS (PARTITION BY anchor_id, room_id ORDER BY ts_ms NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING)"""

ORACLE["audience_totals"] = _with(EV) + f"""
SELECT anchor_id, room_id, CAST(sum({_ENTER}) AS BIGINT) AS total_audience,
       CAST(sum({_DELTA}) AS BIGINT) AS online_audience
FROM {_LIVE} GROUP BY ALL"""

_DAY_DELTA = f"""d AS (SELECT anchor_id, room_id, ts_ms // 86400000 * 86400000 AS window_start,
                  CAST(sum({_ENTER}) AS BIGINT) AS enters, CAST(sum({_DELTA}) AS BIGINT) AS delta
           FROM {_LIVE} GROUP BY ALL)"""

ORACLE["audience_window_delta"] = _with(EV, _DAY_DELTA) + """
SELECT anchor_id, room_id, window_start, enters, delta, window_start + 86400000 AS window_end FROM d"""

ORACLE["audience_window_history"] = _with(EV, _DAY_DELTA) + """
SELECT anchor_id, room_id, window_start,
       CAST(sum(enters) OVER w AS BIGINT) AS total_audience, CAST(sum(delta) OVER w AS BIGINT) AS online_audience
FROM d WINDOW w AS (PARTITION BY anchor_id, room_id ORDER BY window_start ROWS UNBOUNDED PRECEDING)"""

# Stay threshold 2 days on this data (the job's default is 60 s).
ORACLE["effective_audience"] = _with(EV_GAPS, f"""s AS (
  SELECT *, lead(ts_ms) OVER (
    PARTITION BY anchor_id, room_id, live_session, CASE WHEN live_session IS NULL OR ts_ms IS NULL THEN event_id END
    ORDER BY ts_ms, event_id) AS next_ms
  FROM {_LIVE_GAPS})""") + """
SELECT anchor_id, room_id,
       CAST(sum(CASE WHEN event_name = 'liveEnter' AND ts_ms IS NOT NULL AND (next_ms IS NULL OR next_ms - ts_ms >= 172800000) THEN 1 ELSE 0 END) AS BIGINT) AS effective_audience,
       CAST(sum(CASE WHEN event_name = 'liveEnter' THEN 1 ELSE -1 END) AS BIGINT) AS online_audience
FROM s GROUP BY ALL"""

# ---- gifts ----------------------------------------------------------------

ORACLE["gift_dim_current"] = _with(GIFT_LOG, GIFT_DIM) + "SELECT id, name, point FROM gift_dim"

ORACLE["gift_enriched"] = _with(EV, GIFT_LOG, GIFT_DIM) + """
SELECT record_id, anchor_id, room_id, name AS gift_name, 1 AS amount, point
FROM ev LEFT JOIN gift_dim ON gift_id = id WHERE event_name = 'liveReward'"""

ORACLE["gift_totals"] = _with(EV, GIFT_LOG, GIFT_DIM) + """
SELECT anchor_id, room_id, count(*) AS amount, CAST(sum(CAST(point AS DECIMAL(28,10))) AS DOUBLE) AS points
FROM ev LEFT JOIN gift_dim ON gift_id = id WHERE event_name = 'liveReward' GROUP BY ALL"""

ORACLE["gift_count_by_name"] = _with(EV, GIFT_LOG, GIFT_DIM) + """
SELECT name AS gift_name, count(*) AS amount
FROM ev LEFT JOIN gift_dim ON gift_id = id WHERE event_name = 'liveReward' GROUP BY name"""

_AS_OF = _with(EV, GIFT_LOG, GIFT_VERSIONS) + """SELECT {columns}
FROM (SELECT * FROM ev WHERE event_name = 'liveReward') e LEFT JOIN gift_versions v
  ON gift_id = id AND deleted = 0 AND ts_ms >= changed_ms AND (until_ms IS NULL OR ts_ms < until_ms){tail}"""

ORACLE["gift_enriched_as_of"] = _AS_OF.format(
    columns="record_id, anchor_id, room_id, name AS gift_name, 1 AS amount, point", tail="")

ORACLE["gift_totals_as_of"] = _AS_OF.format(
    columns="anchor_id, room_id, count(*) AS amount, CAST(sum(CAST(point AS DECIMAL(28,10))) AS DOUBLE) AS points",
    tail=" GROUP BY ALL")

# ---- generic windows --------------------------------------------------------

_DAY_SUM = """ws AS (SELECT event_type AS key, ts_ms // 86400000 * 86400000 AS window_start,
                   CAST(sum(k) AS BIGINT) AS value_sum FROM ev GROUP BY ALL)"""

ORACLE["window_sum"] = _with(EV, _DAY_SUM) + """
SELECT key, window_start, value_sum, window_start + 86400000 AS window_end FROM ws"""

ORACLE["window_sum_history"] = _with(EV, _DAY_SUM) + """
SELECT key, window_start, window_start + 86400000 AS window_end,
       CAST(sum(value_sum) OVER (PARTITION BY key ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM ws"""

# ---- orders ---------------------------------------------------------------

# 30-day windows; all lines, arrival order ignored.
ORACLE["order_join"] = """
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line, l.l_partkey AS sku, o.o_totalprice AS total_money,
       o.o_orderstatus AS status
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
     AND epoch_ms(l.l_shipdate) // 2592000000 = epoch_ms(o.o_orderdate) // 2592000000"""

ORACLE["late_order_lines"] = _with(LATE_FLAGGED) + "SELECT order_id, line, sku FROM late_flagged WHERE is_late"

ORACLE["orders_with_late"] = _with(LATE_FLAGGED) + """
SELECT f.order_id, f.line, f.sku, f.is_late, o.o_orderkey IS NOT NULL AS joined_in_window,
       coalesce(o.o_totalprice, s.o_totalprice) AS total_money, coalesce(o.o_orderstatus, s.o_orderstatus) AS status
FROM late_flagged f
LEFT JOIN orders o ON NOT f.is_late AND f.order_id = o.o_orderkey AND f.ts_ms // 2592000000 = epoch_ms(o.o_orderdate) // 2592000000
LEFT JOIN orders s ON f.order_id = s.o_orderkey"""

# 365-day windows.
ORACLE["groupon_join"] = """
SELECT 'u' || l_suppkey AS user_id, 'p' || l_partkey AS groupon_id, 'o' || l_orderkey AS order_id,
       p_size AS groupon_status, p_type AS category, o_orderstatus AS order_status, o_totalprice AS money
FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey AND epoch_ms(l_shipdate) // 31536000000 = (788918400000 + (p_partkey % 2500) * 86400000) // 31536000000
LEFT JOIN orders ON l_orderkey = o_orderkey AND epoch_ms(l_shipdate) // 31536000000 = epoch_ms(o_orderdate) // 31536000000"""
