"""Layer 2: the literal cases of FIXTURES.md part C, worked by hand."""

from pyspark.sql import functions as F

from livestats import schemas
from livestats.functions import parse
from livestats.functions.columns import composite_key
from livestats.operators import audience, gifts, groupon, products, users, windows

from .helpers import BASE, events, lines


def _live(spark, rows):
    ev = events(spark, [dict(event_name=n, ts_ms=BASE + t, seq=i,
                             properties={"anchor_id": "a1", "room_id": "r1", "live_session": s})
                        for i, (n, t, s) in enumerate(rows)])
    return audience.live_events(ev)


def _effective(spark, rows, stay=60_000):
    r = audience.effective_audience(_live(spark, rows), stay_ms=stay).collect()
    return (r[0]["effective_audience"], r[0]["online_audience"])


def test_stay_time_cases(spark):
    E, L = schemas.LIVE_ENTER, schemas.LIVE_LEAVE
    assert _effective(spark, [(E, 0, "s1"), (L, 59_999, "s1")]) == (0, 0)
    assert _effective(spark, [(E, 0, "s1"), (L, 60_000, "s1")]) == (1, 0)
    assert _effective(spark, [(E, 0, "s1"), (E, 30_000, "s1")]) == (1, 2)
    assert _effective(spark, [(E, 0, "s1"), (E, 90_000, "s1")]) == (2, 2)
    assert _effective(spark, [(L, 0, "s1")]) == (0, -1)


def test_stay_time_across_buckets(spark):
    # the next event falls in the next (small) time bucket: still found
    E, L = schemas.LIVE_ENTER, schemas.LIVE_LEAVE
    live = _live(spark, [(E, 0, "s1"), (L, 59_999, "s1"), (E, 100_000, "s1"), (L, 250_000, "s1")])
    r = audience.effective_audience(live, stay_ms=60_000).collect()
    assert (r[0]["effective_audience"], r[0]["online_audience"]) == (1, 0)


def test_running_audience(spark):
    E, L = schemas.LIVE_ENTER, schemas.LIVE_LEAVE
    live = _live(spark, [(E, 0, "s1"), (E, 1, "s2"), (L, 2, "s1")])
    got = audience.running_audience(live).orderBy("record_id").collect()
    assert [(r.total_audience, r.online_audience) for r in got] == [(1, 1), (2, 2), (2, 1)]


def test_running_audience_many_buckets(spark):
    # the same answer whatever the bucket size
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice([schemas.LIVE_ENTER, schemas.LIVE_LEAVE]), rnd.randrange(0, 50_000), "s")
            for _ in range(300)]
    live = _live(spark, rows)
    a = audience.running_audience(live, bucket_ms=1_000).orderBy("record_id").collect()
    b = audience.running_audience(live, bucket_ms=10**9).orderBy("record_id").collect()
    assert a == b
    last = max(range(len(rows)), key=lambda i: (rows[i][1], i))
    enters = sum(1 for r in rows if r[0] == schemas.LIVE_ENTER)
    by_id = {r.record_id: r for r in a}
    assert by_id[f"t-0-{last}"].total_audience == enters
    assert by_id[f"t-0-{last}"].online_audience == 2 * enters - len(rows)


def test_gift_unknown_and_deleted(spark):
    log = spark.createDataFrame([(1, "rose", 1.5, 0, 1), (2, "car", 100.0, 0, 2), (2, "car", 100.0, 1, 3)],
                                "id int, name string, point double, deleted int, seq long")
    snap = gifts.gift_snapshot(log)
    assert [tuple(r) for r in snap.collect()] == [(1, "rose", 1.5)]
    ev = events(spark, [dict(event_name=schemas.LIVE_REWARD,
                             properties={"anchor_id": "a", "room_id": "r", "gift_id": g})
                        for g in ("9", "9", "2")])
    enriched = gifts.enrich(gifts.rewards(ev), snap)
    assert [(r.gift_name, r.point) for r in enriched.collect()] == [(None, None)] * 3
    tot = gifts.gift_totals(enriched).collect()
    assert (tot[0].amount, tot[0].points) == (3, None)


def test_malformed_json(spark):
    good = '{"id": "1", "deviceId": "d1", "eventId": "appLaunch", "timestamp": 5, "properties": {"gift_id": 7}}'
    df = parse.parse_events(lines(spark, ["{bad", "null", "", good, None]))
    rows = df.collect()
    assert len(rows) == 1
    assert rows[0].device_id == "d1" and rows[0].is_new == 0 and rows[0].properties["gift_id"] == "7"
    dead = parse.parse_events(lines(spark, ["{bad", "null", "", good]), dead_letter=True)
    assert sorted(r.value for r in dead.collect()) == ["", "null", "{bad"]


def test_cdc_types(spark):
    row = '{{"oid": {k}, "create_time": "2024-01-01 00:00:00", "total_money": 1.5, "status": 1}}'
    env = lambda t, ks: '{"type": "%s", "data": [%s]}' % (t, ",".join(row.format(k=k) for k in ks))
    df = parse.parse_cdc(lines(spark, [env("INSERT", [1, 2]), env("UPDATE", [3]), env("DELETE", [4])]),
                         schemas.ORDER_HEADER)
    got = sorted((r.oid, r.op_type) for r in df.collect())
    assert got == [(1, "INSERT"), (2, "INSERT"), (3, "UPDATE")]
    assert df.where("oid = 1").first().create_time is not None


def test_delimited(spark):
    df = parse.split_delimited(lines(spark, ["spark,3", "hive, 4", "bad", "x,notanumber"]), schemas.WORD_COUNT)
    assert sorted(tuple(r) for r in df.collect()) == [("hive", 4), ("spark", 3)]


def test_composite_key_null(spark):
    df = spark.createDataFrame([(None, "phone")], "c string, d string")
    assert df.select(composite_key("c", "d")).first()[0] == "null-phone"


def test_first_seen(spark):
    ev = events(spark, [dict(device_id=d, device_type="t") for d in ("d1", "d2", "d1")])
    got = users.first_seen(ev).orderBy("seq").select("is_n").collect()
    assert [r.is_n for r in got] == [1, 1, 0]


def test_top3_ties(spark):
    counts = spark.createDataFrame(
        [(0, 10, "c", "e", p, n) for p, n in (("p1", 5), ("p4", 4), ("p2", 4), ("p3", 4))],
        "window_start long, window_end long, category_id string, event_id string, product_id string, cnt long")
    got = products.hot_goods(counts).orderBy(F.col("cnt").desc(), "product_id").collect()
    assert [r.product_id for r in got] == ["p1", "p2", "p3"]


def test_window_sum_with_history(spark):
    base = BASE
    df = spark.createDataFrame([("spark", 3, base), ("hive", 4, base + 1), ("spark", 5, base + 2),
                                ("spark", 2, base + 10_000)], "key string, value int, ts_ms long")
    s = windows.windowed_sum(df, ["key"], "value", 10_000)
    h = windows.with_history(s, ["key"], "window_start", {"value_sum": "total"})
    got = sorted((r.key, r.window_start - base, r.value_sum, r.total) for r in h.collect())
    assert got == [("hive", 0, 4, 4), ("spark", 0, 8, 8), ("spark", 10_000, 2, 10)]


def _groupon(spark, main_first_ts):
    d = spark.createDataFrame([(BASE + 1001, "u1646", "p201", "o1002"), (BASE + 5001, "u1647", "p202", "o1003")],
                              "ts_ms long, user_id string, groupon_id string, order_id string")
    m = spark.createDataFrame([(BASE + main_first_ts, "p201", "1", "phone"), (BASE + 5001, "p202", "1", "phone")],
                              "ts_ms long, groupon_id string, status string, category string")
    o = spark.createDataFrame([(BASE + 1002, "o1002", "101", 2000.0), (BASE + 5002, "o1003", "101", 3000.0)],
                              "ts_ms long, order_id string, status string, money double")
    return sorted(tuple(r) for r in groupon.groupon_join(d, m, o, size_ms=5_000).collect())


def test_groupon_cases(spark):
    assert _groupon(spark, 1000) == [("u1646", "p201", "o1002", "1", "phone", "101", 2000.0),
                                     ("u1647", "p202", "o1003", "1", "phone", "101", 3000.0)]
    assert _groupon(spark, 5001)[0] == ("u1646", "p201", "o1002", None, None, "101", 2000.0)


def test_epoch_ms_independent_of_session_zone(spark):
    from livestats.functions.columns import epoch_ms_from_ntz
    df = spark.createDataFrame([("2024-07-01 10:20:30.123500",), ("1969-12-31 23:59:59.999500",)], "s string") \
              .select(F.col("s").cast("timestamp_ntz").alias("ts"))
    want = [1719829230124, -1]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(epoch_ms_from_ntz("ts", "nearest")).collect()]
            assert got == want, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_launch_hour_in_zone(spark):
    from livestats.functions.columns import date_part, hour_part
    df = spark.createDataFrame([(1704067200000,)], "ms long")  # 2024-01-01 00:00 UTC
    r = df.select(date_part("ms").alias("d"), hour_part("ms").alias("h"),
                  date_part("ms", "Asia/Shanghai").alias("d8"), hour_part("ms", "Asia/Shanghai").alias("h8")).first()
    assert tuple(r) == ("20240101", "00", "20240101", "08")


def test_incomplete_rows_dropped_and_counted(spark):
    from pyspark.sql import Observation
    ev = events(spark, [dict(event_name=schemas.LIVE_ENTER, properties={"anchor_id": "a", "room_id": "r"}),
                        dict(event_name=schemas.LIVE_ENTER, properties={"anchor_id": "a"}),
                        dict(event_name=schemas.LIVE_LEAVE, properties={})])
    obs = Observation("live_incomplete")
    assert audience.live_events(ev, metrics=obs).count() == 1
    assert obs.get["dropped"] == 2 and obs.get["rows"] == 3


def test_zone_free_formatting_at_a_dst_gap(spark):
    # 1995-10-15 00:00 did not exist in Sao Paulo (DST began at midnight)
    from livestats.functions.columns import date_part, hour_part, ntz_text
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        df = spark.createDataFrame([("1995-10-15 00:30:00", 813717000000)], "s string, ms long") \
                  .withColumn("ts", F.col("s").cast("timestamp_ntz"))
        r = df.select(ntz_text("ts").alias("t"), date_part("ms").alias("d"), hour_part("ms").alias("h"),
                      hour_part("ms", "Asia/Shanghai").alias("h8")).first()
        assert tuple(r) == ("1995-10-15 00:30:00", "19951015", "00", "08")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
