"""The jobs end to end on replayed files (memory sinks)."""

import os
import time

from pyspark.sql import functions as F

from livestats.operators import gifts, products, users
from livestats.plans import jobs
from livestats.plans import testdata as td
from livestats.sources import dimension

from .conftest import SF_SMALL

DAY = 86_400_000
ONCE = {"availableNow": True}


def _replay(spark, tmp_dir, names="live", n=2):
    src = os.path.join(tmp_dir, "src")
    recs = td.topic_records(spark, SF_SMALL, names).orderBy("offset").collect()
    size = (len(recs) + n - 1) // n
    schema = "topic string, partition int, offset long, value string"
    for i in range(n):
        spark.createDataFrame(recs[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    return src


def _wait(qs):
    for q in (qs if isinstance(qs, list) else [qs]):
        q.awaitTermination(300)


def test_launch_rows_job_first_seen(spark, tmp_dir):
    src = _replay(spark, tmp_dir)
    _wait(jobs.launch_rows(spark, src, "memory", flag_col="is_n", checkpoint_root=os.path.join(tmp_dir, "ck"),
                           name="lr_job", trigger=ONCE))
    got = spark.table("lr_job")
    flagged = users.first_seen(td.events(spark, SF_SMALL))
    want = users.launch_rows(users.app_launches(flagged), flag_col="is_n")
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())


def test_user_count_job(spark, tmp_dir):
    src = _replay(spark, tmp_dir)
    ck = os.path.join(tmp_dir, "ck")
    _wait(jobs.user_count(spark, src, "memory", checkpoint_root=ck, trigger=ONCE))
    launches = users.app_launches(td.events(spark, SF_SMALL))
    assert spark.table("new_user_count").orderBy("new_users").collect()[-1].new_users == \
        users.new_user_count(launches).first().new_users
    # update mode: the last row per key holds the final count
    got = spark.table("launches_by_channel_device").groupBy("channel_device").agg(F.max("launches").alias("launches"))
    assert sorted(got.collect()) == sorted(users.launches_by_channel_device(launches).collect())


def test_hot_goods_job(spark, tmp_dir):
    src = _replay(spark, tmp_dir, "product")
    close = ('{"id": "c", "deviceId": "d", "eventId": "product_view", "timestamp": 1800000000000, '
             '"properties": {"category_id": "cz", "product_id": "pz"}}')
    spark.createDataFrame([("events", 0, 10**9, close)], "topic string, partition int, offset long, value string") \
         .write.mode("append").parquet(src)
    out = os.path.join(tmp_dir, "top")
    _wait(jobs.hot_goods(spark, src, lambda df, bid: df.write.mode("append").parquet(out),
                         size_ms=DAY, slide_ms=DAY // 4, checkpoint_root=os.path.join(tmp_dir, "ck"), trigger=ONCE))
    got = spark.read.parquet(out).where("category_id <> 'cz'")
    want = products.hot_goods(products.window_counts(
        products.product_events(td.events(spark, SF_SMALL, names="product")), DAY, DAY // 4))
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())


def test_gift_count_job(spark, tmp_dir):
    src = _replay(spark, tmp_dir)
    log = os.path.join(tmp_dir, "gift_log")
    td.gift_log(spark, SF_SMALL).withColumn("update_time", F.timestamp_seconds("seq")).write.parquet(log)
    snap = dimension.DimensionSnapshot(spark, dimension.table_changes(log), os.path.join(tmp_dir, "snap"))
    snap.refresh()
    _wait(jobs.gift_count(spark, src, snap.current(), "memory", "memory", checkpoint_root=os.path.join(tmp_dir, "ck"),
                          trigger=ONCE))
    got = spark.table("gift_totals").groupBy("anchor_id", "room_id").agg(F.max("amount").alias("amount"))
    want = gifts.gift_totals(gifts.enrich(gifts.rewards(td.events(spark, SF_SMALL)),
                                          gifts.gift_snapshot(td.gift_log(spark, SF_SMALL))))
    assert sorted(got.collect()) == sorted(want.select("anchor_id", "room_id", "amount").collect())


def test_groupon_job_literal_case(spark, tmp_dir):
    base = 1_700_000_000_000
    d, m, o = (os.path.join(tmp_dir, x) for x in ("d", "m", "o"))

    def put(path, lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)

    put(d, [f"{base + 1001},u1646,p201,o1002", f"{base + 5001},u1647,p202,o1003", f"{base + 10**9},uz,pz,oz"])
    put(m, [f"{base + 1000},p201,1,phone", f"{base + 5001},p202,1,phone", f"{base + 10**9},pz,1,x"])
    put(o, [f"{base + 1002},o1002,101,2000.0", f"{base + 5002},o1003,101,3000.0", f"{base + 10**9},oz,1,1.0"])
    _wait(jobs.groupon_count(spark, d, m, o, "memory", checkpoint_root=os.path.join(tmp_dir, "ck"), trigger=ONCE))
    got = sorted(tuple(r) for r in spark.table("groupon").where("user_id <> 'uz'").collect())
    assert got == [("u1646", "p201", "o1002", "1", "phone", "101", 2000.0),
                   ("u1647", "p202", "o1003", "1", "phone", "101", 3000.0)]


def test_filter_topic_job(spark, tmp_dir):
    src = _replay(spark, tmp_dir)
    _wait(jobs.filter_topic(spark, src, "memory", checkpoint_root=os.path.join(tmp_dir, "ck"), trigger=ONCE))
    got = spark.table("filter_topic")
    want = td.topic_records(spark, SF_SMALL).where(~F.col("value").contains("error"))
    assert got.count() == want.count() and got.where("key IS NULL").count() == 0


def test_gift_count_refreshing_job(spark, tmp_dir):
    src = _replay(spark, tmp_dir)
    log = os.path.join(tmp_dir, "gift_log")
    td.gift_log(spark, SF_SMALL).withColumn("update_time", F.timestamp_seconds("seq")).write.parquet(log)
    snap = dimension.DimensionSnapshot(spark, dimension.table_changes(log), os.path.join(tmp_dir, "snap"))
    landing = os.path.join(tmp_dir, "enriched")
    q1, start_totals = jobs.gift_count_refreshing(spark, src, snap, landing, "memory", "memory",
                                                  checkpoint_root=os.path.join(tmp_dir, "ck"), trigger=ONCE)
    _wait(q1)
    _wait(start_totals())
    got = spark.table("gift_totals").groupBy("anchor_id", "room_id") \
               .agg(F.max("amount").alias("amount"), F.max("points").alias("points"))
    want = gifts.gift_totals(gifts.enrich(gifts.rewards(td.events(spark, SF_SMALL)),
                                          gifts.gift_snapshot(td.gift_log(spark, SF_SMALL))))
    assert sorted(got.collect()) == sorted(want.select("anchor_id", "room_id", "amount", "points").collect())


def test_order_count_job(spark, tmp_dir):
    """CDC topics -> windowed join (J2) + late lines rescued from the snapshot."""
    import json
    base = 1_700_000_000_000

    def ts(ms):
        import datetime
        return datetime.datetime.fromtimestamp(ms / 1000, datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")

    def env(kind, rows):
        return json.dumps({"type": kind, "data": rows})

    hs, ls = os.path.join(tmp_dir, "h"), os.path.join(tmp_dir, "l")
    schema = "topic string, partition int, offset long, value string"

    def put(path, values, start):
        spark.createDataFrame([("t", 0, start + i, v) for i, v in enumerate(values)], schema) \
             .coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)

    head = lambda oid, ms, money: {"oid": oid, "total_money": money, "status": 1, "update_time": ts(ms)}
    line = lambda i, oid, ms: {"id": i, "order_id": oid, "sku": 100 + i, "update_time": ts(ms)}
    # batch 1: order 1 with its line; batch 2: far later, closes the first window;
    # batch 3: a line of order 1 whose window has closed -> late, rescued from the snapshot
    put(hs, [env("INSERT", [head(1, base + 1_000, 10.0)])], 0)
    put(ls, [env("INSERT", [line(1, 1, base + 2_000)])], 0)
    put(hs, [env("INSERT", [head(2, base + 60_000, 20.0)])], 1)
    put(ls, [env("INSERT", [line(2, 2, base + 61_000)])], 1)
    put(ls, [env("UPDATE", [line(3, 1, base + 3_000)])], 2)
    put(hs, [env("INSERT", [head(9, base + 10**7, 0.0)])], 2)
    put(ls, [env("INSERT", [line(9, 9, base + 10**7)])], 3)
    headers, lines = jobs.order_streams(spark, hs, ls, max_files_per_trigger=1)
    snapshot = spark.createDataFrame([(1, 10.0, "1"), (2, 20.0, "1")], "order_id long, total_money double, status string")
    out = os.path.join(tmp_dir, "rescued")
    qs = jobs.order_count(spark, lines, headers, snapshot, "memory",
                          lambda df, bid: df.write.mode("append").parquet(out), size_ms=10_000,
                          checkpoint_root=os.path.join(tmp_dir, "ck"), trigger={"availableNow": True})
    _wait(qs)
    joined = sorted((r.order_id, r.line, r.total_money) for r in spark.table("order_join").where("order_id < 9").collect())
    rescued = sorted((r.order_id, r.line, r.total_money) for r in spark.read.parquet(out).collect())
    assert (1, 1, 10.0) in joined and (2, 2, 20.0) in joined
    assert rescued == [(1, 3, 10.0)]
    assert (1, 3, 10.0) not in joined


def test_demo_jobs(spark, tmp_dir):
    people, words = os.path.join(tmp_dir, "people"), os.path.join(tmp_dir, "words")
    spark.createDataFrame([("1,ann,30",), ("2,bob,x",), ("3,cy,41",)], "value string").coalesce(1).write.text(people)
    spark.createDataFrame([("spark,3",), ("hive,4",), ("spark,5",)], "value string").coalesce(1).write.text(words)
    out = os.path.join(tmp_dir, "table")
    _wait(jobs.lines_to_table(spark, people, lambda df, bid: df.write.mode("append").parquet(out),
                              checkpoint_root=os.path.join(tmp_dir, "ck1"), trigger=ONCE))
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [("1", "ann", 30), ("3", "cy", 41)]
    _wait(jobs.window_sum_with_history(spark, words, "memory", checkpoint_root=os.path.join(tmp_dir, "ck2"),
                                       trigger=ONCE))
    hist = {r.key: r.total for r in spark.table("word_history").collect()}
    assert hist == {"spark": 8, "hive": 4}


def test_run_from_properties(spark, tmp_dir):
    from livestats.plans import run
    props = run.read_properties("# comment\nbootstrap.servers = b:9092\ninput.topics=a,b\ncheckpoint.path=/ck\n",
                                is_text=True)
    opts = run.source_of(props)
    assert opts.topics == ["a", "b"] and opts.group_id == "g001"
    assert run.trigger_of(props) == {"processingTime": "60000 milliseconds"}
    src = _replay(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    qs = run.start("user_count", {"input.path": src, "trigger": "once", "output.path": out,
                                  "checkpoint.path": os.path.join(tmp_dir, "ck")}, spark)
    _wait(qs)
    assert sorted(os.listdir(out)) == ["launches_by_channel_device", "new_user_count", "new_users_by_channel"]
    got = spark.read.parquet(os.path.join(out, "launches_by_channel_device")).groupBy("channel_device") \
               .agg(F.max("launches").alias("launches"))
    want = users.launches_by_channel_device(users.app_launches(td.events(spark, SF_SMALL)))
    assert sorted(got.collect()) == sorted(want.collect())


def test_audience_windows_job_equals_batch(spark, tmp_dir):
    from livestats.operators import audience
    from livestats.plans import run
    src = _replay(spark, tmp_dir)
    close = ('{"id": "c", "deviceId": "d", "eventId": "liveEnter", "timestamp": 1800000000000, '
             '"properties": {"anchor_id": "az", "room_id": "rz", "live_session": "sz"}}')
    spark.createDataFrame([("events", 0, 10**9, close)], "topic string, partition int, offset long, value string") \
         .write.mode("append").parquet(src)
    out = os.path.join(tmp_dir, "out")
    _wait(run.start("live_audience_windows", {"input.path": src, "trigger": "once", "output.path": out,
                                              "window.ms": str(DAY), "checkpoint.path": os.path.join(tmp_dir, "ck")},
                    spark))
    got = spark.read.parquet(os.path.join(out, "audience_windows")).where("room_id <> 'rz'").drop("batch_id")
    want = audience.window_delta(audience.live_events(td.events(spark, SF_SMALL)), size_ms=DAY)
    cols = ["anchor_id", "room_id", "window_start", "window_end", "enters", "delta"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_example_properties_parse():
    from livestats.plans import run
    conf = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "conf")
    known = {"user_count", "launch_rows", "first_seen", "live_audience", "gift_count", "hot_goods",
             "order_count", "groupon_count", "filter_topic"}
    for f in os.listdir(conf):
        props = run.read_properties(os.path.join(conf, f))
        assert f.removesuffix(".properties") in known
        assert props.get("checkpoint.path")
        if "bootstrap.servers" in props and "input.topics" in props:
            assert run.source_of(props).group_id == props.get("group.id", "g001")
