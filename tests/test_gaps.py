"""Rows with gaps, numbers as text, ties and rows out of order."""

import json
import os
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from livestats import schemas, sinks
from livestats.functions import parse
from livestats.operators import audience, gifts, orders, users
from livestats.plans import jobs, run
from livestats.plans import testdata as td
from livestats.sources import dimension, topic
from livestats.streaming import stateful, use_rocksdb

from .conftest import SF_SMALL
from .helpers import BASE, events, lines

E, L = schemas.LIVE_ENTER, schemas.LIVE_LEAVE
ROOM = {"anchor_id": "a", "room_id": "r"}


def live(spark, rows):
    """rows: (event, ms after BASE or None, session or None)"""
    return audience.live_events(events(spark, [
        dict(event_name=e, ts_ms=None if t is None else BASE + t, seq=i, record_id=f"r{i}",
             properties=ROOM | ({"live_session": s} if s else {})) for i, (e, t, s) in enumerate(rows)]))


# ---- parsers ----------------------------------------------------------------------------

def test_numbers_as_text_and_broken_values(spark):
    texts = ['{"id": "1", "timestamp": "1700000000000", "isNew": "1", "latitude": "1.5", "eventId": "x"}',
             '{"id": "2", "timestamp": 1700000000000, "isNew": 1, "latitude": 1.5, "eventId": "x"}',
             '{"id": "3", "timestamp": "soon", "isNew": "", "latitude": "north", "eventId": "x"}',
             '{"id": "4", "timestamp": 1.7E12, "isNew": 1.0}', "null", "[1", "", "7"]
    seen = Observation("seen")
    got = {r.id: (r.ts_ms, r.is_new, r.latitude) for r in parse.parse_events(lines(spark, texts), metrics=seen).collect()}
    assert got == {"1": (1_700_000_000_000, 1, 1.5), "2": (1_700_000_000_000, 1, 1.5), "3": (None, 0, None),
                   "4": (1_700_000_000_000, 1, None)}
    assert seen.get == {"rejected": 4, "rows": 8}
    dead = parse.parse_events(lines(spark, texts), dead_letter=True).collect()
    assert sorted(r.value for r in dead) == sorted(texts[4:])


@pytest.mark.parametrize(("text", "ms"), [
    ("2021-01-01 00:00:00", 1_609_459_200_000), ("2021-01-01 00:00:00.0", 1_609_459_200_000),
    ("2021-01-01T00:00:00.250", 1_609_459_200_250), ("2021-01-01T02:00:00+02:00", 1_609_459_200_000),
    ("2021-01-01T00:00:00Z", 1_609_459_200_000), ("1609459200000", 1_609_459_200_000), ("2021-01-01", 1_609_459_200_000),
    ("yesterday", None)])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_times(spark, text, ms, zone):
    row = {"oid": "29001", "total_money": "100.5", "status": "1", "create_time": text, "province": "p"}
    env = lines(spark, [json.dumps({"type": "INSERT", "data": [row]})])
    r = parse.parse_cdc(env, schemas.ORDER_HEADER, time_zone=zone).select(
        "oid", "total_money", "status", F.unix_millis("create_time").alias("ms")).first()
    assert (r.oid, r.total_money, r.status) == (29001, 100.5, 1)
    wall = ms is not None and zone != "UTC" and not text.endswith(("Z", "+02:00")) and not text.isdigit()
    assert r.ms == (ms - 8 * 3_600_000 if wall else ms)


def test_rejects_are_counted(spark):
    seen = Observation("seen")
    good = json.dumps({"type": "INSERT", "data": [{"oid": 1}]})
    other = json.dumps({"type": "DELETE", "data": [{"oid": 1}]})
    df = lines(spark, [good, other, "{broken"])
    assert parse.parse_cdc(df, schemas.ORDER_HEADER, metrics=seen).count() == 1
    assert seen.get == {"rejected": 1, "rows": 3}
    assert [r.value for r in parse.parse_cdc(df, schemas.ORDER_HEADER, dead_letter=True).collect()] == ["{broken"]
    short = Observation("short")
    assert parse.split_delimited(lines(spark, ["a|1", "b|x", "c"]), [("k", "string"), ("v", "int")], sep="|",
                                 metrics=short).collect() == [("a", 1)]
    assert short.get == {"rejected": 2, "rows": 3}


# ---- NULLs ------------------------------------------------------------------------------------

def test_events_without_time_or_session(spark):
    rows = live(spark, [(E, 0, "s"), (E, 10, None), (E, None, "s")])
    assert audience.audience_totals(rows).first()["online_audience"] == 3
    r = audience.effective_audience(rows).first()
    assert (r.effective_audience, r.online_audience) == (2, 3)
    running = audience.running_audience(rows).orderBy("record_id").collect()
    assert [(r.record_id, r.total_audience) for r in running] == [("r0", 2), ("r1", 3), ("r2", 1)]


def test_first_seen_without_time_device_or_flag_column(spark):
    ev = events(spark, [dict(device_id="d", ts_ms=None), dict(device_id="d", ts_ms=BASE + 5),
                        dict(device_id=None, ts_ms=BASE + 1), dict(device_id=None, ts_ms=BASE + 2),
                        dict(device_id="n", ts_ms=None)])
    for df in (ev, ev.drop("is_n")):
        assert [r.is_n for r in users.first_seen(df).orderBy("seq").collect()] == [0, 1, 1, 0, 0]


def test_lines_without_batch_stay(spark):
    df = spark.createDataFrame([(1, 1, 1, BASE, None), (1, 2, 1, BASE, 1), (2, 1, 1, BASE + 10 ** 9, 0)],
                               "order_id long, line long, sku long, ts_ms long, batch long")
    got = {(r.order_id, r.line): r.is_late for r in orders.flag_late(df).collect()}
    assert got == {(1, 1): False, (1, 2): True, (2, 1): False}


def test_two_versions_of_a_header_double_no_line(spark):
    flagged = spark.createDataFrame([(1, 1, 5, BASE, False)], "order_id long, line long, sku long, ts_ms long, is_late boolean")
    headers = spark.createDataFrame([(1, BASE, 1.0, "a"), (1, BASE + 1, 2.0, "b")],
                                    "order_id long, ts_ms long, total_money double, status string")
    got = orders.with_late_rescued(flagged, headers).collect()
    assert [(r.total_money, r.status, r.joined_in_window) for r in got] == [(2.0, "b", True)]


def test_points_are_not_rounded(spark):
    df = spark.createDataFrame([("a", "r", 9.0123), ("a", "r", 0.0004), ("a", "r", None)],
                               "anchor_id string, room_id string, point double")
    r = gifts.gift_totals(df).first()
    assert (r.amount, r.points) == (3, 9.0127)


# ---- streams out of order --------------------------------------------------------------------------

def put(spark, path, rows, start=0):
    """One file of topic records per row: (event, ms, session)."""
    for i, (e, t, s) in enumerate(rows, start):
        props = ROOM | ({"live_session": s} if s else {})
        text = json.dumps({"id": str(i), "deviceId": "d", "eventId": e, "timestamp": BASE + t, "properties": props})
        spark.createDataFrame([("events", 0, i, text)], "topic string, partition int, offset long, value string") \
             .coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)


def events_of(spark, path):
    recs = topic.with_record_id(topic.replay(spark, path, stream=True, max_files_per_trigger=1))
    return parse.parse_events(recs, keep=("record_id", "offset")).withColumnRenamed("offset", "seq")


def test_stays_out_of_order_equal_batch(spark, tmp_dir):
    """Enter, later enter, then the leave between them: the delay covers it."""
    use_rocksdb(spark)
    rows = [(E, 0, "s"), (E, 100_000, "s"), (L, 70_000, "s"), (E, 5_000, None), (L, 6_000, None), (E, 90_000, "t"),
            (L, 120_000, "t")]
    src = os.path.join(tmp_dir, "src")
    put(spark, src, rows)
    put(spark, src, [(E, 10 ** 9, "close"), (L, 10 ** 9 + 1, "close")], 50)
    out = stateful.stay_stream(audience.live_events(events_of(spark, src)), 60_000, "10 minutes")
    q = out.writeStream.format("memory").queryName("stays_shuffled").outputMode("append") \
        .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = audience.stay_totals(spark.table("stays_shuffled").where("live_session <> 'close'")).first()
    want = audience.effective_audience(live(spark, rows)).first()
    assert tuple(got) == tuple(want)


def test_processing_time_windows_drop_nothing(spark, tmp_dir):
    rows = [(E, 100_000, "s"), (L, 0, "s"), (E, 50_000, "t"), (L, 10, "t"), (E, 20, "u")]
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    put(spark, src, rows)
    qs = run.start("live_audience_batches", {"input.path": src, "trigger": "once", "output.path": out,
                                             "checkpoint.path": os.path.join(tmp_dir, "ck")}, spark)
    for q in qs:
        q.awaitTermination(300)
    deltas = spark.read.parquet(f"{out}/audience_batches").agg(F.sum("enters"), F.sum("delta")).first()
    assert tuple(deltas) == (3, 1)
    history = spark.read.parquet(f"{out}/audience_history").orderBy(F.desc("batch_id")).first()
    assert (history.total_audience, history.online_audience) == (3, 1)


# ---- jobs from properties ------------------------------------------------------------------------------

def test_gift_job_from_properties(spark, tmp_dir):
    src, log, out = (os.path.join(tmp_dir, x) for x in ("src", "log", "out"))
    td.topic_records(spark, SF_SMALL).write.parquet(src)
    td.gift_log(spark, SF_SMALL).withColumn("update_time", F.timestamp_seconds("seq")).write.parquet(log)
    qs = run.start("gift_count", {"input.path": src, "gift.path": log, "trigger": "once", "output.path": out,
                                  "checkpoint.path": os.path.join(tmp_dir, "ck")}, spark)
    for q in qs:
        q.awaitTermination(300)
    enriched = gifts.enrich(gifts.rewards(td.events(spark, SF_SMALL)), gifts.gift_snapshot(td.gift_log(spark, SF_SMALL)))
    got = spark.read.parquet(f"{out}/gift_totals").select("anchor_id", "room_id", "amount", "points")
    assert sorted(got.collect()) == sorted(gifts.gift_totals(enriched).collect())
    got = spark.read.parquet(f"{out}/gift_by_name").select("gift_name", "amount")
    assert sorted(got.collect(), key=str) == sorted(gifts.count_by_gift(enriched).collect(), key=str)


def test_launch_rows_land_in_folders(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    td.topic_records(spark, SF_SMALL).write.parquet(src)
    (q,) = run.start("launch_rows", {"input.path": src, "trigger": "once", "output.path": out, "flag.column": "is_new",
                                     "output.partitioned": "true", "checkpoint.path": os.path.join(tmp_dir, "ck")}, spark)
    q.awaitTermination(300)
    want = users.launch_rows(users.app_launches(td.events(spark, SF_SMALL)))
    got = sinks.read_partitioned(spark, out, want.schema)
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    assert any(d.startswith("date=") for d in os.listdir(out))


def test_lines_without_header_are_looked_up_with_later_orders(spark, tmp_dir):
    """An on-time line whose header never comes by stream, but is in the table when the window closes."""
    table = os.path.join(tmp_dir, "orders")
    spark.createDataFrame([], "order_id long, total_money double, status string, ts_ms long").write.parquet(table)

    def put_lines(path, rows, first):
        spark.createDataFrame([("t", 0, first + i, json.dumps({"type": "INSERT", "data": [r]})) for i, r in enumerate(rows)],
                              "topic string, partition int, offset long, value string").coalesce(1).write.mode(
            "append").parquet(path)
        time.sleep(0.05)

    h, li = os.path.join(tmp_dir, "h"), os.path.join(tmp_dir, "l")
    put_lines(li, [{"id": 1, "order_id": 7, "sku": 1, "update_time": str(BASE)}], 0)
    put_lines(li, [{"id": 2, "order_id": 8, "sku": 1, "update_time": str(BASE + 10 ** 8)}], 1)
    put_lines(h, [{"oid": 9, "total_money": "1", "status": "1", "update_time": str(BASE)}], 0)
    put_lines(h, [{"oid": 9, "total_money": "1", "status": "1", "update_time": str(BASE + 10 ** 8)}], 1)
    headers, rows = jobs.order_streams(spark, h, li, max_files_per_trigger=1)
    out = os.path.join(tmp_dir, "joined")
    spark.createDataFrame([(7, 70.0, "1", BASE), (7, 71.0, "2", BASE + 1)],
                          "order_id long, total_money double, status string, ts_ms long").write.mode("append").parquet(table)
    qs = jobs.order_count(spark, rows, headers, lambda: spark.read.parquet(table),
                          lambda df, bid: sinks.write_batch(df, out, bid), lambda df, bid: df.count(),
                          checkpoint_root=os.path.join(tmp_dir, "ck"), trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination(300)
    got = {(r.order_id, r.line): (r.total_money, r.status) for r in spark.read.parquet(out).collect()}
    assert got[7, 1] == (71.0, "2")


def test_outputs_need_their_own_tables():
    props = {"jdbc.url": "jdbc:mysql://h/db", "jdbc.table": "t", "jdbc.table.a": "a", "jdbc.keys.a": "k"}
    sink = run.sink_of(props, several=True)
    assert callable(sink("a"))
    with pytest.raises(ValueError, match="jdbc.table.b"):
        sink("b")
    assert callable(run.sink_of({"jdbc.url": "jdbc:h2:x", "jdbc.table": "t"})("anything"))


# ---- sources and sinks ------------------------------------------------------------------------------------

def test_dimension_reads_ties_again(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")

    def change(rows):
        spark.createDataFrame(rows, "id int, name string, point double, deleted int, t long").select(
            "id", "name", "point", "deleted", F.timestamp_seconds("t").alias("update_time")).write.mode("append").parquet(log)

    snap = dimension.DimensionSnapshot(spark, dimension.table_changes(log), os.path.join(tmp_dir, "snap"))
    change([(1, "a", 1.0, 0, 10)])
    assert snap.refresh().count() == 1
    slot = snap.slot
    assert snap.refresh().count() == 1 and snap.slot == slot  # nothing new: nothing written
    change([(2, "b", 2.0, 0, 10)])  # commits late with the mark's own time
    assert sorted(r.name for r in snap.refresh().collect()) == ["a", "b"]
    change([(1, "c", 1.0, 0, 11), (2, "b", 2.0, 1, 12)])
    assert [r.name for r in snap.refresh().collect()] == ["c"]


def test_upsert_dialects():
    def sql(url):
        return sinks.upsert_sql(sinks.upsert_dialect(url), "t", "s", ["k"], ["k", "v"])
    assert sql("jdbc:mysql://h/d") == "INSERT INTO t (k, v) SELECT k, v FROM s ON DUPLICATE KEY UPDATE v = VALUES(v)"
    assert sql("jdbc:postgresql://h/d") == (
        "INSERT INTO t (k, v) SELECT k, v FROM s WHERE TRUE ON CONFLICT (k) DO UPDATE SET v = excluded.v")
    assert sql("jdbc:h2:mem").startswith("MERGE INTO t")


def test_lost_offsets_stop_a_job_by_default():
    props = {"bootstrap.servers": "b", "input.topics": "t", "checkpoint.path": "/c"}
    assert topic.TopicOptions.from_properties(props).reader_options()["failOnDataLoss"] == "true"
    loose = topic.TopicOptions.from_properties(props | {"fail.on.data.loss": "false"})
    assert loose.reader_options()["failOnDataLoss"] == "false"


def test_a_cluster_needs_shared_storage(monkeypatch):
    from livestats import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    monkeypatch.setattr(session, "_LOCAL_FALLBACK", {})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
