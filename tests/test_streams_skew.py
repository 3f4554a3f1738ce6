"""Streams under skew and gaps: first-seen in two stages, salted joins, delays, changes as a source, record ids once."""

import os
import time

import pytest
from pyspark.sql import functions as F

from livestats.operators import groupon, orders, users
from livestats.plans import jobs
from livestats.plans import testdata as td
from livestats.sources import changes, dimension
from livestats.streaming import firsts, stateful, streams

from .conftest import SF_SMALL

ONCE = {"availableNow": True}
DAY = 86_400_000


def _wait(qs):
    for q in (qs if isinstance(qs, list) else [qs]):
        q.awaitTermination(300)


def _append(df, path, pause=0.05):
    df.coalesce(1).write.mode("append").parquet(path)
    time.sleep(pause)


# ---- first seen ----------------------------------------------------------------------

EVENT = "record_id string, device_type string, device_id string, ts_ms long, seq long, event_name string"


def gapped_events(spark, hot=0):
    e = td.events(spark, SF_SMALL, gaps=True).select("record_id", "device_type", "device_id", "ts_ms", "seq", "event_name")
    if hot:
        more = spark.range(hot).select(F.concat(F.lit("hot-"), "id").alias("record_id"), F.lit("type9").alias("device_type"),
                                       F.lit("hot").alias("device_id"), (F.lit(1_704_067_200_000) + F.col("id")).alias("ts_ms"),
                                       (F.lit(10**6) + F.col("id")).alias("seq"), F.lit("appLaunch").alias("event_name"))
        e = e.unionByName(more)
    return e


def _two_stages(spark, src, schema, root, keys, once_more=None):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    stage = firsts.CandidateStage(f"{root}/landing", keys, ("event_name",))
    landed = stage.prepare(stream)
    q = stream.writeStream.foreachBatch(stage).option("checkpointLocation", f"{root}/c1").trigger(**ONCE).start()
    q.awaitTermination(300)
    out = firsts.flagged_stream(spark, stage.landing, landed, keys, ("event_name",))
    q = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c2") \
           .trigger(**ONCE).start()
    q.awaitTermination(300)
    return spark.read.parquet(f"{root}/out")


@pytest.mark.parametrize("keys", [("device_id",), ("device_type", "device_id")])
def test_first_seen_in_two_stages_with_gaps_restart_and_a_hot_device(spark, tmp_dir, keys):
    e = gapped_events(spark, hot=500).persist()
    src = os.path.join(tmp_dir, "src")
    for lo, hi in ((0, 300), (300, 600)):
        _append(e.where(F.col("seq").between(lo, hi - 1)), src)
    _two_stages(spark, src, e.schema, tmp_dir, keys)
    # restart from the same checkpoints with more files: the hot device comes now
    _append(e.where("seq >= 600"), src)
    got = _two_stages(spark, src, e.schema, tmp_dir, keys)
    # the rows arrive by sequence, so the first one is that of the first batch that has the device with a time
    arrival = e.withColumn("_b", F.expr("CASE WHEN seq < 300 THEN 0 WHEN seq < 600 THEN 1 ELSE 2 END"))
    want = users.first_seen(arrival, keys, ("_b", "ts_ms", "seq")).select("record_id", "is_n")
    assert sorted(got.select("record_id", "is_n").collect()) == sorted(want.collect())
    assert got.where("is_n = 1 and device_id is null").count() >= 1
    # one candidate of a device reaches the state from each micro-batch
    landed = spark.read.parquet(f"{tmp_dir}/landing").where("candidate = 1")
    assert landed.groupBy("batch_id", *keys).count().where("count > 1").count() == 0


def test_first_seen_forms_take_events_without_time(spark, tmp_dir):
    rows = [("1", "t", "a", None, 1, "x"), ("2", "t", "a", 50, 2, "x"), ("3", "t", "a", 40, 3, "x"), ("4", "t", "b", None, 4, "x"),
            ("5", "t", None, 7, 5, "x"), ("6", "t", None, None, 6, "x"), ("7", "t", "c", 9, None, "x")]
    src = os.path.join(tmp_dir, "src")
    e = spark.createDataFrame(rows, EVENT)
    _append(e, src)
    want = sorted((r.record_id, r.is_n) for r in users.first_seen(e).collect())
    assert [x for _, x in want] == [0, 0, 1, 0, 1, 0, 0]
    stream = spark.readStream.schema(e.schema).parquet(src)
    for name, out in (("fs_exact", stateful.first_seen_stream(stream)),
                      ("fs_bloom", stateful.approx_first_seen_stream(stream, capacity=1000, buckets=2))):
        q = out.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp_dir}/{name}") \
               .trigger(**ONCE).start()
        q.awaitTermination(300)
        assert sorted((r.record_id, r.is_n) for r in spark.table(name).collect()) == want


# ---- salted joins and delays ---------------------------------------------------------

def hot_orders(spark, base=1_700_000_000_000):
    lines = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 20).otherwise(7).cast("long").alias("order_id"),
        F.col("id").cast("int").alias("line"), (F.col("id") * 3).alias("sku"), (F.lit(base) + F.col("id") * 100).alias("ts_ms"))
    heads = spark.range(16).select(F.col("id").alias("order_id"), (F.lit(base) + F.col("id") * 2000).alias("ts_ms"),
                                   (F.col("id") * 1.5).alias("total_money"), F.lit("O").alias("status"))
    heads = heads.unionByName(spark.createDataFrame([(7, base + 1, 70.0, "F"), (7, base + 25_000, 71.0, "G")], heads.schema))
    close = spark.createDataFrame([(99, 1, 0, base + 10**9)], lines.schema), spark.createDataFrame(
        [(99, base + 10**9, 0.0, "X")], heads.schema)
    return lines, heads, close


@pytest.mark.parametrize("salts", [1, 4])
def test_salted_order_join_equals_batch(spark, tmp_dir, salts):
    lines, heads, close = hot_orders(spark)
    ls, hs = os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "h")
    for df, end, path in ((lines, close[0], ls), (heads, close[1], hs)):
        _append(df, path)
        _append(end, path)
    j = streams.order_join_stream(spark.readStream.schema(lines.schema).parquet(ls),
                                  spark.readStream.schema(heads.schema).parquet(hs), 10_000, salts=salts)
    name = f"salted_{salts}"
    q = j.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp_dir}/c").trigger(**ONCE).start()
    q.awaitTermination(300)
    got = spark.table(name).where("order_id < 99")
    want = orders.join_headers(lines, heads, 10_000).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("total_money is null").count() > 0


def test_salts_spread_a_hot_order(spark):
    lines, _, _ = hot_orders(spark)
    own = streams._salted(lines, lines.columns, 8).where("order_id = 7").groupBy("_salt").count().collect()
    total = sum(r["count"] for r in own)
    assert len(own) == 8 and max(r["count"] for r in own) < total / 4


def test_groupon_job_honours_its_delay_and_counts_rejects(spark, tmp_dir):
    from livestats import schemas
    from livestats.functions import parse
    base = 1_700_000_000_000
    width = {"d": schemas.GROUPON_DETAIL, "m": schemas.GROUPON_MAIN, "o": schemas.GROUPON_ORDER}

    def line(fields, i, ts):
        values = []
        for name, typ in fields:
            values.append(str(ts) if name == "ts_ms" else str(i % 4) if name == "groupon_id" else str(i % 6)
                          if name == "order_id" else f"v{i}" if typ == "string" else str(i))
        return ",".join(values)

    lines = {}
    for tag, fields in width.items():
        own = [line(fields, i, base + i * 400) for i in range(0, 40, 2)]
        late = [line(fields, i, base + i * 400) for i in range(1, 41, 2)]  # behind the first file's newest, within the delay
        close = [line(fields, 999, base + 10**9)]
        lines[tag] = own + late
        os.makedirs(f"{tmp_dir}/{tag}")
        for k, part in enumerate((own + ["broken"], late, close)):
            with open(f"{tmp_dir}/{tag}/{k}.txt", "w") as f:
                f.write("\n".join(part) + "\n")
            os.utime(f"{tmp_dir}/{tag}/{k}.txt", (1_700_000_000 + k * 10,) * 2)
    import livestats.sources.files as files

    def batch(tag):
        df = spark.createDataFrame([(x,) for x in lines[tag]], "value string")
        return parse.split_delimited(df, width[tag])

    original = files.read_lines

    def one_file(spark_, path, stream=False, **kw):
        return spark_.readStream.option("maxFilesPerTrigger", 1).text(path) if stream else original(spark_, path, **kw)

    files.read_lines = one_file
    try:
        q = jobs.groupon_count(spark, *(f"{tmp_dir}/{t}" for t in "dmo"), "memory", checkpoint_root=f"{tmp_dir}/ck",
                               trigger=ONCE, delay="20 seconds", salts=2)
        _wait(q)
    finally:
        files.read_lines = original
    got = spark.table("groupon")
    want = groupon.groupon_join(batch("d"), batch("m"), batch("o")) if hasattr(groupon, "groupon_join") else None
    assert want is not None
    keep = got.where("user_id <> 'v999'")
    assert sorted(map(str, keep.collect())) == sorted(map(str, want.select(*keep.columns).collect()))
    rejected = sum((p.observedMetrics or {}).get("groupon_detail", {"rejected": 0})[0] or 0 for p in q.recentProgress
                   if (p.observedMetrics or {}).get("groupon_detail") is not None)
    assert rejected == 1


def test_order_job_honours_its_delay(spark, tmp_dir):
    """Late and on-time lines are those of the batch form with the same delay, each on one path."""
    delay = "25 days"
    lines = td.order_lines(spark, SF_SMALL).withColumn("batch", F.floor(F.col("batch") / 5)).persist()
    headers = td.order_headers(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "lines")
    own = lines.where("batch is not null")
    for b in [r[0] for r in own.select("batch").distinct().orderBy("batch").collect()]:
        _append(own.where(F.col("batch") == b), src)
    hs = os.path.join(tmp_dir, "heads")
    _append(headers, hs)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(src)
    late_path = os.path.join(tmp_dir, "late")
    snap = headers.select("order_id", "total_money", "status", "ts_ms")
    qs = jobs.order_count(spark, stream, spark.readStream.schema(headers.schema).parquet(hs), snap, "memory",
                          lambda df, b: df.write.mode("append").parquet(late_path), size_ms=30 * DAY,
                          on_time_path=f"{tmp_dir}/on_time", checkpoint_root=f"{tmp_dir}/ck", trigger=ONCE, delay=delay)
    _wait(qs)
    flagged = orders.flag_late(own, 30 * DAY, delay_ms=streams.delay_ms(delay))
    want = {f: sorted(map(tuple, flagged.where(F.col("is_late") == f).select("order_id", "line").collect())) for f in (True, False)}
    undelayed = orders.flag_late(own, 30 * DAY).where("is_late").count()
    late = sorted(map(tuple, spark.read.parquet(late_path).select("order_id", "line").collect()))
    assert late == want[True] and 0 < len(late) < undelayed
    on_time = spark.read.parquet(f"{tmp_dir}/on_time").select("order_id", "line")
    assert sorted(map(tuple, on_time.collect())) == want[False]


def test_delay_in_milliseconds():
    assert [streams.delay_ms(x) for x in ("0 seconds", "1500 milliseconds", "1 minute", "2 days")] == [0, 1500, 60_000, 2 * DAY]


# ---- changes as a source --------------------------------------------------------------

def _log(spark, path, rows):
    _append(spark.createDataFrame(rows, changes.GIFT_COLUMNS), path)


def test_changes_source_with_ties_at_the_mark_and_a_restart(spark, tmp_dir):
    log, out, ck = (os.path.join(tmp_dir, x) for x in ("log", "out", "ck"))

    def run():
        df = changes.read_changes(spark, path=log, partitions="3")
        q = df.writeStream.foreachBatch(lambda b, i: b.write.mode("append").parquet(f"{out}/b={i}")) \
              .option("checkpointLocation", ck).trigger(**ONCE).start()
        q.awaitTermination(300)
        return sum(p.numInputRows for p in q.recentProgress)

    def seen():
        return {(r.id, r.name, r.update_time) for r in spark.read.parquet(out).collect()}

    _log(spark, log, [])
    assert run() == 0
    first = [(i, f"g{i}", i * 1.0, 0, 1000 + i // 10) for i in range(1, 31)]
    _log(spark, log, first)
    assert run() == 30
    assert run() == 0  # nothing new: nothing is read
    # a change that commits later with the mark's own time, and one without an id
    _log(spark, log, [(77, "tie", 1.0, 0, 1003)])
    assert 1 <= run() <= 3
    _log(spark, log, [(5, "g5 new", 5.5, 0, 2000), (None, "no id", 1.0, 0, 2000), (6, "no time", 1.0, 0, None)])
    run()
    got = seen()
    assert {(77, "tie", 1003), (5, "g5 new", 2000), (None, "no id", 2000)} <= got
    assert {(i, f"g{i}", 1000 + i // 10) for i in range(1, 31)} <= got and len(got) == 33


def test_changes_feed_the_snapshot(spark, tmp_dir):
    log, ck = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ck")
    snap = dimension.DimensionSnapshot(spark, None, os.path.join(tmp_dir, "snap"))

    def run():
        changes.read_changes(spark, path=log).writeStream.foreachBatch(snap).option(
            "checkpointLocation", ck).trigger(**ONCE).start().awaitTermination(300)
        return sorted(tuple(r) for r in snap.current().collect())

    _log(spark, log, [(1, "rose", 1.0, 0, 10), (2, "car", 9.0, 0, 10)])
    assert run() == [(1, "rose", 1.0), (2, "car", 9.0)]
    _log(spark, log, [(1, "rose", 1.0, 1, 20), (3, "bus", 4.0, None, 10)])
    assert run() == [(2, "car", 9.0), (3, "bus", 4.0)]


# ---- record ids once (K4) ----------------------------------------------------------------

def test_a_batch_written_twice_is_read_once_and_the_state_is_bounded(spark, tmp_dir):
    from livestats.sources import topic
    from livestats.streaming import use_rocksdb
    use_rocksdb(spark)
    src, ck = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "ck")
    schema = "key string, value string, timestamp timestamp"

    def write(lo, hi, minute, name):
        df = spark.range(lo, hi).select(F.concat(F.lit("events-0-"), "id").alias("key"), F.lit(name).alias("value"),
                                        F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minute)).alias("timestamp"))
        _append(df, src)

    def run():
        out = topic.once(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), "10 minutes")
        q = out.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", ck) \
               .trigger(**ONCE).start()
        q.awaitTermination(300)
        return [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]

    write(0, 50, 0, "a")
    write(0, 50, 1, "again")
    run()
    write(40, 60, 2, "after a restart")  # ten of them were written before
    for k in range(6):
        write(1000 * (k + 1), 1000 * (k + 1) + 20, 15 * (k + 1), "later")
    spark.createDataFrame([(None, "no id", None), (None, "no id", None)], schema).write.mode("append").parquet(src)
    held = run()
    got = spark.read.parquet(f"{tmp_dir}/out")
    ids = [r.key for r in got.where("key is not null").collect()]
    assert len(ids) == len(set(ids)) == 60 + 6 * 20
    assert got.where("value = 'a'").count() == 50 and got.where("key is null").count() == 2
    assert held[-1] <= 60  # of 180 ids


# ---- long histories (W5) ----------------------------------------------------------------

@pytest.mark.parametrize("block", [1, 7, 100, 10**6])
def test_history_in_blocks_equals_running_sums(spark, block):
    import random

    from livestats.operators.windows import with_history
    r = random.Random(block)
    rows = [(r.choice(["a", "b", None]), w, r.choice([None, 1, 5, -3])) for w in [None, *range(-20, 200, 3)] for _ in range(1)]
    rows += [("a", w, 2) for w in range(300, 900, 5)]
    got = with_history(spark.createDataFrame(rows, "key string, w long, v long"), ["key"], "w", {"v": "total"}, block)
    want = []
    for k in ("a", "b", None):
        total = None
        for _, w, v in sorted((x for x in rows if x[0] == k), key=lambda x: (x[1] is not None, x[1] or 0)):
            total = v if total is None else total + (v or 0)
            want.append((k, w, v, total))
    assert got.columns == ["key", "w", "v", "total"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_queries_of_a_database_table(monkeypatch):
    """The texts that a DB-API connection gets; no database is opened."""
    import sys
    import types
    said, answers = [], [[(1003, 2)], [(1, 9, 5)], [(1, "a"), (2, "b")]]

    class Cursor:
        def execute(self, sql):
            said.append(sql)
            self.left = [answers[len(said) - 1], []]

        def fetchmany(self, n):
            return self.left.pop(0)

        def close(self):
            pass

    fake = types.ModuleType("fake_driver")
    fake.connect = lambda text: types.SimpleNamespace(cursor=Cursor, close=lambda: None)
    monkeypatch.setitem(sys.modules, "fake_driver", fake)
    from pyspark.sql.types import StructType
    reader = changes.ChangesReader(StructType.fromDDL("id int, name string"), {
        "module": "fake_driver", "connect": "x", "table": "gift", "partitions": "2"})
    end = reader.latestOffset()
    assert end == {"mark": 1003, "rows": 2}
    parts = reader.partitions({"mark": 1000, "rows": 1}, end)
    assert [(p.lo, p.hi, p.first) for p in parts] == [(1, 4, True), (5, 9, False)]
    assert list(reader.read(parts[0])) == [(1, "a"), (2, "b")]
    assert said[1] == "SELECT min(id), max(id), count(*) FROM gift WHERE update_time <= 1003 AND update_time >= 1000"
    assert said[2] == ("SELECT id, name FROM gift WHERE update_time <= 1003 AND update_time >= 1000 "
                       "AND (id BETWEEN 1 AND 4 OR id IS NULL)")
    assert changes.DbTable._value("it's") == "'it''s'"
