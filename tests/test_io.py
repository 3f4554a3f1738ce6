"""Sources and sinks: options, partitioned landing, dimension merge."""

import os

import pytest
from pyspark.sql import functions as F

from livestats import sinks
from livestats.operators import users
from livestats.plans import testdata as td
from livestats.sources import dimension, files, topic

from .conftest import SF_SMALL


def test_topic_options_defaults_and_required():
    o = topic.TopicOptions.from_properties({"bootstrap.servers": "b:9092", "input.topics": "a, b",
                                            "checkpoint.path": "/shared/ck"})
    assert o.topics == ["a", "b"] and o.group_id == "g001" and o.offset_reset == "earliest"
    assert o.checkpoint_interval_ms == 60_000
    ro = o.reader_options()
    assert ro["subscribe"] == "a,b" and ro["startingOffsets"] == "earliest"
    assert o.trigger() == {"processingTime": "60000 milliseconds"}
    with pytest.raises(ValueError):
        topic.TopicOptions.from_properties({"bootstrap.servers": "b:9092"})
    assert topic.TopicOptions.from_properties({"bootstrap.servers": "b", "checkpoint.path": "c"},
                                              topics="t", group="g2").group_id == "g2"


def test_record_id(spark):
    df = spark.createDataFrame([("events", 0, 7, "x")], "topic string, partition int, offset long, value string")
    assert topic.with_record_id(df).first().record_id == "events-0-7"


def test_partitioned_landing(spark, tmp_dir):
    rows = users.launch_rows(users.app_launches(td.events(spark, SF_SMALL)))
    out = os.path.join(tmp_dir, "launch")
    sinks.write_partitioned(rows, out)
    assert any(d.startswith("date=") for d in os.listdir(out))
    back = sinks.read_partitioned(spark, out, rows.schema)
    assert back.count() == rows.count()
    want = users.rows_per_partition(rows).collect()
    got = back.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("launches"))
    assert sorted((r.date, r.hour, r.launches) for r in got.collect()) == \
        sorted((r.date, r.hour, r.launches) for r in want)


def test_merge_sql():
    sql = sinks.merge_sql("gift_totals", "gift_totals_staging", ["anchor_id", "room_id"],
                          ["anchor_id", "room_id", "amount", "points"])
    assert "ON t.anchor_id = s.anchor_id AND t.room_id = s.room_id" in sql
    assert "UPDATE SET amount = s.amount, points = s.points" in sql
    assert "INSERT (anchor_id, room_id, amount, points)" in sql


def test_jdbc_options():
    o = sinks.JdbcOptions(url="jdbc:x://h/db", table="t", user="u", password="p")
    assert o.writer_options()["batchsize"] == str(sinks.LAUNCH_BATCH_ROWS)
    assert callable(sinks.jdbc_append(o)) and callable(sinks.jdbc_upsert(o, ["id"]))


def test_topic_records_keyed(spark):
    df = spark.createDataFrame([("events-0-1", "a")], "record_id string, value string")
    assert tuple(sinks.topic_records(df).first()) == ("events-0-1", "a")


def test_dimension_snapshot(spark, tmp_dir):
    log = os.path.join(tmp_dir, "gift_log")
    v1 = spark.createDataFrame([(1, "rose", 1.0, 0, "2024-01-01 00:00:00"), (2, "car", 9.0, 0, "2024-01-01 00:00:01")],
                               "id int, name string, point double, deleted int, update_time string") \
              .withColumn("update_time", F.col("update_time").cast("timestamp"))
    v1.write.parquet(log)
    snap = dimension.DimensionSnapshot(spark, dimension.table_changes(log), os.path.join(tmp_dir, "snap"))
    assert sorted(tuple(r) for r in snap.refresh().collect()) == [(1, "rose", 1.0), (2, "car", 9.0)]
    v2 = spark.createDataFrame([(1, "rose", 2.0, 0, "2024-01-02 00:00:00"), (2, "car", 9.0, 1, "2024-01-02 00:00:01"),
                                (3, "boat", 5.0, 0, "2024-01-02 00:00:02")],
                               "id int, name string, point double, deleted int, update_time string") \
              .withColumn("update_time", F.col("update_time").cast("timestamp"))
    v2.write.mode("append").parquet(log)
    assert sorted(tuple(r) for r in snap.refresh().collect()) == [(1, "rose", 2.0), (3, "boat", 5.0)]
    # the next poll only asks for rows from the mark on: here the newest row again
    assert [r.id for r in snap.read_changes(spark, snap.mark).collect()] == [3]


def test_read_lines_and_spread(spark, tmp_dir):
    p = os.path.join(tmp_dir, "lines")
    spark.createDataFrame([("a,1",), ("b,2",)], "value string").coalesce(1).write.text(p)
    df = files.read_lines(spark, p)
    assert df.count() == 2
    assert files.spread(df, 4).rdd.getNumPartitions() == 4


def test_write_batch_is_write_once(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing")
    sinks.write_batch(spark.createDataFrame([(1,)], "x int"), base, 0)
    sinks.write_batch(spark.createDataFrame([(2,), (3,)], "x int"), base, 0)  # a retry: left alone
    sinks.write_batch(spark.createDataFrame([(4,)], "x int"), base, 1)
    assert sorted(r.x for r in spark.read.parquet(base).collect()) == [1, 4]
