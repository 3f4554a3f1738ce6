"""K3 on shared files: upserts of batches, retries, untouched buckets, and a running aggregate of a stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from livestats.plans import run
from livestats.sinks import keyed_files
from livestats.sinks.keyed_files import read_keyed, upsert_batch

SCHEMA = "room long, gift string, total long, at long"


def files_of(base):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{base}/data") for f in fs if f.endswith(".parquet")}


def test_batches_equal_a_dictionary(spark, tmp_path):
    r, base, want = random.Random(5), str(tmp_path / "t"), {}
    schema = spark.createDataFrame([], SCHEMA).schema
    assert read_keyed(spark, base, schema).collect() == []
    for batch in range(4):
        rows = [(r.choice([None, *range(12)]), r.choice(["a", None, "c"]), r.randrange(99), batch * 100 + i)
                for i in range(r.choice([0, 3, 40]) if batch != 1 else 0)]
        upsert_batch(spark.createDataFrame(rows, SCHEMA), base, ["room", "gift"], batch, latest=["at"], buckets=5)
        want |= {(x[0], x[1]): x for x in rows}
        got = read_keyed(spark, base, schema).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want.values(), key=str)


def test_a_retry_changes_nothing_and_other_buckets_stay(spark, tmp_path):
    base = str(tmp_path / "t")
    one = spark.createDataFrame([(i, "a", i, 0) for i in range(100)], SCHEMA)
    upsert_batch(one, base, ["room"], 0, buckets=8)
    before = files_of(base)
    upsert_batch(one.withColumn("total", F.lit(-1).cast("long")), base, ["room"], 0, buckets=8)
    assert files_of(base) == before  # published already
    two = spark.createDataFrame([(7, "b", 70, 1)], SCHEMA)
    upsert_batch(two, base, ["room"], 1, buckets=8)
    written = {f.split("_keyed_bucket=")[1].split("/")[0] for f in files_of(base) - before}
    assert len(written) == 1 and before <= files_of(base)
    got = {x.room: x.total for x in read_keyed(spark, base, one.schema).collect()}
    assert got == {i: i for i in range(100)} | {7: 70}


def test_a_batch_that_broke_off_is_not_seen(spark, tmp_path):
    base = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a", 1, 0)], SCHEMA)
    upsert_batch(one, base, ["room"], 0)
    two = spark.createDataFrame([(1, "a", 2, 1)], SCHEMA)
    upsert_batch(two, base, ["room"], 1)
    os.replace(f"{base}/manifests/batch=1/_SUCCESS", str(tmp_path / "taken"))
    assert [x.total for x in read_keyed(spark, base, one.schema).collect()] == [1]
    upsert_batch(two, base, ["room"], 1)  # the retry
    assert [x.total for x in read_keyed(spark, base, one.schema).collect()] == [2]


@pytest.mark.parametrize("per_batch", [1, 3])
def test_running_totals_of_a_stream(spark, tmp_path, per_batch):
    src, base = str(tmp_path / "src"), str(tmp_path / "t")
    rows = spark.range(400).select((F.col("id") % 7).alias("room"), F.col("id").alias("points"))
    for k in range(5):
        rows.where(F.col("points") % 5 == k).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(src)
    totals = stream.groupBy("room").agg(F.sum("points").alias("points"))
    q = (totals.writeStream.outputMode("update").foreachBatch(keyed_files.keyed_files(base, ["room"], buckets=4))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(map(tuple, read_keyed(spark, base, totals.schema).collect()))
    assert got == sorted(map(tuple, rows.groupBy("room").agg(F.sum("points")).collect()))


def test_sink_of_a_job_with_keys(spark, tmp_path):
    props = {"output.path": str(tmp_path), "output.keys.gift_totals": "room"}
    handler = run.handler_of(run.sink_of(props), "gift_totals")
    for batch, total in enumerate((1, 2)):
        handler(spark.createDataFrame([(1, "a", total, 0)], SCHEMA), batch)
    schema = spark.createDataFrame([], SCHEMA).schema
    assert [x.total for x in read_keyed(spark, str(tmp_path / "gift_totals"), schema).collect()] == [2]
