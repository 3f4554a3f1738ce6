"""J1 as of a time: every row meets the version valid at its own time."""

import random

from pyspark.sql import functions as F

from livestats.operators import gifts
from livestats.operators.asof import as_of_join, steps
from livestats.plans import testdata as td

from .conftest import SF_SMALL

LOG = "id int, name string, point double, deleted int, changed_ms long, seq long"
REWARD = "record_id string, anchor_id string, room_id string, gift_id int, ts_ms long"


def plain(rewards, log):
    """The last change of the gift at or before the reward, by a scan."""
    out = []
    for rid, _, _, gift, ts in rewards:
        past = [c for c in log if c[0] is not None and c[0] == gift and c[4] is not None and ts is not None and c[4] <= ts]
        last = max(past, key=lambda c: (c[4], c[5]), default=None)
        out.append((rid, None, None) if last is None or last[3] == 1 else (rid, last[1], last[2]))
    return sorted(out)


def rows_of(df):
    return sorted((r.record_id, r.gift_name, r.point) for r in df.collect())


def test_insert_update_delete_in_order(spark):
    log = [(1, "rose", 1.0, 0, 1000, 1), (1, "rose", 2.0, 0, 2000, 2), (1, "rose", 2.0, 1, 3000, 3),
           (1, "tulip", 5.0, 0, 4000, 4), (2, "car", 9.0, 0, 2500, 5), (2, "bus", 8.0, 0, 2500, 6),
           (3, "later", 1.0, None, 10**9, 7), (None, "x", 1.0, 0, 1, 8), (4, "no time", 1.0, 0, None, 9)]
    times = [0, 999, 1000, 1999, 2000, 2500, 2999, 3000, 3999, 4000, 10**9 - 1, 10**9, 10**10, None]
    rewards = [(f"{g}-{t}", "a", "r", g, t) for g in (1, 2, 3, 4, 5, None) for t in times]
    rw, lg = spark.createDataFrame(rewards, REWARD), spark.createDataFrame(log, LOG)
    for bucket in (1, 700, 1000, 3_600_000):
        if bucket == 1:
            rw1 = rw.where("ts_ms < 5000 or ts_ms is null")
            want = plain([r for r in rewards if r[4] is None or r[4] < 5000], log)
        else:
            rw1, want = rw, plain(rewards, log)
        assert rows_of(gifts.enrich_as_of(rw1, lg, bucket_ms=bucket)) == want


def test_random_logs_equal_a_scan(spark):
    r = random.Random(11)
    log = [(r.randrange(6), r.choice("abc"), float(r.randrange(9)), r.choice((0, 0, 1)), r.randrange(5000), i)
           for i in range(150)]
    rewards = [(str(i), "a", "r", r.choice((0, 0, 0, 1, 2, 3, 4, 5, 6)), r.randrange(-50, 6000)) for i in range(600)]
    got = gifts.enrich_as_of(spark.createDataFrame(rewards, REWARD), spark.createDataFrame(log, LOG), bucket_ms=250)
    assert rows_of(got) == plain(rewards, log)


def test_repeated_rows_and_clashing_columns_are_kept(spark):
    rows = spark.createDataFrame([(1, 5, "x", 0.5)] * 3 + [(1, 5, "y", None)], "k int, t long, deleted string, seq double")
    log = spark.createDataFrame([(1, "n", 0, 1, 1)], "id int, v string, deleted int, at long, seq int")
    out = as_of_join(rows, log, ("k", "id"), ("t", "at"), "seq", ("v",))
    assert out.columns == ["k", "t", "deleted", "seq", "v"]
    assert sorted(map(str, (r.deleted for r in out.collect()))) == ["x"] * 3 + ["y"] and out.where("v = 'n'").count() == 4


def test_empty_sides(spark):
    log, rw = spark.createDataFrame([], LOG), spark.createDataFrame([("1", "a", "r", 1, 5)], REWARD)
    assert rows_of(gifts.enrich_as_of(rw, log)) == [("1", None, None)]
    assert gifts.enrich_as_of(rw.limit(0), log).collect() == []


def test_a_hot_gift_is_spread_over_its_buckets(spark):
    """Rows of one gift join on (gift, bucket); the carry holds one row for each bucket, not one for each reward."""
    rows = spark.range(20_000).select(F.lit(1).alias("_key"), (F.col("id") % 40 * 1000).alias("_bucket"))
    log = spark.createDataFrame([(1, "n", 1.0, 0, 500, 1)], LOG)
    s = steps(rows.distinct(), log, "id", "changed_ms", "seq", ("name",), bucket_ms=1000)
    got = s.orderBy("_from").collect()
    assert len(got) == 40 and (got[0]["_from"], got[0]["_until"]) == (500, 1000)
    assert all(r["_from"] == r["_bucket"] for r in got[1:])
    plan = gifts.enrich_as_of(gifts.rewards(td.events(spark, SF_SMALL), keep=("ts_ms",)), td.timed_gift_log(
        spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rewards_without_room_are_counted(spark):
    from pyspark.sql import Observation
    e = spark.createDataFrame([("1", "liveReward", "a", "r", "1"), ("2", "liveReward", None, "r", "1"),
                               ("3", "liveReward", "a", None, "1")],
                              "record_id string, event_name string, anchor_id string, room_id string, gift_id string")
    seen = Observation("rewards")
    assert [r.record_id for r in gifts.rewards(e, seen).collect()] == ["1"]
    assert seen.get == {"dropped": 2, "rows": 3}
