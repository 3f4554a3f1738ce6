"""The plan shapes the scale design relies on (see PLANS.md)."""

import re

import pytest

import __spark_entry__ as entry
from livestats.operators import audience, users
from livestats.plans import testdata as td
from livestats.plans.catalog import QUERIES

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The running maximum over arrival batches runs in one task, over one row per
# batch: bounded by time, not by data.
ONE_ROW_PER_BATCH = {"late_order_lines", "orders_with_late"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_single_partition_or_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    single = [i for i, line in enumerate(plan.splitlines()) if "SinglePartition" in line]
    assert len(single) == (name in ONE_ROW_PER_BATCH)
    for i in single:
        assert re.search(r"HashAggregate\(keys=\[batch#\w+\], functions=\[max\(", plan.splitlines()[i + 1])
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan)


def test_top_n_limits_before_its_shuffle(spark):
    plan = _plan(entry.queries()["hot_goods_top3"](spark, SF_SMALL))
    # the lower WindowGroupLimit (partial) sits below an Exchange, the upper one above it
    lines = plan.splitlines()
    limits = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln]
    exchanges = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    assert len(limits) == 2 and any(limits[0] < e < limits[1] for e in exchanges)


def test_first_seen_joins_on_the_full_tuple_at_scale(spark):
    old_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(entry.queries()["new_device_flag"](spark, SF_SMALL))
        smj = [ln for ln in plan.splitlines() if "SortMergeJoin" in ln]
        assert smj and all(k in smj[0] for k in ("device_id", "ts_ms", "seq"))
        plan = _plan(entry.queries()["audience_running"](spark, SF_SMALL))
        assert "SortMergeJoin" in plan and "_b" in [ln for ln in plan.splitlines() if "SortMergeJoin" in ln][0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_threshold)


def test_predicates_reach_the_scan(spark, tmp_dir):
    """F1-F3 on a flat events table are pushed into the parquet scan."""
    td.events(spark, SF_SMALL).drop("properties").write.parquet(f"{tmp_dir}/events")
    events = spark.read.parquet(f"{tmp_dir}/events")
    for df, pushed in ((users.app_launches(events), "EqualTo(event_name,appLaunch)"),
                       (audience.live_events(events), "In(event_name, [liveEnter,liveLeave])")):
        assert pushed in _plan(df)


def test_effective_audience_shuffles_twice(spark):
    plan = _plan(QUERIES["effective_audience"](spark, SF_SMALL))
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") <= 2


def test_aggregates_combine_before_shuffle(spark):
    for name in ("product_window_counts", "gift_totals", "audience_totals", "new_device_flag"):
        assert "partial_" in _plan(entry.queries()[name](spark, SF_SMALL)), name


def test_hot_order_is_split_by_aqe_and_result_unchanged(spark):
    """A third of the order lines on one (order, window) key: AQE splits that
    partition of the windowed join (J2) across tasks; the rows are the same."""
    from pyspark.sql import functions as F

    from livestats.operators import orders
    from livestats.plans import testdata as td
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = td.order_lines(spark, SF_SMALL).drop("batch")
        is_hot = F.col("order_id") % 3 == 0
        # many map tasks, as a cluster scan has: a skewed partition is split by map ranges
        hot = lines.withColumn("ts_ms", F.when(is_hot, F.lit(694224000000)).otherwise(F.col("ts_ms"))) \
                   .withColumn("order_id", F.when(is_hot, F.lit(1)).otherwise(F.col("order_id"))).repartition(8)
        j = orders.join_headers(hot, td.order_headers(spark, SF_SMALL), 30 * 86_400_000)
        rows = sorted(j.collect())
        assert "SortMergeJoin(skew=true)" in _plan(j)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        assert rows == sorted(orders.join_headers(hot, td.order_headers(spark, SF_SMALL), 30 * 86_400_000).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
