"""The app's jobs as started Structured Streaming queries.

Each function wires a source, the operators and the sinks of one job.  A
source is either ``TopicOptions`` (a topic list) or a folder of replayed
topic records; a sink is a ``foreachBatch`` handler from ``livestats.sinks``
or the name of a built-in format (``console``, ``memory``).  Checkpoints go
under ``checkpoint_root`` (by default the shared ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas, sinks
from ..functions import parse
from ..functions.columns import line_without
from ..operators import audience, gifts, orders, users
from ..session import checkpoint_location
from ..sources import files, topic
from ..streaming import firsts, late, stateful, streams, use_rocksdb

Sink = str | Callable[[DataFrame, int], None] | Callable[[str], object]


def _start(df: DataFrame, name: str, sink: Sink, mode: str, checkpoint_root: str | None,
           trigger: dict | None = None) -> StreamingQuery:
    spark = df.sparkSession
    if isinstance(sink, PerQuery):
        sink = sink(name)
    ckpt = f"{checkpoint_root.rstrip('/')}/{name}" if checkpoint_root else checkpoint_location(spark, name)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).queryName(name)
    w = w.foreachBatch(sink) if callable(sink) else w.format(sink)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


class PerQuery:
    """A sink chosen by query name, for jobs with several outputs."""

    def __init__(self, make: Callable[[str], object]):
        self.make = make

    def __call__(self, name: str):
        return self.make(name)


def records(spark: SparkSession, source, max_files_per_trigger: int | None = None) -> DataFrame:
    """Topic records with their record id, from a topic or a replay folder."""
    if isinstance(source, topic.TopicOptions):
        raw = topic.read_topic(spark, source)
    else:
        raw = topic.replay(spark, source, stream=True, max_files_per_trigger=max_files_per_trigger)
    return topic.with_record_id(raw)


def event_stream(spark: SparkSession, source, max_files_per_trigger: int | None = None) -> DataFrame:
    """S2 + P2: parsed events with record id and arrival sequence."""
    e = parse.parse_events(records(spark, source, max_files_per_trigger), keep=("record_id", "offset"),
                           metrics="events")
    return e.withColumnRenamed("offset", "seq")


# ---- users ------------------------------------------------------------------

def user_count(spark, source, sink: Sink = "console", checkpoint_root=None, trigger=None):
    """New users (A1), new users by channel (A2), launches by channel x type (A3)."""
    ev = event_stream(spark, source)
    return [_start(streams.new_user_counts(ev), "new_user_count", sink, "update", checkpoint_root, trigger),
            _start(streams.new_users_by_channel(ev), "new_users_by_channel", sink, "update", checkpoint_root, trigger),
            _start(streams.launches_by_channel_device(ev), "launches_by_channel_device", sink, "update",
                   checkpoint_root, trigger)]


LAUNCH_CARRY = ("event_name", "is_new", "os_name", "province", "release_channel", "device_type")


def _staged_first_seen(spark, ev: DataFrame, name: str, keys, carry, landing_path, checkpoint_root, trigger):
    """Stage 1 of the first-seen forms, started, and the flagged rows as a stream."""
    root = (checkpoint_root or checkpoint_location(spark, "")).rstrip("/")
    stage = firsts.CandidateStage(landing_path or f"{root}/{name}_landing", keys, carry)
    schema = stage.prepare(ev)
    q1 = _start(ev, f"{name}_candidates", stage, "append", checkpoint_root, trigger)
    if trigger and trigger.get("availableNow"):
        q1.awaitTermination()  # a one-shot run: let stage 2 see every landed row
    return q1, firsts.flagged_stream(spark, stage.landing, schema, keys, carry)


def launch_rows(spark, source, sink: Sink, flag_col: str = "is_n", checkpoint_root=None,
                name: str = "launch_rows", trigger=None, partitioned_path: str | None = None,
                landing_path: str | None = None):
    """Wide launch rows to a warehouse (M3 + M5, K2/K5).  ``flag_col`` is
    ``is_n`` (the first-seen flag, computed over all events first) or
    ``is_new`` (the arriving flag).  With ``partitioned_path`` the rows land
    there in date and hour folders.  Returns the query, for ``is_n`` after that of
    the stage that marks candidates (see ``streaming.firsts``)."""
    ev = event_stream(spark, source)
    started = []
    if flag_col == "is_n":
        # the flag is computed over all events (not only launches), and the
        # row's columns ride along with it: no join back to the events
        q1, ev = _staged_first_seen(spark, ev, name, ("device_id",), LAUNCH_CARRY, landing_path, checkpoint_root, trigger)
        started = [q1]
    rows = users.launch_rows(users.app_launches(ev), flag_col=flag_col)
    if partitioned_path:  # date and hour folders of files (K5), each batch exactly once
        ckpt = f"{checkpoint_root.rstrip('/')}/{name}" if checkpoint_root else checkpoint_location(spark, name)
        w = sinks.partitioned_files(rows, partitioned_path, ckpt).queryName(name)
        return [*started, (w.trigger(**trigger) if trigger else w).start()]
    return [*started, _start(rows, name, sink, "append", checkpoint_root, trigger)]


def first_seen(spark, source, sink: Sink = "console", per_type: bool = False, approximate: bool = False,
               checkpoint_root=None, trigger=None, capacity: int | None = None, fpp: float = 0.01,
               buckets: int = stateful.BUCKETS, landing_path: str | None = None):
    """First-seen device flag: per device type (D1), per device (D2), or the
    bounded-memory approximation (D3).

    The exact forms run in two stages (``streaming.firsts``), so both queries
    are returned.  D3 holds ``buckets`` filters for ``capacity`` devices in all
    (per type) at a false-positive rate of ``fpp``; beyond the capacity more new
    devices go unflagged, and more tasks than buckets have no work."""
    use_rocksdb(spark)
    ev = event_stream(spark, source)
    keys = ("device_type", "device_id") if per_type else ("device_id",)
    if approximate:
        cap = capacity or (stateful.CAPACITY_PER_TYPE if per_type else stateful.CAPACITY_PER_TASK)
        out = stateful.approx_first_seen_stream(ev, capacity=cap, fpp=fpp, buckets=buckets, keys=keys)
        return [_start(out, "first_seen", sink, "append", checkpoint_root, trigger)]
    q1, out = _staged_first_seen(spark, ev, "first_seen", keys, (), landing_path, checkpoint_root, trigger)
    return [q1, _start(out, "first_seen", sink, "append", checkpoint_root, trigger)]


# ---- audience ---------------------------------------------------------------------

def live_audience(spark, source, sink: Sink = "console", checkpoint_root=None, trigger=None):
    """Cumulative and online audience per room (A4/A5), update mode."""
    return _start(streams.audience_totals(event_stream(spark, source)), "audience", sink, "update",
                  checkpoint_root, trigger)


def live_audience_windows(spark, source, sink: Sink = "console", size_ms: int = audience.WINDOW_MS,
                          checkpoint_root=None, trigger=None, delay: str = streams.DEFAULT_DELAY):
    """Per event-time window deltas (A6); windows close ``delay`` behind the newest event."""
    return _start(streams.audience_window_delta(event_stream(spark, source), size_ms, delay), "audience_windows",
                  sink, "append", checkpoint_root, trigger)


def live_audience_batches(spark, source, sink: Callable[[DataFrame, int], None], history_sink: Sink = "console",
                          size_ms: int = audience.WINDOW_MS, checkpoint_root=None, trigger=None,
                          max_files_per_trigger: int | None = None):
    """Deltas by processing-time window (A6, W4) and every room's history.

    The trigger interval is the window, so no event is late or dropped; the
    history is the running total, emitted for each room that changed."""
    trigger = trigger or {"processingTime": f"{int(size_ms)} milliseconds"}
    ev = event_stream(spark, source, max_files_per_trigger)
    handler = sink("audience_batches") if isinstance(sink, PerQuery) else sink
    return [_start(ev, "audience_batches", streams.audience_batch_delta(handler), "append", checkpoint_root, trigger),
            _start(streams.audience_totals(ev), "audience_history", history_sink, "update", checkpoint_root, trigger)]


def effective_audience(spark, source, sink: Sink = "console", stay_ms: int = audience.STAY_MS,
                       checkpoint_root=None, trigger=None, delay: str = streams.DEFAULT_DELAY, by_clock: bool = False):
    """Stays of at least ``stay_ms`` (A7): one row per settled enter plus
    online deltas; per-room totals are their sums.  ``by_clock`` measures a stay
    by the clock (W6) instead of by the events' times."""
    use_rocksdb(spark)
    live = audience.live_events(event_stream(spark, source), metrics="effective_audience_incomplete")
    stays = stateful.stay_clock_stream(live, stay_ms) if by_clock else stateful.stay_stream(live, stay_ms, delay)
    return _start(stays, "effective_audience", sink, "append",
                  checkpoint_root, trigger)


# ---- gifts --------------------------------------------------------------------------

def gift_count(spark, source, snapshot: DataFrame, totals_sink: Sink = "console", by_name_sink: Sink = "console",
               checkpoint_root=None, trigger=None):
    """Gift totals per room (J1 + A8, upsert with ``sinks.jdbc_upsert``) and
    count per gift name (A9) against a fixed ``snapshot`` (as it is when the
    queries start); for a changing one see :func:`gift_count_refreshing`."""
    ev = event_stream(spark, source)
    enriched = streams.gift_enriched(ev, snapshot)
    return [_start(gifts.gift_totals(enriched), "gift_totals", totals_sink, "update", checkpoint_root, trigger),
            _start(gifts.count_by_gift(enriched), "gift_by_name", by_name_sink, "update", checkpoint_root, trigger)]


def gift_count_refreshing(spark, source, snapshot, landing_path: str, totals_sink: Sink = "console",
                          by_name_sink: Sink = "console", checkpoint_root=None, trigger=None):
    """Gift job with the dimension re-polled during the stream (S3 + J1):
    stage 1 enriches each micro-batch against a freshly merged snapshot and
    lands the rows (A12); stage 2 keeps the running totals (A8, A9) over the
    landing.  ``snapshot`` is a ``sources.dimension.DimensionSnapshot``.
    Returns the stage-1 query and a function starting stage 2."""
    from ..streaming.enrich import ENRICHED_SCHEMA, RefreshingEnricher, enriched_stream
    q1 = _start(event_stream(spark, source), "gift_enrich", RefreshingEnricher(snapshot, landing_path), "append",
                checkpoint_root, trigger)

    def start_totals():
        if trigger and trigger.get("availableNow"):
            q1.awaitTermination()  # a one-shot run: let the totals see every landed row
        # make sure the landing folder exists (through Spark, so shared storage works)
        schema = T.StructType([f for f in T.StructType.fromDDL(ENRICHED_SCHEMA).fields if f.name != "batch_id"])
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{landing_path.rstrip('/')}/batch_id=-1")
        e = enriched_stream(spark, landing_path)
        return [_start(gifts.gift_totals(e), "gift_totals", totals_sink, "update", checkpoint_root, trigger),
                _start(gifts.count_by_gift(e), "gift_by_name", by_name_sink, "update", checkpoint_root, trigger)]
    return q1, start_totals


# ---- products ------------------------------------------------------------------------

def hot_goods(spark, source, write: Callable[[DataFrame, int], None], size_ms: int = 600_000,
              slide_ms: int = 60_000, n: int = 3, checkpoint_root=None, trigger=None,
              delay: str = streams.DEFAULT_DELAY):
    """Top ``n`` products per closed sliding window (A10 + T1)."""
    counts = streams.product_window_counts(event_stream(spark, source), size_ms, slide_ms, delay)
    return _start(counts, "hot_goods", streams.top_n_per_batch(n, write), "append", checkpoint_root, trigger)


# ---- orders --------------------------------------------------------------------------------

ORDER_COLS = ["order_id", "line", "sku", "ts_ms"]


def order_count(spark, lines: DataFrame, headers: DataFrame, snapshot: DataFrame | Callable[[], DataFrame],
                joined_sink: Callable[[DataFrame, int], None], rescued_write: Callable[[DataFrame, int], None],
                on_time_path: str | None = None, size_ms: int = orders.WINDOW_MS, checkpoint_root=None, trigger=None,
                delay: str = streams.DEFAULT_DELAY, salts: int = 1):
    """Order lines joined to headers in windows (J2), late lines split off
    (W7), given an empty header (M6) and looked up in the snapshot (J4).

    One watermark decides: the splitter flags every line against the
    watermark before its micro-batch.  Late lines are rescued at once; on-time
    lines land (once per batch id) in ``on_time_path``, and
    the windowed stream-stream join reads them from there.  So each line takes
    exactly one of the two paths (Spark's join alone may still match a line
    behind its watermark while the header is in state).  Joined lines that
    found no header in their window are looked up in the snapshot too.

    ``snapshot`` is the table of orders, or a function that reads it anew: then
    every micro-batch sees the orders that have arrived by then.  It is reduced
    to the batch's order ids before it is joined.  ``joined_sink`` and
    ``rescued_write`` are ``foreachBatch`` handlers (or the name of a format for
    ``joined_sink``, which then gets the plain join).

    ``lines``/``headers`` are parsed streams with ``order_id`` and ``ts_ms``.
    Returns the splitter query and the join query.
    """
    root = (checkpoint_root or checkpoint_location(spark, "")).rstrip("/")
    on_time_path = (on_time_path or f"{root}/order_lines_on_time").rstrip("/")
    line_schema = lines.select(*ORDER_COLS).schema

    def known(ids: DataFrame) -> DataFrame:
        all_orders = snapshot() if callable(snapshot) else snapshot
        return all_orders.join(ids.select("order_id").distinct(), "order_id", "left_semi")

    def rescue(late_df: DataFrame, batch_id: int) -> None:
        rescued_write(orders.rescue(None, late_df.select(*ORDER_COLS), known(late_df)), batch_id)

    def complete(joined_df: DataFrame, batch_id: int) -> None:
        missing = joined_df.where(F.col("total_money").isNull() & F.col("status").isNull())
        found = orders.rescue(joined_df, missing.limit(0).select(*ORDER_COLS), known(missing))
        handler(found, batch_id)

    def land(on_time_df: DataFrame, batch_id: int) -> None:
        sinks.write_batch(on_time_df.select(*ORDER_COLS), on_time_path, batch_id)

    splitter = late.LateSplitter(f"{root}/order_marks", size_ms, on_late=rescue, on_time=land,
                                 delay_ms=streams.delay_ms(delay))
    q1 = _start(lines.select(*ORDER_COLS), "late_orders", splitter, "append", checkpoint_root, trigger)
    if trigger and trigger.get("availableNow"):
        q1.awaitTermination()  # a one-shot run: let the join see every landed line
    # make sure the landing folder exists (through Spark, so shared storage works)
    spark.createDataFrame([], line_schema).write.mode("append").parquet(f"{on_time_path}/batch_id=-1")
    landed = T.StructType(line_schema.fields + [T.StructField("batch_id", T.LongType())])
    on_time = spark.readStream.schema(landed).parquet(on_time_path).drop("batch_id")
    j = streams.order_join_stream(on_time, headers, size_ms, delay, salts)
    handler = joined_sink("order_join") if isinstance(joined_sink, PerQuery) else joined_sink
    q2 = _start(j, "order_join", complete if callable(handler) else handler, "append", checkpoint_root, trigger)
    return [q1, q2]


def cdc_stream(spark, source, row_schema, max_files_per_trigger: int | None = None,
               metrics: str = "changes") -> DataFrame:
    """P3/P4 on a stream of change-capture records."""
    return parse.parse_cdc(records(spark, source, max_files_per_trigger), row_schema, keep=("record_id",),
                           metrics=metrics)


def order_streams(spark, headers_source, lines_source,
                  max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Order headers and lines from their change-capture topics, in the
    shape ``order_count`` takes; event time is the row's update time."""
    h = cdc_stream(spark, headers_source, schemas.ORDER_HEADER, max_files_per_trigger, "order_headers").select(
        F.col("oid").alias("order_id"), F.unix_millis("update_time").alias("ts_ms"), "total_money",
        F.col("status").cast("string").alias("status"))
    li = cdc_stream(spark, lines_source, schemas.ORDER_LINE, max_files_per_trigger, "order_lines").select(
        "order_id", F.col("id").alias("line"), "sku", F.unix_millis("update_time").alias("ts_ms"))
    return h, li


# ---- group-buying ---------------------------------------------------------------------------------

def groupon_count(spark, detail_dir: str, main_dir: str, order_dir: str, sink: Sink = "console",
                  size_ms: int = 5_000, checkpoint_root=None, trigger=None, delay: str = streams.DEFAULT_DELAY,
                  salts: int = 1):
    """Detail -> main -> order (J3) from three delimited text feeds (S4 + P5).
    Rejected lines are counted in the observed metrics ``groupon_detail``,
    ``groupon_main`` and ``groupon_order``."""
    def feed(path, fields, name):
        return parse.split_delimited(files.read_lines(spark, path, stream=True), fields, metrics=f"groupon_{name}")
    j = streams.groupon_join_stream(feed(detail_dir, schemas.GROUPON_DETAIL, "detail"),
                                    feed(main_dir, schemas.GROUPON_MAIN, "main"),
                                    feed(order_dir, schemas.GROUPON_ORDER, "order"), size_ms, delay, salts)
    return _start(j, "groupon", sink, "append", checkpoint_root, trigger)


# ---- demos --------------------------------------------------------------------------------------------

def lines_to_table(spark, lines_dir: str, sink: Callable[[DataFrame, int], None], checkpoint_root=None, trigger=None):
    """Delimited ``id,name,age`` lines appended to a table (P5 + K2)."""
    rows = parse.split_delimited(files.read_lines(spark, lines_dir, stream=True), schemas.PERSON, metrics="lines_to_table")
    return _start(rows, "lines_to_table", sink, "append", checkpoint_root, trigger)


def filter_topic(spark, source, sink: Sink, word: str = "error", checkpoint_root=None, trigger=None,
                 to_topic: tuple[str, str] | None = None):
    """Topic-to-topic ETL dropping lines containing ``word`` (F4 + K4); rows
    carry the source record id as key for de-duplication downstream.
    ``to_topic`` = (servers, topic) writes to a topic instead of ``sink``."""
    r = records(spark, source)
    if to_topic:
        ckpt = f"{checkpoint_root.rstrip('/')}/filter_topic" if checkpoint_root else checkpoint_location(spark, "filter_topic")
        w = sinks.topic_writer(r.where(line_without(word)), *to_topic, ckpt).queryName("filter_topic")
        return (w.trigger(**trigger) if trigger else w).start()
    out = sinks.topic_records(r.where(line_without(word)))
    return _start(out, "filter_topic", sink, "append", checkpoint_root, trigger)


def window_sum_with_history(spark, lines_dir: str, sink: Sink = "console", size_ms: int = 10_000,
                            checkpoint_root=None, trigger=None, delay: str = streams.DEFAULT_DELAY):
    """``word,count`` lines: sum per word and processing-time window
    and the word's lifetime total at every trigger (W5)."""
    rows = parse.split_delimited(files.read_lines(spark, lines_dir, stream=True), schemas.WORD_COUNT, metrics="word_counts") \
        .withColumn("ts_ms", F.unix_millis(F.current_timestamp()))
    windowed = streams.with_event_time(rows, delay).groupBy(
        F.window("event_time", f"{int(size_ms)} milliseconds").alias("w"), "key").agg(F.sum("value").alias("value_sum"))
    windowed = windowed.select("key", F.unix_millis("w.start").alias("window_start"), "value_sum")
    return [_start(windowed, "word_windows", sink, "append", checkpoint_root, trigger),
            _start(streams.running_sum(rows, ["key"], "value"), "word_history", sink, "update",
                   checkpoint_root, trigger)]
