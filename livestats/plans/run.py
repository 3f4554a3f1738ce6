"""Launch a job from a properties file, the way the app's jobs are started.

    spark-submit --py-files livestats.zip run_job.py <job> <file.properties>
    python -m livestats.plans.run <job> <file.properties>

Source options keep the app's names (``bootstrap.servers``, ``input.topics``,
``group.id``, ``auto.offset.reset``, ``checkpoint.interval``,
``checkpoint.path``); ``input.path`` replays topic records from files instead.
Sinks: ``jdbc.url`` + ``jdbc.table`` (append, or upsert with ``jdbc.keys``),
else ``output.path`` (parquet, one folder per micro-batch, written once; with
``output.keys`` a table that each micro-batch is merged into), else
the console.  A job with several outputs names each table and its keys by the
query (``jdbc.table.gift_totals``, ``jdbc.keys.gift_totals``).
``watermark.ms`` is how far event-time jobs wait for rows out of order.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import sinks
from ..session import build_session, ensure_checkpoint_dir
from ..sinks.keyed_files import keyed_files
from ..sources import dimension, topic
from ..streaming import stateful
from . import jobs


def read_properties(path_or_text: str, is_text: bool = False) -> dict[str, str]:
    """``key=value`` lines; ``#``/``!`` comments and blank lines skipped."""
    text = path_or_text if is_text else open(path_or_text, encoding="utf-8").read()
    props = {}
    for raw in text.splitlines():
        line = raw.strip()
        if not line or line[0] in "#!":
            continue
        sep = min((i for i in (line.find("="), line.find(":")) if i >= 0), default=-1)
        if sep < 0:
            props[line] = ""
        else:
            props[line[:sep].strip()] = line[sep + 1:].strip()
    return props


def source_of(props: dict[str, str], topics_key: str = "input.topics"):
    """A replay folder (``input.path``) or the topic options."""
    if props.get("input.path"):
        return props["input.path"]
    return topic.TopicOptions.from_properties(props, topics=props.get(topics_key))


def trigger_of(props: dict[str, str]) -> dict | None:
    if props.get("trigger") == "once":
        return {"availableNow": True}
    if props.get("input.path") and not props.get("checkpoint.interval"):
        return None
    return {"processingTime": f"{int(props.get('checkpoint.interval', topic.DEFAULT_CHECKPOINT_INTERVAL_MS))} milliseconds"}


# Jobs with several outputs, each with its own columns.
SEVERAL = ("user_count", "gift_count", "order_count", "live_audience_batches", "window_sum_with_history")


def sink_of(props: dict[str, str], default: str = "console", several: bool = False):
    """The job's sink; with ``output.path`` each query writes its own folder,
    and with ``jdbc.table.<query>`` its own table."""
    def of_query(name: str):
        own = dict(props)
        if props.get("output.path"):
            own["output.path"] = f"{props['output.path'].rstrip('/')}/{name}"
        for key in ("jdbc.table", "jdbc.keys", "output.keys"):
            if props.get(f"{key}.{name}"):
                own[key] = props[f"{key}.{name}"]
        if props.get("jdbc.url") and several and not props.get(f"jdbc.table.{name}"):
            raise ValueError(f"a job with several outputs needs jdbc.table.{name}")
        return _sink(own, default)
    if props.get("output.path") or props.get("jdbc.url"):
        return jobs.PerQuery(of_query)
    return default


def handler_of(sink, name: str):
    """A ``foreachBatch`` handler for a query."""
    own = sink(name) if isinstance(sink, jobs.PerQuery) else sink
    return own if callable(own) else (lambda df, bid: df.show(truncate=False))


def delay_of(props: dict[str, str]) -> str:
    return f"{int(props.get('watermark.ms', 0))} milliseconds"


def _sink(props: dict[str, str], default: str = "console") -> str | Callable[[DataFrame, int], None]:
    if props.get("jdbc.url") and props.get("jdbc.table"):
        opts = sinks.JdbcOptions(url=props["jdbc.url"], table=props["jdbc.table"], user=props.get("jdbc.user"),
                                 password=props.get("jdbc.password"), driver=props.get("jdbc.driver"),
                                 batch_rows=int(props.get("jdbc.batch.rows", sinks.LAUNCH_BATCH_ROWS)))
        keys = [k.strip() for k in props.get("jdbc.keys", "").split(",") if k.strip()]
        return sinks.jdbc_upsert(opts, keys) if keys else sinks.jdbc_append(opts)
    if props.get("output.path"):
        out = props["output.path"].rstrip("/")
        keys = [k.strip() for k in props.get("output.keys", "").split(",") if k.strip()]
        if keys:
            return keyed_files(out, keys)

        def write(df: DataFrame, batch_id: int) -> None:
            sinks.write_batch(df, out, batch_id)
        return write
    return default


def start(job: str, props: dict[str, str], spark: SparkSession | None = None):
    """Start ``job`` with ``props``; returns the started queries."""
    spark = spark or build_session()
    ck = props.get("checkpoint.path")
    trig = trigger_of(props)
    sink = sink_of(props, several=job in SEVERAL)
    delay = delay_of(props)
    salts = int(props.get("join.salts", 1))
    if job == "user_count":
        return jobs.user_count(spark, source_of(props), sink, ck, trig)
    if job in ("launch_rows", "launch_rows_first_seen"):
        flag = "is_n" if job == "launch_rows_first_seen" else props.get("flag.column", "is_new")
        folders = props.get("output.path") if props.get("output.partitioned") == "true" else None
        return jobs.launch_rows(spark, source_of(props), sink, flag, ck, trigger=trig, partitioned_path=folders)
    if job == "first_seen":
        return jobs.first_seen(spark, source_of(props), sink, props.get("per.type") == "true",
                               props.get("approximate") == "true", ck, trig,
                               int(props["bloom.capacity"]) if props.get("bloom.capacity") else None,
                               float(props.get("bloom.fpp", 0.01)), int(props.get("bloom.buckets", stateful.BUCKETS)))
    if job == "live_audience":
        return [jobs.live_audience(spark, source_of(props), sink, ck, trig)]
    if job == "live_audience_windows":
        return [jobs.live_audience_windows(spark, source_of(props), sink, int(props.get("window.ms", 5000)), ck, trig,
                                           delay)]
    if job == "live_audience_batches":
        return jobs.live_audience_batches(spark, source_of(props), handler_of(sink, "audience_batches"), sink,
                                          int(props.get("window.ms", 5000)), ck, trig)
    if job == "effective_audience":
        return [jobs.effective_audience(spark, source_of(props), sink, int(props.get("stay.ms", 60000)), ck, trig,
                                        delay, props.get("stay.by.clock") == "true")]
    if job == "hot_goods":
        return [jobs.hot_goods(spark, source_of(props), handler_of(sink, "hot_goods"),
                               int(props.get("window.ms", 600000)), int(props.get("slide.ms", 60000)),
                               int(props.get("top.n", 3)), ck, trig, delay)]
    if job == "filter_topic":
        to = (props["bootstrap.servers"], props["output.topic"]) if props.get("output.topic") else None
        return [jobs.filter_topic(spark, source_of(props), sink, props.get("drop.word", "error"), ck, trig, to)]
    if job == "groupon_count":
        return [jobs.groupon_count(spark, props["detail.path"], props["main.path"], props["order.path"], sink,
                                   int(props.get("window.ms", 5000)), ck, trig, delay, salts)]
    if job == "lines_to_table":
        if isinstance(sink, str):
            raise ValueError("lines_to_table needs jdbc.url + jdbc.table or output.path")
        return [jobs.lines_to_table(spark, props["input.path"], sink, ck, trig)]
    if job == "window_sum_with_history":
        return jobs.window_sum_with_history(spark, props["input.path"], sink, int(props.get("window.ms", 10000)),
                                            ck, trig, delay)
    if job == "gift_count":
        # the gift dimension: a database table (gift.jdbc.url + gift.jdbc.table) or a change-log folder
        if props.get("gift.jdbc.url"):
            changes = dimension.jdbc_changes(props["gift.jdbc.url"], props["gift.jdbc.table"],
                                             {k[len("gift.jdbc."):]: v for k, v in props.items()
                                              if k in ("gift.jdbc.user", "gift.jdbc.password", "gift.jdbc.driver")})
        else:
            changes = dimension.table_changes(props["gift.path"])
        root = (ck or ensure_checkpoint_dir(spark)).rstrip("/")
        snap = dimension.DimensionSnapshot(spark, changes, f"{root}/gift_snapshot")
        q1, start_totals = jobs.gift_count_refreshing(spark, source_of(props), snap, f"{root}/gift_enriched",
                                                      sink, sink, ck, trig)
        return [q1, *start_totals()]
    if job == "order_count":
        # two change-capture topics (order.topics / detail.topics) and an order snapshot table
        headers, lines = jobs.order_streams(spark, props.get("order.path") or source_of(props, "order.topics"),
                                            props.get("detail.path") or source_of(props, "detail.topics"))

        def snapshot():  # listed anew, so orders that have arrived since are found
            return spark.read.parquet(props["orders.snapshot.path"]).selectExpr(
                "oid AS order_id", "total_money", "cast(status AS STRING) AS status",
                "unix_millis(update_time) AS ts_ms")
        return jobs.order_count(spark, lines, headers, snapshot, handler_of(sink, "order_join"),
                                handler_of(sink, "order_rescued"), size_ms=int(props.get("window.ms", 10000)),
                                checkpoint_root=ck, trigger=trig, delay=delay, salts=salts)
    raise ValueError(f"unknown job {job!r}")


def main(argv: list[str]) -> None:
    if len(argv) != 2:
        raise SystemExit(__doc__)
    queries = start(argv[0], read_properties(argv[1]))
    for q in queries:
        q.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
