"""Topic sources.

``read_topic`` builds a Kafka reader with the app's option names and defaults;
the same records can be replayed from files (``replay``), which is what the
tests and the registered queries do (no broker is reachable here).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The jobs' option defaults.
DEFAULT_GROUP = "g001"
DEFAULT_OFFSET_RESET = "earliest"
DEFAULT_CHECKPOINT_INTERVAL_MS = 60_000


@dataclass
class TopicOptions:
    """Options of a topic job, named as in the app's properties files.

    ``bootstrap.servers``, ``input.topics`` and ``checkpoint.path`` are
    required; ``group.id`` defaults to g001 and ``auto.offset.reset`` to
    earliest.  ``checkpoint.interval`` becomes the trigger interval.
    """

    bootstrap_servers: str
    topics: list[str]
    checkpoint_path: str
    group_id: str = DEFAULT_GROUP
    offset_reset: str = DEFAULT_OFFSET_RESET
    checkpoint_interval_ms: int = DEFAULT_CHECKPOINT_INTERVAL_MS
    extra: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_properties(cls, props: dict[str, str], topics: str | None = None,
                        group: str | None = None) -> "TopicOptions":
        missing = [k for k in ("bootstrap.servers", "checkpoint.path") if not props.get(k)]
        topic_list = topics or props.get("input.topics")
        if not topic_list:
            missing.append("input.topics")
        if missing:
            raise ValueError(f"missing required options: {', '.join(missing)}")
        return cls(
            bootstrap_servers=props["bootstrap.servers"],
            topics=[t.strip() for t in topic_list.split(",") if t.strip()],
            checkpoint_path=props["checkpoint.path"],
            group_id=group or props.get("group.id", DEFAULT_GROUP),
            offset_reset=props.get("auto.offset.reset", DEFAULT_OFFSET_RESET),
            checkpoint_interval_ms=int(props.get("checkpoint.interval", DEFAULT_CHECKPOINT_INTERVAL_MS)),
            extra={"failOnDataLoss": props["fail.on.data.loss"]} if props.get("fail.on.data.loss") else {},
        )

    def reader_options(self) -> dict[str, str]:
        # Spark tracks offsets in the checkpoint; the group id only names the
        # consumer group prefix.  "earliest"/"latest" map to startingOffsets.
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": ",".join(self.topics),
            "startingOffsets": "earliest" if self.offset_reset == "earliest" else "latest",
            "groupIdPrefix": self.group_id,
            # lost offsets stop the job; ``fail.on.data.loss=false`` lets it skip them
            "failOnDataLoss": "true",
        }
        opts.update(self.extra)
        return opts

    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.checkpoint_interval_ms} milliseconds"}


def read_topic(spark: SparkSession, opts: TopicOptions, stream: bool = True) -> DataFrame:
    """(topic, partition, offset, value as text) from a Kafka topic list."""
    r = (spark.readStream if stream else spark.read).format("kafka").options(**opts.reader_options())
    return r.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def with_record_id(df: DataFrame) -> DataFrame:
    """The unique record id ``topic-partition-offset``."""
    return df.withColumn("record_id", F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"),
                                                  F.col("offset").cast("string")))


def replay(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Topic records saved as parquet (topic, partition, offset, value), read
    back as a batch or as a stream of files (the test backend of S1)."""
    if not stream:
        return spark.read.parquet(path)
    schema = "topic string, partition int, offset bigint, value string"
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def once(records: DataFrame, delay: str, key: str = "key", time: str = "timestamp") -> DataFrame:
    """The reader's half of an at-least-once topic (K4): each record id once.

    A writer that repeats a micro-batch writes its records again with the same
    id as key.  Of the records with one id whose times lie within ``delay``
    the first that arrives passes; its id is kept until the watermark is past
    that, so the state holds the ids of one ``delay`` and no more.  Records without an id have nothing to
    be told apart by and all pass.
    """
    marked = records.withWatermark(time, delay)
    with_id = marked.where(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return with_id.unionByName(marked.where(F.col(key).isNull()))
