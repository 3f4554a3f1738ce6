"""D1/D2 on streams without Python for each event.

Stage 1 (``CandidateStage``, a ``foreachBatch`` handler) marks one candidate of
each device in the micro-batch: the first by (time, sequence).  It is the batch
operator on the micro-batch, so the minimum is pre-aggregated in every task
and a device with a third of all rows costs no task more.  All rows land once
for each batch id.

Stage 2 (``flagged_stream``) reads the landing.  Rows that are no candidates pass
with flag 0; of the candidates, at most one for each device and micro-batch, the
first that its device's state has not seen gets flag 1.

As in the batch form, a NULL device (or type) is a device of its own, and an
event without a time or sequence is never first and leaves no trace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import users
from ..sinks import write_batch
from . import use_rocksdb
from .stateful import FirstSeenProcessor, device_key, first_out

ORDER = ("ts_ms", "seq")


def landed_columns(events: DataFrame, keys, carry) -> list[str]:
    names = ["record_id", *keys, *ORDER, *carry]
    return list(dict.fromkeys(names))


class CandidateStage:
    """Lands the rows of each micro-batch with ``candidate`` = 1 on the first of each device."""

    def __init__(self, landing_path: str, keys=("device_id",), carry: tuple[str, ...] = ()):
        self.landing, self.keys, self.carry = landing_path.rstrip("/"), tuple(keys), tuple(carry)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        rows = batch_df.select(*landed_columns(batch_df, self.keys, self.carry))
        write_batch(users.first_seen(rows, self.keys, ORDER, flag="candidate"), self.landing, batch_id)

    def prepare(self, events: DataFrame) -> T.StructType:
        """Makes the landing folder (through Spark, so shared storage works); returns the schema of its rows."""
        rows = events.select(*landed_columns(events, self.keys, self.carry))
        schema = T.StructType([*rows.schema.fields, T.StructField("candidate", T.IntegerType())])
        events.sparkSession.createDataFrame([], schema).write.mode("append").parquet(f"{self.landing}/batch_id=-1")
        return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def flagged_stream(spark: SparkSession, landing_path: str, schema: T.StructType, keys=("device_id",),
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """``record_id, device_id, ts_ms, is_n`` and ``carry`` of every landed row."""
    use_rocksdb(spark)
    rows = spark.readStream.schema(schema).parquet(landing_path)
    if "device_id" not in rows.columns:
        rows = rows.withColumn("device_id", F.col(keys[-1]))
    out = first_out(rows.schema, carry)
    others = rows.where("candidate = 0").withColumn("is_n", F.lit(0)).select(*out.fieldNames())
    firsts = rows.where("candidate = 1").withColumn("_device", device_key(keys)).groupBy("_device").transformWithState(
        FirstSeenProcessor(out.fieldNames(), ("batch_id", *ORDER)), out, "Append", "None")
    return others.unionByName(firsts)
