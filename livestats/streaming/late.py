"""W7 on streams: split late rows off instead of dropping them.

Spark drops rows behind the watermark inside a stateful operator and only
counts them.  ``LateSplitter`` runs as a ``foreachBatch`` handler ahead of
that: it flags each row of a micro-batch against the watermark *before* the
batch (max event time of all earlier batches - delay), exactly the rule of the
batch operator ``operators.orders.flag_late``.

The running max is stored per batch id under the shared checkpoint folder
(one tiny parquet file per batch, read back by exact path), so a retried
batch sees the same watermark and writes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import tumbling_start
from ..sinks import path_exists


class LateSplitter:
    def __init__(self, marks_path: str, size_ms: int, on_late: Callable[[DataFrame, int], None],
                 on_time: Callable[[DataFrame, int], None] | None = None,
                 delay_ms: int = 0, time_col: str = "ts_ms"):
        self.marks_path = marks_path.rstrip("/")
        self.size_ms, self.delay_ms, self.time_col = int(size_ms), int(delay_ms), time_col
        self.on_late, self.on_time = on_late, on_time

    def _mark(self, spark, batch_id: int):
        path = f"{self.marks_path}/batch={batch_id}"
        if not path_exists(spark, path):
            raise RuntimeError(f"the mark of batch {batch_id} is gone: {path}")
        row = spark.read.parquet(path).first()
        return None if row is None else row["running_max"]

    @staticmethod
    def _drop(spark, path: str) -> None:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        prev = self._mark(spark, batch_id - 1) if batch_id > 0 else None
        batch_df.persist()  # read three times below
        # one scalar per batch reaches the driver: the batch's max event time
        batch_max = batch_df.agg(F.max(self.time_col)).first()[0]
        seen = [v for v in (prev, batch_max) if v is not None]
        running = max(seen) if seen else None
        spark.createDataFrame([(running,)], "running_max long").coalesce(1) \
             .write.mode("overwrite").parquet(f"{self.marks_path}/batch={batch_id}")
        if batch_id >= 2:  # only batch - 1 is ever read again: keep the folder small
            self._drop(spark, f"{self.marks_path}/batch={batch_id - 2}")
        end = tumbling_start(self.time_col, self.size_ms) + F.lit(self.size_ms)
        if prev is None:
            late = F.lit(False)
        else:
            late = F.coalesce(end <= F.lit(int(prev) - self.delay_ms), F.lit(False))
        flagged = batch_df.withColumn("is_late", late)
        self.on_late(flagged.where("is_late"), batch_id)
        if self.on_time is not None:
            self.on_time(flagged.where(~F.col("is_late")), batch_id)
        batch_df.unpersist()
