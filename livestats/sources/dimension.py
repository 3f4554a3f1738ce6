"""S3: a polled dimension (the gift table) merged into a snapshot.

Each poll reads only the rows changed at or since the high-water mark (a
pushed down predicate on the update time), so a change that commits later with
the mark's own time is not lost, and the snapshot keeps the latest change per
id with deletes applied.  Re-reading a row is harmless: the merge is keyed by
id and ordered by update time; of equal times the one read last counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gifts import gift_snapshot
from ..sinks import path_exists

# Poll interval of the gift dimension (ms).
POLL_INTERVAL_MS = 5_000


def jdbc_changes(url: str, table: str, props: dict[str, str] | None = None,
                 time_col: str = "update_time") -> Callable[[SparkSession, object], DataFrame]:
    """Reader of the rows changed after a mark, from a database table.

    The predicate is part of the query sent to the database, so only the
    changed rows travel.
    """
    def read(spark: SparkSession, mark) -> DataFrame:
        where = "" if mark is None else f" WHERE {time_col} >= TIMESTAMP '{mark}'"
        q = f"(SELECT id, name, point, deleted, {time_col} FROM {table}{where}) AS changes"
        return spark.read.jdbc(url, q, properties=props or {})
    return read


def table_changes(path: str, time_col: str = "update_time") -> Callable[[SparkSession, object], DataFrame]:
    """Reader of the rows changed after a mark, from a parquet change log
    (the filter is pushed into the scan)."""
    def read(spark: SparkSession, mark) -> DataFrame:
        df = spark.read.parquet(path)
        return df if mark is None else df.where(F.col(time_col) >= F.lit(mark).cast("timestamp"))
    return read


class DimensionSnapshot:
    """Keeps the current snapshot under ``snapshot_path`` (shared storage).

    ``refresh`` merges the changes since the last mark and rewrites the
    snapshot (a dimension: small and bounded by the number of ids); call it
    at the start of a micro-batch, or every ``POLL_INTERVAL_MS``.  Two slots
    alternate, so the snapshot being read is never the one being written,
    and a poll that finds no change writes nothing.
    """

    def __init__(self, spark: SparkSession, read_changes, snapshot_path: str,
                 key: str = "id", time_col: str = "update_time"):
        self.spark, self.read_changes = spark, read_changes
        self.path, self.key, self.time_col = snapshot_path.rstrip("/"), key, time_col
        self.mark = None
        self.slot = None  # slot holding the current snapshot (0 or 1), None before the first refresh

    def _log(self) -> DataFrame | None:
        if self.slot is None or not path_exists(self.spark, f"{self.path}/slot={self.slot}/_SUCCESS"):
            return None
        return self.spark.read.parquet(f"{self.path}/slot={self.slot}")

    def refresh(self) -> DataFrame:
        return self.merge(self.read_changes(self.spark, self.mark))

    def merge(self, changes: DataFrame) -> DataFrame:
        """Merges changed rows, polled or from a stream's micro-batch; merging rows again is harmless."""
        changes = changes.select(
            self.key, "name", "point", F.coalesce("deleted", F.lit(0)).alias("deleted"), self.time_col)
        cur = self._log()
        if cur is not None:
            same = [changes[c].eqNullSafe(cur[c]) for c in changes.columns]
            if changes.join(cur, same, "left_anti").isEmpty():
                return self.current()
        log = changes.withColumn("_read", F.lit(1))
        log = log if cur is None else log.unionByName(cur.withColumn("_read", F.lit(0)))
        # keep the last change per id (deleted ones too, so a late re-read of
        # an older row cannot resurrect a deleted gift)
        change = F.struct("name", "point", "deleted", self.time_col)
        last = log.groupBy(self.key).agg(F.max_by(change, F.struct(
            self.time_col, "_read", "deleted", "name", "point")).alias("_l"))
        nxt = 0 if self.slot in (None, 1) else 1
        last.select(self.key, "_l.*").write.mode("overwrite").parquet(f"{self.path}/slot={nxt}")
        self.slot = nxt
        m = self._log().agg(F.max(self.time_col)).first()[0]
        self.mark = m if m is not None else self.mark
        return self.current()

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        """A ``foreachBatch`` handler for a stream of changes (``sources.changes``)."""
        self.merge(batch_df)

    def current(self) -> DataFrame:
        """The snapshot: (id, name, point) of the gifts not deleted."""
        log = self._log()
        if log is None:
            raise RuntimeError("refresh() before current()")
        return gift_snapshot(log, key=self.key, order=self.time_col)
