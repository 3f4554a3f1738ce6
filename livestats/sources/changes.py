"""S3 as a streaming source: the changes of a dimension table, polled by high-water mark.

``spark.dataSource.register(ChangesSource)`` and then
``spark.readStream.format("dimension_changes").option(...)`` give the rows of a
table that changed since the last batch.  The offset is the greatest update time
read, with the number of rows that have it: a change that commits later with the
mark's own time moves the offset too.  A batch reads from the mark on, so such a
change is not lost; rows at the mark can come twice, which a merge by id
(``DimensionSnapshot.merge``) takes without harm.

The changed rows of a batch are split by ranges of the id and read in parallel.
The table is a folder of parquet files (``path``; a change log that grows) or a
database table behind any DB-API module (``module``, ``connect``, ``table``).

Other options: ``columns`` (a schema text), ``id`` (an integer column, default
``id``), ``time`` (epoch milliseconds or a sortable text, default ``update_time``),
``partitions`` (default 4).  Rows without an update time never count as changed;
rows without an id are read by the first partition.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from contextlib import closing

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# The columns of the gift dimension.
GIFT_COLUMNS = "id int, name string, point double, deleted int, update_time bigint"


class IdRange(InputPartition):
    """Ids from ``lo`` to ``hi`` of the rows changed from ``start`` to ``end``; the first has those without an id."""

    def __init__(self, start, end, lo: int, hi: int, first: bool):
        self.start, self.end, self.lo, self.hi, self.first = start, end, lo, hi, first


class ParquetLog:
    """Changes in a folder of parquet files; filters and columns reach the files' row groups."""

    def __init__(self, options):
        self.path, self.id, self.time = options["path"], options.get("id", "id"), options.get("time", "update_time")

    def _batches(self, names: list[str], start=None, end=None, own=None):
        import pyarrow.dataset as ds
        data = ds.dataset(self.path, format="parquet")
        if not data.files:
            return
        wanted = ds.field(self.time).is_valid()
        if start is not None:
            wanted &= ds.field(self.time) >= start
        if end is not None:
            wanted &= ds.field(self.time) <= end
        if own is not None:
            lo, hi, first = own
            inside = (ds.field(self.id) >= lo) & (ds.field(self.id) <= hi)
            wanted &= (inside | ~ds.field(self.id).is_valid()) if first else inside
        yield from data.scanner(columns=names, filter=wanted).to_batches()

    def mark(self) -> tuple:
        mark, rows = None, 0
        for batch in self._batches([self.time]):
            times = batch.column(0).to_pylist()
            top = max(times, default=None)
            if top is not None and (mark is None or top > mark):
                mark, rows = top, 0
            rows += sum(t == mark for t in times)
        return mark, rows

    def id_range(self, start, end) -> tuple:
        lo, hi, rows = None, None, 0
        for batch in self._batches([self.id], start, end):
            ids = [i for i in batch.column(0).to_pylist() if i is not None]
            rows += batch.num_rows
            if ids:
                lo, hi = min([*ids, *([] if lo is None else [lo])]), max([*ids, *([] if hi is None else [hi])])
        return lo, hi, rows

    def rows(self, names: list[str], start, end, lo: int, hi: int, first: bool) -> Iterator[tuple]:
        for batch in self._batches(names, start, end, (lo, hi, first)):
            yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


class DbTable:
    """Changes in a database table, by queries that only bring the changed rows."""

    def __init__(self, options):
        self.module, self.connect, self.table = options["module"], options["connect"], options["table"]
        self.id, self.time = options.get("id", "id"), options.get("time", "update_time")

    def _rows(self, sql: str) -> Iterator[tuple]:
        with closing(importlib.import_module(self.module).connect(self.connect)) as connection:
            with closing(connection.cursor()) as cursor:
                cursor.execute(sql)
                while rows := cursor.fetchmany(10_000):
                    yield from rows

    @staticmethod
    def _value(mark) -> str:
        return str(mark) if isinstance(mark, int | float) else "'" + str(mark).replace("'", "''") + "'"

    def _changed(self, start, end) -> str:
        since = f" AND {self.time} >= {self._value(start)}" if start is not None else ""
        return f"{self.time} <= {self._value(end)}{since}"

    def mark(self) -> tuple:
        return next(self._rows(f"SELECT max({self.time}), count(*) FROM {self.table} "
                               f"WHERE {self.time} = (SELECT max({self.time}) FROM {self.table})"))

    def id_range(self, start, end) -> tuple:
        return next(self._rows(f"SELECT min({self.id}), max({self.id}), count(*) FROM {self.table} "
                               f"WHERE {self._changed(start, end)}"))

    def rows(self, names: list[str], start, end, lo: int, hi: int, first: bool) -> Iterator[tuple]:
        own = f"{self.id} BETWEEN {lo} AND {hi}" + (f" OR {self.id} IS NULL" if first else "")
        return self._rows(f"SELECT {', '.join(names)} FROM {self.table} WHERE {self._changed(start, end)} AND ({own})")


class ChangesReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options):
        self.names = schema.fieldNames()
        self.table = ParquetLog(options) if options.get("path") else DbTable(options)
        self.n = int(options.get("partitions", "4"))

    def initialOffset(self) -> dict:
        return {"mark": None, "rows": 0}

    def latestOffset(self) -> dict:
        mark, rows = self.table.mark()
        return {"mark": mark, "rows": rows}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        if end["mark"] is None:
            return []
        lo, hi, rows = self.table.id_range(start["mark"], end["mark"])
        if not rows:
            return []
        lo, hi = (0, 0) if lo is None else (lo, hi)
        n = min(self.n, hi - lo + 1)
        cuts = [lo + (hi - lo + 1) * i // n for i in range(n + 1)]
        return [IdRange(start["mark"], end["mark"], cuts[i], cuts[i + 1] - 1, i == 0) for i in range(n)]

    def read(self, partition: IdRange) -> Iterator[tuple]:
        p = partition
        yield from self.table.rows(self.names, p.start, p.end, p.lo, p.hi, p.first)

    def commit(self, end: dict) -> None:
        pass


class ChangesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dimension_changes"

    def schema(self) -> str:
        return self.options.get("columns", GIFT_COLUMNS)

    def streamReader(self, schema: StructType) -> ChangesReader:
        return ChangesReader(schema, self.options)


def read_changes(spark, **options):
    """The changes of a table as a stream (registers the source)."""
    spark.dataSource.register(ChangesSource)
    return spark.readStream.format("dimension_changes").options(**options).load()
