"""Parsers P1-P5: text -> typed columns with Catalyst expressions only.

Unparsable input never stops a job: a text that is no JSON object is dropped
from the main output, counted as an observed metric where a name is given, and
can be landed separately with ``dead_letter=True``.

Scalars are read as text and converted leniently, as a mapper that coerces
does: ``"5"`` and ``5`` are the same number, a value that does not convert is
NULL and the rest of the row stays.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..schemas import CORRUPT_COL

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT_COL in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType())])


_SCALARS = (T.LongType, T.IntegerType, T.DoubleType, T.TimestampType)


def as_text(schema: T.StructType) -> T.StructType:
    """The schema with every number and time as text."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, _SCALARS) else f.dataType)
                         for f in schema.fields])


def json_struct(text: str | Column, schema: T.StructType) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.from_json(c, _with_corrupt(schema), _PERMISSIVE)


# Time texts with a zone of their own are instants; all others are wall times.
_ZONED = r"([Zz]|[+-][0-9]{2}:?[0-9]{2})$"


def lenient(value: Column, kind: T.DataType, time_zone: str = "UTC") -> Column:
    """A text value as ``kind``; NULL if it does not convert.

    Whole numbers may be written with a fraction (``"3.0"``), which is cut.
    Times are ISO texts with or without a fraction of seconds, ``T`` and zone,
    or epoch milliseconds; a text without a zone is wall time in ``time_zone``.
    """
    text = F.trim(value)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.coalesce(text.try_cast(kind), text.try_cast("decimal(38,6)").try_cast(kind))
    if isinstance(kind, T.TimestampType):
        day = F.when(F.length(text) <= 10, F.lit("T00:00:00Z")).otherwise(F.lit("Z"))
        wall = F.to_utc_timestamp(F.concat(text, day).try_cast("timestamp"), time_zone)
        instant = F.when(text.rlike(_ZONED), text.try_cast("timestamp")).otherwise(wall)
        return F.coalesce(F.when(text.rlike("^-?[0-9]{6,}$"), F.timestamp_millis(text.try_cast("bigint"))), instant)
    return text.try_cast(kind)


def _typed(value: Column, kind: T.DataType, time_zone: str = "UTC") -> Column:
    return lenient(value, kind, time_zone) if isinstance(kind, _SCALARS) else value


def _valid(parsed: Column, text: Column) -> Column:
    # Empty text parses to NULL; the literal text ``null`` and truncated or
    # non-object text land in the corrupt column.  All of them are invalid.
    return (parsed.isNotNull() & parsed[CORRUPT_COL].isNull()
            & (F.trim(text) != F.lit("null")))


def parse_events(df: DataFrame, text_col: str = "value", keep: tuple[str, ...] = (),
                 dead_letter: bool = False, metrics=None) -> DataFrame:
    """P1 (and P2 with ``keep=("record_id",)``): JSON event text -> model columns.

    ``keep`` columns of the input (such as the record id) are carried along.
    With ``dead_letter=True`` the invalid rows are returned instead, with the
    raw text, so that a caller can land them separately.  ``metrics`` (a name
    or an ``Observation``) counts the rows and the rejected ones.

    The validity test sits inside the generator (``inline`` of an array that
    is NULL for invalid rows) rather than in a ``where``: Catalyst would push
    a filter below the projection and parse every line once per reference.
    Here each line is parsed exactly once.
    """
    parsed = json_struct(text_col, as_text(schemas.EVENT_JSON))
    tmp = df.select(*keep, F.col(text_col).alias("_text"), parsed.alias("_e"))
    ok = _valid(F.col("_e"), F.col("_text"))
    if metrics is not None:
        tmp = counted(tmp, ok, metrics)
    if dead_letter:
        return tmp.select(*keep, F.inline(F.when(~F.coalesce(ok, F.lit(False)), F.array(
            F.struct(F.col("_text").alias(text_col))))))
    rows = tmp.select(*keep, F.inline(F.when(ok, F.array("_e"))))
    kinds = {f.name: f.dataType for f in schemas.EVENT_JSON.fields}
    fields = [_typed(F.col(w), kinds[w]).alias(m) for w, m in schemas.EVENT_COLUMNS.items()]
    out = rows.select(*keep, *fields)
    return out.withColumn("is_new", F.coalesce("is_new", F.lit(0))) \
              .withColumn("is_n", F.coalesce("is_n", F.lit(0)))


def counted(df: DataFrame, ok: Column, metrics) -> DataFrame:
    """Count rows and rejected rows as an observed metric."""
    return df.observe(metrics, F.sum((~F.coalesce(ok, F.lit(False))).cast("long")).alias("rejected"),
                      F.count(F.lit(1)).alias("rows"))


def parse_cdc(df: DataFrame, row_schema: T.StructType, text_col: str = "value",
              types=("INSERT", "UPDATE"), keep: tuple[str, ...] = (),
              time_zone: str = "UTC", dead_letter: bool = False, metrics=None) -> DataFrame:
    """P3/P4 + F7: change-capture envelope -> one row per ``data`` element.

    Only the change types in ``types`` pass; the type is kept as ``op_type``.
    Invalid envelopes and other types explode an empty (NULL) array, so the
    envelope is parsed once (see :func:`parse_events`).  With
    ``dead_letter=True`` the texts that are no envelope are returned instead;
    ``metrics`` counts them.
    """
    env = json_struct(text_col, schemas.cdc_envelope(as_text(row_schema)))
    tmp = df.select(*keep, F.col(text_col).alias("_text"), env.alias("_c"))
    valid = _valid(F.col("_c"), F.col("_text"))
    if metrics is not None:
        tmp = counted(tmp, valid, metrics)
    if dead_letter:
        return tmp.select(*keep, F.inline(F.when(~F.coalesce(valid, F.lit(False)), F.array(
            F.struct(F.col("_text").alias(text_col))))))
    ok = valid & F.coalesce(F.col("_c.type").isin(list(types)), F.lit(False))
    rows = tmp.select(*keep, F.col("_c.type").alias("op_type"),
                      F.explode(F.when(ok, F.col("_c.data"))).alias("_r"))
    return rows.select(*keep, *[_typed(F.col("_r")[f.name], f.dataType, time_zone).alias(f.name)
                                for f in row_schema.fields], "op_type")


def split_delimited(df: DataFrame, fields, text_col: str = "value", sep: str = ",",
                    keep: tuple[str, ...] = (), strict: bool = True, metrics=None) -> DataFrame:
    """P5: ``a,b,c`` -> typed columns.  ``fields`` is ``[(name, spark type), ...]``.

    ``sep`` is taken literally.  Values are trimmed and converted with
    ``try_cast``; with ``strict`` a line with too few fields or a failed
    conversion is dropped, and counted if ``metrics`` names an observed metric.
    """
    parts = F.split(F.col(text_col), re.escape(sep))
    cols = []
    for i, (name, typ) in enumerate(fields):
        raw = F.trim(F.get(parts, i))
        cols.append((raw if typ == "string" else raw.try_cast(typ)).alias(name))
    out = df.select(*keep, *cols, (F.size(parts) >= len(fields)).alias("_complete"))
    if strict:
        cond = F.col("_complete")
        for name, typ in fields:
            if typ != "string":
                cond = cond & F.col(name).isNotNull()
        if metrics is not None:
            out = counted(out, cond, metrics)
        out = out.where(cond)
    return out.drop("_complete")
