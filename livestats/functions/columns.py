"""Predicates (F1-F4) and scalar projections (M1-M3, M7) as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- time -----------------------------------------------------------------

# Session zones in which a cast TIMESTAMP_NTZ -> TIMESTAMP is the identity.
_UTC_ZONES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UCT", "Universal", "Zulu", "Etc/Universal"}


def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in _UTC_ZONES


def epoch_us_sql(c: str) -> str:
    """SQL of :func:`epoch_us_from_ntz` for a column name."""
    if _session_is_utc():
        return f"unix_micros(cast({c} as timestamp))"
    return (f"(cast(datediff(to_date({c}), DATE'1970-01-01') as bigint) * 86400000000"
            f" + cast(hour({c}) as bigint) * 3600000000 + cast(minute({c}) as bigint) * 60000000"
            f" + cast(date_part('SECOND', {c}) * 1000000 as bigint))")


def epoch_ms_sql(c: str, rounding: str = "floor") -> str:
    """SQL of :func:`epoch_ms_from_ntz` for a column name."""
    us = epoch_us_sql(c)
    if rounding == "floor":
        return f"(({us}) - pmod({us}, 1000)) div 1000"
    if rounding != "nearest":
        raise ValueError(f"unknown rounding {rounding!r}")
    return f"CASE WHEN ({us}) < 0 THEN -((abs({us}) + 500) div 1000) ELSE (({us}) + 500) div 1000 END"


def epoch_us_from_ntz(c: str) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ column read as UTC wall time.

    In a UTC session (the library's default) this is a plain cast.  In any
    other zone the value is built from the zone-free date and time fields,
    since a cast to TIMESTAMP would shift it by the zone's offset (DST
    included); that form costs about three times as much per row.
    """
    return F.expr(epoch_us_sql(c))


def epoch_ms_from_ntz(c: str, rounding: str = "floor") -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ column read as UTC wall time.

    ``rounding="floor"`` drops the sub-millisecond digits; ``"nearest"``
    rounds half away from zero (the rule of the warehouse the feeds are
    checked against).  Exact integer arithmetic either way.
    """
    return F.expr(epoch_ms_sql(c, rounding))


def event_time(ms: str | Column = "ts_ms") -> Column:
    """Epoch ms -> TIMESTAMP (an instant), the type ``window``/watermarks need."""
    return F.timestamp_millis(col(ms))


def window_bounds_ms(window_col: str | Column = "window") -> tuple[Column, Column]:
    """M7: window struct -> (start ms, end ms)."""
    w = col(window_col)
    return F.unix_millis(w["start"]), F.unix_millis(w["end"])


def floor_to(ms: str | Column, size_ms: int) -> Column:
    """Start of the epoch-aligned bucket of ``size_ms`` holding ``ms`` (exact, long)."""
    m = col(ms)
    return m - F.pmod(m, F.lit(int(size_ms)))


def local_ms(ms: str | Column, zone: str = "UTC") -> Column:
    """Epoch ms shifted by ``zone``'s offset at that instant (wall-clock ms).

    ``from_utc_timestamp`` converts between UTC and ``zone`` only, so the
    result never depends on the session zone.
    """
    if zone == "UTC":
        return col(ms)
    return F.unix_millis(F.from_utc_timestamp(event_time(ms), zone))


def date_part(ms: str | Column, zone: str = "UTC") -> Column:
    """M3: ``yyyyMMdd`` of an epoch-ms time in ``zone``.

    Built by arithmetic on the wall-clock milliseconds: formatting a
    TIMESTAMP_NTZ goes through the session zone and shifts wall times that
    do not exist there (a midnight DST start would print 01:00).
    """
    lm = local_ms(ms, zone)
    day = ((lm - F.pmod(lm, F.lit(86_400_000))) / F.lit(86_400_000)).cast("int")
    return F.regexp_replace(F.date_add(F.lit("1970-01-01").cast("date"), day).cast("string"), "-", "")


def hour_part(ms: str | Column, zone: str = "UTC") -> Column:
    """M3: ``HH`` of an epoch-ms time in ``zone`` (arithmetic, zone-free)."""
    lm = local_ms(ms, zone)
    h = (F.pmod(lm, F.lit(86_400_000)) / F.lit(3_600_000)).cast("int")
    return F.lpad(h.cast("string"), 2, "0")


def ntz_text(c: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ, from its zone-free fields."""
    t = col(c)

    def two(x):
        return F.lpad(x.cast("string"), 2, "0")
    return F.concat(F.to_date(t).cast("string"), F.lit(" "), two(F.hour(t)), F.lit(":"),
                    two(F.minute(t)), F.lit(":"), two(F.second(t)))


# ---- properties (M1) --------------------------------------------------------

def prop(key: str, props: str = "properties", df=None) -> Column:
    """M1: one value of the event's property map (string, NULL if absent).

    When ``df`` already carries the property as a flat column (feeds that were
    flattened upstream), that column is used and the map is never built.
    """
    if df is not None and key in df.columns:
        return F.col(key)
    return F.col(props).getItem(key)


def with_props(df, keys, props: str = "properties", casts: dict | None = None):
    """M1: add one column per property key; ``casts`` maps key -> type (try_cast)."""
    casts = casts or {}
    out = df
    for k in keys:
        c = prop(k, props, df)
        if k in casts:
            c = c.try_cast(casts[k])
        out = out.withColumn(k, c)
    return out


# ---- composite keys (M2) ----------------------------------------------------

def composite_key(*cols: str | Column, sep: str = "-") -> Column:
    """M2: ``a-b`` where a NULL part prints as ``null`` (string concatenation rule)."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("null")) for c in cols])


# ---- predicates (F1-F4) -----------------------------------------------------

def event_is(name: str, c: str = "event_name") -> Column:
    """a NULL event name is no match (a filter drops it), and the plain
    comparison can be pushed into the scan."""
    return F.col(c) == F.lit(name)


def event_in(names, c: str = "event_name") -> Column:
    """F2."""
    return F.col(c).isin(list(names))


def event_has_prefix(prefix: str = schemas.PRODUCT_PREFIX, c: str = "event_name") -> Column:
    """rows with a NULL name are dropped."""
    return F.col(c).startswith(prefix)


def line_without(word: str, c: str = "value") -> Column:
    """the line does not contain ``word``."""
    return ~F.col(c).contains(word)


def drop_incomplete(df, cols, metrics=None):
    """Drop rows with a NULL in any of ``cols``; with ``metrics`` (a name or a
    ``pyspark.sql.Observation``), count them as observed metric ``dropped``.

    A missing key would stop the original job; here one bad row is dropped
    and shows up in the query's observed metrics (batch: ``Observation.get``;
    stream: ``lastProgress.observedMetrics``) instead.
    """
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    if metrics is not None:
        df = df.observe(metrics, F.sum(missing.cast("long")).alias("dropped"),
                        F.count(F.lit(1)).alias("rows"))
    return df.where(~missing)
