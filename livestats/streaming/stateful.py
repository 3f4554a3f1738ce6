"""Stateful stream operators: stay time (A7), first-seen (D2) and its
bounded-memory approximate form (D3).

Only these need per-key state that Spark's built-in aggregates cannot
express.  Each keeps O(1) state per key (a timestamp, a flag, or a bit array
per hash bucket) and sorts only the rows of one key within one micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import schemas
from ..functions.columns import event_time
from . import use_rocksdb

# ---- A7: effective audience (stay time) -------------------------------------

STAY_OUT = T.StructType([
    T.StructField("anchor_id", T.StringType()), T.StructField("room_id", T.StringType()),
    T.StructField("live_session", T.StringType()), T.StructField("ts_ms", T.LongType()),
    T.StructField("effective", T.LongType()), T.StructField("delta", T.LongType()),
])


class StayProcessor(StatefulProcessor):
    """Keyed by (anchor, room, visit).  State: the time of the pending enter and
    the events that the watermark has not passed yet.

    Events are held until the watermark passes them and are then settled in
    time order, so rows out of order within the delay give the same stays as
    the batch form.  A pending enter is settled by the session's next event
    (counts when the gap is >= stay) or by the watermark passing enter + stay
    (counts).  The online delta of a batch's rows leaves at once.
    """

    def __init__(self, stay_ms: int):
        self.stay_ms = int(stay_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        event = T.StructType([T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()),
                              T.StructField("enter", T.BooleanType())])
        self.pending = handle.getValueState("pending", T.StructType([T.StructField("ts", T.LongType())]))
        self.held = handle.getListState("held", event)

    def _out(self, key, ts, effective, delta):
        anchor, room, session = key
        return Row(anchor_id=anchor, room_id=room, live_session=session, ts_ms=ts, effective=effective, delta=delta)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        delta, last, new = 0, None, []
        for r in rows:
            enter = r["event_id"] == schemas.LIVE_ENTER
            delta += 1 if enter else -1
            if r["ts_ms"] is None:
                continue
            last = r["ts_ms"] if last is None else max(last, r["ts_ms"])
            new.append((r["ts_ms"], r["seq"], enter))
        for ts in {e[0] for e in new}:
            self.handle.registerTimer(ts)
        if new:
            self.held.appendList(new)
        yield self._out(key, last, 0, delta)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        pending = self.pending.get()[0] if self.pending.exists() else None
        held = sorted(tuple(e) for e in self.held.get()) if self.held.exists() else []
        counted, last = 0, None
        for ts, _seq, enter in [e for e in held if e[0] <= passed]:
            if pending is not None and ts - pending >= self.stay_ms:
                counted, last = counted + 1, pending
            pending = ts if enter else None
        if pending is not None and pending + self.stay_ms <= passed:
            counted, last, pending = counted + 1, pending, None
        rest = [e for e in held if e[0] > passed]
        if rest:
            self.held.put(rest)
        else:
            self.held.clear()
        if pending is None:
            self.pending.clear()
        else:
            self.pending.update((pending,))
            self.handle.registerTimer(pending + self.stay_ms)
        if counted:
            yield self._out(key, last, counted, 0)

    def close(self) -> None:
        pass


class StayClockProcessor(StatefulProcessor):
    """A7 by the clock (W6): keyed by (anchor, room, visit).  State: when the pending
    enter has stayed long enough; a processing-time timer fires then.

    Events count in the order of their sequence, when they arrive.  An enter
    sets the timer anew, a leave deletes it.  When the timer fires the stay is
    counted and the state is gone, so what is kept is the visits that are
    younger than ``stay_ms``.
    """

    def __init__(self, stay_ms: int):
        self.stay_ms = int(stay_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", T.StructType([T.StructField("at", T.LongType()),
                                                             T.StructField("ts", T.LongType())]))

    def _out(self, key, ts, effective, delta):
        anchor, room, session = key
        return Row(anchor_id=anchor, room_id=room, live_session=session, ts_ms=ts, effective=effective, delta=delta)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        events = sorted(((r["seq"] is None, r["seq"] or 0, r["event_id"] == schemas.LIVE_ENTER, r["ts_ms"]) for r in rows),
                        key=lambda e: e[:2])
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
            self.due.clear()
        if events[-1][2]:
            at = timerValues.getCurrentProcessingTimeInMs() + self.stay_ms
            self.due.update((at, events[-1][3]))
            self.handle.registerTimer(at)
        times = [e[3] for e in events if e[3] is not None]
        yield self._out(key, max(times, default=None), 0, sum(1 if e[2] else -1 for e in events))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.due.exists():
            return
        at, ts = self.due.get()
        if at <= expiredTimerInfo.getExpiryTimeInMs():
            self.due.clear()
            yield self._out(key, ts, 1, 0)

    def close(self) -> None:
        pass


def _visits(live: DataFrame) -> DataFrame:
    """An event without a session is a visit of its own."""
    if "record_id" not in live.columns:
        return live
    return live.withColumn("live_session", F.coalesce("live_session", F.concat(F.lit("record "), F.col("record_id"))))


def stay_clock_stream(live: DataFrame, stay_ms: int = 60_000) -> DataFrame:
    """A7 on a stream by the clock: a stay counts ``stay_ms`` after its enter has
    arrived, unless the visit has another event by then.  No event is late."""
    use_rocksdb(live.sparkSession)
    return (_visits(live).groupBy("anchor_id", "room_id", "live_session")
            .transformWithState(StayClockProcessor(stay_ms), STAY_OUT, "Append", "ProcessingTime"))


def stay_stream(live: DataFrame, stay_ms: int = 60_000, delay: str = "0 seconds") -> DataFrame:
    """A7 on a stream of live events (anchor_id, room_id, live_session,
    event_id, ts_ms, seq).  Output: settled stays and online deltas; the
    per-room totals are ``sum(effective)``, ``sum(delta)`` downstream.

    Rows further behind the watermark than ``delay`` are dropped and counted
    by Spark (``numRowsDroppedByWatermark`` in the progress).  An event without
    a session is a visit of its own, as in the batch form.
    """
    use_rocksdb(live.sparkSession)  # transformWithState needs the RocksDB state store
    src = live.withColumn("event_time", event_time("ts_ms")).withWatermark("event_time", delay)
    return (_visits(src).groupBy("anchor_id", "room_id", "live_session")
               .transformWithState(StayProcessor(stay_ms), STAY_OUT, "Append", "EventTime"))


# ---- D2: exact first-seen flag -------------------------------------------------

FIRST_OUT = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("device_id", T.StringType()),
    T.StructField("ts_ms", T.LongType()), T.StructField("is_n", T.IntegerType()),
])


def first_out(schema: T.StructType, carry: tuple[str, ...] = ()) -> T.StructType:
    """The output of the first-seen forms with ``carry`` columns of the input."""
    return T.StructType(FIRST_OUT.fields + [schema[c] for c in carry if c not in FIRST_OUT.fieldNames()])


def device_key(keys) -> Column:
    """One text for the key columns, in which a NULL differs from any value."""
    return F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]))


class FirstSeenProcessor(StatefulProcessor):
    """Keyed by device.  State: one boolean.  Flags the first event ever.

    ``names`` are the output columns; all but ``is_n`` come from the input, so
    the flag never has to be joined back to the events.  Rows with a NULL in
    ``order`` are flagged 0 and leave the state alone, as in the batch form.
    """

    def __init__(self, names, order: tuple[str, ...] = ("ts_ms", "seq")):
        self.names, self.order = list(names), tuple(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("v", T.BooleanType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # One pass, O(1) memory per key: every row leaves at once flagged 0,
        # except the earliest so far, which is held back and emitted last --
        # flagged 1 when the device was never seen before.
        seen = self.seen.exists()

        def out(r, flag):
            return Row(**{c: flag if c == "is_n" else r[c] for c in self.names})

        held, first = None, None
        for r in rows:
            at = tuple(r[c] for c in self.order)
            if None in at:
                yield out(r, 0)
            elif held is None:
                held, first = r, at
            elif at < first:
                yield out(held, 0)
                held, first = r, at
            else:
                yield out(r, 0)
        if held is not None:
            yield out(held, 0 if seen else 1)
            if not seen:
                self.seen.update((True,))

    def close(self) -> None:
        pass


def first_seen_stream(events: DataFrame, keys=("device_id",), carry: tuple[str, ...] = ()) -> DataFrame:
    """D2 (keys = device) or D1 (keys = device type, device) on a stream in one query:
    every event with ``is_n`` = 1 for its key's first event, plus ``carry``.

    All events of a device go through one task; ``firsts`` has the form in two
    stages, which only sends one candidate of a device and micro-batch there.
    """
    use_rocksdb(events.sparkSession)
    src = events if "device_id" in events.columns else events.withColumn("device_id", F.col(keys[-1]))
    out = first_out(src.schema, carry)
    names = out.fieldNames()
    rows = src.withColumn("_device", device_key(keys)).select("_device", "seq", *[c for c in names if c not in ("is_n", "seq")])
    return rows.groupBy("_device").transformWithState(FirstSeenProcessor(names), out, "Append", "None")


# ---- D3: bounded-memory approximate first-seen (Bloom filter per bucket) ---------

def bloom_size(capacity: int, fpp: float) -> tuple[int, int]:
    """Bits and hash count of a Bloom filter for ``capacity`` items at ``fpp``."""
    m = int(np.ceil(-capacity * np.log(fpp) / (np.log(2) ** 2)))
    k = max(1, int(round(m / capacity * np.log(2))))
    return m, k


class BloomProcessor(StatefulProcessor):
    """Keyed by a hash bucket of the device.  State: the bucket's bit array.

    Two 64-bit hashes per device are computed JVM-side; positions are
    ``h1 + i * h2`` (double hashing).  A device is flagged new when any of
    its bits is clear; a flagged device sets its bits, so it is never
    flagged twice.  A false positive (all bits set by others) leaves a new
    device unflagged -- the documented error of this form.
    """

    def __init__(self, bits: int, hashes: int):
        self.bits, self.hashes = int(bits), int(hashes)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("bits", T.StructType([T.StructField("b", T.BinaryType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Arrow chunks are handled one at a time (memory stays at one chunk,
        # even for a hot bucket); a device seen in an earlier chunk already
        # has its bits set, so it is never flagged twice.
        nbytes = (self.bits + 7) // 8
        arr = (np.frombuffer(self.state.get()[0], dtype=np.uint8).copy() if self.state.exists()
               else np.zeros(nbytes, dtype=np.uint8))
        i = np.arange(self.hashes, dtype=np.uint64)
        for pdf in rows:
            pdf = pdf.sort_values(["ts_ms", "seq"], kind="stable").reset_index(drop=True)
            # an event without a time or sequence is never first and leaves no trace
            timed = (pdf["ts_ms"].notna() & pdf["seq"].notna()).to_numpy()
            first_in_chunk = np.zeros(len(pdf), bool)
            first_in_chunk[timed] = ~pdf["device_id"][timed].duplicated().to_numpy()
            h1 = pdf["h1"].to_numpy(dtype=np.int64).astype(np.uint64)
            h2 = pdf["h2"].to_numpy(dtype=np.int64).astype(np.uint64) | np.uint64(1)
            pos = ((h1[:, None] + i[None, :] * h2[:, None]) % np.uint64(self.bits)).astype(np.int64)
            byte, bit = pos // 8, (pos % 8).astype(np.uint8)
            present = ((arr[byte] >> bit) & 1).astype(bool).all(axis=1)
            new = first_in_chunk & ~present
            np.bitwise_or.at(arr, byte[new].ravel(), (np.uint8(1) << bit[new].ravel()).astype(np.uint8))
            yield pd.DataFrame({"record_id": pdf["record_id"], "device_id": pdf["device_id"],
                                "ts_ms": pdf["ts_ms"].astype("Int64"), "is_n": new.astype(np.int32)})
        self.state.update((arr.tobytes(),))

    def close(self) -> None:
        pass


# Bloom capacities of the two first-seen forms (per device type; per task).
CAPACITY_PER_TYPE = 2_000_000
CAPACITY_PER_TASK = 500_000
# Filters that the devices are spread over (the largest number of busy tasks).
BUCKETS = 64


def approx_first_seen_stream(events: DataFrame, capacity: int = CAPACITY_PER_TASK, fpp: float = 0.01,
                             buckets: int = BUCKETS, keys=("device_id",)) -> DataFrame:
    """D3: approximate first-seen with bounded state: ``buckets`` Bloom
    filters (per value of the leading keys, e.g. device type, when ``keys``
    has more than one column), each sized for ``capacity / buckets`` devices.
    """
    use_rocksdb(events.sparkSession)
    keys = list(keys)
    device = F.col(keys[-1])
    ident = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys])
    bits, hashes = bloom_size(max(1, capacity // buckets), fpp)
    src = events.select("record_id", device.alias("device_id"), "ts_ms", "seq", *keys[:-1],
                        F.xxhash64(ident).alias("h1"),
                        F.xxhash64(F.concat(F.lit("#"), ident)).alias("h2"),
                        F.pmod(F.hash(ident), F.lit(buckets)).alias("bucket"))
    return src.groupBy(*keys[:-1], "bucket").transformWithStateInPandas(
        BloomProcessor(bits, hashes), FIRST_OUT, "Append", "None")
