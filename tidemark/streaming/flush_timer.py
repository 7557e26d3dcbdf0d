"""The commit-flush timer as keyed streaming state with event-time timers.

Per partition key the state holds the open flush window (start, number of
accepted registrations, max offset).  The first accepted registration of a
window registers a timer at start + interval; when the watermark passes it,
the flush is emitted and the state cleared; the next registration re-arms.
Registrations that arrive in the same micro-batch past the window end close
it immediately, so the result is the C10 greedy timeline whatever the
trigger size.  A window whose timer has not fired when the stream ends is
never flushed - the reference's "no final flush on close" (C11).

State lives in the RocksDB state store, one small row per log partition.
"""

from __future__ import annotations

import sys
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues,
)

from tidemark.functions.datetime import format_offset_datetime
from tidemark.session import state_partitions

OUTPUT_SCHEMA = "event_type string, partition string, flush_ms long, n_registrations long, flushed_offset long"
STATE_SCHEMA = "start_ms long, n long, max_offset long"
BATCH_SCHEMA = ("event_type string, partition string, first_offset long, last_offset long, n_events long, "
                "closed_by string")
BATCH_STATE_SCHEMA = "start_ms long, n long, first_offset long, last_offset long, clock_ms long"


class FlushTimer(StatefulProcessor):
    def __init__(self, interval_ms: int):
        self.interval_ms = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", STATE_SCHEMA)

    def _flush(self, key, st) -> dict:
        return {"event_type": key[0], "partition": key[1], "flush_ms": int(st[0]) + self.interval_ms,
                "n_registrations": int(st[1]), "flushed_offset": int(st[2])}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values("arrival_seq")
        st = self.window.get() if self.window.exists() else None
        out = []
        for ts, off in zip(pdf["arrived_ms"].tolist(), pdf["offset"].tolist()):
            if st is not None and ts >= st[0] + self.interval_ms:
                out.append(self._flush(key, st))
                self.handle.deleteTimer(int(st[0]) + self.interval_ms)
                st = None
            if st is None:
                st = (int(ts), 0, -1)
                self.handle.registerTimer(int(ts) + self.interval_ms)
            st = (st[0], st[1] + 1, max(st[2], int(off)))
        self.window.update(st)
        yield pd.DataFrame(out, columns=["event_type", "partition", "flush_ms", "n_registrations",
                                         "flushed_offset"])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.window.exists():
            out.append(self._flush(key, self.window.get()))
            self.window.clear()
        yield pd.DataFrame(out, columns=["event_type", "partition", "flush_ms", "n_registrations",
                                         "flushed_offset"])

    def close(self) -> None:
        pass


def _in_order(rows: Iterator[pd.DataFrame], last_offset: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The key's rows of one micro-batch by offset, and those at or before
    the last offset already processed (late).  A micro-batch is bounded by
    its number of files, so a hot key holds at most that much of one task."""
    pdf = pd.concat(list(rows)).sort_values("offset")
    late = pdf["offset"] <= last_offset
    return pdf[~late], pdf[late]


class BatchWindow(StatefulProcessor):
    """A7 live: an open batch closes at ``max_rows`` events (emitted at once)
    or when the event-time timer at first event + timeout fires.

    Rows are taken in offset order, their clock is the running maximum of
    the event times (producers' clocks are not monotone in the offset).  A
    row below the last processed offset is emitted as ``late``.  The loop
    runs once per batch, not per row."""

    def __init__(self, max_rows: int, timeout_ms: int):
        self.max_rows, self.timeout_ms = max_rows, timeout_ms

    def _arm(self, start: int, timerValues: TimerValues) -> None:
        self.handle.registerTimer(start + self.timeout_ms)

    def _disarm(self, start: int) -> None:
        self.handle.deleteTimer(start + self.timeout_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.batch = handle.getValueState("batch", BATCH_STATE_SCHEMA)

    def _state(self) -> tuple:
        """(start_ms, n, first_offset, last_offset, clock_ms); n = 0: none open."""
        return tuple(self.batch.get()) if self.batch.exists() else (0, 0, -1, -1, -(1 << 62))

    @staticmethod
    def _frame(key, rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["first_offset", "last_offset", "n_events", "closed_by"])
        out.insert(0, "partition", key[1])
        out.insert(0, "event_type", key[0])
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        start, n, first, last, clock = self._state()
        pdf, late = _in_order(rows, last)
        out = [(int(o), int(o), 1, "late") for o in late["offset"]]
        off = pdf["offset"].to_numpy()
        ts = np.maximum(np.maximum.accumulate(pdf["ts_ms"].to_numpy()), clock) if len(pdf) else off
        armed, i = n > 0, 0
        while i < len(off):
            if n == 0:
                start, first = int(ts[i]), int(off[i])
            by_time = int(np.searchsorted(ts, start + self.timeout_ms, "left"))
            end = min(max(by_time, i), i + self.max_rows - n)
            if end > i:
                n, last = n + end - i, int(off[end - 1])
            if n >= self.max_rows or end < len(off):
                out.append((first, last, n, "count" if n >= self.max_rows else "time"))
                if armed:
                    self._disarm(start)
                armed, n = False, 0
            i = end
        if n > 0 and not armed:
            self._arm(start, timerValues)
        if len(off):
            self.batch.update((start, n, first, last, int(ts[-1])))
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, n, first, last, clock = self._state()
        out = []
        if n > 0:
            out.append((first, last, n, "time"))
            self.batch.update((start, 0, first, last, clock))
        yield self._frame(key, out)

    def close(self) -> None:
        pass


class OwnClock:
    """Timers of a partition that runs by its own clock: only its own rows
    move event time, so the progress of another partition closes nothing.  If
    ``idle_ms`` is set, a partition without new rows for that long (processing
    time) is settled by a timer; it is set anew with every micro-batch."""

    idle_ms: int | None = None

    def idle_after(self, idle_ms: int | None):
        self.idle_ms = idle_ms
        return self

    def _rearm(self, timerValues: TimerValues) -> None:
        if self.idle_ms is not None:
            self._stop_timers()
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def _stop_timers(self) -> None:
        if self.idle_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)


class OwnClockBatchWindow(OwnClock, BatchWindow):
    """A7 live by the partition's own clock: a batch closes at ``max_rows``
    events, or when an event of its partition comes ``timeout`` or more after
    the batch's first.  An idle partition's open batch closes as ``idle``."""

    def _arm(self, start: int, timerValues: TimerValues) -> None:
        self._rearm(timerValues)

    def _disarm(self, start: int) -> None:
        self._stop_timers()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        yield from BatchWindow.handleInputRows(self, key, rows, timerValues)
        if self._state()[1] > 0:
            self._rearm(timerValues)

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        for out in BatchWindow.handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            yield out.assign(closed_by="idle")


STALL_SCHEMA = "event_type string, partition string, offset long, last_us long, gap_us long, kind string"
STALL_STATE_SCHEMA = "offset long, last_us long"


class StallDetector(StatefulProcessor):
    """A13 live: no message for a partition within ``limit_us`` after its
    last one is a stall.  The timer behind last message + limit reports it
    (``open``) when the watermark passes with no newer message; the next
    message reports its length (``gap``), in the same or a later
    micro-batch, as the last message stays in the state.  Rows below the
    last processed offset are emitted as ``late``."""

    def __init__(self, limit_us: int):
        self.limit_us = limit_us

    def _timer_ms(self, last_us: int) -> int:
        return (last_us + self.limit_us) // 1000 + 1     # first ms past the limit

    def _arm(self, last_us: int, timerValues: TimerValues) -> None:
        self.handle.registerTimer(self._timer_ms(last_us))

    def _disarm(self, last_us: int) -> None:
        self.handle.deleteTimer(self._timer_ms(last_us))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STALL_STATE_SCHEMA)

    @staticmethod
    def _frame(key, offset, last_us, gap_us, kind) -> pd.DataFrame:
        out = pd.DataFrame({"offset": offset, "last_us": last_us}, dtype="int64")
        out["gap_us"] = pd.array(gap_us, dtype="Int64")
        out["kind"] = kind
        out.insert(0, "partition", key[1])
        out.insert(0, "event_type", key[0])
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = self.last.exists()
        seen, last = self.last.get() if known else (-1, 0)
        pdf, late = _in_order(rows, seen)
        if len(late):
            yield self._frame(key, late["offset"].to_numpy(), late["ts_us"].to_numpy(), [None] * len(late), "late")
        if not len(pdf):
            return
        off, ts = pdf["offset"].to_numpy(), pdf["ts_us"].to_numpy()
        if known:
            self._disarm(last)
            off, ts = np.r_[seen, off], np.r_[last, ts]
        gap = np.diff(ts)
        at = np.flatnonzero(gap > self.limit_us)
        self._arm(int(ts[-1]), timerValues)
        self.last.update((int(off[-1]), int(ts[-1])))
        yield self._frame(key, off[at], ts[at], gap[at], "gap")

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            off, last = self.last.get()
            yield self._frame(key, [off], [last], [None], "open")

    def close(self) -> None:
        pass


class OwnClockStallDetector(OwnClock, StallDetector):
    """A13 live by the partition's own clock: ``gap`` rows come with the
    partition's next message; ``open`` ones only from the idle rule."""

    def _arm(self, last_us: int, timerValues: TimerValues) -> None:
        self._rearm(timerValues)

    def _disarm(self, last_us: int) -> None:
        self._stop_timers()


def run_by_offset(events: DataFrame, ts: Column, processor: OwnClock, output: str, is_late: Column, out: str,
                  name: str, live_seconds: float | None = None) -> None:
    """Run an own-clock processor over decoded events (event_type, partition,
    offset, occurred_at) that a stream delivers in offset order: what is there
    now, in as many micro-batches as the source makes, or for ``live_seconds``
    (Spark starts micro-batches for processing-time timers without end, so the
    idle rule needs a live run).  Without a watermark; results do not depend
    on how the log is cut into files or micro-batches."""
    if processor.idle_ms is not None and live_seconds is None:
        raise ValueError("the idle rule needs live_seconds")
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    res = (events.select("event_type", "partition", "offset", ts).groupBy("event_type", "partition")
           .transformWithStateInPandas(processor, output, "Append", "None" if processor.idle_ms is None else "ProcessingTime"))
    with state_partitions(spark):
        q = (res.writeStream.foreachBatch(_results_sink(out, name, is_late))
             .option("checkpointLocation", f"{out}/_checkpoint").start())
    try:
        if live_seconds is None:
            q.processAllAvailable()
        else:
            q.awaitTermination(live_seconds)
    finally:
        q.stop()


def own_clock_batches(events: DataFrame, out: str, max_rows: int, timeout_seconds: int, idle_seconds: int | None = None,
                      live_seconds: float | None = None) -> None:
    """A7 as a stream, each partition by its own clock: ``out/batches``, ``out/late``."""
    run_by_offset(events, (F.unix_micros("occurred_at") / 1000).cast("long").alias("ts_ms"),
                  OwnClockBatchWindow(max_rows, timeout_seconds * 1000).idle_after(_ms(idle_seconds)), BATCH_SCHEMA,
                  F.col("closed_by") == "late", out, "batches", live_seconds)


def own_clock_stalls(events: DataFrame, out: str, flush_timeout_seconds: int, stall_factor: float = 1.5,
                     idle_seconds: int | None = None, live_seconds: float | None = None) -> None:
    """A13 as a stream, each partition by its own clock: ``out/stalls``, ``out/late``."""
    run_by_offset(events, F.unix_micros("occurred_at").alias("ts_us"),
                  OwnClockStallDetector(int(flush_timeout_seconds * stall_factor * 1_000_000)).idle_after(_ms(idle_seconds)),
                  STALL_SCHEMA, F.col("kind") == "late", out, "stalls", live_seconds)


def _ms(seconds: int | None) -> int | None:
    return None if seconds is None else seconds * 1000


def _results_sink(out: str, name: str, is_late: Column):
    def sink(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            for folder, rows in ((name, df.filter(~is_late)), ("late", df.filter(is_late))):
                rows.write.mode("overwrite").parquet(f"{out}/{folder}/batch_id={batch_id:012d}")
        finally:
            df.unpersist()
    return sink


def _run(spark: SparkSession, events_path: str, schema: StructType | str, ts: Column, processor, output: str,
         is_late: Column, out: str, name: str, max_files: int, watermark_delay: str) -> None:
    """Run a keyed processor over landed events (event_type, partition,
    offset, occurred_at): results under ``out/name``, late rows under
    ``out/late``, one directory per micro-batch.

    Timers follow the watermark, the latest event time of all partitions
    minus ``watermark_delay``: set it to how far files may land out of event
    time order.  The event-time column ends at the watermark, so Spark drops
    no row behind it; the processor decides by offset."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # The processor is also instantiated by a driver-side runner that does
    # not see files added with addPyFile: ship this small module by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(events_path)
           .withWatermark("occurred_at", watermark_delay)
           .select("event_type", "partition", "offset", ts))
    res = src.groupBy("event_type", "partition").transformWithStateInPandas(processor, output, "Append", "EventTime")

    with state_partitions(spark):
        q = (res.writeStream.foreachBatch(_results_sink(out, name, is_late))
             .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()


def stream_stalls(spark: SparkSession, events_path: str, schema: StructType | str, out: str,
                  flush_timeout_seconds: int, stall_factor: float = 1.5, max_files: int = 64,
                  watermark_delay: str = "0 seconds") -> None:
    """A13 as a stream: ``out/stalls`` and ``out/late``."""
    _run(spark, events_path, schema, F.unix_micros("occurred_at").alias("ts_us"),
         StallDetector(int(flush_timeout_seconds * stall_factor * 1_000_000)), STALL_SCHEMA,
         F.col("kind") == "late", out, "stalls", max_files, watermark_delay)


def stream_batches(spark: SparkSession, events_path: str, schema: StructType | str, out: str,
                   max_rows: int, timeout_seconds: int, max_files: int = 64,
                   watermark_delay: str = "0 seconds") -> None:
    """A7 as a stream: batches close at ``max_rows`` events or
    ``timeout_seconds`` after their first event (event time); ``out/batches``
    and ``out/late``."""
    _run(spark, events_path, schema, (F.unix_micros("occurred_at") / 1000).cast("long").alias("ts_ms"),
         BatchWindow(max_rows, timeout_seconds * 1000), BATCH_SCHEMA,
         F.col("closed_by") == "late", out, "batches", max_files, watermark_delay)


def stream_flush_timer(spark: SparkSession, registrations_path: str, schema: StructType | str, out: str,
                       interval_seconds: int) -> None:
    """Run S5 over accepted registrations landed as Parquet files
    (event_type, partition, offset, arrival_seq, arrived)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # The processor is also instantiated by a driver-side runner that does
    # not see files added with addPyFile: ship this small module by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 10_000).parquet(registrations_path)
           .withWatermark("arrived", "0 seconds")
           .withColumn("arrived_ms", (F.unix_micros("arrived") / 1000).cast("long")))
    flushes = (src.groupBy("event_type", "partition")
               .transformWithStateInPandas(FlushTimer(interval_seconds * 1000), OUTPUT_SCHEMA,
                                           "Append", "EventTime"))

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/flushes/batch_id={batch_id:012d}")

    with state_partitions(spark):
        q = (flushes.writeStream.foreachBatch(sink).option("checkpointLocation", f"{out}/_checkpoint")
             .trigger(availableNow=True).start())
    q.awaitTermination()


def read_flushes(spark: SparkSession, out: str) -> DataFrame:
    f = spark.read.parquet(f"{out}/flushes")
    flush_at = F.timestamp_micros(F.col("flush_ms") * 1000)
    return f.select("event_type", "partition", format_offset_datetime(flush_at).alias("flush_at"),
                    "n_registrations", "flushed_offset")
