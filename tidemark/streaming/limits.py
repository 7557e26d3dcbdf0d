"""Live stream limits (A8, A10): quotas and keep-alive runs across micro-batches.

Each partition of an opened stream closes on its own: after ``stream_limit``
events from its start (A8), or after ``keep_alive_limit`` consecutive empty
batches (A10).  Both span micro-batches, so one row per log partition goes
from batch to batch: the last cursor, the empty batches seen at it, and the
cursor at which the partition closed.  The state of a micro-batch is a small
table of its own, worked out from its predecessor's; a replayed batch works
out the same table again.

A keep-alive carries the cursor of the last delivered batch, so a run of
empty batches is a count per cursor: grouped aggregates, no ordering.
"""

from __future__ import annotations

import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import codec, consume
from tidemark.plans.joins import broadcast_if_small
from tidemark.sources import segments
from tidemark.streaming import consume as streams

KEYS = consume.KEYS
STATE_SCHEMA = ("event_type string, partition string, cursor bigint, empty_run bigint, closed_at bigint, "
                "start_offset bigint, done boolean")


def advance(msgs: DataFrame, state: DataFrame, starts: DataFrame | None, stream_limit: int,
            keep_alive_limit: int) -> DataFrame:
    """The state after a micro-batch.  ``msgs``: event_type, partition,
    cursor_offset_long, n_events; keep-alives before a partition's first
    event (no offset yet) count at cursor -1."""
    runs = msgs.select(*KEYS, F.coalesce("cursor_offset_long", F.lit(-1)).alias("cursor"),
                       (F.col("n_events") == 0).cast("bigint").alias("empty_run"))
    runs = (runs.unionByName(state.select(*KEYS, "cursor", "empty_run"))
            .groupBy(*KEYS, "cursor").agg(F.sum("empty_run").alias("empty_run")))
    closing = F.when(F.col("empty_run") >= keep_alive_limit, F.col("cursor")) if keep_alive_limit > 0 \
        else F.lit(None).cast("bigint")
    now = runs.groupBy(*KEYS).agg(F.max("cursor").alias("cursor"), F.max_by("empty_run", "cursor").alias("empty_run"),
                                  F.min(closing).alias("_closing"))
    now = now.join(state.select(*KEYS, "closed_at", F.col("start_offset").alias("_start")), KEYS, "left")
    if starts is None:
        now = now.withColumn("_first", F.lit(0).cast("bigint"))
    else:
        now = now.join(starts.withColumnRenamed("_start", "_first"), KEYS, "left")
    start = F.coalesce("_start", "_first", F.lit(0).cast("bigint"))
    closed = F.coalesce("closed_at", "_closing")
    full = F.col("cursor") >= start + stream_limit - 1 if stream_limit > 0 else F.lit(False)
    return now.select(*KEYS, "cursor", "empty_run", closed.alias("closed_at"), start.alias("start_offset"),
                      (closed.isNotNull() | full).alias("done"))


def deliver(events: DataFrame, state: DataFrame, stream_limit: int, offset: str = "offset") -> DataFrame:
    """Rows (of events, or of batches by their cursor) that the partition's
    limits let through."""
    s = broadcast_if_small(state.select(*KEYS, "closed_at", F.col("start_offset").alias("_from")))
    keep = F.col("closed_at").isNull() | (F.col(offset) <= F.col("closed_at"))
    if stream_limit > 0:
        keep = keep & (F.col(offset) - F.col("_from") < stream_limit)
    return events.join(s, KEYS, "left").filter(keep).drop("closed_at", "_from")


def limited_sink(spark: SparkSession, out: str, stream_limit: int, keep_alive_limit: int, stop: threading.Event,
                 cursors: DataFrame | None = None, partitions: int | None = None):
    """Decoded events, delivered batches and quarantined lines within the
    limits, one directory per micro-batch.  ``stop`` is set when all of
    ``partitions`` partitions are closed."""
    starts = None if cursors is None else consume.start_table(cursors)[0]

    def run(df: DataFrame, batch_id: int) -> None:
        path = f"{out}/limits"
        state = spark.createDataFrame([], STATE_SCHEMA) if batch_id == 0 else \
            spark.read.schema(STATE_SCHEMA).parquet(streams._batch_dir(path, batch_id - 1))
        parsed = codec.parse_batches(df).drop("_v").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            msgs, events, bad = streams.decode_parsed(parsed)
            if starts is not None:
                # a cursor inside a batch leaves the batch's later events
                events = consume.read_from_starts(events, starts).drop("start_offset")
                msgs = msgs.join(starts, KEYS, "left").filter(
                    F.col("cursor_offset_long").isNull() | (F.col("cursor_offset_long") >= F.coalesce("_start", F.lit(0)))
                    | (F.col("n_events") == 0)).drop("_start")
            seen = Observation()
            advance(msgs, state, starts, stream_limit, keep_alive_limit).coalesce(1) \
                .observe(seen, F.count_if("done").alias("closed")) \
                .write.mode("overwrite").parquet(streams._batch_dir(path, batch_id))
            state = spark.read.schema(STATE_SCHEMA).parquet(streams._batch_dir(path, batch_id))
            deliver(events, state, stream_limit).select(*streams.EVENT_COLUMNS) \
                .write.mode("overwrite").parquet(streams._batch_dir(f"{out}/events", batch_id))
            batches = consume.drop_keep_alives(msgs).select(*KEYS, "cursor_offset_long", "n_events")
            deliver(batches, state, 0, "cursor_offset_long") \
                .write.mode("overwrite").parquet(streams._batch_dir(f"{out}/batches", batch_id))
            bad.write.mode("overwrite").parquet(streams._batch_dir(f"{out}/quarantine", batch_id))
            if partitions is not None and seen.get["closed"] >= partitions:
                stop.set()
        finally:
            parsed.unpersist()
    return run


def consume_limited(spark: SparkSession, src: str, out: str, stream_limit: int = 0, keep_alive_limit: int = 0,
                    cursors: DataFrame | None = None, partitions: int | None = None, max_offsets: int = 0,
                    max_files: int = 16, live_seconds: float | None = None) -> None:
    """A8 and A10 on a live stream: what is there now, or for
    ``live_seconds``; ends early once all of ``partitions`` partitions have
    closed.  A restart on the same ``out`` goes on with its state.

    The quota counts offsets from the start, as A8 does: events of a
    quarantined batch count."""
    stop = threading.Event()
    sink = limited_sink(spark, out, stream_limit, keep_alive_limit, stop, cursors, partitions)
    q = streams.start(spark, src, f"{out}/_checkpoint", sink, max_files=max_files, max_offsets=max_offsets,
                      cursors=cursors, available_now=live_seconds is None)
    drained = live_seconds is None and segments.is_segmented(spark, src)

    def stop_when_closed() -> None:
        while q.isActive:
            if stop.wait(0.2):
                q.stop()

    watcher = threading.Thread(target=stop_when_closed, daemon=True)
    watcher.start()
    try:
        if drained:
            q.processAllAvailable()
        elif live_seconds is None:
            q.awaitTermination()
        else:
            q.awaitTermination(live_seconds)
    finally:
        q.stop()
        watcher.join()


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/batches")
