"""Cursor-bounded reads, batching and stream limits.

All operators take the log as a DataFrame with (event_type, partition,
offset) and work on every partition at once.  Offsets of a log partition
are dense (the log assigns them consecutively), so "the n-th event after a
cursor" is arithmetic on the offset: batching and count limits need no
per-partition window.  Gap detection uses offset-range chunks.  No log
partition ever has to fit in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.offsets import BEGIN, require_offset
from tidemark.plans.joins import broadcast_if_small, collect_small
from tidemark.plans.numbering import chunked_lag, offset_chunk
from tidemark.settings import STALL_FACTOR

KEYS = ["event_type", "partition"]


def cursor_start(cursor_text: Column) -> Column:
    """First offset delivered after a cursor: ``BEGIN`` -> 0 (symbolic),
    ``n`` -> n + 1, no cursor -> 0.  ``BEGIN`` and ``0`` are different here
    although both convert to 0 as numbers.  Any other text fails the query:
    reading it as "no cursor" would deliver the partition again."""
    return (F.when(cursor_text.isNull(), F.lit(0))
            .when(cursor_text == F.lit(BEGIN), F.lit(0))
            .otherwise(require_offset(cursor_text) + 1)).cast("bigint")


def resolve_start_cursor(requests: DataFrame, commits: DataFrame) -> DataFrame:
    """A3: per (group, event type, partition): explicit offset, else the
    committed checkpoint, else no cursor (start of stream).

    ``requests``: group_id, event_type, partition, explicit_offset (nullable)
    ``commits``:  group_id, event_type, partition_id, checkpoint_id
    """
    c = commits.select("group_id", "event_type", F.col("partition_id").alias("partition"),
                       F.col("checkpoint_id").alias("_committed"))
    j = requests.join(broadcast_if_small(c), ["group_id", "event_type", "partition"], "left")
    return j.select("group_id", "event_type", "partition",
                    F.coalesce("explicit_offset", "_committed").alias("start_cursor"),
                    F.when(F.col("explicit_offset").isNotNull(), "explicit")
                    .when(F.col("_committed").isNotNull(), "committed")
                    .otherwise("none").alias("cursor_source"))


def start_table(cursors: DataFrame, cursor_col: str = "start_cursor") -> tuple[DataFrame, list | None]:
    """The first offset per (event_type, partition) of ``cursors``, and its
    rows when their number is within the broadcast bound (else None).  A
    job that reads many times (a stream) builds it once."""
    c = cursors.select(*KEYS, cursor_start(F.col(cursor_col)).alias("_start"))
    rows = collect_small(c)
    if rows is not None:
        c = F.broadcast(c.sparkSession.createDataFrame(rows, c.schema))
    return c, rows


def read_from_cursor(log: DataFrame, cursors: DataFrame, cursor_col: str = "start_cursor",
                     event_types: list[str] | None = None) -> DataFrame:
    """A4/A5: events strictly after each partition's cursor; partitions
    without a cursor row (or with a null cursor) start at offset 0; a cursor
    that cannot be read fails the query.

    ``cursors`` has one row per (event_type, partition).  The join applies
    the exact start.  The cursor side is broadcast only when its row count
    is proven small, so a partition holding a third of the log is not
    shuffled; beyond the bound it is a shuffle join with the same rows.

    ``event_types`` names the event types ``log`` holds.  With them it is
    known for which partition ids every pair has a cursor, and a filter on
    (partition, offset) for those ids reaches the Parquet scan, where the
    offset statistics skip row groups before the cursor."""
    return read_from_starts(log, *start_table(cursors, cursor_col), event_types=event_types)


def read_from_starts(log: DataFrame, starts: DataFrame, rows: list | None = None,
                     event_types: list[str] | None = None) -> DataFrame:
    """:func:`read_from_cursor` with a prepared :func:`start_table`."""
    if rows and event_types:
        log = log.filter(cursor_scan_predicate(rows, event_types))
    j = log.join(starts, KEYS, "left")
    return j.filter(F.col("offset") >= F.coalesce(F.col("_start"), F.lit(0))) \
        .withColumn("start_offset", F.coalesce(F.col("_start"), F.lit(0).cast("bigint"))).drop("_start")


# The scan filter holds at most this many starts and partition ids; it only
# skips rows the join would drop, so leaving ids out of it changes no result.
SCAN_STARTS, SCAN_PARTITIONS = 16, 2_000


def cursor_scan_predicate(rows: list, event_types: list[str]) -> Column:
    """A superset filter on data columns only (pushable to Parquet): partition
    ids that have a cursor for every one of ``event_types`` drop the offsets
    below the smallest of those starts.  Starts are rounded down to at most
    ``SCAN_STARTS`` values, each one flat condition ``partition NOT IN (...)
    OR offset >= start``."""
    start = {(r["event_type"], r["partition"]): r["_start"] for r in rows}
    low = {p: min(start.get((e, p), 0) for e in event_types) for p in {p for _, p in start if p is not None}}
    best = sorted(((s, p) for p, s in low.items() if s > 0), reverse=True)[:SCAN_PARTITIONS]
    pred, step = F.lit(True), -(-len(best) // SCAN_STARTS) or 1
    for k in range(0, len(best), step):
        group = best[k:k + step]
        pred = pred & (F.col("partition").isNull() | ~F.col("partition").isin([p for _, p in group])
                       | (F.col("offset") >= F.lit(group[-1][0])))
    return pred


def partition_summary(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per-partition delivered count, first and last offset (partial +
    final aggregate)."""
    keys = keys or KEYS
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events"),
                                     F.min("offset").alias("first_offset"),
                                     F.max("offset").alias("last_offset"))


def batch_by_count(events: DataFrame, batch_limit: int) -> DataFrame:
    """Consecutive events of a partition grouped n at a time from the
    start offset; the batch cursor is the offset of its last event.
    ``batch_limit = 0`` means the service default, one event per batch.

    Input needs ``start_offset`` (from :func:`read_from_cursor`)."""
    n = batch_limit if batch_limit > 0 else 1
    b = events.withColumn("batch_no", F.floor((F.col("offset") - F.col("start_offset")) / n)
                          .cast("bigint"))
    return (b.groupBy(*KEYS, "batch_no")
            .agg(F.max("offset").alias("batch_cursor"), F.min("offset").alias("first_offset"),
                 F.count(F.lit(1)).alias("n_events"))
            .withColumn("is_full", F.col("n_events") == n))


def limit_stream(events: DataFrame, stream_limit: int) -> DataFrame:
    """At most n events per opened stream (per partition); 0 = no limit."""
    if stream_limit <= 0:
        return events
    return events.filter(F.col("offset") - F.col("start_offset") < stream_limit)


def limit_stream_by_time(events: DataFrame, opened_at: str, timeout_seconds: int,
                         ts: str = "occurred_at") -> DataFrame:
    """The stream closes ``timeout_seconds`` after it was opened; in a
    replay that keeps events that occurred before open + timeout."""
    if timeout_seconds <= 0:
        return events
    close = F.to_timestamp(F.lit(opened_at)) + F.make_dt_interval(secs=F.lit(timeout_seconds))
    return events.filter(F.col(ts) < close)


def close_on_keep_alives(batches: DataFrame, keep_alive_limit: int) -> DataFrame:
    """A10: after n consecutive empty batches the stream closes.

    A keep-alive carries the cursor of the last delivered batch (the cursor
    only moves with events), so a run of consecutive empty batches is the
    set of empty batches sharing one cursor.  Run lengths are a grouped
    count, the closing cursor a grouped min: no ordering window.  The
    per-partition closing table is size-checked and broadcast, so the
    batches are never shuffled by partition key.  ``batches`` (event_type,
    partition, cursor_offset_long, n_events) is read twice: pass a
    materialised table."""
    nonempty = batches.filter(F.col("n_events") > 0)
    if keep_alive_limit <= 0:
        return nonempty
    runs = (batches.filter(F.col("n_events") == 0)
            .groupBy(*KEYS, "cursor_offset_long").agg(F.count(F.lit(1)).alias("_run"))
            .filter(F.col("_run") >= keep_alive_limit)
            .groupBy(*KEYS).agg(F.min("cursor_offset_long").alias("_close_at")))
    j = nonempty.join(broadcast_if_small(runs), KEYS, "left")
    return j.filter(F.col("_close_at").isNull() | (F.col("cursor_offset_long") <= F.col("_close_at"))) \
        .drop("_close_at")


def drop_keep_alives(messages: DataFrame) -> DataFrame:
    """Empty batches are acknowledged, not delivered."""
    return messages.filter(F.col("n_events") > 0)


def detect_stalled_partitions(log: DataFrame, flush_timeout_seconds: int,
                              ts: str = "occurred_at", rows_per_chunk: int = 1 << 20) -> DataFrame:
    """Gaps between consecutive events of a partition above 1.5 x the
    flush timeout (the point where a consumer would raise a timeout).

    The previous event's time is a chunked ``lag`` (offset-range chunks):
    one shuffle of the narrow (key, offset, time) projection plus a
    one-row-per-chunk table, instead of a per-partition window or a
    self-join that shuffles the log twice."""
    limit_us = int(flush_timeout_seconds * STALL_FACTOR * 1_000_000)
    cur = log.select(*KEYS, "offset", F.unix_micros(F.col(ts)).alias("_t"))
    gaps = chunked_lag(cur, KEYS, "offset", "_t", offset_chunk("offset", rows_per_chunk), "_prev_t") \
        .withColumn("gap_us", F.col("_t") - F.col("_prev_t"))
    return (gaps.filter(F.col("gap_us") > limit_us)
            .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_stalls"),
                                F.floor(F.max("gap_us") / 1_000_000).cast("bigint").alias("max_gap_seconds")))
