"""User-level entry points: what a consumer with given settings receives,
and publishing, as batch replays over a log table.

``consume`` composes the operators in the order the service applies them:
start cursor (explicit, committed or start of stream) -> events after it ->
stream limits -> batches (count, or count-or-time when a flush timeout is
set).  Live streaming lives in :mod:`tidemark.streaming`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import consume as ops
from tidemark.operators import publish as pub
from tidemark.plans.greedy import greedy_windows
from tidemark.settings import ConsumerSettings, ProducerSettings

KEYS = ["event_type", "partition"]


def start_cursors(log: DataFrame, settings: ConsumerSettings, commits: DataFrame | None = None,
                  partitions: DataFrame | None = None) -> DataFrame:
    """A3 for one consumer: per partition of its event type, the explicit
    offset of the settings, else the group's committed checkpoint."""
    parts = partitions if partitions is not None else log.select(*KEYS).distinct()
    req = (parts.filter(F.col("event_type") == settings.event_type)
           .select(F.lit(settings.group_id).alias("group_id"), *KEYS,
                   F.lit(settings.offset).cast("string").alias("explicit_offset")))
    if commits is None:
        commits = log.sparkSession.createDataFrame(
            [], "group_id string, event_type string, partition_id string, checkpoint_id string")
    return ops.resolve_start_cursor(req, commits)


def consume(log: DataFrame, settings: ConsumerSettings, commits: DataFrame | None = None,
            partitions: DataFrame | None = None, opened_at: str | None = None) -> DataFrame:
    """Batches a consumer would receive: event_type, partition, batch cursor,
    first offset, number of events.  ``opened_at`` applies the stream
    timeout relative to the time the stream was opened."""
    events = log.filter(F.col("event_type") == settings.event_type)
    cursors = start_cursors(log, settings, commits, partitions)
    ev = ops.read_from_cursor(events, cursors, event_types=[settings.event_type])
    ev = ops.limit_stream(ev, settings.stream_limit)
    if opened_at is not None:
        ev = ops.limit_stream_by_time(ev, opened_at, settings.stream_timeout_seconds)
    if settings.batch_flush_timeout_seconds > 0 and settings.batch_limit > 0:
        w = greedy_windows(ev, KEYS, "offset", "occurred_at", max_rows=settings.batch_limit,
                           max_seconds=settings.batch_flush_timeout_seconds)
        return w.select(*KEYS, F.col("last_offset").alias("batch_cursor"), "first_offset", "n_events")
    return ops.batch_by_count(ev, settings.batch_limit).select(*KEYS, "batch_cursor", "first_offset", "n_events")


def publish(spark: SparkSession, events: DataFrame, settings: ProducerSettings, path: str) -> DataFrame:
    """Group producer rows (message_id, position, eid, flow_id,
    event_json) into one JSON array body per message and store them under
    the target event type; returns the messages this call stored."""
    run = uuid.uuid4().hex
    pub.write_messages(pub.publish_messages(events, settings.event_type), path, run, settings.run_timeout_seconds)
    return pub.read_messages(spark, path, run, settings.event_type)
