"""Structured Streaming jobs over the wire log.

Every job reads the newline-JSON log: a segmented log by offsets (bounded per
trigger by ``maxOffsetsPerTrigger``), a plain folder with ``readStream.text``
(by ``maxFilesPerTrigger``), and writes through ``foreachBatch``.
Sinks are idempotent on ``batch_id``: a micro-batch replayed after a
failure overwrites its own output directory instead of appending twice,
and the commits table records each consumer's last batch, so a replayed
batch does not bump lease counters twice.  Spark's checkpoint gives exactly-once
input progress; restarting with the same checkpoint resumes after the last
committed micro-batch (S6).
"""

from __future__ import annotations

from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import codec, commit_log, commits, consume, offsets, publish
from tidemark.session import state_partitions
from tidemark.sources import segments
from tidemark.sources.batch_log import stream_batch_log, stream_offsets
from tidemark.sources.event_log import exists as _exists

EVENT_COLUMNS = ["event_type", "partition", "offset", "pos", "cursor_offset", "eid", "kind",
                 "occurred_at", "flow_id", "data_type", "data_op", "payload"]


START_SCHEMA = "event_type string, partition string, start_cursor string"


def _batch_dir(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id:012d}"


def decode_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split parsed lines: (valid messages, decoded events, quarantine)."""
    good = parsed.filter(F.col("valid")).drop("errors", "valid")
    msgs = codec.to_consumer_messages(good)
    events = codec.decode_event_fields(codec.explode_events(consume.drop_keep_alives(msgs)))
    first = F.col("errors")[0]
    bad = parsed.filter(~F.col("valid")).select(
        "event_type", "value", "errors",
        F.when(first["reason"] == codec.UNPARSEABLE, F.lit(codec.UNPARSEABLE))
        .otherwise(F.concat(first["path"], F.lit(": "), first["reason"])).alias("reason"))
    return msgs, events, bad


def consume_sink(out: str, on_batch: Callable[[DataFrame, DataFrame, int], None] | None = None,
                 start_cursors: DataFrame | None = None):
    """S1 sink: decoded events and quarantined lines, one directory per batch.

    ``start_cursors`` (event_type, partition, start_cursor) starts a fresh
    checkpoint of an existing consumer group after its committed (or an
    explicit) cursor: events at or before it are not delivered (S6).  They
    are resolved once, when the sink is made."""
    starts = None if start_cursors is None else consume.start_table(start_cursors)[0]

    def run(df: DataFrame, batch_id: int) -> None:
        # parse each micro-batch once; both outputs and the hook read the
        # parsed lines, of which only the quarantined keep their text
        parsed = codec.parse_batches(df).drop("_v").withColumn("value", F.when(~F.col("valid"), F.col("value")))
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            msgs, events, bad = decode_parsed(parsed)
            if starts is not None:
                events = consume.read_from_starts(events, starts).drop("start_offset")
            events.select(*EVENT_COLUMNS).write.mode("overwrite").parquet(_batch_dir(f"{out}/events", batch_id))
            bad.write.mode("overwrite").parquet(_batch_dir(f"{out}/quarantine", batch_id))
            if on_batch is not None:
                on_batch(msgs, events, batch_id)
        finally:
            parsed.unpersist()
    return run


def start(spark: SparkSession, src: str, checkpoint: str, sink, max_files: int = 16,
          available_now: bool = True, event_type: str | None = None, max_offsets: int = 0,
          cursors: DataFrame | None = None):
    """Start a consumer of ``src``: a segmented log is read by offsets (at most
    about ``max_offsets`` per micro-batch), a plain folder by files."""
    if segments.is_segmented(spark, src):
        lines = stream_offsets(spark, src, checkpoint, max_offsets, cursors, event_type)
    else:
        lines = stream_batch_log(spark, src, max_files_per_trigger=max_files, event_type=event_type)
    w = lines.select("event_type", "value").writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now and not segments.is_segmented(spark, src):
        w = w.trigger(availableNow=True)
    elif not available_now:
        w = w.trigger(processingTime="30 seconds")
    return w.start()


def run(spark: SparkSession, src: str, checkpoint: str, sink, **options) -> None:
    """Consume what ``src`` holds now, in as many micro-batches as the limits
    ask for, and stop.  (Spark serves an available-now trigger of a Python
    source in one micro-batch, so a segmented log is drained instead.)"""
    q = start(spark, src, checkpoint, sink, **options)
    if not segments.is_segmented(spark, src):
        q.awaitTermination()
        return
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def stream_events(spark: SparkSession, src: str, checkpoint: str, max_offsets: int = 0,
                  cursors: DataFrame | None = None) -> DataFrame:
    """The decoded events of a segmented log as a stream, in offset order per
    partition, after the cursors."""
    lines = stream_offsets(spark, src, checkpoint, max_offsets, cursors).select("event_type", "value")
    _, events, _ = decode_parsed(codec.parse_batches(lines).drop("_v"))
    return events if cursors is None else consume.read_from_starts(events, consume.start_table(cursors)[0])


def stream_consume(spark: SparkSession, src: str, out: str, max_files: int = 16,
                   start_cursors: DataFrame | None = None, max_offsets: int = 0) -> None:
    """Log -> decode / quarantine -> drop keep-alives -> events."""
    run(spark, src, f"{out}/_checkpoint", consume_sink(out, start_cursors=start_cursors), max_files=max_files,
        max_offsets=max_offsets, cursors=start_cursors)


def consume_for(spark: SparkSession, src: str, out: str, timeout_seconds: float,
                max_files: int = 16) -> None:
    """A9 on a live stream: the consumer runs with processing-time triggers
    and is closed ``timeout_seconds`` after it was opened."""
    q = start(spark, src, f"{out}/_checkpoint", consume_sink(out), max_files, available_now=False)
    try:
        q.awaitTermination(timeout_seconds)
    finally:
        q.stop()


def read_events(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/events")


def read_quarantine(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/quarantine")


# --------------------------------------------------------------------------- S2: commits

def commits_hook(table_root: str, group_id: str, holder: str, lease_id: str, now: str, writer: str | None = None):
    """After a micro-batch is processed, its high-water offsets become
    puts (D4/D5) - only those larger than the stored checkpoint, so files
    that land out of offset order never move a checkpoint back.

    ``writer`` names this consumer; its batch id is recorded with the
    versions of each (event type, group), so a replay bumps no counter
    twice.  Any number of consumers share the table: those of other groups
    or event types move other lines, those of the same pair retry."""
    def on_batch(msgs: DataFrame, events: DataFrame, batch_id: int) -> None:
        hw = offsets.high_water_offsets(consume.drop_keep_alives(msgs), "cursor_offset_long")
        puts = hw.select(F.lit(group_id).alias("group_id"), "event_type",
                         F.col("partition").alias("partition_id"),
                         F.col("high_water").cast("string").alias("checkpoint_id"),
                         F.lit(holder).alias("lease_holder"),
                         F.lit(None).cast("bigint").alias("lease_counter"),
                         (F.to_timestamp(F.lit(now)) + F.make_dt_interval(secs=F.lit(commits.STALE_LEASE_SECONDS)))
                         .alias("lease_timestamp"),
                         F.lit(lease_id).alias("lease_id"))
        commit_log.put(msgs.sparkSession, table_root, puts, writer=writer or f"{holder}/{lease_id}", batch=batch_id,
                       forward=True)
    return on_batch


def group_start(spark: SparkSession, out: str, table_root: str, group_id: str) -> DataFrame:
    """Where a consumer with checkpoint folder ``out`` began: the group's
    cursors in the commits table at that time.  Written on the first start
    and read on every restart, so a restarted consumer delivers nothing again."""
    path = f"{out}/_start"
    if not _exists(spark, f"{path}/_SUCCESS"):
        table = commit_log.read(spark, table_root, group_id=group_id)
        table.select("event_type", F.col("partition_id").alias("partition"), F.col("checkpoint_id").alias("start_cursor")) \
            .write.mode("overwrite").parquet(path)
    return spark.read.schema(START_SCHEMA).parquet(path)


def stream_consume_with_commits(spark: SparkSession, src: str, out: str, group_id: str = "s2",
                                holder: str = "worker-s", lease_id: str = "lease-s",
                                now: str = "2024-02-01 00:00:00", max_files: int = 16,
                                table_root: str | None = None, max_offsets: int = 0) -> str:
    """Consume, committing after each micro-batch.  ``table_root`` is the
    group's commits table (``out/commits`` by default): a consumer with a
    fresh ``out`` starts after the cursors the group has committed there."""
    table_root = table_root or f"{out}/commits"
    cursors = group_start(spark, out, table_root, group_id)
    hook = commits_hook(table_root, group_id, holder, lease_id, now, writer=out)
    run(spark, src, f"{out}/_checkpoint", consume_sink(out, hook, cursors), max_files=max_files,
        max_offsets=max_offsets, cursors=cursors)
    return table_root


# --------------------------------------------------------------------------- S3: live high water

def stream_high_water(spark: SparkSession, src: str, out: str, max_files: int = 16) -> None:
    """S3: running max cursor per partition as a stateful streaming
    aggregation (update mode); the state is one row per log partition."""
    lines = stream_batch_log(spark, src, max_files_per_trigger=max_files)
    msgs = codec.to_consumer_messages(codec.decode_batches(lines))
    hw = offsets.high_water_offsets(consume.drop_keep_alives(msgs), "cursor_offset_long")

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(_batch_dir(f"{out}/updates", batch_id))

    with state_partitions(spark):
        q = (hw.writeStream.outputMode("update").foreachBatch(sink)
             .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()


def read_high_water(spark: SparkSession, out: str) -> DataFrame:
    u = spark.read.parquet(f"{out}/updates")
    return u.groupBy("event_type", "partition").agg(F.max("high_water").alias("high_water"))


# --------------------------------------------------------------------------- S4: republish

def stream_republish(spark: SparkSession, src: str, out: str, source_type: str, target_type: str,
                     transform: Callable[[DataFrame], DataFrame], max_files: int = 16) -> None:
    """Consume one event type, map it, publish each source batch as one
    message (a JSON array) to the target event type.  Only the source type's
    directory is listed and read."""
    def sink(df: DataFrame, batch_id: int) -> None:
        _, events, _ = decode_parsed(codec.parse_batches(df))
        bodies = publish.batch_bodies(transform(events), target_type).select("event_type", F.col("body").alias("value"))
        bodies.write.mode("overwrite").partitionBy("event_type").text(_batch_dir(f"{out}/published", batch_id))

    run(spark, src, f"{out}/_checkpoint", sink, max_files=max_files, event_type=source_type)


def audit_transform(events: DataFrame) -> DataFrame:
    """Example user stage: an audit event per source event (new eid, the
    source eid as parent, same payload)."""
    new_eid = F.md5(F.concat(F.col("eid"), F.lit(":audit")))
    md = codec.metadata_struct(new_eid, F.col("occurred_at_text"), event_type=F.lit("purchase-audit"),
                               parent_eids=F.array(F.col("eid")), flow_id=F.col("flow_id"))
    return events.select("event_type", "partition", "offset", "cursor_offset",
                         codec.encode_event(F.col("kind"), md, F.col("payload"), F.col("data_type"),
                                            F.col("data_op")).alias("event_json"))


def read_published(spark: SparkSession, out: str) -> DataFrame:
    t = spark.read.text(f"{out}/published/*")
    ev = t.select(F.explode(F.from_json("value", "array<string>")).alias("e"))
    return ev.select(F.get_json_object("e", "$.metadata.eid").alias("new_eid"),
                     F.get_json_object("e", "$.metadata.parent_eids[0]").alias("parent_eid"))


# --------------------------------------------------------------------------- A16 live

def stream_publish_with_markers(spark: SparkSession, producer_src: str, schema, out: str,
                                target_type: str, max_files: int = 16) -> None:
    """A16 as a stream: producer rows (message_id, position, eid, flow_id,
    event_json, marker) land as files; each micro-batch first stores its
    messages, then appends the markers of exactly those messages.  A marker
    therefore never precedes its message, and a replayed batch rewrites the
    same two directories."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            bodies = publish.publish_messages(df, target_type)
            bodies.select("event_type", "message_id", "flow_id", "body").write.mode("overwrite") \
                .parquet(_batch_dir(f"{out}/messages", batch_id))
            (df.filter(F.col("position") == 0).select("message_id", "marker")
             .write.mode("overwrite").parquet(_batch_dir(f"{out}/markers", batch_id)))
        finally:
            df.unpersist()

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(producer_src)
         .writeStream.foreachBatch(sink).option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
