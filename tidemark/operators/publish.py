"""Publishing producer messages.

A producer message is a group of event rows sharing ``message_id``, ordered
by ``position``.  Each message becomes one JSON array body for the target
event type.  Message groups are small (a producer batch), so the grouping
shuffle spreads over many keys.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.version_log import VersionLog


def publish_messages(events: DataFrame, target_event_type: str) -> DataFrame:
    """A14 + A15: one body per message.

    ``events``: message_id, position, eid, flow_id, event_json.  The message
    flow id is the *first* event's flow id only (absent if that one has
    none) - ``min_by`` keeps a null, unlike ``first(ignorenulls)``."""
    s = F.struct("position", "event_json")
    return (events.groupBy("message_id")
            .agg(F.sort_array(F.collect_list(s)).alias("_evs"),
                 F.min_by("flow_id", "position").alias("flow_id"),
                 F.min_by("eid", "position").alias("first_eid"),
                 F.count(F.lit(1)).alias("n_events"))
            .select(F.lit(target_event_type).alias("event_type"), "message_id", "n_events",
                    "first_eid", "flow_id",
                    F.concat(F.lit("["), F.array_join(F.transform("_evs", lambda x: x["event_json"]), ","),
                             F.lit("]")).alias("body")))


def batch_bodies(events: DataFrame, target_event_type: str) -> DataFrame:
    """One body per source batch, its events in offset order.
    ``events``: event_type (the source's), partition, cursor_offset, offset,
    event_json; batches of different source types stay apart."""
    return (events.withColumnRenamed("event_type", "_source").groupBy("_source", "partition", "cursor_offset")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "event_json"))).alias("_evs"))
            .select(F.lit(target_event_type).alias("event_type"), "partition", "cursor_offset",
                    F.size("_evs").cast("bigint").alias("n_events"),
                    F.concat(F.lit("["), F.array_join(F.transform("_evs", lambda x: x["event_json"]), ","),
                             F.lit("]")).alias("body")))


class PublishTimeout(RuntimeError):
    """A run did not store its messages in time; none of them is published."""


def _runs(spark: SparkSession, path: str, run: str) -> VersionLog:
    return VersionLog(spark, f"{path}/_runs/{run}")


def _within(spark: SparkSession, seconds: float | None, job) -> None:
    """``job()``; its Spark jobs are cancelled once ``seconds`` have passed."""
    if seconds is None:
        return job()
    sc, tag, late = spark.sparkContext, f"publish-{uuid.uuid4().hex}", threading.Event()

    def cancel():
        late.set()
        sc.cancelJobsWithTag(tag)
    timer = threading.Timer(seconds, cancel)
    sc.addJobTag(tag)
    timer.start()
    try:
        job()
    except Exception as e:
        if late.is_set():
            raise PublishTimeout(f"not stored within {seconds} s") from e
        raise
    finally:
        timer.cancel()
        sc.removeJobTag(tag)
    if late.is_set():
        raise PublishTimeout(f"not stored within {seconds} s")


def write_messages(bodies: DataFrame, path: str, run: str, timeout_seconds: float | None = None) -> None:
    """Sink: one JSON array per line under ``event_type=<target>/``, behind a
    header of the other columns.

    An attempt writes a folder of its own; the run's manifest then names it in
    one step, and readers follow the manifest.  So a failed or timed-out
    attempt publishes nothing and raises, and a repeated attempt replaces the
    one before as a whole."""
    spark, attempt = bodies.sparkSession, f"attempt={uuid.uuid4().hex}"
    head = F.to_json(F.struct(*[c for c in bodies.columns if c not in ("event_type", "body")]))
    rows = bodies.select("event_type", F.concat_ws("\t", head, "body").alias("value"))
    folder = f"{path}/{attempt}"
    try:
        _within(spark, timeout_seconds, lambda: rows.write.partitionBy("event_type").text(folder))
        runs = _runs(spark, path, run)
        while not runs.append(runs.latest()[0] + 1, {"attempt": attempt}):
            pass                                    # another attempt came in between: the last one stays
    except BaseException:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        raise


def read_messages(spark: SparkSession, path: str, run: str, event_type: str | None = None,
                  header: str = "message_id bigint, flow_id string") -> DataFrame:
    """The messages a run published (for one target event type); none before
    its manifest is there."""
    version, entry = _runs(spark, path, run).latest()
    schema = "value string, event_type string"
    t = spark.read.schema(schema).text(f"{path}/{entry['attempt']}") if version else spark.createDataFrame([], schema)
    if event_type is not None:
        t = t.filter(F.col("event_type") == event_type)
    parts = F.split(F.col("value"), "\t", 2)
    return t.select("event_type", F.from_json(parts[0], header).alias("_h"), parts[1].alias("body")) \
        .select("event_type", "_h.*", "body")


def publish_with_markers(spark: SparkSession, bodies: DataFrame, markers: DataFrame,
                         path: str, run: str) -> DataFrame:
    """A marker is emitted only once its message is published by this
    run's manifest, in input order; a failed run raises and emits none.  Batch twin of the streaming sink: write, read back,
    semi-join, sort.

    ``markers``: message_id, marker, seq (the place in the input)."""
    write_messages(bodies, path, run)
    stored = read_messages(spark, path, run).select("message_id").distinct()
    return markers.join(stored, "message_id", "left_semi").orderBy("seq")


def republish(spark: SparkSession, events: DataFrame, transform, target_event_type: str,
              path: str, run: str) -> DataFrame:
    """Map decoded events (``transform`` adds event_json), publish each
    source batch as one message to the target event type, and return what
    was stored: event_type, partition, cursor_offset, n_events, body."""
    write_messages(batch_bodies(transform(events), target_event_type), path, run)
    return read_messages(spark, path, run, target_event_type,
                         "partition string, cursor_offset string, n_events bigint")


def latest_event_types(defs: DataFrame) -> DataFrame:
    """The registry keeps the latest definition per name."""
    cols = [c for c in defs.columns if c not in ("name", "version")]
    s = F.struct(*[F.col(c) for c in cols])
    return defs.groupBy("name").agg(F.max("version").alias("version"),
                                    F.max_by(s, "version").alias("_d")) \
        .select("name", "version", *[F.col("_d." + c).alias(c) for c in cols])


def register_event_types(spark: SparkSession, defs: DataFrame, path: str) -> DataFrame:
    """Append definitions to the registry table and return the latest
    definition per name."""
    defs.write.mode("append").parquet(path)
    return latest_event_types(spark.read.parquet(path))
