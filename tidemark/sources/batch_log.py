"""The newline-delimited JSON wire log (A1, A2, B16 and FIXTURES F2).

Layout: ``<root>/event_type=<name>/part-*.txt``, one batch per line, UTF-8,
no line-length cap.  The event type is the directory (the subscription),
the partition and offset travel in each line's cursor.  Text files split at
line boundaries, so one large file is still read by many tasks.
"""

from __future__ import annotations

import json
import re

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.datetime import format_offset_datetime
from tidemark.operators.codec import batch_line, cursor_json, encode_event, metadata_struct
from tidemark.operators.consume import start_table
from tidemark.session import session_key
from tidemark.sources import offset_source, segments
from tidemark.sources.event_log import event_log, log_root, materialise, partition_catalog
from tidemark.sources.version_log import VersionLog

# Fixed values of the fixture's injected lines (FIXTURES F2).  A batch's
# fault is picked by its first event_id; the first matching rule wins.
FAULT_RULES = [
    (97, "cut"),              # line cut in half: not JSON
    (89, "offset_number"),    # cursor offset written as a JSON number
    (83, "no_eid"),           # first event lacks metadata.eid
    (79, "date_only"),        # first event's occurred_at is a bare date
    (73, "data_not_object"),  # first event's data is a JSON string
]
KEEP_ALIVE_EVERY = 7          # keep-alive lines follow every 7th batch
# The k-th keep-alive of a run (1, 2, 3) writes events as: missing, null, [].
# Runs have 1, 2, 3, 1, 2, 3, ... lines so consecutive-keep-alive limits bite.


def _fault_of(first_event_id: Column) -> Column:
    expr = None
    for mod, name in FAULT_RULES:
        cond = first_event_id % mod == 0
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def wire_lines(log: DataFrame, batch_limit: int = 5, faults: bool = True,
               keep_alives: bool = True) -> DataFrame:
    """Encode the canonical log as wire lines (B16 with the F2 fixture rules).

    Offsets are dense per partition, so batch membership is arithmetic
    (``offset div n``) and the grouping shuffles on (event_type, partition,
    batch) - many small groups, whatever the partition skew.
    """
    pos = F.col("offset") % batch_limit
    ev = log.withColumn("batch_no", F.floor(F.col("offset") / batch_limit).cast("bigint"))
    fault = _fault_of(F.col("event_id")) if faults else F.lit(None).cast("string")
    ev = ev.withColumn("_fault", F.when(pos == 0, fault))
    f = F.col("_fault")
    occ = F.when(f == "date_only", F.date_format("occurred_at", "yyyy-MM-dd")) \
        .otherwise(format_offset_datetime("occurred_at"))
    eid = F.when(f == "no_eid", F.lit(None).cast("string")).otherwise(F.col("eid"))
    md = metadata_struct(eid, occ, event_type=F.col("event_type"), flow_id=F.col("flow_id"))
    normal = encode_event(F.col("kind"), md, F.col("payload"), F.col("data_type"), F.col("data_op"))
    # data given as a JSON string (double-encoded object); on a business event
    # this adds a top-level "data" key, which makes it a (bad) data-change event.
    bad_data_dc = F.to_json(F.struct(F.col("data_type").alias("data_type"),
                                     F.col("data_op").alias("data_op"),
                                     F.col("payload").alias("data"), md.alias("metadata")))
    bad_data_be = F.to_json(F.map_concat(
        F.create_map(F.lit("metadata"), F.parse_json(F.to_json(md))),
        F.from_json(F.col("payload"), "map<string,variant>"),
        F.create_map(F.lit("data"), F.variant_get(
            F.parse_json(F.to_json(F.struct(F.col("payload").alias("s")))), "$.s", "variant"))))
    event_json = F.when(f == "data_not_object",
                        F.when(F.col("kind") == "data", bad_data_dc).otherwise(bad_data_be)) \
        .otherwise(normal)
    ev = ev.withColumn("event_json", event_json)

    batches = (ev.groupBy("event_type", "partition", "batch_no")
               .agg(F.max("offset").alias("cursor_offset"),
                    F.max("_fault").alias("fault"),
                    F.min_by("event_id", "offset").alias("first_event_id"),
                    F.count(F.lit(1)).alias("n_events"),
                    F.sort_array(F.collect_list(F.struct("offset", "event_json"))).alias("_evs")))
    cur_text = F.lpad(F.col("cursor_offset").cast("string"), 18, "0")
    cur = F.when(F.col("fault") == "offset_number",
                 cursor_json(F.col("partition"), F.col("cursor_offset")))\
        .otherwise(cursor_json(F.col("partition"), cur_text))
    line = batch_line(cur, F.transform("_evs", lambda x: x["event_json"]))
    line = F.when(F.col("fault") == "cut", F.substring(line, 1, F.floor(F.length(line) / 2).cast("int")))\
        .otherwise(line)
    out = batches.select("event_type", "partition", "batch_no", "cursor_offset", "first_event_id",
                         "fault", "n_events", F.lit(0).cast("bigint").alias("line_seq"),
                         line.alias("value"))
    if not keep_alives:
        return out
    run = F.floor((F.col("batch_no") + 1) / KEEP_ALIVE_EVERY).cast("bigint")
    ka = (batches.filter((F.col("batch_no") + 1) % KEEP_ALIVE_EVERY == 0)
          .select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), (run - 1) % 3 + 1)).alias("line_seq")))
    plain_cursor = cursor_json(F.col("partition"), cur_text)
    ka_line = (F.when(F.col("line_seq") == 1, batch_line(plain_cursor, None))
               .when(F.col("line_seq") == 2, F.concat(F.lit('{"cursor":'), plain_cursor,
                                                       F.lit(',"events":null}')))
               .otherwise(F.concat(F.lit('{"cursor":'), plain_cursor, F.lit(',"events":[]}'))))
    ka_out = ka.select("event_type", "partition", "batch_no", "cursor_offset", "first_event_id",
                       F.lit(None).cast("string").alias("fault"), F.lit(0).cast("bigint").alias("n_events"),
                       "line_seq", ka_line.alias("value"))
    return out.unionByName(ka_out)


def write_batch_log(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Sink: one text line per batch under ``event_type=<name>/``; lines of a
    partition are written in (offset, line) order.  Range partitioning on
    (event_type, partition, offset) splits a hot log partition over many
    writer tasks instead of one."""
    (lines.repartitionByRange("event_type", "partition", "cursor_offset")
     .sortWithinPartitions("event_type", "partition", "cursor_offset", "line_seq")
     .select("event_type", "value")
     .write.mode(mode).partitionBy("event_type").text(path))


def read_batch_log(spark: SparkSession, path: str) -> DataFrame:
    """A1: lines as (event_type, value).  ``wholetext`` stays off: files are
    split at newlines by many tasks.  Every call lists the files anew, so
    lines appended since the last one are read."""
    return spark.read.schema("value string, event_type string").text(path).select("event_type", "value")


def stream_batch_log(spark: SparkSession, path: str, max_files_per_trigger: int = 64,
                     event_type: str | None = None) -> DataFrame:
    """A2: the unbounded version; new files are picked up as they land, at
    most ``max_files_per_trigger`` per micro-batch (backpressure).  For plain
    folders: lines arrive in the order of file times; :func:`stream_offsets`
    delivers a segmented log in offset order.  With ``event_type`` only that
    type's directory is listed."""
    # always a glob: a plain directory would lose its partition value
    types = "*" if event_type is None else "{" + re.sub(r"([\\{}\[\]*?,])", r"\\\1", event_type) + "}"
    return (spark.readStream.format("text")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("basePath", path)
            .load(f"{path}/event_type={types}")
            .select("event_type", "value"))


def cursor_map(cursors: DataFrame | None) -> dict:
    """Cursors (event_type, partition, start_cursor) as event type ->
    partition -> last offset consumed; ``BEGIN`` and null are left out."""
    if cursors is None:
        return {}
    _, rows = start_table(cursors)
    if rows is None:
        raise ValueError("more cursors than a stream offset can hold")
    out: dict = {}
    for r in rows:
        if r["_start"] > 0:
            out.setdefault(r["event_type"], {})[r["partition"]] = r["_start"] - 1
    return out


def _last_offset(spark: SparkSession, checkpoint: str) -> str | None:
    """The newest stream offset in a query's checkpoint."""
    log = VersionLog(spark, f"{checkpoint}/offsets")
    if not log.fs.exists(log._path("")):
        return None
    names = [int(n) for n in (s.getPath().getName() for s in log.fs.listStatus(log._path(""))) if n.isdigit()]
    if not names:
        return None
    stream = log.fs.open(log._path(str(max(names))))
    try:
        return log.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip().split("\n")[-1]
    finally:
        stream.close()


def stream_offsets(spark: SparkSession, root: str, checkpoint: str, max_offsets: int = 0,
                   cursors: DataFrame | None = None, event_type: str | None = None) -> DataFrame:
    """A2 over a segmented log: lines (event_type, partition, segment_offset,
    line, value) in offset order per partition, at most about ``max_offsets``
    offsets per micro-batch (0: all there are), dealt into two tasks a core.
    ``cursors`` start a fresh ``checkpoint``; a used one goes on where it
    stopped."""
    cloudpickle.register_pickle_by_value(offset_source)
    spark.dataSource.register(offset_source.OffsetLog)
    start = json.dumps(cursor_map(cursors))
    reader = (spark.readStream.format(offset_source.NAME).option("path", root).option("maxOffsetsPerTrigger", max_offsets)
              .option("tasks", 2 * max(spark.sparkContext.defaultParallelism, 1))
              .option("start", start).option("resume", _last_offset(spark, checkpoint) or start))
    return (reader if event_type is None else reader.option("eventTypes", json.dumps([event_type]))).load()


def wire_log_path(spark: SparkSession, sf_dir: str, name: str = "wire") -> str:
    return f"{log_root(spark, sf_dir)}/{name}"


def wire_log(spark: SparkSession, sf_dir: str) -> str:
    """Materialise the fixture wire log (with faults and keep-alives) once
    and return its path."""
    path = wire_log_path(spark, sf_dir)
    key = (session_key(spark), "done:" + path)
    if key not in _DONE:
        materialise(spark, path, lambda p: write_batch_log(wire_lines(event_log(spark, sf_dir)), p))
        _DONE.add(key)
    return path


#: Offsets per segment of the fixture's segmented log: a 2000th of what it
#: holds, since a file has a cost whatever it holds, within these bounds.
FIXTURE_SEGMENT, FIXTURE_SEGMENT_MOST, FIXTURE_SEGMENTS = 1000, 5000, 2000


def fixture_segment(spark: SparkSession, sf_dir: str) -> int:
    held = partition_catalog(spark, sf_dir).agg(F.sum("n_events")).first()[0] or 0
    return min(max(FIXTURE_SEGMENT, held // FIXTURE_SEGMENTS), FIXTURE_SEGMENT_MOST)


def segment_log(spark: SparkSession, sf_dir: str) -> str:
    """The fixture wire log in segments with a manifest, written once."""
    path = wire_log_path(spark, sf_dir, "segments")
    key = (session_key(spark), "done:" + path)
    if key not in _DONE:
        if not segments.is_segmented(spark, path):
            segments.write_segments(wire_lines(event_log(spark, sf_dir)), path, fixture_segment(spark, sf_dir))
        _DONE.add(key)
    return path


_DONE: set = set()
