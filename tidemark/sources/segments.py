"""The wire log in segments with a manifest (A1, A4, A5).

A write run stores its lines as *segments*: one text file per (event type,
partition, range of ``rows_per_segment`` offsets), lines in offset order, so a
hot partition is many files and a file is one bounded task.  The run's
manifest (Parquet) has one row per segment with its first and last offset.
The run becomes visible as a whole when its number is appended to the log's
version line; a run that dies before leaves nothing that a reader sees.

Readers ask the manifest before any file is listed: a consumer's cursors pick
the segments that end after them, so what lies before is neither listed nor
read, and a consumer at the end reads no line.  Only a cursor inside a segment
brings lines before it (fewer than ``rows_per_segment`` offsets); those are
dropped by offset after decoding.  The live reader is ``offset_source``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.consume import KEYS, start_table
from tidemark.plans.joins import collect_small
from tidemark.sources.version_log import VersionLog

#: Offsets per segment: some hundred MB of text.
ROWS_PER_SEGMENT = 1 << 20
MANIFEST = ("run string, segment string, event_type string, partition string, first_offset bigint, "
            "last_offset bigint, n_lines bigint")


def write_segments(lines: DataFrame, root: str, rows_per_segment: int = ROWS_PER_SEGMENT) -> str | None:
    """Publish ``lines`` (event_type, partition, cursor_offset, n_events,
    line_seq, value) as one run; returns its name, None without lines."""
    spark, run = lines.sparkSession, uuid.uuid4().hex
    number = F.floor(F.col("cursor_offset") / rows_per_segment).cast("bigint")
    # a name that needs no escaping in any file system
    name = F.concat(F.substring(F.md5(F.concat_ws("\0", *KEYS)), 1, 16), F.lit("-"), F.lpad(number.cast("string"), 15, "0"))
    lines = lines.withColumn("segment", name)
    (lines.repartition("segment").sortWithinPartitions("segment", "cursor_offset", "line_seq")
     .select("segment", "value").write.partitionBy("segment").text(f"{root}/data/run={run}"))
    rows = lines.groupBy("segment", *KEYS).agg(
        F.min(F.col("cursor_offset") - F.greatest(F.col("n_events"), F.lit(1)) + 1).alias("first_offset"),
        F.max("cursor_offset").alias("last_offset"), F.count(F.lit(1)).alias("n_lines"))
    rows.select(F.lit(run).alias("run"), "segment", *KEYS, "first_offset", "last_offset", "n_lines") \
        .sort(*KEYS, "first_offset").write.parquet(f"{root}/manifest/run={run}")
    if manifest_of(spark, root, [run]).isEmpty():
        return None
    line = VersionLog(spark, f"{root}/log")
    while not line.append(max(line.versions(), default=0) + 1, {"run": run}):
        pass                                # another run was published meanwhile: take the next number
    return run


def runs(spark: SparkSession, root: str) -> list[str]:
    """Published runs, oldest first."""
    line = VersionLog(spark, f"{root}/log")
    return [line.read(v)["run"] for v in line.versions()]


def manifest_of(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*[f"{root}/manifest/run={r}" for r in names])


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per published segment."""
    return manifest_of(spark, root, runs(spark, root))


def segments_after(spark: SparkSession, root: str, cursors: DataFrame | None = None) -> DataFrame:
    """The segments that hold an offset after the cursor of their partition
    (``cursors``: event_type, partition, start_cursor; none: all)."""
    found = manifest(spark, root)
    if cursors is None:
        return found
    starts, _ = start_table(cursors)
    return found.join(starts, KEYS, "left").filter(F.col("last_offset") >= F.coalesce("_start", F.lit(0))).drop("_start")


def read_segments(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Lines (event_type, value) of the ``wanted`` manifest rows.  Their
    folders are named to the reader, nothing else is listed; only if there are
    more than the bound of a broadcast is the whole log listed and joined."""
    rows = collect_small(wanted.select("run", "segment", "event_type"))
    if rows is not None and not rows:
        return spark.createDataFrame([], "event_type string, value string")
    paths = [f"{root}/data/"] if rows is None else [f"{root}/data/run={r['run']}/segment={r['segment']}/" for r in rows]
    lines = spark.read.schema("value string, run string, segment string").option("basePath", f"{root}/data").text(paths)
    names = wanted.select("run", "segment", "event_type") if rows is None else F.broadcast(
        spark.createDataFrame(rows, "run string, segment string, event_type string"))
    return lines.join(names, ["run", "segment"]).select("event_type", "value")


def read_after(spark: SparkSession, root: str, cursors: DataFrame | None = None) -> DataFrame:
    """Lines that may hold events after the cursors (see ``segments_after``)."""
    return read_segments(spark, root, segments_after(spark, root, cursors))


def is_segmented(spark: SparkSession, root: str) -> bool:
    line = VersionLog(spark, f"{root}/log")
    return line.fs.exists(line._path(""))
