"""The decoded log, landed as Parquet (A5, B1).

``land`` decodes the runs of a segmented wire log that have not landed yet,
each once: events into a *part* sorted by (event type, partition, offset), the
lines that cannot be decoded into a quarantine part beside it.  A version of
the landed log names the runs it contains and its live parts; it moves by
compare and set, so a landing that is repeated, or done by two jobs at once,
counts once, and one that dies leaves only a folder that nobody reads.

``compact`` merges parts of like size into one (sizes by powers of four, so a
row is rewritten a logarithmic number of times).  Readers see whole versions.
In a part, files hold ranges of (partition, offset), so the cursor filter of
``read_from_cursor`` skips files and row groups, and nothing is parsed again.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import codec, consume
from tidemark.sources import segments
from tidemark.sources.version_log import VersionLog

EVENTS = ("partition string, offset bigint, pos bigint, cursor_offset string, eid string, kind string, "
          "occurred_at_text string, occurred_at timestamp, received_at timestamp, parent_eids array<string>, "
          "flow_id string, data_type string, data_op string, payload string, event_type string")
EVENT_COLUMNS = [c.split(" ")[0] for c in EVENTS.split(", ")]
QUARANTINE = "value string, reason string, event_type string"


def _line(spark: SparkSession, root: str) -> VersionLog:
    return VersionLog(spark, f"{root}/log")


def decode_lines(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed lines (``codec.parse_batches``) as decoded events and quarantine."""
    msgs = codec.to_consumer_messages(parsed.filter(F.col("valid")).drop("errors", "valid"))
    events = codec.decode_event_fields(codec.explode_events(consume.drop_keep_alives(msgs)))
    first = F.col("errors")[0]
    reason = F.when(first["reason"] == codec.UNPARSEABLE, F.lit(codec.UNPARSEABLE)).otherwise(
        F.concat(first["path"], F.lit(": "), first["reason"]))
    return events.select(*EVENT_COLUMNS), parsed.filter(~F.col("valid")).select("value", reason.alias("reason"), "event_type")


def _write(events: DataFrame, path: str) -> int:
    """Store a part; returns its number of rows (from the files' footers)."""
    (events.repartitionByRange(*consume.KEYS, "offset").sortWithinPartitions(*consume.KEYS, "offset")
     .write.partitionBy("event_type").parquet(path))
    return events.sparkSession.read.schema(EVENTS).parquet(path).count()


def land(spark: SparkSession, src: str, root: str) -> list[str]:
    """Decode and store the runs of ``src`` that ``root`` lacks; returns them."""
    line, landed = _line(spark, root), []
    for run in segments.runs(spark, src):
        if run in line.latest()[1].get("runs", []):
            continue
        part = f"{run}-{uuid.uuid4().hex[:8]}"
        lines = segments.read_segments(spark, src, segments.manifest_of(spark, src, [run]))
        parsed = codec.parse_batches(lines).drop("_v").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events, bad = decode_lines(parsed)
            rows = _write(events, f"{root}/events/part={part}")
            bad.write.partitionBy("event_type").parquet(f"{root}/quarantine/part={part}")
        finally:
            parsed.unpersist()
        while True:
            version, entry = line.latest()
            if run in entry.get("runs", []):            # another job has landed it: this copy is not named
                break
            new = {"runs": [*entry.get("runs", []), run], "quarantine": [*entry.get("quarantine", []), part],
                   "parts": [*entry.get("parts", []), [part, rows]]}
            if line.append(version + 1, new):
                landed.append(run)
                break
    return landed


def _read(spark: SparkSession, root: str, parts: list[str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], EVENTS).select(*EVENT_COLUMNS)
    rows = spark.read.schema(EVENTS).option("basePath", f"{root}/events")
    return rows.parquet(*[f"{root}/events/part={p}/" for p in parts]).select(*EVENT_COLUMNS)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The decoded events of the newest version."""
    return _read(spark, root, [p for p, _ in _line(spark, root).latest()[1].get("parts", [])])


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    parts = _line(spark, root).latest()[1].get("quarantine", [])
    if not parts:
        return spark.createDataFrame([], QUARANTINE)
    return spark.read.schema(QUARANTINE).option("basePath", f"{root}/quarantine").parquet(
        *[f"{root}/quarantine/part={p}/" for p in parts]).select("value", "reason", "event_type")


def compact(spark: SparkSession, root: str, at_least: int = 8) -> list[str]:
    """Merge the parts of a size class that has ``at_least``; returns them."""
    line = _line(spark, root)
    classes: dict[int, list[tuple[str, int]]] = {}
    for part, rows in line.latest()[1].get("parts", []):
        classes.setdefault(max(rows, 1).bit_length() // 2, []).append((part, rows))
    full = next((x for _, x in sorted(classes.items()) if len(x) >= max(2, at_least)), [])
    if not full:
        return []
    merged, names = f"merged-{uuid.uuid4().hex}", [p for p, _ in full]
    rows = _write(_read(spark, root, names), f"{root}/events/part={merged}")
    while True:
        version, entry = line.latest()
        if not set(names) <= {p for p, _ in entry["parts"]}:
            return []                                   # another job has merged some of them
        kept = [x for x in entry["parts"] if x[0] not in names]
        if line.append(version + 1, {**entry, "parts": [*kept, [merged, rows]]}):
            return names
