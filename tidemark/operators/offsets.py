"""Offset maps, commit registration and acknowledgement.

An offset map is a DataFrame ``(key STRING, offset BIGINT)`` where ``key``
is the partition-key hash; high-water maps are grouped maxima (partial +
final aggregation), never windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.offsets import partition_key_hash
from tidemark.functions.text import fill_message
from tidemark.plans.numbering import chunked_running, offset_chunk

KEYS = ["event_type", "partition"]

# Fixed value: the error text for a partition missing from an offset map
# ({partition}, {event_type} are filled in).
MISSING_OFFSET_MESSAGE = "No offset set for given partition {partition} and event-type {event_type}"


def with_key(df: DataFrame) -> DataFrame:
    return df.withColumn("key", partition_key_hash("event_type", "partition"))


def high_water_offsets(messages: DataFrame, offset_col: str = "offset") -> DataFrame:
    """Max offset per (event type, partition); ``BEGIN`` counts as 0 via
    C1 upstream."""
    return messages.groupBy(*KEYS).agg(F.max(offset_col).alias("high_water"))


def offset_map(high_water: DataFrame) -> DataFrame:
    return with_key(high_water).select("key", F.col("high_water").alias("offset"))


def last_offset(lookups: DataFrame, omap: DataFrame) -> DataFrame:
    """Offset per looked-up partition, -1 when the key is unknown."""
    lk = with_key(lookups)
    return lk.join(omap, "key", "left").withColumn("last_offset", F.coalesce("offset", F.lit(-1)))\
        .drop("offset")


def last_offset_required(lookups: DataFrame, omap: DataFrame) -> DataFrame:
    """C4: as C3 but a missing key is an error; found offsets as plain text."""
    lk = with_key(lookups)
    j = lk.join(omap, "key", "left")
    err = fill_message(MISSING_OFFSET_MESSAGE, partition="partition", event_type="event_type")
    return j.select(*lookups.columns, F.col("offset").cast("string").alias("checkpoint"),
                    F.when(F.col("offset").isNull(), err).alias("error"))


def register_commits(messages: DataFrame, arrival: str = "arrival_seq",
                     rows_per_chunk: int = 1 << 20) -> DataFrame:
    """In arrival order a message is accepted iff its offset is larger
    than the last accepted one of its partition (start -1).

    The last accepted offset equals the running max over all earlier
    messages (a skipped message never raises it), so acceptance is
    ``offset > max(earlier offsets)`` - a chunked running max in arrival
    order (chunks = arrival ranges), exact and spread over many tasks."""
    r = chunked_running(messages, KEYS, [arrival], chunk=offset_chunk(arrival, rows_per_chunk),
                        out="_prev_max", how="max", value="offset", exclusive=True)
    return r.withColumn("accepted", F.col("offset") > F.coalesce("_prev_max", F.lit(-1)))\
        .drop("_prev_max")


def offset_map_upsert(base: DataFrame, writes: DataFrame) -> DataFrame:
    """Add or replace keys; the last write wins even if it goes down.
    ``writes`` carries ``write_seq`` (base rows count as sequence 0)."""
    allw = base.select("key", "offset", F.lit(0).cast("bigint").alias("write_seq")) \
        .unionByName(writes.select("key", "offset", F.col("write_seq").cast("bigint")))
    return allw.groupBy("key").agg(F.max_by("offset", "write_seq").alias("offset"))


def offset_map_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set difference on (key, offset) pairs: a changed offset stays."""
    return a.select("key", "offset").subtract(b.select("key", "offset"))


def offset_map_non_empty(omap: DataFrame, group_cols: list[str]) -> DataFrame:
    """Whether a map (per group) has anything to flush, as a column."""
    return omap.groupBy(*group_cols).agg((F.count(F.lit(1)) > 0).alias("non_empty"))


def acknowledge_offsets(current: DataFrame, acknowledged: DataFrame) -> DataFrame:
    """Committed := acknowledged - 1 each; flush = current diff committed."""
    committed = acknowledged.select("key", (F.col("offset") - 1).alias("offset"))
    return offset_map_diff(current, committed)
