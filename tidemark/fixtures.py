"""Deterministic inputs derived from the given tables (FIXTURES F1-F10).

Every registered query starts from ``events.parquet``: the canonical log
(F1), the wire log (F2), commit rows, cursors, producer messages and
event-type definitions are all Spark-derived from it, so the work of every
query grows with the table.  The rules below are mirrored in the DuckDB
oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.datetime import format_offset_datetime
from tidemark.functions.offsets import BEGIN, offset_text
from tidemark.operators import codec, consume, offsets
from tidemark.sources.batch_log import read_batch_log, wire_log
from tidemark.sources.event_log import cached_read, event_log, partition_catalog

# Fixed parameters of the fixture scenarios.
NOW = "2024-02-01 00:00:00"          # "now" for leases and commits
CUT_A = "2024-01-08 00:00:00"        # group g2 committed up to here
CUT_B = "2024-01-15 00:00:00"        # group g1 committed / map A
CUT_C = "2024-01-20 00:00:00"        # map B
LEASE_SKEW_SECONDS = 400


def log(spark: SparkSession, sf: str) -> DataFrame:
    return event_log(spark, sf)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    path = wire_log(spark, sf)          # written once per session: one listing serves all queries
    return cached_read(spark, "text:" + path, lambda: read_batch_log(spark, path))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Valid consumer messages (keep-alives included) of the wire log."""
    return codec.to_consumer_messages(codec.decode_batches(lines(spark, sf)))


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Decoded, exploded events of the valid batches."""
    return codec.decode_event_fields(codec.explode_events(consume.drop_keep_alives(messages(spark, sf))))


def partitions(spark: SparkSession, sf: str) -> DataFrame:
    """(event_type, partition) pairs from the partition catalogue."""
    return partition_catalog(spark, sf).select("event_type", "partition")


def event_types(spark: SparkSession, sf: str) -> list[str]:
    """The event types of the log: one directory each in the topic layout."""
    return [r["event_type"] for r in partitions(spark, sf).select("event_type").distinct().collect()]


def explicit_cursors(spark: SparkSession, sf: str) -> DataFrame:
    """A4 cursors: partition 0 -> BEGIN, 1 -> "0", 2 -> padded 100, 3 -> none."""
    p = F.col("partition")
    c = (F.when(p == "0", F.lit(BEGIN)).when(p == "1", F.lit("0"))
         .when(p == "2", offset_text(F.lit(100))))
    return partitions(spark, sf).withColumn("start_cursor", c).filter(F.col("start_cursor").isNotNull())


def high_water_before(spark: SparkSession, sf: str, cut: str) -> DataFrame:
    lg = log(spark, sf).filter(F.col("occurred_at") < F.to_timestamp(F.lit(cut)))
    return offsets.high_water_offsets(lg)


def commits(spark: SparkSession, sf: str) -> DataFrame:
    """Stored commit rows: group g1 for every partition (up to CUT_B), group
    g2 for partitions 0 and 1 (up to CUT_A)."""
    now = F.to_timestamp(F.lit(NOW))
    skew = F.make_dt_interval(secs=F.lit(LEASE_SKEW_SECONDS))

    def rows(group: str, cut: str, only: list[str] | None) -> DataFrame:
        hw = high_water_before(spark, sf, cut)
        if only:
            hw = hw.filter(F.col("partition").isin(*only))
        p = F.col("partition")
        return hw.select(
            F.lit(group).alias("group_id"), "event_type", p.alias("partition_id"),
            F.col("high_water").cast("string").alias("checkpoint_id"),
            F.lit("worker-a").alias("lease_holder"),
            F.when(p == "3", F.lit(None)).otherwise(p.cast("bigint")).cast("bigint").alias("lease_counter"),
            F.when(F.col("event_type").isin("click", "signup"), now - skew).otherwise(now + skew)
            .alias("lease_timestamp"),
            (F.concat(F.lit(f"lease-{group}-"), p) if group == "g1" else F.lit(None).cast("string"))
            .alias("lease_id"))
    return rows("g1", CUT_B, None).unionByName(rows("g2", CUT_A, ["0", "1"]))


def lease_requests(spark: SparkSession, sf: str) -> DataFrame:
    groups = F.array(F.lit("g1"), F.lit("g2"), F.lit("g3"))
    return partitions(spark, sf).select(F.explode(groups).alias("group_id"), "event_type",
                                        F.col("partition").alias("partition_id"))


def own_counters(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("partition_id")
    c = F.when(p == "0", F.lit(0)).when(p == "1", F.lit(5)).when(p == "2", F.lit(None)).otherwise(F.lit(7))
    return lease_requests(spark, sf).filter(F.col("event_type") != "view") \
        .withColumn("own_counter", c.cast("bigint"))


def producer_events(spark: SparkSession, sf: str, shift: int = 0) -> DataFrame:
    """message_id = (event_id + shift) div 10, position = (event_id +
    shift) % 10; marker = eid of position 0."""
    lg = codec.encode_log_events(log(spark, sf))
    k = F.col("event_id") + shift
    return lg.select(F.floor(k / 10).cast("bigint").alias("message_id"),
                     (k % 10).cast("int").alias("position"), "eid", "flow_id", "event_json")


def event_type_defs(spark: SparkSession, sf: str) -> DataFrame:
    """Two registered versions per event type; version 2 changes the owner
    of click and view and gives view a category outside the enumeration."""
    # derived from a scan of the log, so the job grows with the table
    names = log(spark, sf).select(F.col("event_type").alias("name")).distinct()
    n = F.col("name")

    def version(v: int) -> DataFrame:
        owner = F.concat(F.lit("app-"), n) if v == 1 else \
            F.when(n.isin("click", "view"), F.concat(F.lit("team-"), n)).otherwise(F.concat(F.lit("app-"), n))
        cat = F.when(n == "purchase", F.lit("business")).otherwise(F.lit("data"))
        if v == 2:
            cat = F.when(n == "view", F.lit("audit")).otherwise(cat)
        return names.select(n, F.lit(v).alias("version"), owner.alias("owning_application"),
                            cat.alias("category"),
                            F.array(F.lit("user_id")).alias("partition_key_fields"),
                            F.array(F.lit("metadata_enrichment")).alias("enrichment_strategies"))
    return version(1).unionByName(version(2))


def event_type_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Definition texts; the signup definition lacks owning_application."""
    d = event_type_defs(spark, sf).filter(F.col("version") == 2)
    owner = F.when(F.col("name") == "signup", F.lit(None)).otherwise(F.col("owning_application"))
    s = F.struct(F.col("name"), F.col("partition_key_fields"), owner.alias("owning_application"),
                 F.col("category"), F.col("enrichment_strategies"),
                 F.struct(F.lit(1000).cast("bigint").alias("expected_write_rate")).alias("statistics"))
    return d.select(F.to_json(s).alias("value"))


def datetime_texts(spark: SparkSession, sf: str) -> DataFrame:
    """B11 inputs: occurred_at written six ways by event_id % 6."""
    t = F.col("occurred_at")
    k = F.col("event_id") % 6
    plus1 = F.concat(F.date_format(t + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                     F.lit("+01:00"))
    text = (F.when(k == 0, format_offset_datetime(t))
            .when(k == 1, plus1)
            .when(k == 2, F.date_format(t, "yyyy-MM-dd"))
            .when(k == 3, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm"), F.lit("Z")))
            .when(k == 4, F.lower(format_offset_datetime(t)))
            .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")))
    return log(spark, sf).select("event_id", text.alias("text"))


def offset_texts(spark: SparkSession, sf: str) -> DataFrame:
    """C1 inputs by event_id % 8."""
    o = F.col("offset").cast("string")
    k = F.col("event_id") % 8
    text = (F.when(k == 0, F.col("offset_text")).when(k == 1, o).when(k == 2, F.lit(BEGIN))
            .when(k == 3, F.lit("something invalid")).when(k == 4, F.lit(""))
            .when(k == 5, F.concat(F.lit("-"), o)).when(k == 6, F.lit("9" * 20))
            .otherwise(F.concat(o, F.lit("0"))))
    return log(spark, sf).select("event_id", text.alias("text"))
