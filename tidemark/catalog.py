"""Registered queries: one per operator of the inventory.

Each query takes (spark, sf_dir) and returns a DataFrame whose column
names match the DuckDB oracle in :mod:`tidemark.oracle`.  Timestamps are
returned as ISO text and integers as BIGINT so both sides compare exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.functions.datetime import format_offset_datetime, parse_offset_datetime
from tidemark.functions.offsets import offset_error, offset_to_long, partition_key_hash
from tidemark.operators import codec, commit_log, commits, consume, offsets, publish
from tidemark.plans import greedy
from tidemark.session import checkpoint_root
from tidemark.sources import landed_log, segments
from tidemark.sources.batch_log import read_batch_log, segment_log, wire_lines, wire_log
from tidemark.sources.event_log import with_arrival_seq
from tidemark.streaming import consume as streams

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["event_type", "partition"]
#: Offsets per micro-batch of the registered live queries.
STREAM_OFFSETS = 25_000


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/tidemark-runs/{name}-{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------- A: sources / consume

def scan_batch_log(spark, sf):
    t = read_batch_log(spark, wire_log(spark, sf))
    return t.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.sum(F.length("value")).cast("bigint").alias("n_chars"))


def stream_batch_log_q(spark, sf):
    """A2: the segmented wire log as a stream of offsets, a few thousand per
    micro-batch, counted into a Parquet sink via foreachBatch, then summed."""
    src, out = segment_log(spark, sf), _scratch(spark, "stream-batch-log")

    def sink(df: DataFrame, batch_id: int) -> None:
        # one directory per micro-batch, overwritten on replay: idempotent
        (df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_lines"),
                                      F.sum(F.length("value")).alias("n_chars"))
         .write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id:012d}"))

    streams.run(spark, src, f"{out}/_checkpoint", sink, max_offsets=STREAM_OFFSETS)
    r = spark.read.parquet(f"{out}/data")
    return r.groupBy("event_type").agg(F.sum("n_lines").cast("bigint").alias("n_lines"),
                                       F.sum("n_chars").cast("bigint").alias("n_chars"))


def consume_after_cursors(spark, sf):
    """A4/A5 over the segmented wire log: the manifest picks the segments
    that end after group g1's cursors, only their lines are read and parsed."""
    cur = resolve_start_cursor(spark, sf).filter(F.col("group_id") == "g1")
    lines = segments.read_after(spark, segment_log(spark, sf), cur)
    msgs = codec.to_consumer_messages(codec.decode_batches(lines))
    ev = codec.decode_event_fields(codec.explode_events(consume.drop_keep_alives(msgs)))
    return consume.partition_summary(consume.read_from_cursor(ev, cur))


def resolve_start_cursor(spark, sf):
    req = fx.lease_requests(spark, sf).withColumnRenamed("partition_id", "partition")
    p, g = F.col("partition"), F.col("group_id")
    explicit = F.when((g == "g1") & (p == "2"), F.lit("BEGIN")).when((g == "g3") & (p == "1"), F.lit("5"))
    req = req.withColumn("explicit_offset", explicit)
    return consume.resolve_start_cursor(req, fx.commits(spark, sf))


def read_from_cursor(spark, sf):
    ev = consume.read_from_cursor(fx.log(spark, sf), fx.explicit_cursors(spark, sf),
                                  event_types=fx.event_types(spark, sf))
    return consume.partition_summary(ev)


def read_from_mixed_cursors(spark, sf):
    """A4 where some (event type, partition) pairs have no cursor row: only
    the event types before "p" have one, so a partition id holds both."""
    c = fx.explicit_cursors(spark, sf).filter(F.col("event_type") < "p")
    ev = consume.read_from_cursor(fx.log(spark, sf), c, event_types=fx.event_types(spark, sf))
    return consume.partition_summary(ev)


def landed(spark, sf) -> str:
    """The landed form of the segmented wire log: runs that are not yet
    decoded are, others are left alone."""
    src = segment_log(spark, sf)
    root = f"{src}-landed"
    landed_log.land(spark, src, root)
    return root


def consume_all_partitions(spark, sf):
    """Flagship: wire log -> decoded once into the landed log -> group g1's
    resolved start cursors -> per-partition delivered count, first and last
    offset.  Consuming parses no text; the cursors filter the Parquet scan."""
    cur = resolve_start_cursor(spark, sf).filter(F.col("group_id") == "g1")
    ev = consume.read_from_cursor(landed_log.read(spark, landed(spark, sf)), cur, event_types=fx.event_types(spark, sf))
    return consume.partition_summary(ev)


def consume_wire_log(spark, sf):
    """A5 over plain folders of lines, without manifest or landed log: all
    text is parsed, whatever the cursors."""
    cur = resolve_start_cursor(spark, sf).filter(F.col("group_id") == "g1")
    return consume.partition_summary(consume.read_from_cursor(fx.events(spark, sf), cur))


def land_decoded_log(spark, sf):
    """A5/B1: two runs of the wire log land one after the other, a repeated
    landing adds nothing, compaction merges the parts."""
    src, root = _scratch(spark, "land-src"), _scratch(spark, "land")
    lines = wire_lines(fx.log(spark, sf))
    first = F.col("event_type").isin("click", "error")
    for part in (lines.filter(first), lines.filter(~first)):
        segments.write_segments(part, src, 500)
        landed_log.land(spark, src, root)
    landed_log.land(spark, src, root)
    landed_log.compact(spark, root, 2)
    return consume.partition_summary(landed_log.read(spark, root))


def quarantine_landed(spark, sf):
    """B2 from the landed log: the lines that could not be decoded."""
    bad = landed_log.read_quarantine(spark, landed(spark, sf))
    return bad.groupBy("event_type", "reason").agg(F.count(F.lit(1)).alias("n_batches"))


def batch_by_count(spark, sf):
    ev = consume.read_from_cursor(fx.log(spark, sf), fx.explicit_cursors(spark, sf),
                                  event_types=fx.event_types(spark, sf))
    return consume.batch_by_count(ev, 10).select(*KEYS, "batch_cursor", "first_offset", "n_events")


def batch_by_count_or_time(spark, sf):
    ev = consume.read_from_cursor(fx.log(spark, sf), fx.explicit_cursors(spark, sf),
                                  event_types=fx.event_types(spark, sf))
    w = greedy.greedy_windows(ev, KEYS, "offset", "occurred_at", max_rows=4, max_seconds=6 * 3600)
    return w.select(*KEYS, F.col("last_offset").alias("batch_cursor"), "first_offset", "n_events")


def limit_stream(spark, sf):
    ev = consume.read_from_cursor(fx.log(spark, sf), fx.explicit_cursors(spark, sf),
                                  event_types=fx.event_types(spark, sf))
    return consume.partition_summary(consume.limit_stream(ev, 25))


def limit_stream_by_time(spark, sf):
    ev = consume.read_from_cursor(fx.log(spark, sf), fx.explicit_cursors(spark, sf),
                                  event_types=fx.event_types(spark, sf))
    return consume.partition_summary(consume.limit_stream_by_time(ev, "2024-01-10 00:00:00", 3 * 86400))


def close_on_keep_alives(spark, sf):
    # decoded once (checkpoint): the run table is derived from the same
    # messages it is joined back to
    m = fx.messages(spark, sf).select(*KEYS, "cursor_offset_long", "n_events")
    d = consume.close_on_keep_alives(m.checkpoint(eager=True), 2)
    return d.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_batches"),
                                F.max("cursor_offset_long").alias("last_cursor"))


def drop_keep_alives(spark, sf):
    m = fx.messages(spark, sf)
    return m.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_valid_lines"),
        F.count_if(F.col("n_events") > 0).alias("n_delivered"),
        F.count_if(F.col("n_events") == 0).alias("n_dropped"))


def to_consumer_message(spark, sf):
    return fx.messages(spark, sf).select(*KEYS, "cursor_offset", "n_events")


def detect_stalled_partitions(spark, sf):
    return consume.detect_stalled_partitions(fx.log(spark, sf), flush_timeout_seconds=3600)


# --------------------------------------------------------------------------- A: publish

def publish_messages(spark, sf):
    b = publish.publish_messages(fx.producer_events(spark, sf), "audit")
    return b.select("event_type", "message_id", "n_events", "first_eid", F.md5("body").alias("body_md5"))


def publish_flow_header(spark, sf):
    out = None
    for name, shift in (("v0", 0), ("v3", 3)):
        b = publish.publish_messages(fx.producer_events(spark, sf, shift), "audit")
        b = b.select(F.lit(name).alias("variant"), "message_id", "flow_id")
        out = b if out is None else out.unionByName(b)
    return out


def publish_with_markers(spark, sf):
    pe = fx.producer_events(spark, sf)
    bodies = publish.publish_messages(pe, "audit")
    markers = pe.filter(F.col("position") == 0).select("message_id", F.col("eid").alias("marker"),
                                                       F.col("message_id").alias("seq"))
    return publish.publish_with_markers(spark, bodies, markers, _scratch(spark, "published"), "1")


def republish(spark, sf):
    """A17, the mapping alone: purchase events to audit events (new eid,
    parent = source eid)."""
    ev = fx.events(spark, sf).filter(F.col("event_type") == "purchase")
    mapped = ev.select(
        KEYS[1], "offset", "cursor_offset",
        F.md5(F.concat(F.col("eid"), F.lit(":audit"))).alias("new_eid"),
        F.col("eid").alias("parent_eid"))
    return mapped.select("new_eid", "parent_eid", "partition", "offset")


def republish_bodies(spark, sf):
    """Purchase events from the start become audit events, published as
    one message per source batch; the stored bodies."""
    ev = fx.events(spark, sf).filter(F.col("event_type") == "purchase")
    m = publish.republish(spark, ev, streams.audit_transform, "purchase-audit",
                          _scratch(spark, "republished"), "1")
    return m.select("event_type", "partition", F.col("cursor_offset").cast("bigint").alias("cursor_offset"),
                    "n_events", F.md5("body").alias("body_md5"))


def register_event_types(spark, sf):
    """Both definition versions are appended to a registry table; the
    registry answers with the latest per name."""
    path = _scratch(spark, "event-type-registry")
    defs = fx.event_type_defs(spark, sf)
    publish.register_event_types(spark, defs.filter(F.col("version") == 1), path)
    return publish.register_event_types(spark, defs.filter(F.col("version") == 2), path) \
        .select("name", F.col("version").cast("bigint").alias("version"), "owning_application", "category")


# --------------------------------------------------------------------------- B: codec

def decode_batches(spark, sf):
    m = fx.messages(spark, sf)
    return m.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_batches"),
                                F.sum("n_events").cast("bigint").alias("n_events"))


def quarantine_batches(spark, sf):
    q = codec.quarantine_batches(fx.lines(spark, sf))
    return q.groupBy("event_type", "reason").agg(F.count(F.lit(1)).alias("n_batches"))


def validation_report(spark, sf):
    return codec.validation_report(codec.quarantine_batches(fx.lines(spark, sf)))


def explode_events(spark, sf):
    return fx.events(spark, sf).select(*KEYS, "offset", "pos", "eid")


def classify_events(spark, sf):
    return fx.events(spark, sf).groupBy("event_type", "kind").agg(F.count(F.lit(1)).alias("n_events"))


def decode_metadata(spark, sf):
    return fx.events(spark, sf).select("eid", format_offset_datetime("occurred_at").alias("occurred_at_text"),
                                       "flow_id", "meta_event_type")


def decode_full_metadata(spark, sf):
    """All six metadata fields of events that are written with them.
    Every third event was received (its text in another zone), every second
    has parents; the fields are left out of the others."""
    lg = fx.log(spark, sf)
    received = F.when(F.col("event_id") % 3 == 0, format_offset_datetime("occurred_at", F.lit("+01:00")))
    parents = F.when(F.col("event_id") % 2 == 1, F.array(F.concat(F.lit("root-"), F.col("eid")), F.md5("eid")))
    md = codec.metadata_struct(F.col("eid"), format_offset_datetime("occurred_at"), event_type=F.col("event_type"),
                               received_at_text=received, parent_eids=parents, flow_id=F.col("flow_id"))
    text = codec.encode_event(F.col("kind"), md, F.col("payload"), F.col("data_type"), F.col("data_op"))
    dec = codec.decode_event_fields(lg.select(F.parse_json(text).alias("event")))
    return dec.select("eid", "meta_event_type", format_offset_datetime("occurred_at").alias("occurred_at_text"),
                      format_offset_datetime("received_at").alias("received_at_text"),
                      F.to_json("parent_eids").alias("parent_eids"), "flow_id")


def decode_data_change(spark, sf):
    return fx.events(spark, sf).filter(F.col("kind") == "data") \
        .select("eid", "data_type", "data_op", "payload")


def decode_business(spark, sf):
    return fx.events(spark, sf).filter(F.col("kind") == "business").select("eid", "payload")


def normalise_data_op(spark, sf):
    return fx.events(spark, sf).filter(F.col("kind") == "data") \
        .groupBy("data_op").agg(F.count(F.lit(1)).alias("n_events"))


def normalise_category(spark, sf):
    return fx.event_type_defs(spark, sf).select(
        "name", F.col("version").cast("bigint").alias("version"),
        codec.normalise_category("category").alias("category"))


def parse_offset_datetime_q(spark, sf):
    t = fx.datetime_texts(spark, sf)
    return t.select("event_id", "text", F.unix_micros(parse_offset_datetime("text")).alias("parsed_us"))


def format_offset_datetime_q(spark, sf):
    return fx.log(spark, sf).select("event_id", format_offset_datetime("occurred_at").alias("occurred_at_text"))


def encode_events(spark, sf):
    return codec.encode_log_events(fx.log(spark, sf)).select("eid", "event_json")


def round_trip_events(spark, sf):
    """Encode the log, decode it again, compare both ways."""
    lg = fx.log(spark, sf)
    enc = codec.encode_log_events(lg).select(F.parse_json("event_json").alias("event"))
    dec = codec.decode_event_fields(enc)
    cols = ["eid", "kind", "data_type", "data_op", "flow_id", "occurred_at", "meta_event_type"]
    # the decoder normalises unknown data ops to UnknownValue(x), which is
    # also what it re-encodes: compare against the normalised original
    left = lg.select("eid", "kind", "data_type", codec.normalise_data_op("data_op").alias("data_op"),
                     "flow_id", "occurred_at",
                     F.col("event_type").alias("meta_event_type"),
                     F.to_json(F.parse_json("payload")).alias("payload"))
    right = dec.select(*cols, "payload")
    # exceptAll in both directions as one tagged aggregate: per distinct row,
    # how often it occurs on each side (one scan of each side)
    tagged = left.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0)).unionByName(
        right.withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1)))
    per_row = tagged.groupBy(*cols, "payload").agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
    return per_row.agg(
        F.sum("l").cast("bigint").alias("n_events"),
        F.coalesce(F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0))), F.lit(0)).cast("bigint")
        .alias("n_only_original"),
        F.coalesce(F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0))), F.lit(0)).cast("bigint")
        .alias("n_only_round_trip"))


def encode_cursors(spark, sf):
    hw = offsets.high_water_offsets(fx.log(spark, sf)).withColumnRenamed("high_water", "offset")
    return codec.encode_cursors(hw, ["event_type"])


def encode_batches(spark, sf):
    w = wire_lines(fx.log(spark, sf), batch_limit=5, faults=False, keep_alives=False)
    return w.select(*KEYS, "cursor_offset", "value")


def decode_event_types(spark, sf):
    d = codec.decode_event_types(fx.event_type_texts(spark, sf))
    return d.select("name", "valid", "category",
                    F.size("partition_key_fields").cast("bigint").alias("n_key_fields"),
                    F.col("statistics.expected_write_rate").alias("expected_write_rate"))


# --------------------------------------------------------------------------- C: offsets

def offset_to_long_q(spark, sf):
    t = fx.offset_texts(spark, sf)
    return t.select("event_id", "text", offset_to_long("text").alias("value"),
                    offset_error("text").alias("error"))


def partition_key_hash_q(spark, sf):
    """C2 on every log row (the key a consumer computes per message), then
    the distinct keys."""
    return fx.log(spark, sf).select(*KEYS, partition_key_hash("event_type", "partition").alias("key")).distinct()


def _lookups(spark, sf):
    p = fx.partitions(spark, sf)
    extra = p.select("event_type").distinct().select("event_type", F.lit("9").alias("partition"))
    return p.unionByName(extra)


def _omap(spark, sf, cut):
    return offsets.offset_map(fx.high_water_before(spark, sf, cut))


def last_offset(spark, sf):
    return offsets.last_offset(_lookups(spark, sf), _omap(spark, sf, fx.CUT_B)) \
        .select(*KEYS, "last_offset")


def last_offset_required(spark, sf):
    return offsets.last_offset_required(_lookups(spark, sf), _omap(spark, sf, fx.CUT_B))


def register_commits(spark, sf):
    m = with_arrival_seq(fx.log(spark, sf))
    return offsets.register_commits(m).select("event_id", *KEYS, "offset", "arrival_seq", "accepted")


def high_water_offsets(spark, sf):
    m = consume.drop_keep_alives(fx.messages(spark, sf))
    return offsets.high_water_offsets(m, "cursor_offset_long")


def _upsert_writes(spark, sf):
    hw = fx.high_water_before(spark, sf, fx.CUT_C)
    w1 = offsets.with_key(hw.filter(F.col("partition").isin("0", "1"))) \
        .select("key", F.col("high_water").alias("offset"), F.lit(1).alias("write_seq"))
    parts = fx.partitions(spark, sf)
    w2 = offsets.with_key(parts.filter(F.col("partition") == "2")) \
        .select("key", F.lit(3).cast("bigint").alias("offset"), F.lit(2).alias("write_seq"))
    w3 = offsets.with_key(parts.filter(F.col("partition") == "0")
                          .select("event_type", F.lit("7").alias("partition"))) \
        .select("key", F.lit(42).cast("bigint").alias("offset"), F.lit(3).alias("write_seq"))
    return w1.unionByName(w2).unionByName(w3)


def offset_map_upsert(spark, sf):
    return offsets.offset_map_upsert(_omap(spark, sf, fx.CUT_B), _upsert_writes(spark, sf))


def offset_map_diff(spark, sf):
    return offsets.offset_map_diff(_omap(spark, sf, fx.CUT_C), _omap(spark, sf, fx.CUT_B))


def offset_map_non_empty(spark, sf):
    """Per event type: does the current map differ from the committed one?
    click and view were committed fully, the others only up to CUT_B."""
    lg = fx.log(spark, sf)
    cur = offsets.high_water_offsets(lg)
    committed = offsets.high_water_offsets(
        lg.filter(F.col("event_type").isin("click", "view") | (F.col("occurred_at") < F.to_timestamp(F.lit(fx.CUT_B)))))
    diff = offsets.with_key(cur).select("event_type", "key", F.col("high_water").alias("offset")) \
        .join(offsets.offset_map_diff(offsets.offset_map(cur), offsets.offset_map(committed)),
              ["key", "offset"], "left_semi")
    flags = offsets.offset_map_non_empty(diff, ["event_type"])
    return fx.partitions(spark, sf).select("event_type").distinct().join(flags, "event_type", "left") \
        .select("event_type", F.coalesce("non_empty", F.lit(False)).alias("non_empty"))


def commit_flush_timeline(spark, sf):
    acc = offsets.register_commits(with_arrival_seq(fx.log(spark, sf)))
    return greedy.flush_timeline(acc, KEYS, interval_seconds=6 * 3600)


def uncommitted_on_close(spark, sf):
    acc = offsets.register_commits(with_arrival_seq(fx.log(spark, sf)))
    return greedy.uncommitted_on_close(acc, KEYS, interval_seconds=6 * 3600,
                                       closed_at="2024-02-04 00:00:00")


def acknowledge_offsets(spark, sf):
    cur = _omap(spark, sf, fx.CUT_C)
    hw = fx.high_water_before(spark, sf, fx.CUT_C)
    acked = offsets.with_key(hw).select(
        "key", (F.col("high_water") + F.when(F.col("partition") == "0", 1).otherwise(0)).alias("offset"))
    return offsets.acknowledge_offsets(cur, acked)


# --------------------------------------------------------------------------- D: commits and leases

def _ts_text(c):
    return format_offset_datetime(c)


def validate_lease(spark, sf):
    v = commits.validate_lease(fx.commits(spark, sf), fx.own_counters(spark, sf), fx.NOW)
    return v.select(*commits.TABLE_KEYS, "valid")


def request_lease(spark, sf):
    return commits.request_lease(fx.lease_requests(spark, sf), fx.commits(spark, sf),
                                 fx.own_counters(spark, sf), fx.NOW)


def release_lease(spark, sf):
    req = fx.lease_requests(spark, sf).filter(F.col("partition_id").isin("0", "3"))
    r = commits.release_lease(req, fx.commits(spark, sf), fx.NOW)
    return r.select(*commits.TABLE_KEYS, "released", "lease_counter",
                    _ts_text(F.col("lease_timestamp")).alias("lease_timestamp"), "warning")


def _flush_commits(spark, sf):
    lookups = _lookups(spark, sf)
    found = offsets.last_offset_required(lookups, _omap(spark, sf, fx.CUT_C))
    flushes = lookups.select(F.lit("g1").alias("group_id"), "event_type",
                             F.col("partition").alias("partition_id"))
    return commits.build_commit(flushes, found, "worker-b", "lease-new", fx.NOW)


def build_commit(spark, sf):
    c = _flush_commits(spark, sf)
    return c.select(*commits.TABLE_KEYS, "checkpoint_id", "lease_holder",
                    _ts_text(F.col("lease_timestamp")).alias("lease_timestamp"), "lease_id", "error")


def _table_out(t: DataFrame) -> DataFrame:
    return t.select(*commits.TABLE_KEYS, "checkpoint_id", "lease_holder", "lease_counter",
                    _ts_text(F.col("lease_timestamp")).alias("lease_timestamp"), "lease_id")


def commit_put(spark, sf):
    good = _flush_commits(spark, sf).filter(F.col("error").isNull()).drop("error")
    parts = fx.partitions(spark, sf)
    now = F.to_timestamp(F.lit(fx.NOW))
    g2 = parts.filter(F.col("partition") == "0").select(
        F.lit("g2").alias("group_id"), "event_type", F.col("partition").alias("partition_id"),
        F.lit("1").alias("checkpoint_id"), F.lit("worker-c").alias("lease_holder"),
        F.lit(0).cast("bigint").alias("lease_counter"), now.alias("lease_timestamp"),
        F.lit(None).cast("string").alias("lease_id"))
    g3 = parts.select(
        F.lit("g3").alias("group_id"), "event_type", F.col("partition").alias("partition_id"),
        F.lit("7").alias("checkpoint_id"), F.lit("worker-c").alias("lease_holder"),
        F.when(F.col("partition") == "1", F.lit(5)).cast("bigint").alias("lease_counter"),
        now.alias("lease_timestamp"), F.lit(None).cast("string").alias("lease_id"))
    puts = good.unionByName(g2).unionByName(g3)
    # the stored rows are the first version of each (event type, group) line,
    # the put batch the second of those it touches
    root = _scratch(spark, "commits-put")
    commit_log.load(spark, root, fx.commits(spark, sf))
    commit_log.put(spark, root, puts)
    return _table_out(commit_log.read(spark, root))


def commit_put_twice(spark, sf):
    """D5 with two puts per key in one batch, applied in put_seq order: for
    group g1 (stored rows) and g3 (none)."""
    seq = F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint")))
    puts = fx.lease_requests(spark, sf).filter(F.col("group_id") != "g2") \
        .select("*", seq.alias("put_seq")) \
        .select(*commits.TABLE_KEYS, "put_seq", (F.col("put_seq") + 4).cast("string").alias("checkpoint_id"),
                F.lit("worker-d").alias("lease_holder"),
                F.when(F.col("put_seq") == 1, F.lit(5)).cast("bigint").alias("lease_counter"),
                F.to_timestamp(F.lit(fx.NOW)).alias("lease_timestamp"),
                F.when(F.col("put_seq") == 1, F.lit("lease-d")).alias("lease_id"))
    return _table_out(commits.commit_put(fx.commits(spark, sf), puts))


def _fold_puts(spark, sf):
    """Every delivered batch of the wire log is a commit put, for group g1
    (has stored rows) and group g4 (none)."""
    m = consume.drop_keep_alives(fx.messages(spark, sf))
    b = F.floor(F.col("cursor_offset_long") / 5).cast("bigint")
    holder = F.when(F.floor(F.col("cursor_offset_long") / 50) % 2 == 0, F.lit("worker-a")) \
        .otherwise(F.lit("worker-b"))
    supplied = F.when(b % 17 == 3, F.lit(0)).when(b % 23 == 7, F.lit(5)).cast("bigint")
    lid = F.when(b % 4 == 0, F.concat(F.lit("lease-"), holder, F.lit("-"),
                                      F.floor(b / 40).cast("string")))
    return m.select(F.explode(F.array(F.lit("g1"), F.lit("g4"))).alias("group_id"), "event_type",
                    F.col("partition").alias("partition_id"),
                    F.col("cursor_offset_long").alias("put_seq"),
                    F.col("cursor_offset_long").cast("string").alias("checkpoint_id"),
                    holder.alias("lease_holder"), supplied.alias("lease_counter"),
                    F.to_timestamp(F.lit(fx.NOW)).alias("lease_timestamp"), lid.alias("lease_id"))


def commit_fold(spark, sf):
    """Final table state after every delivered batch was put, by
    grouped aggregates (the per-put states are not needed for it)."""
    puts = _fold_puts(spark, sf).checkpoint(eager=True)      # decoded once, read by two aggregates
    final = commits.commit_fold_final(fx.commits(spark, sf), puts)
    return final.select(*commits.TABLE_KEYS, "checkpoint_id", "lease_holder", "lease_counter", "lease_id")


def commit_get(spark, sf):
    """D7 against the stored table: the fixture rows are loaded as the first
    version of each (event type, group) and read back."""
    root = _scratch(spark, "commits-table")
    commit_log.load(spark, root, fx.commits(spark, sf))
    g = commits.commit_get(commit_log.read(spark, root), fx.lease_requests(spark, sf))
    return g.select(*commits.TABLE_KEYS, "checkpoint_id", "lease_counter")


def lease_counters(spark, sf):
    # the puts come from decoding the wire log and feed two chunked passes:
    # decode once, checkpoint, then fold
    states = commits.commit_fold(fx.commits(spark, sf), _fold_puts(spark, sf).checkpoint(eager=True))
    return commits.lease_counters(states)


# --------------------------------------------------------------------------- S: streaming

def stream_consume(spark, sf):
    """The wire log as a stream -> decoded events (+ quarantine sink), in
    micro-batches that follow the log."""
    src, out = segment_log(spark, sf), _scratch(spark, "stream-consume")
    streams.stream_consume(spark, src, out, max_offsets=max(STREAM_OFFSETS, _live_offsets(spark, src)))
    return consume.partition_summary(streams.read_events(spark, out))


def stream_consume_with_commits(spark, sf):
    """Commits written after each micro-batch; final checkpoint per
    partition = high-water cursor of everything delivered."""
    out = _scratch(spark, "stream-commits")
    root = streams.stream_consume_with_commits(spark, wire_log(spark, sf), out)
    t = commit_log.read(spark, root)
    return t.select(*commits.TABLE_KEYS, "checkpoint_id", "lease_holder", "lease_id")


def stream_consume_two_groups(spark, sf):
    """S2 with two groups in turn on one commits table: both consume the
    first part of the log, then the second part lands and only g1 goes on,
    on its old checkpoint."""
    src, stage = wire_log(spark, sf), _scratch(spark, "two-groups-src")
    root, outs = _scratch(spark, "two-groups-commits"), {g: _scratch(spark, f"two-groups-{g}") for g in ("g1", "g2")}
    lines = spark.read.text(src)
    first = F.col("event_type").isin("click", "error")

    def run(group: str) -> None:
        streams.stream_consume_with_commits(spark, stage, outs[group], group, f"worker-{group}", f"lease-{group}",
                                            table_root=root)

    lines.filter(first).write.partitionBy("event_type").text(stage)
    run("g1")
    run("g2")
    lines.filter(~first).write.mode("append").partitionBy("event_type").text(stage)
    run("g1")
    return commit_log.read(spark, root).select(*commits.TABLE_KEYS, "checkpoint_id", "lease_holder", "lease_id")


def stream_high_water(spark, sf):
    out = _scratch(spark, "stream-high-water")
    streams.stream_high_water(spark, wire_log(spark, sf), out)
    return streams.read_high_water(spark, out)


def stream_republish(spark, sf):
    out = _scratch(spark, "stream-republish")
    streams.stream_republish(spark, wire_log(spark, sf), out, "purchase", "purchase-audit",
                             streams.audit_transform)
    return streams.read_published(spark, out)


def stream_resume(spark, sf):
    """The log lands in two parts; the stream is stopped after the first
    and restarted on the same checkpoint: nothing is lost or repeated."""
    src = wire_log(spark, sf)
    stage = _scratch(spark, "stream-resume-src")
    out = _scratch(spark, "stream-resume")
    lines = spark.read.text(src)
    first = F.col("event_type").isin("click", "error")
    lines.filter(first).write.partitionBy("event_type").text(stage)
    streams.stream_consume(spark, stage, out)
    lines.filter(~first).write.mode("append").partitionBy("event_type").text(stage)
    streams.stream_consume(spark, stage, out)
    return consume.partition_summary(streams.read_events(spark, out))


S5_INTERVAL_SECONDS = 6 * 3600 + 30   # 30 s past whole minutes: no flush time ties the watermark


def stream_flush_timer(spark, sf):
    """Accepted registrations land as Parquet; a keyed state machine with
    event-time timers emits the flushes.  The last open window of each key
    is not flushed when the stream ends (no final flush)."""
    from tidemark.streaming import flush_timer
    stage = _scratch(spark, "registrations")
    out = _scratch(spark, "stream-flush-timer")
    acc = offsets.register_commits(with_arrival_seq(fx.log(spark, sf))).filter(F.col("accepted"))
    acc = acc.select("event_type", "partition", "offset", "arrival_seq",
                     greedy.arrival_time().alias("arrived"))
    acc.write.parquet(stage)
    flush_timer.stream_flush_timer(spark, stage, acc.schema, out, S5_INTERVAL_SECONDS)
    return flush_timer.read_flushes(spark, out)


A7_STREAM_TIMEOUT_SECONDS = 6 * 3600 + 1   # 1 s past the event times' microsecond grid ties: none


def _land_in_time_order(spark, ev: DataFrame, path: str, files: int = 8) -> None:
    """Events as files that landed one after another: ranges of event time,
    file times in that order."""
    ev.repartitionByRange(files, "occurred_at").write.parquet(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((s.getPath().getName(), s) for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
    for k, (_, st) in enumerate(parts):
        fs.setTimes(st.getPath(), st.getModificationTime() - 1000 * (len(parts) - k), -1)


def batch_by_count_or_time_stream(spark, sf, max_files: int = 2):
    """A7 live: events after the A4 cursors land as Parquet; a keyed state
    machine closes batches at 4 events or 6 h after their first event,
    over several micro-batches.
    Batches still open when the stream ends are not emitted."""
    from tidemark.streaming import flush_timer
    stage = _scratch(spark, "batch-events")
    out = _scratch(spark, "stream-batches")
    ev = consume.read_from_cursor(fx.log(spark, sf), fx.explicit_cursors(spark, sf),
                                  event_types=fx.event_types(spark, sf))
    ev = ev.select("event_type", "partition", "offset", "occurred_at")
    _land_in_time_order(spark, ev, stage)
    flush_timer.stream_batches(spark, stage, ev.schema, out, 4, A7_STREAM_TIMEOUT_SECONDS, max_files)
    b = spark.read.parquet(f"{out}/batches")
    return b.select(*KEYS, F.col("last_offset").alias("batch_cursor"), "first_offset", "n_events")


def detect_stalled_partitions_stream(spark, sf, max_files: int = 2):
    """A13 live: the log's events land as Parquet and stream through a
    per-partition stall detector (event-time timers, flush timeout 1 h, stall
    limit 1.5 h).  Per partition: stalls between events, the largest such
    gap, and whether the partition was stalled when the stream ended."""
    from tidemark.streaming import flush_timer
    stage = _scratch(spark, "stall-events")
    out = _scratch(spark, "stream-stalls")
    ev = fx.log(spark, sf).select("event_type", "partition", "offset", "occurred_at")
    _land_in_time_order(spark, ev, stage)
    flush_timer.stream_stalls(spark, stage, ev.schema, out, flush_timeout_seconds=3600, max_files=max_files)
    st = spark.read.parquet(f"{out}/stalls")
    gap, last = F.col("kind") == "gap", F.col("offset")
    # an open stall is over once the message after the same offset came
    return st.groupBy(*KEYS).agg(
        F.count_if(gap).cast("bigint").alias("n_stalls"),
        F.floor(F.max("gap_us") / 1_000_000).cast("bigint").alias("max_gap_seconds"),
        (F.coalesce(F.max(F.when(~gap, last)), F.lit(-1)) > F.coalesce(F.max(F.when(gap, last)), F.lit(-1)))
        .alias("stalled_at_end"))


#: A live query takes a 20th of what its log holds in a micro-batch, whose
#: cost besides its rows is fixed; never fewer offsets than at sf0.1, and never
#: more than one task can hold if all are of one partition.
LIVE_SHARE, LIVE_LEAST, LIVE_MOST = 20, STREAM_OFFSETS // 5, 1 << 20


def _live_offsets(spark, src: str) -> int:
    held = segments.manifest(spark, src).agg(F.sum(F.col("last_offset") - F.col("first_offset") + 1)).first()[0] or 0
    return min(max(LIVE_LEAST, held // LIVE_SHARE), LIVE_MOST)


def batch_by_count_or_time_live(spark, sf, max_offsets: int | None = None):
    """A7 live on the wire log in its own order: offsets after the A4 cursors,
    several micro-batches, each partition by its own clock.  A batch still
    open when the log ends is not emitted."""
    from tidemark.streaming import flush_timer
    src, out = segment_log(spark, sf), _scratch(spark, "live-batches")
    ev = streams.stream_events(spark, src, f"{out}/_checkpoint", max_offsets or _live_offsets(spark, src),
                               fx.explicit_cursors(spark, sf))
    flush_timer.own_clock_batches(ev, out, 4, A7_STREAM_TIMEOUT_SECONDS)
    b = spark.read.parquet(f"{out}/batches")
    return b.select(*KEYS, F.col("last_offset").alias("batch_cursor"), "first_offset", "n_events")


def detect_stalled_partitions_live(spark, sf, max_offsets: int | None = None):
    """A13 live on the wire log in its own order, each partition by its own clock."""
    from tidemark.streaming import flush_timer
    src, out = segment_log(spark, sf), _scratch(spark, "live-stalls")
    ev = streams.stream_events(spark, src, f"{out}/_checkpoint", max_offsets or _live_offsets(spark, src))
    flush_timer.own_clock_stalls(ev, out, 3600)
    st = spark.read.parquet(f"{out}/stalls")
    return st.filter(F.col("kind") == "gap").groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_stalls"), F.floor(F.max("gap_us") / 1_000_000).cast("bigint").alias("max_gap_seconds"))


# --------------------------------------------------------------------------- registry

QUERIES: dict[str, Query] = {
    # A: sources, consume, publish
    "scan_batch_log": scan_batch_log,
    "stream_batch_log": stream_batch_log_q,
    "resolve_start_cursor": resolve_start_cursor,
    "read_from_cursor": read_from_cursor,
    "read_from_mixed_cursors": read_from_mixed_cursors,
    "consume_all_partitions": consume_all_partitions,
    "consume_after_cursors": consume_after_cursors,
    "consume_wire_log": consume_wire_log,
    "land_decoded_log": land_decoded_log,
    "batch_by_count": batch_by_count,
    "batch_by_count_or_time": batch_by_count_or_time,
    "limit_stream": limit_stream,
    "limit_stream_by_time": limit_stream_by_time,
    "close_on_keep_alives": close_on_keep_alives,
    "drop_keep_alives": drop_keep_alives,
    "to_consumer_message": to_consumer_message,
    "detect_stalled_partitions": detect_stalled_partitions,
    "publish_messages": publish_messages,
    "publish_flow_header": publish_flow_header,
    "publish_with_markers": publish_with_markers,
    "republish": republish,
    "republish_bodies": republish_bodies,
    "register_event_types": register_event_types,
    # B: codec
    "decode_batches": decode_batches,
    "quarantine_batches": quarantine_batches,
    "quarantine_landed": quarantine_landed,
    "validation_report": validation_report,
    "explode_events": explode_events,
    "classify_events": classify_events,
    "decode_metadata": decode_metadata,
    "decode_full_metadata": decode_full_metadata,
    "decode_data_change": decode_data_change,
    "decode_business": decode_business,
    "normalise_data_op": normalise_data_op,
    "normalise_category": normalise_category,
    "parse_offset_datetime": parse_offset_datetime_q,
    "encode_events": encode_events,
    "format_offset_datetime": format_offset_datetime_q,
    "round_trip_events": round_trip_events,
    "encode_cursors": encode_cursors,
    "encode_batches": encode_batches,
    "decode_event_types": decode_event_types,
    # C: offsets
    "offset_to_long": offset_to_long_q,
    "partition_key_hash": partition_key_hash_q,
    "last_offset": last_offset,
    "last_offset_required": last_offset_required,
    "register_commits": register_commits,
    "high_water_offsets": high_water_offsets,
    "offset_map_upsert": offset_map_upsert,
    "offset_map_diff": offset_map_diff,
    "offset_map_non_empty": offset_map_non_empty,
    "commit_flush_timeline": commit_flush_timeline,
    "uncommitted_on_close": uncommitted_on_close,
    "acknowledge_offsets": acknowledge_offsets,
    # D: commits and leases
    "validate_lease": validate_lease,
    "request_lease": request_lease,
    "release_lease": release_lease,
    "build_commit": build_commit,
    "commit_put": commit_put,
    "commit_put_twice": commit_put_twice,
    "commit_fold": commit_fold,
    "commit_get": commit_get,
    "lease_counters": lease_counters,
    # S: streaming (checked against their batch twins)
    "stream_consume": stream_consume,
    "stream_consume_with_commits": stream_consume_with_commits,
    "stream_consume_two_groups": stream_consume_two_groups,
    "stream_high_water": stream_high_water,
    "stream_republish": stream_republish,
    "stream_resume": stream_resume,
    "stream_flush_timer": stream_flush_timer,
    "batch_by_count_or_time_stream": batch_by_count_or_time_stream,
    "detect_stalled_partitions_stream": detect_stalled_partitions_stream,
    "batch_by_count_or_time_live": batch_by_count_or_time_live,
    "detect_stalled_partitions_live": detect_stalled_partitions_live,
}
