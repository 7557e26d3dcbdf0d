"""The commits table: puts, folds, gets and leases.

One table for all consumer groups and event types, one row per
(group_id, event_type, partition_id), stored as Parquet partitioned by
(event_type, group_id) - the reference's per-(event type, group) table is a
partition directory here (D9), so a get or put for one pair only touches
its directory.  Columns: checkpoint_id, lease_holder, lease_counter,
lease_timestamp, lease_id.

Plain Parquet has no MERGE, so a put batch produces a new table version:
the full outer join of the current rows with the puts, written to a new
directory (the version is the commit point).  ``now`` is always a
parameter so results are reproducible.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import fill_message
from tidemark.plans.joins import broadcast_if_small
from tidemark.plans.numbering import chunked_running, chunked_running_multi, offset_chunk
from tidemark.settings import STALE_LEASE_SECONDS

TABLE_KEYS = ["group_id", "event_type", "partition_id"]
TABLE_COLUMNS = [*TABLE_KEYS, "checkpoint_id", "lease_holder", "lease_counter",
                 "lease_timestamp", "lease_id"]
TABLE_SCHEMA = ("partition_id string, checkpoint_id string, lease_holder string, lease_counter bigint, "
                "lease_timestamp timestamp, lease_id string, event_type string, group_id string")

# Fixed value: the warning for releasing a lease that has no stored row.
NO_LEASE_MESSAGE = "No lease exists to release for group: '{group_id}' eventType: '{event_type}' partition: '{partition_id}'"


def _ts(text: str) -> Column:
    return F.to_timestamp(F.lit(text))


# --------------------------------------------------------------------------- leases

def validate_lease(stored: DataFrame, own_counters: DataFrame, now: str) -> DataFrame:
    """Valid iff the stored counter equals the holder's own counter for
    the partition (own default 0), or the stored lease timestamp is before
    now.  A null stored counter only lets the timestamp count.

    ``own_counters``: group_id, event_type, partition_id, own_counter."""
    j = stored.join(own_counters, TABLE_KEYS, "left")
    own = F.coalesce(F.col("own_counter"), F.lit(0))
    valid = (F.col("lease_counter").isNotNull() & (F.col("lease_counter") == own)) | \
            (F.col("lease_timestamp") < _ts(now))
    return j.withColumn("valid", valid)


def request_lease(requests: DataFrame, stored: DataFrame, own_counters: DataFrame,
                  now: str) -> DataFrame:
    """No stored row -> available; otherwise the D1 answer."""
    v = validate_lease(stored, own_counters, now).select(*TABLE_KEYS, F.col("valid").alias("_valid"))
    j = requests.join(v, TABLE_KEYS, "left")
    return j.select(*requests.columns,
                    F.when(F.col("_valid").isNull(), F.lit(True)).otherwise(F.col("_valid"))
                    .alias("available"))


def release_lease(requests: DataFrame, stored: DataFrame, now: str) -> DataFrame:
    """D3: existing row -> a put with timestamp now and counter 0, all else
    kept; no row -> a warning (no put)."""
    j = requests.join(stored.withColumn("_stored", F.lit(True)), TABLE_KEYS, "left")
    exists = F.col("_stored").isNotNull()
    warning = fill_message(NO_LEASE_MESSAGE, group_id="group_id", event_type="event_type",
                       partition_id="partition_id")
    return j.select(*TABLE_KEYS, "checkpoint_id", "lease_holder",
                    F.when(exists, F.lit(0).cast("bigint")).alias("lease_counter"),
                    F.when(exists, _ts(now)).alias("lease_timestamp"), "lease_id",
                    exists.alias("released"), F.when(~exists, warning).alias("warning"))


def build_commit(flushes: DataFrame, omap_found: DataFrame, lease_holder: str, lease_id: str,
                 now: str, stale_seconds: int = STALE_LEASE_SECONDS) -> DataFrame:
    """A flush of one partition becomes a put: checkpoint = the map's
    offset as text (missing key -> error), holder, lease id, timestamp =
    now + stale delta, no counter.

    ``flushes``: group_id, event_type, partition_id.  ``omap_found``: the C4
    result (event_type, partition, checkpoint, error)."""
    m = omap_found.select("event_type", F.col("partition").alias("partition_id"), "checkpoint", "error")
    j = flushes.join(m, ["event_type", "partition_id"], "left")
    return j.select(*TABLE_KEYS, F.col("checkpoint").alias("checkpoint_id"),
                    F.lit(lease_holder).alias("lease_holder"),
                    F.lit(None).cast("bigint").alias("lease_counter"),
                    (_ts(now) + F.make_dt_interval(secs=F.lit(stale_seconds))).alias("lease_timestamp"),
                    F.lit(lease_id).alias("lease_id"),
                    F.coalesce("error", F.when(F.col("checkpoint").isNull(), F.lit("no offset")))
                    .alias("error"))


# --------------------------------------------------------------------------- puts

def commit_put(current: DataFrame, puts: DataFrame) -> DataFrame:
    """Puts against the current table.

    Insert: counter := 1 (a supplied counter is ignored).  Update: counter
    := supplied value, else old + 1; checkpoint, holder and timestamp are
    replaced; the lease id only when one is supplied.  Unconditional - the
    checkpoint may move back.

    Several puts of one key need their order: with a ``put_seq`` column they
    are applied in it (D6), without one the query fails."""
    if "put_seq" in puts.columns:
        kept = current.select(*TABLE_COLUMNS).join(puts.select(*TABLE_KEYS).distinct(), TABLE_KEYS, "left_anti")
        return kept.unionByName(commit_fold_final(current, puts))
    cur = current.select(*TABLE_KEYS, F.lit(True).alias("_old"),
                         *[F.col(c).alias("_o_" + c) for c in TABLE_COLUMNS[3:]])
    one = puts.groupBy(*TABLE_KEYS).agg(F.count(F.lit(1)).alias("_n"),
                                        F.any_value(F.struct(*TABLE_COLUMNS[3:])).alias("_p"))
    single = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit("several puts without put_seq for "), F.concat_ws("/", *TABLE_KEYS))).cast("boolean"))
    one = one.select(*TABLE_KEYS, F.col("_p.*"), single.alias("_put"))
    j = cur.join(one, TABLE_KEYS, "full_outer")
    has_old = F.col("_old").isNotNull()
    has_put = F.col("_put").isNotNull()
    counter = (F.when(~has_put, F.col("_o_lease_counter"))
               .when(~has_old, F.lit(1))
               .otherwise(F.coalesce(F.col("lease_counter"),
                                     F.coalesce(F.col("_o_lease_counter"), F.lit(0)) + 1)))
    pick = lambda c: F.when(has_put, F.col(c)).otherwise(F.col("_o_" + c))
    return j.select(*TABLE_KEYS, pick("checkpoint_id").alias("checkpoint_id"),
                    pick("lease_holder").alias("lease_holder"),
                    counter.cast("bigint").alias("lease_counter"),
                    pick("lease_timestamp").alias("lease_timestamp"),
                    F.when(has_put, F.coalesce(F.col("lease_id"), F.col("_o_lease_id")))
                    .otherwise(F.col("_o_lease_id")).alias("lease_id"))


def commit_fold(current: DataFrame, puts: DataFrame, rows_per_chunk: int = 1 << 20) -> DataFrame:
    """The state after every put of an ordered sequence per key.

    ``puts``: TABLE_KEYS, put_seq, checkpoint_id, lease_holder,
    lease_counter (supplied, nullable), lease_timestamp, lease_id.

    Counter after put k = base of the last *reset* at or before k plus the
    number of puts after that reset.  A reset is the first put of a key
    without a stored row (base 1, supplied counter ignored) or a later put
    carrying a counter (base = that counter).  Without any reset the base is
    the stored counter.  Lease id = last supplied one, else the stored one.
    Everything is a chunked running count/max along put_seq, so a key with
    a huge put history is still spread over many tasks."""
    stored = current.select(*TABLE_KEYS, F.col("lease_counter").alias("_s_counter"),
                            F.col("lease_id").alias("_s_lease"), F.lit(True).alias("_stored"))
    p = puts.join(stored, TABLE_KEYS, "left")
    chunk = offset_chunk("put_seq", rows_per_chunk)
    lid = F.when(F.col("lease_id").isNotNull(),
                 F.struct(F.col("put_seq").alias("s"), F.col("lease_id").alias("l")))
    # pass 1: put index, first put of the key, last supplied lease id
    p = chunked_running_multi(p, TABLE_KEYS, ["put_seq"], chunk,
                              [("_i", "count", None), ("_first", "min", "put_seq"), ("_last_lid", "max", lid)])
    first_insert = F.col("_stored").isNull() & (F.col("put_seq") == F.col("_first"))
    base = F.when(first_insert, F.lit(1).cast("bigint")) \
        .when(F.col("lease_counter").isNotNull(), F.col("lease_counter"))
    reset = F.when(base.isNotNull(), F.struct(F.col("_i").alias("i"), base.alias("b")))
    # pass 2: the last reset at or before each put
    p = chunked_running(p, TABLE_KEYS, ["put_seq"], chunk, out="_last_reset", how="max", value=reset)
    counter = F.when(F.col("_last_reset").isNotNull(),
                     F.col("_last_reset.b") + F.col("_i") - F.col("_last_reset.i")) \
        .otherwise(F.coalesce(F.col("_s_counter"), F.lit(0)) + F.col("_i"))
    return p.select(*TABLE_KEYS, "put_seq", "checkpoint_id", "lease_holder",
                    counter.cast("bigint").alias("lease_counter"), "lease_timestamp",
                    F.coalesce(F.col("_last_lid.l"), F.col("_s_lease")).alias("lease_id"))


def commit_fold_final(current: DataFrame, puts: DataFrame) -> DataFrame:
    """D6 final state per key with grouped aggregates only (no per-put
    windows): partial aggregation on the map side, one key-sized join.

    The last reset of a key is its latest put that supplies a counter,
    unless that put is the very first put of a key without a stored row (an
    insert ignores the supplied counter; base 1).  Then
    counter = base + number of puts after the reset; with no reset at all,
    stored counter + number of puts."""
    stored = current.select(*TABLE_KEYS, F.col("lease_counter").alias("_s_counter"),
                            F.col("lease_id").alias("_s_lease"), F.lit(True).alias("_stored"))
    last = F.struct(*[F.col(c) for c in ("checkpoint_id", "lease_holder", "lease_timestamp")])
    per_key = puts.groupBy(*TABLE_KEYS).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("put_seq").alias("_first_seq"),
        F.max_by(last, "put_seq").alias("_last"),
        F.max(F.when(F.col("lease_counter").isNotNull(), F.col("put_seq"))).alias("_seq_c"),
        F.max_by(F.col("lease_counter"), F.when(F.col("lease_counter").isNotNull(), F.col("put_seq")))
        .alias("_c"),
        F.max_by(F.col("lease_id"), F.when(F.col("lease_id").isNotNull(), F.col("put_seq"))).alias("_lid"))
    k = per_key.join(stored, TABLE_KEYS, "left")
    insert_reset = F.col("_stored").isNull() & (F.col("_seq_c").isNull() | (F.col("_seq_c") == F.col("_first_seq")))
    k = k.withColumn("_reset_seq", F.when(insert_reset, F.col("_first_seq")).otherwise(F.col("_seq_c"))) \
        .withColumn("_base", F.when(insert_reset, F.lit(1).cast("bigint")).otherwise(F.col("_c")))
    # puts after the reset: a second aggregate over puts joined with the
    # one-row-per-key reset table, broadcast when small so that the puts of
    # a hot key stay spread out
    k = broadcast_if_small(k)
    after = puts.select(*TABLE_KEYS, "put_seq").join(k.select(*TABLE_KEYS, "_reset_seq"), TABLE_KEYS) \
        .groupBy(*TABLE_KEYS).agg(F.count_if(F.col("put_seq") > F.col("_reset_seq")).alias("_after"))
    k = k.join(after, TABLE_KEYS, "left")
    counter = F.when(F.col("_reset_seq").isNotNull(), F.col("_base") + F.col("_after")) \
        .otherwise(F.coalesce(F.col("_s_counter"), F.lit(0)) + F.col("_n"))
    return k.select(*TABLE_KEYS, F.col("_last.checkpoint_id").alias("checkpoint_id"),
                    F.col("_last.lease_holder").alias("lease_holder"),
                    counter.cast("bigint").alias("lease_counter"),
                    F.col("_last.lease_timestamp").alias("lease_timestamp"),
                    F.coalesce(F.col("_lid"), F.col("_s_lease")).alias("lease_id"))


def fold_final(states: DataFrame) -> DataFrame:
    """Final row per key of a D6 fold (grouped ``max_by``)."""
    s = F.struct(*[F.col(c) for c in TABLE_COLUMNS[3:]])
    return states.groupBy(*TABLE_KEYS).agg(F.max_by(s, "put_seq").alias("_s")) \
        .select(*TABLE_KEYS, *[F.col("_s." + c).alias(c) for c in TABLE_COLUMNS[3:]])


def lease_counters(states: DataFrame) -> DataFrame:
    """Per holder and partition, the counter returned by its last put
    (0 when absent)."""
    return (states.groupBy("lease_holder", *TABLE_KEYS)
            .agg(F.max_by(F.coalesce(F.col("lease_counter"), F.lit(0)), "put_seq").alias("counter")))


def commit_get(table: DataFrame, requests: DataFrame) -> DataFrame:
    """The row for each requested key, or nulls when absent.  With the
    table partitioned by (event_type, group_id) the scan is pruned to the
    requested directories (dynamic partition pruning from the request side)."""
    return requests.join(table, TABLE_KEYS, "left")


def commit_get_one(table: DataFrame, group_id: str, event_type: str, partition_id: str) -> DataFrame:
    """D7 for one key: literal predicates prune the scan to one directory."""
    return table.filter((F.col("event_type") == event_type) & (F.col("group_id") == group_id)
                        & (F.col("partition_id") == partition_id))


# --------------------------------------------------------------------------- storage

def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _claim_version(spark: SparkSession, root: str, version: int, writer: str) -> None:
    """Reserve a version for one writer.  The claim file is created
    exclusively: a second writer of the table fails instead of overwriting."""
    fs, p = _fs(spark, f"{root}/_claims/v={version:010d}")
    if not fs.exists(p):
        try:
            out = fs.create(p, False)
            out.writeUTF(writer)
            out.close()
        except Exception:  # noqa: BLE001 - another writer was first: its claim is read below
            if not fs.exists(p):
                raise
    src = fs.open(p)
    owner = src.readUTF()
    src.close()
    if owner != writer:
        raise RuntimeError(f"version {version} of {root} belongs to writer {owner}")


def write_table_version(spark: SparkSession, table: DataFrame, root: str, version: int,
                        writer: str | None = None, keep: int | None = None) -> str:
    """Write a full table version; readers switch by reading the highest
    complete version (``_SUCCESS`` present).

    A named ``writer`` may write its own version again (a replayed
    micro-batch), never another writer's; without a name an existing version
    is an error.  ``keep``: number of newest versions that stay."""
    _claim_version(spark, root, version, writer or uuid.uuid4().hex)
    path = f"{root}/v={version:010d}"
    table.select(*TABLE_COLUMNS).write.mode("overwrite") \
        .partitionBy("event_type", "group_id").parquet(path)
    if keep:
        for old in [v for v in versions(spark, root) if v <= version][:-keep]:
            fs, p = _fs(spark, f"{root}/v={old:010d}")
            fs.delete(p, True)
    return path


def versions(spark: SparkSession, root: str) -> list[int]:
    """The complete versions of a table, oldest first."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and fs.exists(_fs(spark, f"{root}/{n}/_SUCCESS")[1]))


def read_latest_version(spark: SparkSession, root: str) -> DataFrame | None:
    return read_version_at_or_below(spark, root, 1 << 62)


def read_version_at_or_below(spark: SparkSession, root: str, version: int) -> DataFrame | None:
    """The newest complete table version <= ``version`` (replay-safe base)."""
    found = [v for v in versions(spark, root) if v <= version]
    if not found:
        return None
    return spark.read.schema(TABLE_SCHEMA).parquet(f"{root}/v={found[-1]:010d}").select(*TABLE_COLUMNS)
