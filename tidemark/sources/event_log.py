"""The canonical event log (FIXTURES F1), derived from ``events.parquet``.

Columns: event_type, partition, offset, offset_text, eid, occurred_at, kind,
data_type, data_op, flow_id, payload, plus the source event_id and user_id.

Offsets are the per-(event_type, partition) row number in (ts, event_id)
order, minus one.  They are assigned with the chunked running count (time
buckets as chunks), so a partition holding a third of the log is still
numbered by many tasks.  The result is written once as Parquet partitioned
by event_type and sorted by (partition, offset) inside each file, so reads
prune event-type directories and skip row groups on offset min/max.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.offsets import offset_text
from tidemark.plans.numbering import chunked_running, hash_prefix_chunk, time_chunk
from tidemark.session import checkpoint_root, session_key

# Fixed values of the fixture definition.
N_PARTITIONS = 4                       # partition = user_id % 4
DATA_OP_BY_MOD4 = ["C", "U", "D", "S"]  # data_op by event_id % 4
UNKNOWN_OP = "X"                       # data_op when event_id % 101 = 0
BUSINESS_MOD = 3                       # business iff event_id % 3 = 0
NO_FLOW_MOD = 5                        # no flow id iff event_id % 5 = 0

LOG_COLUMNS = ["event_type", "partition", "offset", "offset_text", "eid", "occurred_at",
               "kind", "data_type", "data_op", "flow_id", "payload", "event_id", "user_id", "arrival_seq"]


def number_events(events: DataFrame, chunk_seconds: int = 60) -> DataFrame:
    """Offset and arrival_seq over the raw columns.  All else of F1 is a
    function of these, so what the numbering shuffles is only them; the eid
    travels as its 16 bytes, which sort like its text."""
    raw = events.select("event_type", (F.col("user_id") % N_PARTITIONS).cast("string").alias("partition"),
                        "event_id", "user_id", F.col("ts").cast("timestamp").alias("occurred_at"),
                        F.col("props").alias("payload"))
    numbered = chunked_running(raw, ["event_type", "partition"], ["occurred_at", "event_id"],
                               chunk=time_chunk("occurred_at", chunk_seconds), out="_rn")
    numbered = numbered.withColumn("offset", F.col("_rn") - 1).drop("_rn")
    # out-of-order arrival, precomputed once (one global order)
    keyed = numbered.withColumn("_eid", F.unhex(F.md5(F.col("event_id").cast("string"))))
    first = hash_prefix_chunk(F.hex(F.substring("_eid", 1, 2)), 4)
    return chunked_running(keyed, [], ["_eid", "event_id"], chunk=first, out="arrival_seq").drop("_eid")


def describe_events(numbered: DataFrame) -> DataFrame:
    """The columns of F1 that follow from a numbered event alone."""
    eid = F.col("event_id")
    return numbered.select(
        "*", offset_text("offset").alias("offset_text"),
        F.md5(eid.cast("string")).alias("eid"),
        F.when(eid % BUSINESS_MOD == 0, "business").otherwise("data").alias("kind"),
        F.when(eid % BUSINESS_MOD != 0, F.col("event_type")).alias("data_type"),
        F.when(eid % BUSINESS_MOD == 0, F.lit(None).cast("string"))
         .when(eid % 101 == 0, F.lit(UNKNOWN_OP))
         .otherwise(F.element_at(F.array(*[F.lit(x) for x in DATA_OP_BY_MOD4]),
                                 (eid % 4 + 1).cast("int"))).alias("data_op"),
        F.when(eid % NO_FLOW_MOD != 0, F.concat(F.lit("flow-"), F.col("user_id").cast("string")))
         .alias("flow_id")).select(*LOG_COLUMNS)


def derive_event_log(events: DataFrame, chunk_seconds: int = 60) -> DataFrame:
    """F1 as a lazy plan over the raw ``events`` table."""
    return describe_events(number_events(events, chunk_seconds))


def _code_signature() -> str:
    """Hash of the code that shapes materialised logs, so a change to the
    encoders never reads a stale copy."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for rel in ("sources/event_log.py", "sources/batch_log.py", "operators/codec.py",
                "functions/datetime.py", "functions/offsets.py", "plans/numbering.py"):
        try:
            with open(os.path.join(here, rel), "rb") as f:
                h.update(f.read())
        except OSError:
            h.update(rel.encode())
    return h.hexdigest()


def _source_tag(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the source table: path, size and newest file of
    ``events.parquet`` (a file or a folder) on whatever store holds it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    newest = max((st.getModificationTime() for st in fs.listStatus(p)), default=0)
    sig = f"{fs.makeQualified(p)}|{fs.getContentSummary(p).getLength()}|{newest}"
    return hashlib.sha1((sig + "|" + _code_signature()).encode()).hexdigest()[:16]


def log_root(spark: SparkSession, sf_dir: str) -> str:
    return f"{checkpoint_root(spark)}/tidemark-logs/{_source_tag(spark, sf_dir)}"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def materialise(spark: SparkSession, path: str, write) -> None:
    """Run ``write(path)`` once; the ``_SUCCESS`` marker of a completed
    Spark write means done (a failed or half-written attempt is redone)."""
    if not exists(spark, f"{path}/_SUCCESS"):
        write(path)


LOG_SCHEMA = ("partition string, offset bigint, offset_text string, eid string, occurred_at timestamp, "
              "kind string, data_type string, data_op string, flow_id string, payload string, "
              "event_id bigint, user_id bigint, arrival_seq bigint, event_type string")

# Reading a materialised table lists its files once per session; queries
# that combine several views of the log reuse the same DataFrame.
_READ_CACHE: dict[tuple[str, str], DataFrame] = {}


def cached_read(spark: SparkSession, path: str, read) -> DataFrame:
    key = (session_key(spark), path)
    df = _READ_CACHE.get(key)
    if df is None:
        df = read()
        _READ_CACHE[key] = df
    return df


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical log, materialised once per source table version."""
    path = f"{log_root(spark, sf_dir)}/event_log"
    key = (session_key(spark), path)
    if key in _READ_CACHE:
        return _READ_CACHE[key]

    def build():
        ev = spark.read.parquet(f"{sf_dir}/events.parquet")
        # Cluster by (event_type, partition) and sort by offset so each file
        # holds offset ranges: Parquet min/max statistics then skip row groups
        # for cursor predicates.
        return describe_events(number_events(ev)
                               .repartitionByRange("event_type", "partition", "offset")
                               .sortWithinPartitions("event_type", "partition", "offset"))

    materialise(spark, path, lambda p: build().write.mode("overwrite").partitionBy("event_type").parquet(p))
    return cached_read(spark, path, lambda: spark.read.schema(LOG_SCHEMA).parquet(path).select(*LOG_COLUMNS))


def partition_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic layout: one row per (event_type, partition), with its
    event count and offset range; written once next to the log (the log's
    metadata, so consumers never scan the log to list partitions)."""
    path = f"{log_root(spark, sf_dir)}/partitions"

    def write(p: str) -> None:
        (event_log(spark, sf_dir).groupBy("event_type", "partition")
         .agg(F.count(F.lit(1)).alias("n_events"), F.min("offset").alias("first_offset"),
              F.max("offset").alias("last_offset"))
         .write.mode("overwrite").parquet(p))

    key = (session_key(spark), path)
    if key not in _READ_CACHE:
        materialise(spark, path, write)
    return cached_read(spark, path, lambda: spark.read.schema(
        "event_type string, partition string, n_events bigint, first_offset bigint, last_offset bigint")
        .parquet(path))


def with_arrival_seq(log: DataFrame, hex_digits: int = 4) -> DataFrame:
    """Out-of-order arrival: ``arrival_seq`` = global rank by eid (an MD5).

    A global row number normally means one task; here the uniform hash is
    cut into 16**hex_digits chunks by its leading digits and numbered with
    the chunked running count.  The materialised log already carries it."""
    if "arrival_seq" in log.columns:
        return log
    return chunked_running(log, [], ["eid", "event_id"], chunk=hash_prefix_chunk("eid", hex_digits),
                           out="arrival_seq")
