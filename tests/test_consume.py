"""Cursor reads, batching, limits and keep-alives (A3-A13) on literal logs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import consume
from tidemark.sources.batch_log import read_batch_log

T0 = datetime(2024, 1, 1)


def log(spark, n=30, partitions=("0",)):
    rows = [("t", p, o, T0 + timedelta(minutes=o)) for p in partitions for o in range(n)]
    return spark.createDataFrame(rows, "event_type string, partition string, offset long, occurred_at timestamp")


def cursors(spark, rows):
    return spark.createDataFrame(rows, "event_type string, partition string, start_cursor string")


def offsets_after(spark, cursor):
    c = cursors(spark, [("t", "0", cursor)])
    return [r.offset for r in consume.read_from_cursor(log(spark, 5), c).orderBy("offset").collect()]


def test_begin_differs_from_zero(spark):
    assert offsets_after(spark, "BEGIN") == [0, 1, 2, 3, 4]
    assert offsets_after(spark, "0") == [1, 2, 3, 4]
    assert offsets_after(spark, "000000000000000003") == [4]
    assert offsets_after(spark, None) == [0, 1, 2, 3, 4]


def test_no_cursor_row_means_start(spark):
    c = cursors(spark, [("t", "0", "2")])
    got = consume.read_from_cursor(log(spark, 4, ("0", "1")), c)
    counts = {r.partition: r.n_events for r in consume.partition_summary(got).collect()}
    assert counts == {"0": 1, "1": 4}


def test_pairs_without_a_cursor_start_at_zero(spark):
    """Only (click, 2) has a cursor; (view, 2) shares its partition id."""
    rows = [(e, p, o, T0) for e in ("click", "view") for p in ("2", "3") for o in range(10)]
    lg = spark.createDataFrame(rows, "event_type string, partition string, offset long, occurred_at timestamp")
    c = cursors(spark, [("click", "2", "5")])
    for types in (None, ["click", "view"]):
        got = consume.read_from_cursor(lg, c, event_types=types)
        n = {(r.event_type, r.partition): r.n_events for r in consume.partition_summary(got).collect()}
        assert n == {("click", "2"): 4, ("click", "3"): 10, ("view", "2"): 10, ("view", "3"): 10}


def test_scan_filter_reaches_parquet(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(e, p, o) for e in ("a", "b") for p in ("0", "1") for o in range(10)]
    spark.createDataFrame(rows, "event_type string, partition string, offset long") \
        .write.partitionBy("event_type").parquet(path)
    c = cursors(spark, [("a", "0", "5"), ("b", "0", "7"), ("a", "1", "3")])
    got = consume.read_from_cursor(spark.read.parquet(path), c, event_types=["a", "b"])
    n = {(r.event_type, r.partition): r.n_events for r in consume.partition_summary(got).collect()}
    assert n == {("a", "0"): 4, ("b", "0"): 2, ("a", "1"): 6, ("b", "1"): 10}
    plan = got._jdf.queryExecution().simpleString()
    assert "GreaterThanOrEqual(offset,6)" in plan       # partition 0 only: (b, 1) has no cursor


def test_unreadable_cursor_fails(spark):
    with pytest.raises(Exception, match="Invalid offset value: bogus"):
        offsets_after(spark, "bogus")


def test_many_partition_ids(spark):
    n = 10_000
    lg = spark.range(2 * n).select(F.lit("t").alias("event_type"), (F.col("id") % n).cast("string").alias("partition"),
                                   F.floor(F.col("id") / n).alias("offset"))
    c = spark.range(n).select(F.lit("t").alias("event_type"), F.col("id").cast("string").alias("partition"),
                              F.lit("0").alias("start_cursor"))
    got = consume.read_from_cursor(lg, c, event_types=["t"])
    assert got.agg(F.count(F.lit(1)), F.min("offset")).first() == (n, 1)


def test_appended_lines_are_read(spark, tmp_path):
    path = str(tmp_path / "wire")
    line = spark.createDataFrame([("t", "{}")], "event_type string, value string")
    line.write.partitionBy("event_type").text(path)
    assert read_batch_log(spark, path).count() == 1
    line.write.mode("append").partitionBy("event_type").text(path)
    assert read_batch_log(spark, path).count() == 2


def test_batch_by_count(spark):
    ev = consume.read_from_cursor(log(spark, 35), cursors(spark, [("t", "0", "9")]))
    b = sorted((r.batch_cursor, r.n_events) for r in consume.batch_by_count(ev, 10).collect())
    assert b == [(19, 10), (29, 10), (34, 5)]          # from cursor 9: cursors 19, 29, then a partial batch
    one = consume.batch_by_count(ev, 0).count()
    assert one == 25                                    # 0 = service default, one event per batch


def test_limits(spark):
    ev = consume.read_from_cursor(log(spark, 30), cursors(spark, [("t", "0", "BEGIN")]))
    assert consume.limit_stream(ev, 7).count() == 7
    assert consume.limit_stream(ev, 0).count() == 30
    assert consume.limit_stream_by_time(ev, "2024-01-01 00:00:00", 600).count() == 10
    assert consume.limit_stream_by_time(ev, "2024-01-01 00:00:00", 0).count() == 30


def test_close_on_keep_alives(spark):
    # cursor: 4 (2 keep-alives), 9 (1), 14 (3), 19
    rows = [("t", "0", c, n) for c, n in [(4, 5), (4, 0), (4, 0), (9, 5), (9, 0), (14, 5), (14, 0), (14, 0), (14, 0),
                                         (19, 5)]]
    b = spark.createDataFrame(rows, "event_type string, partition string, cursor_offset_long long, n_events long")
    def delivered(limit):
        return sorted(r.cursor_offset_long for r in consume.close_on_keep_alives(b, limit).collect())
    assert delivered(0) == [4, 9, 14, 19]
    assert delivered(1) == [4]
    assert delivered(2) == [4]
    assert delivered(3) == [4, 9, 14]
    assert delivered(4) == [4, 9, 14, 19]
    assert consume.drop_keep_alives(b).count() == 4


def test_resolve_start_cursor(spark):
    req = spark.createDataFrame([("g", "t", "0", None), ("g", "t", "1", "7"), ("g", "t", "2", None)],
                                "group_id string, event_type string, partition string, explicit_offset string")
    com = spark.createDataFrame([("g", "t", "0", "12"), ("g", "t", "1", "3")],
                                "group_id string, event_type string, partition_id string, checkpoint_id string")
    got = {r.partition: (r.start_cursor, r.cursor_source) for r in consume.resolve_start_cursor(req, com).collect()}
    assert got == {"0": ("12", "committed"), "1": ("7", "explicit"), "2": (None, "none")}


def test_stalls(spark):
    rows = [("t", "0", o, T0 + timedelta(hours=h)) for o, h in enumerate([0, 1, 5, 6, 20])]
    lg = spark.createDataFrame(rows, "event_type string, partition string, offset long, occurred_at timestamp")
    r = consume.detect_stalled_partitions(lg, flush_timeout_seconds=3600, rows_per_chunk=2).first()
    assert (r.n_stalls, r.max_gap_seconds) == (2, 14 * 3600)      # gaps above 1.5 h: 4 h and 14 h


def test_cursor_predicate_keeps_rows_without_partition(spark):
    rows = [("t", "0", 0, T0), ("t", "0", 5, T0), ("t", None, 3, T0)]
    lg = spark.createDataFrame(rows, "event_type string, partition string, offset long, occurred_at timestamp")
    got = consume.read_from_cursor(lg, cursors(spark, [("t", "0", "2")]))
    assert sorted((r.partition or "", r.offset) for r in got.collect()) == [("", 3), ("0", 5)]
