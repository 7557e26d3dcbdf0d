"""Live A7 and A13 by each partition's own clock, over a segmented log."""

import json

import pytest

from tidemark.sources import segments
from tidemark.streaming import consume as streams
from tidemark.streaming import flush_timer

LINES = "event_type string, partition string, cursor_offset bigint, n_events bigint, line_seq bigint, value string"


def land(spark, root, partition, first, minutes):
    """Events of one partition at these minutes of the day, one batch per event, one run."""
    rows = []
    for k, m in enumerate(minutes):
        o = first + k
        ev = {"metadata": {"eid": f"{partition}-{o}", "occurred_at": f"2024-01-01T{m // 60:02d}:{m % 60:02d}:00Z"}, "a": 1}
        rows.append(("t", partition, o, 1, 0, json.dumps({"cursor": {"partition": partition, "offset": str(o)}, "events": [ev]})))
    segments.write_segments(spark.createDataFrame(rows, LINES), root, 4)


def expected(minutes, n, timeout):
    out, start, first = [], None, 0
    for k, m in enumerate(minutes):
        if start is not None and m >= start + timeout:
            out.append((first, k - 1))
            start = None
        if start is None:
            start, first = m, k
        if k - first + 1 == n:
            out.append((first, k))
            start = None
    return out


A, B = [0, 10, 20, 30, 100, 300, 310, 320, 330, 331], [600, 601, 700, 701, 702, 703, 1200]


@pytest.mark.parametrize("max_offsets", [1, 6, 0])
def test_one_partition_does_not_close_another(spark, tmp_path, max_offsets):
    """Files in log order: all of a late partition comes before the early one's last events."""
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    land(spark, root, "b", 0, B)
    land(spark, root, "a", 0, A[:4])
    land(spark, root, "a", 4, A[4:])
    events = streams.stream_events(spark, root, f"{out}/_checkpoint", max_offsets)
    flush_timer.own_clock_batches(events, out, 4, 3600)
    got = sorted((r.partition, r.first_offset, r.last_offset) for r in spark.read.parquet(f"{out}/batches").collect())
    assert got == sorted([("a", *x) for x in expected(A, 4, 60)] + [("b", *x) for x in expected(B, 4, 60)])
    assert spark.read.parquet(f"{out}/late").count() == 0
    events = streams.stream_events(spark, root, f"{out}-s/_checkpoint", max_offsets)
    flush_timer.own_clock_stalls(events, f"{out}-s", 3600)
    gaps = sorted((r.partition, r.offset, r.gap_us // 60_000_000) for r in spark.read.parquet(f"{out}-s/stalls").collect())
    assert gaps == [("a", 4, 200), ("b", 1, 99), ("b", 5, 497)]


def test_an_idle_partition_is_settled(spark, tmp_path):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    land(spark, root, "a", 0, [0, 10])
    events = streams.stream_events(spark, root, f"{out}/_checkpoint")
    with pytest.raises(ValueError, match="live_seconds"):
        flush_timer.own_clock_batches(events, out, 4, 3600, idle_seconds=1)
    flush_timer.own_clock_batches(events, out, 4, 3600, idle_seconds=1, live_seconds=25)
    got = [(r.first_offset, r.last_offset, r.closed_by) for r in spark.read.parquet(f"{out}/batches").collect()]
    assert got == [(0, 1, "idle")]


def test_state_has_no_more_partitions_than_cores(spark, tmp_path):
    """A state partition costs a task and a Python worker in every micro-batch, empty or not."""
    import os
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    land(spark, root, "a", 0, A)
    key = "spark.sql.shuffle.partitions"
    before, cores = spark.conf.get(key), spark.sparkContext.defaultParallelism
    spark.conf.set(key, str(4 * cores))
    try:
        events = streams.stream_events(spark, root, f"{out}/_checkpoint", 6)
        flush_timer.own_clock_batches(events, out, 4, 3600)
        assert spark.conf.get(key) == str(4 * cores)
    finally:
        spark.conf.set(key, before)
    assert len([d for d in os.listdir(f"{out}/_checkpoint/state/0") if d.isdigit()]) <= cores
    got = sorted((r.first_offset, r.last_offset) for r in spark.read.parquet(f"{out}/batches").collect())
    assert got == expected(A, 4, 60)


def test_micro_batches_of_a_live_query_follow_the_log(spark, tmp_path):
    """A log of any size drains in a bounded number of micro-batches, up to what a task can hold."""
    from tidemark import catalog
    for held, most in ((40, 5_000), (2_000_000, 100_000), (10 ** 9, 1 << 20)):
        root = str(tmp_path / f"log-{held}")
        line = ("t", "a", held - 1, held, 0, "{}")
        segments.write_segments(spark.createDataFrame([line], LINES), root, 4)
        assert catalog._live_offsets(spark, root) == most
