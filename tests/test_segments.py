"""Segmented log, its offset-addressed stream and the landed decoded log."""

import glob
import json
import os
import random

import pytest

from tidemark import catalog
from tidemark.operators import codec, consume
from tidemark.sources import batch_log, landed_log, offset_source, segments
from tidemark.sources.batch_log import cursor_map, stream_offsets
from tidemark.streaming import consume as streams

LINES = "event_type string, partition string, cursor_offset bigint, n_events bigint, line_seq bigint, value string"


def line(event_type, partition, last, n=2):
    ev = ",".join('{"metadata":{"eid":"%s-%s-%s","occurred_at":"2024-01-01T00:00:00Z"},"a":1}' % (event_type, partition, o)
                  for o in range(last - n + 1, last + 1))
    return (event_type, partition, last, n, 0, '{"cursor":{"partition":"%s","offset":"%d"},"events":[%s]}' % (partition, last, ev))


def lines(spark, event_type, partition, lo, hi, n=2):
    """Batches of ``n`` events for the offsets lo .. hi - 1."""
    return spark.createDataFrame([line(event_type, partition, k + n - 1, n) for k in range(lo, hi, n)], LINES)


def cursors(spark, *rows):
    return spark.createDataFrame(rows, "event_type string, partition string, start_cursor string")


def offsets_of(df):
    msgs = codec.to_consumer_messages(codec.decode_batches(df.select("event_type", "value")))
    return sorted((r.event_type, r.partition, r.cursor_offset_long) for r in msgs.collect())


class Seen:
    """A sink that keeps, per micro-batch, the batch cursors it got, in the source's own order."""

    def __init__(self):
        self.batches, self.lines = [], 0

    def __call__(self, df, batch_id):
        rows = df.collect()
        self.lines += len(rows)
        self.batches.append([(r.event_type, json.loads(r.value)["cursor"]) for r in rows])

    def of(self, partition):
        return [int(c["offset"]) for b in self.batches for _, c in b if c["partition"] == partition]


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "log")


def test_segments_are_bounded_and_in_order(spark, root):
    both = lines(spark, "t", "0", 0, 100).unionByName(lines(spark, "t", "odd/é =%", 0, 10)).repartition(4)
    segments.write_segments(both, root, rows_per_segment=20)
    rows = {(r.partition, r.first_offset): (r.last_offset, r.n_lines) for r in segments.manifest(spark, root).collect()}
    assert rows == {**{("0", k): (k + 19, 10) for k in range(0, 100, 20)}, ("odd/é =%", 0): (9, 5)}
    for f in glob.glob(f"{root}/data/run=*/segment=*/part-*"):
        at = [int(json.loads(x)["cursor"]["offset"]) for x in open(f)]
        assert at == sorted(at) and at[0] // 20 == at[-1] // 20
    assert len(glob.glob(f"{root}/data/run=*/segment=*/part-*")) == 6
    assert segments.read_after(spark, root).count() == 55


def test_keep_alives_and_batches_across_a_border(spark, root):
    rows = [line("t", "0", 4, 5), ("t", "0", 4, 0, 1, '{"cursor":{"partition":"0","offset":"4"}}'), line("t", "0", 11, 7), line("t", "0", 13, 2)]
    segments.write_segments(spark.createDataFrame(rows, LINES), root, rows_per_segment=10)
    got = [(r.first_offset, r.last_offset, r.n_lines) for r in segments.manifest(spark, root).orderBy("first_offset").collect()]
    assert got == [(0, 4, 2), (5, 13, 2)]


def test_a_cursor_skips_segments_before_any_line_is_read(spark, root):
    segments.write_segments(lines(spark, "t", "0", 0, 100).unionByName(lines(spark, "t", "1", 0, 40))
                            .unionByName(lines(spark, "u", "0", 0, 40)), root, 20)
    at = cursors(spark, ("t", "0", "79"), ("t", "1", "39"), ("u", "0", "BEGIN"))
    wanted = segments.segments_after(spark, root, at)
    assert sorted((r.event_type, r.partition, r.first_offset) for r in wanted.collect()) == [("t", "0", 80), ("u", "0", 0), ("u", "0", 20)]
    assert len(offsets_of(segments.read_after(spark, root, at))) == 10 + 20
    end = cursors(spark, ("t", "0", "99"), ("t", "1", "39"), ("u", "0", "39"))
    assert segments.read_after(spark, root, end).count() == 0
    # not a line before the cursor even if the files before it are unreadable
    for r in segments.manifest(spark, root).filter("last_offset < 80 AND event_type = 't'").collect():
        for f in glob.glob(f"{root}/data/run={r.run}/segment={r.segment}/*"):
            os.remove(f)
    assert len(offsets_of(segments.read_after(spark, root, at))) == 30
    out = f"{root}-skip"
    seen = Seen()
    cursor = cursors(spark, ("t", "0", "79"), ("t", "1", "39"), ("u", "0", "39"))
    streams.run(spark, root, f"{out}/_checkpoint", seen, cursors=cursor)
    assert seen.lines == 10 and seen.of("0") == list(range(81, 100, 2))


def test_an_unpublished_run_is_invisible(spark, root, monkeypatch):
    monkeypatch.setattr(segments.VersionLog, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError, match="died"):
        segments.write_segments(lines(spark, "t", "0", 0, 10), root, 20)
    monkeypatch.undo()
    assert segments.manifest(spark, root).count() == 0 and segments.read_after(spark, root).count() == 0
    assert segments.write_segments(lines(spark, "t", "0", 0, 0), root, 20) is None
    segments.write_segments(lines(spark, "t", "0", 0, 10), root, 20)
    assert segments.read_after(spark, root).count() == 5


def test_stream_is_in_offset_order_whatever_the_file_times(spark, root):
    """Runs land out of order, file times are shuffled: every partition comes in offset order, each offset once."""
    r = random.Random(4)
    for lo in (40, 0, 60, 20):
        segments.write_segments(lines(spark, "t", "0", lo, lo + 20).unionByName(lines(spark, "t", "1", lo // 2, lo // 2 + 10)), root, 10)
    for f in glob.glob(f"{root}/data/run=*/segment=*/part-*"):
        t = 1_600_000_000 + r.randint(0, 10**8)
        os.utime(f, (t, t))
    seen = Seen()
    streams.run(spark, root, f"{root}-ck", seen, max_offsets=25)
    assert seen.of("0") == list(range(1, 80, 2)) and seen.of("1") == list(range(1, 40, 2))
    assert len(seen.batches) >= 4 and all(2 * len(b) <= 25 for b in seen.batches)


def test_a_gap_waits_and_a_restart_goes_on(spark, root):
    segments.write_segments(lines(spark, "t", "0", 0, 10), root, 10)
    segments.write_segments(lines(spark, "t", "0", 20, 30), root, 10)
    seen = Seen()
    streams.run(spark, root, f"{root}-ck", seen)
    assert seen.of("0") == [1, 3, 5, 7, 9]
    segments.write_segments(lines(spark, "t", "0", 10, 20), root, 10)
    streams.run(spark, root, f"{root}-ck", seen, max_offsets=10)
    assert seen.of("0") == list(range(1, 30, 2)) and [len(b) for b in seen.batches] == [5, 5, 5]
    streams.run(spark, root, f"{root}-ck", seen)
    assert len(seen.of("0")) == 15


def test_offsets_taken_per_micro_batch(spark, root):
    segments.write_segments(lines(spark, "t", "0", 0, 100).unionByName(lines(spark, "u", "1", 0, 20)), root, 10)
    reader = offset_source.OffsetLogReader({"path": root, "maxOffsetsPerTrigger": "30", "resume": "{}"})
    ends = [reader.latestOffset()]
    while True:
        reader.partitions({}, ends[-1])
        if (end := reader.latestOffset()) == ends[-1]:
            break
        ends.append(end)
    assert ends[0] == {"t": {"0": 29}} and ends[-1] == {"t": {"0": 99}, "u": {"1": 19}}
    totals = [sum(o + 1 for p in e.values() for o in p.values()) for e in ends]
    assert all(b - a <= 30 for a, b in zip([0, *totals], totals))
    only = offset_source.OffsetLogReader({"path": root, "eventTypes": '["u"]', "resume": '{"u": {"1": 9}}'})
    assert only.latestOffset() == {"u": {"1": 19}}
    assert [(p.event_type, p.first) for p in only.partitions({"u": {"1": 9}}, {"u": {"1": 19}})] == [("u", 10)]
    assert cursor_map(cursors(spark, ("t", "0", "5"), ("t", "1", "BEGIN"))) == {"t": {"0": 5}}


def test_small_segments_share_a_task(spark, root):
    """100 segments of one micro-batch are dealt into few tasks of about equally many offsets, lines in their order."""
    segments.write_segments(lines(spark, "t", "0", 0, 160).unionByName(lines(spark, "t", "1", 0, 40)), root, 2)
    reader = offset_source.OffsetLogReader({"path": root, "resume": "{}", "tasks": "4"})
    parts = reader.partitions({}, reader.latestOffset())
    assert [len(p.pieces) for p in parts] == [25] * 4 and [(p.partition, p.first) for p in parts][:3] == [("0", 0), ("0", 50), ("0", 100)]
    got = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["partition"], r["segment_offset"], r["line"]) for r in got] == \
        [("0", k, 0) for k in range(0, 160, 2)] + [("1", k, 0) for k in range(0, 40, 2)]
    assert all(json.loads(r["value"])["cursor"] == {"partition": r["partition"], "offset": str(r["segment_offset"] + 1)} for r in got)
    whole = offset_source.OffsetLogReader({"path": root, "resume": "{}"})
    assert len(whole.partitions({}, whole.latestOffset())) == 100


def test_a_large_segment_keeps_its_own_task(spark, root, monkeypatch):
    monkeypatch.setattr(offset_source, "TASK_OFFSETS", 20)
    segments.write_segments(lines(spark, "t", "0", 0, 100).unionByName(lines(spark, "t", "1", 0, 30, 30)), root, 10)
    reader = offset_source.OffsetLogReader({"path": root, "resume": "{}", "tasks": "2"})
    parts = reader.partitions({}, reader.latestOffset())
    assert [[(p, first) for _, p, first, _ in t.pieces] for t in parts] == \
        [[("0", k), ("0", k + 10)] for k in range(0, 100, 20)] + [[("1", 0)]]
    assert reader.partitions(reader.at, reader.at) == []


def test_registered_stream_takes_micro_batches_that_follow_the_log(spark, root, monkeypatch):
    """S1 over 2,000,000 offsets: 20 micro-batches, not 80 of 25,000."""
    asked = []
    monkeypatch.setattr(catalog, "segment_log", lambda *_: root)
    monkeypatch.setattr(streams, "stream_consume", lambda *_, max_offsets: asked.append(max_offsets))
    monkeypatch.setattr(streams, "read_events", lambda *_: spark.createDataFrame(
        [], "event_type string, partition string, offset bigint"))
    run = "run"
    spark.createDataFrame([(run, "s", "t", "0", 0, 1_999_999, 1)], segments.MANIFEST).write.parquet(f"{root}/manifest/run={run}")
    segments.VersionLog(spark, f"{root}/log").append(1, {"run": run})
    catalog.stream_consume(spark, "-")
    assert asked == [100_000]
    segments.write_segments(lines(spark, "u", "0", 0, 10), f"{root}-small", 10)
    monkeypatch.setattr(catalog, "segment_log", lambda *_: f"{root}-small")
    catalog.stream_consume(spark, "-")
    assert asked == [100_000, 25_000]


def test_fixture_segments_follow_the_log(spark, monkeypatch):
    def held(n):
        monkeypatch.setattr(batch_log, "partition_catalog", lambda *_: spark.createDataFrame(
            [("t", "0", n // 2), ("t", "1", n - n // 2)], "event_type string, partition string, n_events bigint"))
        return batch_log.fixture_segment(spark, "-")
    assert [held(n) for n in (0, 100_000, 6_000_000, 36_000_000)] == [1000, 1000, 3000, 5000]


def test_only_quarantined_lines_keep_their_text(spark, root, monkeypatch):
    cut = ("t", "0", 11, 2, 0, '{"cursor":{"partition":"0","offset":"11"},"events":[{"a"')
    segments.write_segments(lines(spark, "t", "0", 0, 10).unionByName(spark.createDataFrame([cut], LINES)), root, 20)
    held, decode = [], streams.decode_parsed

    def spy(parsed):
        held.extend((r.valid, r.value) for r in parsed.select("valid", "value").collect())
        return decode(parsed)

    monkeypatch.setattr(streams, "decode_parsed", spy)
    streams.stream_consume(spark, root, f"{root}-out")
    assert sorted(held, key=str) == [(False, cut[-1]), *[(True, None)] * 5]
    assert [(r.event_type, r.value, r.reason) for r in streams.read_quarantine(spark, f"{root}-out").collect()] == \
        [("t", cut[-1], codec.UNPARSEABLE)]
    assert sorted(r.offset for r in streams.read_events(spark, f"{root}-out").collect()) == list(range(10))


def test_source_reads_long_and_odd_lines(spark, root, monkeypatch):
    monkeypatch.setattr(offset_source, "READ_BYTES", 7)
    values = ["é" * 50, "", "x", "tail 中文"]
    rows = [("t", "0", k, 1, 0, v) for k, v in enumerate(values)]
    segments.write_segments(spark.createDataFrame(rows, LINES), root, 10)
    reader = offset_source.OffsetLogReader({"path": root, "resume": "{}"})
    (part,) = reader.partitions({}, reader.latestOffset())
    got = [r for b in reader.read(part) for r in b.to_pylist()]
    assert [r["value"] for r in got] == values and [r["line"] for r in got] == [0, 1, 2, 3]


def test_resume_from_commits_over_offsets(spark, root):
    """S2 on a segmented log: a fresh consumer of the group starts after its commits."""
    segments.write_segments(lines(spark, "t", "0", 0, 40), root, 10)
    table = f"{root}-commits"
    streams.stream_consume_with_commits(spark, root, f"{root}-a", "g", table_root=table, max_offsets=20)
    segments.write_segments(lines(spark, "t", "0", 40, 50), root, 10)
    streams.stream_consume_with_commits(spark, root, f"{root}-b", "g", table_root=table)
    assert [r.offset for r in streams.read_events(spark, f"{root}-b").orderBy("offset").collect()] == list(range(40, 50))


def test_landing_is_incremental_and_repeatable(spark, root):
    out = f"{root}-landed"
    assert landed_log.land(spark, root, out) == [] and landed_log.read(spark, out).count() == 0
    bad = ("t", "0", 21, 2, 0, '{"cursor":{"partition":"0","offset":"21"},"events":[{"a"')
    for k, part in enumerate((lines(spark, "t", "0", 0, 20), spark.createDataFrame([bad], LINES), lines(spark, "u", "1", 0, 20),
                              lines(spark, "t", "0", 22, 30))):
        run = segments.write_segments(part, root, 10)
        assert landed_log.land(spark, root, out) == [run]
        assert landed_log.land(spark, root, out) == []
    want = [("t", "0", o) for o in [*range(20), *range(22, 30)]] + [("u", "1", o) for o in range(20)]
    rows = lambda: sorted((r.event_type, r.partition, r.offset) for r in landed_log.read(spark, out).collect())
    assert rows() == want
    assert [(r.event_type, r.reason) for r in landed_log.read_quarantine(spark, out).collect()] == [("t", codec.UNPARSEABLE)]
    assert landed_log.compact(spark, out, 9) == []
    assert len(landed_log.compact(spark, out, 2)) >= 2
    assert rows() == want and landed_log.land(spark, root, out) == []
    assert landed_log.read_quarantine(spark, out).count() == 1


def test_two_landings_at_once_count_once(spark, root, monkeypatch):
    out = f"{root}-landed"
    segments.write_segments(lines(spark, "t", "0", 0, 20), root, 10)
    write, nested = landed_log._write, []

    def racing(events, path):
        if not nested:
            nested.append(1)
            assert len(landed_log.land(spark, root, out)) == 1
        return write(events, path)

    monkeypatch.setattr(landed_log, "_write", racing)
    assert landed_log.land(spark, root, out) == []
    assert landed_log.read(spark, out).count() == 20


def test_landed_cursor_reaches_the_scan(spark, root):
    out = f"{root}-landed"
    segments.write_segments(lines(spark, "t", "0", 0, 40), root, 10)
    landed_log.land(spark, root, out)
    ev = consume.read_from_cursor(landed_log.read(spark, out), cursors(spark, ("t", "0", "29")), event_types=["t"])
    plan = ev._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(offset,30)" in plan and "parse_json" not in plan
    assert [r.offset for r in ev.select("offset").orderBy("offset").collect()] == list(range(30, 40))


def test_stream_offsets_has_the_place_of_each_line(spark, root):
    segments.write_segments(lines(spark, "t", "0", 0, 40), root, 20)
    got = []
    q = stream_offsets(spark, root, f"{root}-ck").writeStream.foreachBatch(
        lambda df, _: got.extend((r.partition, r.segment_offset, r.line) for r in df.collect())).option(
        "checkpointLocation", f"{root}-ck").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(got) == [("0", s, k) for s in (0, 20) for k in range(10)]
