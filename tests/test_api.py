"""The consumer entry point equals the operators composed by hand."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import api, fixtures as fx
from tidemark.operators import consume
from tidemark.settings import ConsumerSettings


def test_consume_from_start_by_count(spark):
    log = fx.log(spark, SF_SMALL)
    s = ConsumerSettings("click", "g", batch_limit=10, batch_flush_timeout_seconds=0).read_from_start_of_stream()
    got = sorted(map(tuple, api.consume(log, s).collect()))
    ev = log.filter(F.col("event_type") == "click").withColumn("start_offset", F.lit(0).cast("bigint"))
    want = sorted(map(tuple, consume.batch_by_count(ev, 10)
                      .select("event_type", "partition", "batch_cursor", "first_offset", "n_events").collect()))
    assert got == want


def test_consume_after_commits_with_limits(spark):
    log = fx.log(spark, SF_SMALL)
    commits = fx.commits(spark, SF_SMALL).filter(F.col("group_id") == "g1")
    s = ConsumerSettings("view", "g1", batch_limit=3, batch_flush_timeout_seconds=3600, stream_limit=7)
    batches = api.consume(log, s, commits).collect()
    per_part = {}
    for b in batches:
        per_part.setdefault(b.partition, []).append(b)
    committed = {r.partition_id: int(r.checkpoint_id) for r in commits.filter(F.col("event_type") == "view").collect()}
    for p, bs in per_part.items():
        assert sum(b.n_events for b in bs) <= 7
        assert min(b.first_offset for b in bs) == committed[p] + 1
        assert all(b.n_events <= 3 for b in bs)


def test_consume_accepts_event_times_that_step_back(spark):
    from datetime import datetime, timedelta
    rows = [("t", "0", o, datetime(2024, 1, 1) + timedelta(seconds=s)) for o, s in enumerate((0, 50, 10, 70, 65))]
    log = spark.createDataFrame(rows, "event_type string, partition string, offset long, occurred_at timestamp")
    s = ConsumerSettings("t", "g", batch_limit=10, batch_flush_timeout_seconds=60).read_from_start_of_stream()
    assert sorted(tuple(r)[2:] for r in api.consume(log, s).collect()) == [(2, 0, 3), (4, 3, 2)]


def test_publish_stores_one_body_per_message(spark, tmp_path):
    import json as _json
    from tidemark.settings import ProducerSettings
    pe = fx.producer_events(spark, SF_SMALL)
    stored = api.publish(spark, pe, ProducerSettings("audit"), str(tmp_path / "out"))
    assert stored.count() == pe.select("message_id").distinct().count()
    again = api.publish(spark, pe.filter(F.col("message_id") == 2), ProducerSettings("other"), str(tmp_path / "out"))
    assert [(r.event_type, r.message_id) for r in again.collect()] == [("other", 2)]     # this call's messages only
    body = stored.orderBy("message_id").first().body
    assert len(_json.loads(body)) == 10


def test_batches_of_two_source_types_stay_apart(spark):
    from tidemark.operators.publish import batch_bodies
    rows = [(t, "0", "7", o, f'"{t}{o}"') for t in ("a", "b") for o in (5, 4)]
    ev = spark.createDataFrame(rows, "event_type string, partition string, cursor_offset string, offset long, event_json string")
    got = sorted((r.event_type, r.partition, r.cursor_offset, r.n_events, r.body) for r in batch_bodies(ev, "out").collect())
    assert got == [("out", "0", "7", 2, '["a4","a5"]'), ("out", "0", "7", 2, '["b4","b5"]')]


BODIES = "event_type string, message_id long, flow_id string, body string"


def test_failed_publish_run_leaves_nothing_and_a_repeat_replaces(spark, tmp_path):
    import os
    import pytest
    from tidemark.operators import publish
    path = str(tmp_path / "out")
    good = spark.createDataFrame([("t", i, None, f'["{i}"]') for i in range(40)], BODIES).repartition(8)
    markers = good.select("message_id", F.col("body").alias("marker"), F.col("message_id").alias("seq"))
    bad = good.withColumn("body", F.when(F.col("message_id") == 33, F.raise_error(F.lit("lost"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="lost"):
        publish.publish_with_markers(spark, bad, markers, path, "r")     # dies when other tasks have stored rows
    assert publish.read_messages(spark, path, "r").count() == 0
    assert not [f for f in os.listdir(path) if f.startswith("attempt=")]
    assert publish.publish_with_markers(spark, good, markers, path, "r").count() == 40
    with pytest.raises(Exception, match="lost"):
        publish.write_messages(bad, path, "r")
    assert publish.read_messages(spark, path, "r").count() == 40         # what was published stays
    publish.write_messages(good.filter("message_id < 3"), path, "r")
    assert sorted(r.message_id for r in publish.read_messages(spark, path, "r").collect()) == [0, 1, 2]


def test_publish_run_times_out_as_a_whole(spark, tmp_path):
    import pytest
    from tidemark.operators import publish
    path = str(tmp_path / "out")

    def slow(batches):
        import time
        for b in batches:
            time.sleep(30)
            yield b
    rows = spark.createDataFrame([("t", 1, None, "[]")], BODIES).repartition(1).mapInArrow(slow, BODIES)
    with pytest.raises(publish.PublishTimeout):
        publish.write_messages(rows, path, "r", timeout_seconds=3)
    assert publish.read_messages(spark, path, "r").count() == 0
    publish.write_messages(spark.createDataFrame([("t", 1, None, "[]")], BODIES), path, "q", timeout_seconds=60)
    assert publish.read_messages(spark, path, "q").count() == 1
