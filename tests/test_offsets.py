"""Offsets, offset maps and commit registration (C1-C12; FIXTURES F7, F9)."""

import random

from pyspark.sql import functions as F

from tidemark.functions.offsets import offset_error, offset_to_long, partition_key_hash
from tidemark.operators import offsets


def test_offset_text(spark):
    cases = [("10", 10), ("3", 3), ("BEGIN", 0), ("000000000000000010", 10), ("something invalid", None),
             ("", None), ("-1", None), ("9" * 20, None)]
    df = spark.createDataFrame(cases, "t string, expected long")
    for r in df.select("t", "expected", offset_to_long("t").alias("v"), offset_error("t").alias("e")).collect():
        assert r.v == r.expected, r.t
        assert (r.e is None) == (r.expected is not None), r.t


def test_partition_key_hash_drops_leading_zeros(spark):
    import hashlib
    keys = [("et", str(i)) for i in range(300)]
    df = spark.createDataFrame(keys, "event_type string, partition string")
    got = {(r.event_type, r.partition): r.h for r in
           df.select("event_type", "partition", partition_key_hash("event_type", "partition").alias("h")).collect()}
    for et, p in keys:
        expected = format(int(hashlib.md5(f"{et} - {p}".encode()).hexdigest(), 16), "x")
        assert got[(et, p)] == expected


def _map(spark, d):
    return spark.createDataFrame(list(d.items()) or [], "key string, offset long")


def test_last_offset_and_required(spark):
    omap = offsets.offset_map(spark.createDataFrame([("t", "0", 10)], "event_type string, partition string, high_water long"))
    look = spark.createDataFrame([("t", "0"), ("t", "1")], "event_type string, partition string")
    got = {r.partition: r.last_offset for r in offsets.last_offset(look, omap).collect()}
    assert got == {"0": 10, "1": -1}
    req = {r.partition: (r.checkpoint, r.error) for r in offsets.last_offset_required(look, omap).collect()}
    assert req["0"] == ("10", None) and req["1"][0] is None and "partition 1" in req["1"][1]


def test_offset_map_diff(spark):
    def diff(a, b):
        return dict((r.key, r.offset) for r in offsets.offset_map_diff(_map(spark, a), _map(spark, b)).collect())
    assert diff({"a": 10}, {"b": 12}) == {"a": 10}
    assert diff({"a": 10, "b": 2}, {"b": 12}) == {"a": 10, "b": 2}
    assert diff({"b": 12}, {"a": 10, "b": 2}) == {"b": 12}
    assert diff({}, {}) == {}


def test_offset_map_upsert(spark):
    base = _map(spark, {"a": 10, "b": 2})
    writes = spark.createDataFrame([("c", 5, 1), ("a", 3, 2)], "key string, offset long, write_seq int")
    got = dict((r.key, r.offset) for r in offsets.offset_map_upsert(base, writes).collect())
    assert got == {"a": 3, "b": 2, "c": 5}     # last write wins, may go down


def test_register_commits_matches_sequential(spark):
    rnd = random.Random(7)
    rows = []
    for seq in range(1, 400):
        rows.append(("t", str(rnd.randrange(3)), rnd.randrange(50), seq))
    df = spark.createDataFrame(rows, "event_type string, partition string, offset long, arrival_seq long")
    got = {r.arrival_seq: r.accepted for r in offsets.register_commits(df, rows_per_chunk=37).collect()}
    last = {}
    for et, p, o, seq in rows:
        ok = o > last.get(p, -1)
        if ok:
            last[p] = o
        assert got[seq] == ok, seq
    hw = {r.partition: r.high_water for r in
          offsets.high_water_offsets(offsets.register_commits(df).filter("accepted")).collect()}
    assert hw == last


def test_acknowledge(spark):
    cur = _map(spark, {"a": 10, "b": 5})
    acked = _map(spark, {"a": 11, "b": 5})
    got = dict((r.key, r.offset) for r in offsets.acknowledge_offsets(cur, acked).collect())
    assert got == {"b": 5}


def test_non_empty(spark):
    m = spark.createDataFrame([("g1", "a", 1)], "g string, key string, offset long")
    assert [tuple(r) for r in offsets.offset_map_non_empty(m, ["g"]).collect()] == [("g1", True)]
    assert offsets.offset_map_non_empty(m.filter(F.lit(False)), ["g"]).count() == 0
