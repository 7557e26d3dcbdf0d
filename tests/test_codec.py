"""Decoding, validation and encoding (B1-B17) on literal cases (FIXTURES F2-F5)."""

import json

from pyspark.sql import functions as F

from tidemark.functions.datetime import format_offset_datetime, parse_offset_datetime, zone_offset
from tidemark.operators import codec

META = {"eid": "e1", "occurred_at": "2016-03-15T23:47:15+01:00"}


def line(cursor, events=None, omit_events=False):
    d = {"cursor": cursor}
    if not omit_events:
        d["events"] = events
    return json.dumps(d)


def parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return {r.value: r for r in codec.parse_batches(df).collect()}


def reasons(row):
    return sorted((e.path, e.reason) for e in row.errors)


def test_cursor_must_be_strings(spark):
    ok = line({"partition": "0", "offset": "10"}, [])
    num = line({"partition": "0", "offset": 10}, [])
    part = line({"partition": 3, "offset": "1"}, [])
    missing = line({"partition": "0"}, [])
    r = parse(spark, [ok, num, part, missing])
    assert reasons(r[ok]) == []
    assert reasons(r[num]) == [("cursor.offset", "not a string")]
    assert reasons(r[part]) == [("cursor.partition", "not a string")]
    assert reasons(r[missing]) == [("cursor.offset", "missing")]


def test_keep_alives_and_unparseable(spark):
    ka1 = line({"partition": "0", "offset": "5"}, omit_events=True)
    ka2 = line({"partition": "0", "offset": "5"}, None)
    cut = ka1[: len(ka1) // 2]
    r = parse(spark, [ka1, ka2, cut])
    assert reasons(r[ka1]) == [] and r[ka1].n_events == 0
    assert reasons(r[ka2]) == [] and r[ka2].n_events == 0
    assert reasons(r[cut]) == [("$", "unparseable")]


def test_one_bad_event_invalidates_batch(spark):
    good = {"metadata": META, "k": 1}
    bad = {"metadata": {"occurred_at": META["occurred_at"]}, "k": 2}
    t = line({"partition": "0", "offset": "1"}, [good, bad])
    df = spark.createDataFrame([(t,)], "value string")
    assert codec.decode_batches(df).count() == 0
    q = codec.quarantine_batches(df).collect()
    assert q[0].reason == "events[1].metadata.eid: missing"


def test_data_change_rules(spark):
    dc_ok = {"data_type": "t", "data_op": "C", "data": {"a": 1}, "metadata": META}
    dc_null = {"data_type": "t", "data_op": "C", "data": None, "metadata": META}
    dc_str = {"data_type": "t", "data_op": "C", "data": "x", "metadata": META}
    be_with_data = {"metadata": META, "data": [1]}       # a "data" key makes it data-change
    texts = [line({"partition": "0", "offset": str(i)}, [e])
             for i, e in enumerate([dc_ok, dc_null, dc_str, be_with_data])]
    r = parse(spark, texts)
    assert reasons(r[texts[0]]) == []
    assert reasons(r[texts[1]]) == [("events[0].data", "not an object")]
    assert reasons(r[texts[2]]) == [("events[0].data", "not an object")]
    assert reasons(r[texts[3]]) == [("events[0].data", "not an object"),
                                    ("events[0].data_op", "missing"), ("events[0].data_type", "missing")]


def test_datetimes_need_offset(spark):
    cases = {"2016-03-15T23:47:15+01:00": True, "2016-03-15T23:47:15.123456789Z": True,
             "2016-03-15t23:47:15z": True, "2016-03-15T13:42Z": True,
             "2016-03-15": False, "2016-03-15T23:47:15": False, "2016-02-30T00:00:00Z": False}
    texts = []
    for occ in cases:
        texts.append(line({"partition": "0", "offset": "1"}, [{"metadata": {"eid": "e", "occurred_at": occ}}]))
    r = parse(spark, texts)
    for (occ, ok), t in zip(cases.items(), texts):
        assert (reasons(r[t]) == []) == ok, occ


def test_optional_metadata_types(spark):
    bad_parents = {"metadata": {**META, "parent_eids": ["a", 1]}}
    bad_flow = {"metadata": {**META, "flow_id": 7}}
    null_flow = {"metadata": {**META, "flow_id": None, "received_at": None}}
    bad_received = {"metadata": {**META, "received_at": "yesterday"}}
    texts = [line({"partition": "0", "offset": str(i)}, [e])
             for i, e in enumerate([bad_parents, bad_flow, null_flow, bad_received])]
    r = parse(spark, texts)
    assert reasons(r[texts[0]]) == [("events[0].metadata.parent_eids", "not an array of strings")]
    assert reasons(r[texts[1]]) == [("events[0].metadata.flow_id", "not a string")]
    assert reasons(r[texts[2]]) == []
    assert reasons(r[texts[3]]) == [("events[0].metadata.received_at", "not an offset date-time")]


def test_business_payload_and_classification(spark):
    cases = [
        {"metadata": META, "greeting": "hi"},
        {"metadata": META, "nested": {"a": [1, {"b": 2.50}]}, "z": None},
        {"metadata": META},
    ]
    t = line({"partition": "0", "offset": "2"}, cases)
    df = spark.createDataFrame([("t", t)], "event_type string, value string")
    ev = codec.decode_event_fields(codec.explode_events(codec.to_consumer_messages(codec.decode_batches(df))))
    rows = sorted(ev.collect(), key=lambda r: r.pos)
    assert [r.kind for r in rows] == ["business"] * 3
    assert [r.offset for r in rows] == [0, 1, 2]
    assert json.loads(rows[0].payload) == {"greeting": "hi"}
    assert json.loads(rows[1].payload) == {"nested": {"a": [1, {"b": 2.5}]}, "z": None}
    assert json.loads(rows[2].payload) == {}


def test_encode_business_payload_keys_win(spark):
    md = codec.metadata_struct(F.lit("e1"), F.lit("2016-03-15T22:47:15Z"))
    df = spark.range(1).select(codec.encode_event(F.lit("business"), md, F.lit('{"metadata": 5, "k": 1}'),
                                                  F.lit(None), F.lit(None)).alias("j"))
    assert json.loads(df.first().j) == {"metadata": 5, "k": 1}


def test_encode_omits_absent_optionals(spark):
    md = codec.metadata_struct(F.lit("e1"), F.lit("2016-03-15T22:47:15Z"), flow_id=F.lit(None).cast("string"))
    df = spark.range(1).select(codec.encode_event(F.lit("data"), md, F.lit('{"a": 1}'), F.lit("t"),
                                                  F.lit("UnknownValue(X)")).alias("j"))
    assert json.loads(df.first().j) == {"data_type": "t", "data_op": "UnknownValue(X)", "data": {"a": 1},
                                        "metadata": {"eid": "e1", "occurred_at": "2016-03-15T22:47:15Z"}}


def test_normalise_enums(spark):
    df = spark.createDataFrame([("C",), ("c",), ("S",), ("X",)], "op string")
    got = [r[0] for r in df.select(codec.normalise_data_op("op")).collect()]
    assert got == ["C", "UnknownValue(c)", "S", "UnknownValue(X)"]
    df = spark.createDataFrame([("data",), ("undefined",), ("audit",)], "c string")
    got = [r[0] for r in df.select(codec.normalise_category("c")).collect()]
    assert got == ["data", "undefined", "UnknownValue(audit)"]


def test_event_type_definitions(spark):
    full = {"name": "t", "owning_application": "a", "category": "data", "partition_key_fields": ["k"],
            "enrichment_strategies": [], "statistics": {"message_size": 5}, "schema": {"type": "json"}}
    no_owner = {k: v for k, v in full.items() if k != "owning_application"}
    df = spark.createDataFrame([(json.dumps(full),), (json.dumps(no_owner),)], "value string")
    rows = {r.value: r for r in codec.decode_event_types(df).collect()}
    a, b = rows[json.dumps(full)], rows[json.dumps(no_owner)]
    assert a.valid and a.statistics.message_size == 5 and a.statistics.read_parallelism is None
    assert not b.valid and b.missing_fields == ["owning_application"]


def test_event_type_wrong_json_types(spark):
    ok = {"name": "t", "owning_application": "a", "category": "data", "partition_key_fields": [],
          "enrichment_strategies": [], "statistics": {"message_size": 5}, "data_key_fields": None}
    cases = [({}, []), ({"name": 5}, ["name"]), ({"enrichment_strategies": "oops"}, ["enrichment_strategies"]),
             ({"partition_key_fields": [1]}, ["partition_key_fields"]), ({"statistics": [1]}, ["statistics"]),
             ({"statistics": {"message_size": "5"}}, ["statistics.message_size"]),
             ({"statistics": {"message_size": 1.5}}, ["statistics.message_size"])]
    df = spark.createDataFrame([(i, json.dumps({**ok, **c})) for i, (c, _) in enumerate(cases)], "i int, value string")
    for r in codec.decode_event_types(df).collect():
        assert (r.mistyped_fields, r.valid) == (cases[r.i][1], not cases[r.i][1])


def test_zone_offsets_are_kept(spark):
    texts = ["2024-01-01T00:30:00+01:00", "2024-01-01T00:30:00.123456-05:30", "2024-01-01T00:30:00Z",
             "2024-01-01T00:30:00.5+00:00:30"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    again = df.select(format_offset_datetime(parse_offset_datetime("t"), zone_offset("t")).alias("x")).collect()
    assert [r.x for r in again] == texts


def test_encode_cursors(spark):
    df = spark.createDataFrame([("t", "1", 12), ("t", "0", 10)], "event_type string, partition string, offset long")
    assert codec.encode_cursors(df, ["event_type"]).first().cursors_json == \
        '[{"partition":"0","offset":"10"},{"partition":"1","offset":"12"}]'


def test_event_type_round_trip(spark):
    full = {"name": "t", "owning_application": "a", "category": "data", "partition_key_fields": ["k"],
            "enrichment_strategies": ["metadata_enrichment"], "statistics": {"message_size": 5},
            "data_key_fields": ["id"], "schema": {"type": "json_schema"}}
    df = spark.createDataFrame([(json.dumps(full),)], "value string")
    decoded = codec.decode_event_types(df)
    again = codec.encode_event_types(decoded).first().event_type_json
    assert json.loads(again) == full          # absent optionals stay absent
