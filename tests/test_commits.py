"""Commit table puts, folds and leases (D1-D8; FIXTURES F6, F8)."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import commits

NOW = "2024-02-01 00:00:00"
SCHEMA = ("group_id string, event_type string, partition_id string, checkpoint_id string, lease_holder string, "
          "lease_counter long, lease_timestamp timestamp, lease_id string")
T0 = datetime(2024, 2, 1)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def put(spark, partition, checkpoint, counter=None, lease_id=None, holder="h"):
    return table(spark, [("g", "t", partition, checkpoint, holder, counter, T0, lease_id)])


def test_put_sequence_cases(spark):
    """insert ignores a supplied counter; update takes it or adds one;
    lease id kept when not supplied; checkpoint may go backwards."""
    cur = table(spark, [])
    steps = [("10", None, "L1", 1), ("20", 5, None, 5), ("15", None, None, 6), ("30", 0, "L2", 0),
             ("31", None, None, 1)]
    for ck, counter, lid, expected in steps:
        cur = commits.commit_put(cur, put(spark, "0", ck, counter, lid))
        r = cur.first()
        assert (r.checkpoint_id, r.lease_counter) == (ck, expected)
    assert cur.first().lease_id == "L2"
    first = commits.commit_put(table(spark, []), put(spark, "1", "1", 5)).first()
    assert first.lease_counter == 1


def test_fold_equals_step_by_step(spark):
    rnd = random.Random(3)
    stored = table(spark, [("g", "t", "0", "0", "h", 4, T0, "S")])
    rows = []
    for seq in range(1, 120):
        p = str(rnd.randrange(3))
        counter = rnd.choice([None, None, None, 0, 7])
        lid = rnd.choice([None, None, "L%d" % seq])
        rows.append(("g", "t", p, seq, str(seq), "h%d" % rnd.randrange(2), counter, T0, lid))
    puts = spark.createDataFrame(rows, "group_id string, event_type string, partition_id string, put_seq long, "
                                       "checkpoint_id string, lease_holder string, lease_counter long, "
                                       "lease_timestamp timestamp, lease_id string")
    final = {r.partition_id: r for r in commits.fold_final(commits.commit_fold(stored, puts, rows_per_chunk=8)).collect()}
    agg = {r.partition_id: r for r in commits.commit_fold_final(stored, puts).collect()}
    assert {p: tuple(r) for p, r in agg.items()} == {p: tuple(r) for p, r in final.items()}
    state = {"0": {"counter": 4, "lease_id": "S"}}
    last_by_holder = {}
    for g, et, p, seq, ck, holder, counter, ts, lid in rows:
        if p not in state:
            state[p] = {"counter": 1, "lease_id": lid}
        else:
            s = state[p]
            s["counter"] = counter if counter is not None else s["counter"] + 1
            if lid is not None:
                s["lease_id"] = lid
        state[p]["ck"] = ck
        last_by_holder[(holder, p)] = state[p]["counter"]
    for p, s in state.items():
        assert final[p].lease_counter == s["counter"], p
        assert final[p].lease_id == s["lease_id"], p
        assert final[p].checkpoint_id == s["ck"], p
    lc = {(r.lease_holder, r.partition_id): r.counter for r in
          commits.lease_counters(commits.commit_fold(stored, puts, rows_per_chunk=8)).collect()}
    assert lc == last_by_holder


def test_lease_validation_cases(spark):
    """F8 rows: stored counter / stored time vs now / own counter -> valid."""
    now = datetime(2024, 2, 1)
    cases = [("a", 2, -400, 2, True), ("b", 2, 400, 2, True), ("c", 2, -400, 5, True), ("d", 2, 400, 5, False),
             ("e", None, 400, None, False), ("f", 0, 400, None, True)]
    stored = table(spark, [("g", "t", p, "1", "h", c, now + timedelta(seconds=dt), None) for p, c, dt, _, _ in cases])
    own = spark.createDataFrame([("g", "t", p, o) for p, _, _, o, _ in cases if o is not None],
                                "group_id string, event_type string, partition_id string, own_counter long")
    got = {r.partition_id: r.valid for r in commits.validate_lease(stored, own, NOW).collect()}
    assert got == {p: exp for p, _, _, _, exp in cases}
    req = spark.createDataFrame([("g", "t", "a"), ("g", "t", "z")], "group_id string, event_type string, partition_id string")
    avail = {r.partition_id: r.available for r in commits.request_lease(req, stored, own, NOW).collect()}
    assert avail == {"a": True, "z": True}


def test_release(spark):
    stored = table(spark, [("g", "t", "0", "9", "h", 3, T0, "L")])
    req = spark.createDataFrame([("g", "t", "0"), ("g", "t", "1")], "group_id string, event_type string, partition_id string")
    r = {x.partition_id: x for x in commits.release_lease(req, stored, NOW).collect()}
    assert r["0"].released and r["0"].lease_counter == 0 and r["0"].checkpoint_id == "9" and r["0"].warning is None
    assert not r["1"].released and "partition: '1'" in r["1"].warning


def test_several_puts_of_one_key(spark):
    cur = table(spark, [("g", "t", "0", "1", "h", 3, T0, "L")])
    two = put(spark, "0", "5").unionByName(put(spark, "0", "6"))
    with pytest.raises(Exception, match="several puts without put_seq for g/t/0"):
        commits.commit_put(cur, two).collect()
    seq = put(spark, "0", "5").withColumn("put_seq", F.lit(1)) \
        .unionByName(put(spark, "0", "6").withColumn("put_seq", F.lit(2)))
    rows = commits.commit_put(cur, seq).collect()
    assert [(r.checkpoint_id, r.lease_counter, r.lease_id) for r in rows] == [("6", 5, "L")]


def test_row_without_checkpoint_exists(spark):
    cur = table(spark, [("g", "t", "0", None, "h", 3, T0, "L")])
    assert commits.commit_put(cur, put(spark, "0", "5")).first().lease_counter == 4
    req = cur.select(*commits.TABLE_KEYS)
    assert commits.release_lease(req, cur, NOW).first().released


def test_version_guard_and_retention(spark, tmp_path):
    root = str(tmp_path / "guarded")
    t = put(spark, "0", "5")
    for v in (1, 2, 3):
        commits.write_table_version(spark, t, root, v, writer="a", keep=2)
    commits.write_table_version(spark, t, root, 3, writer="a", keep=2)      # replay
    assert commits.versions(spark, root) == [2, 3]
    for other in ("b", None):
        with pytest.raises(RuntimeError, match="belongs to writer a"):
            commits.write_table_version(spark, t, root, 3, writer=other)


def test_table_versions(spark, tmp_path):
    root = str(tmp_path / "commits")
    t1 = commits.commit_put(table(spark, []), put(spark, "0", "5"))
    commits.write_table_version(spark, t1, root, 1)
    t2 = commits.commit_put(commits.read_latest_version(spark, root), put(spark, "0", "6"))
    commits.write_table_version(spark, t2, root, 2)
    r = commits.read_latest_version(spark, root).first()
    assert (r.checkpoint_id, r.lease_counter) == ("6", 2)
    assert commits.read_version_at_or_below(spark, root, 1).first().checkpoint_id == "5"
