"""Generated property checks (survey §5): a fold equals step-by-step puts;
accepted registrations reach exactly the high-water offsets."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import commits, offsets

T0 = datetime(2024, 2, 1)
SCHEMA = ("group_id string, event_type string, partition_id string, checkpoint_id string, lease_holder string, "
          "lease_counter long, lease_timestamp timestamp, lease_id string")
PUTS = ("group_id string, event_type string, partition_id string, put_seq long, checkpoint_id string, "
        "lease_holder string, lease_counter long, lease_timestamp timestamp, lease_id string")

put_st = st.tuples(st.sampled_from(["0", "1"]), st.one_of(st.none(), st.integers(0, 9)),
                   st.one_of(st.none(), st.sampled_from(["A", "B"])))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(seq=st.lists(put_st, min_size=1, max_size=8), stored=st.booleans())
def test_fold_equals_repeated_put(spark, seq, stored):
    base_rows = [("g", "t", "0", "s", "h", 3, T0, "S")] if stored else []
    cur = spark.createDataFrame(base_rows, SCHEMA)
    table = cur
    for i, (p, counter, lid) in enumerate(seq, start=1):
        put = spark.createDataFrame([("g", "t", p, str(i), "h", counter, T0, lid)], SCHEMA)
        # materialise each step (small) so the plan does not nest eight joins deep
        table = spark.createDataFrame(commits.commit_put(table, put).collect(), SCHEMA)
    puts = spark.createDataFrame([("g", "t", p, i, str(i), "h", c, T0, lid) for i, (p, c, lid) in
                                  enumerate(seq, start=1)], PUTS)
    folded = commits.fold_final(commits.commit_fold(cur, puts, rows_per_chunk=3))
    by_agg = commits.commit_fold_final(cur, puts)
    want = {r.partition_id: (r.checkpoint_id, r.lease_counter, r.lease_id) for r in table.collect()}
    for result in (folded, by_agg):
        got = {r.partition_id: (r.checkpoint_id, r.lease_counter, r.lease_id) for r in result.collect()}
        for p in got:
            assert got[p] == want[p], (seq, stored, p)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(offs=st.lists(st.tuples(st.sampled_from(["0", "1", "2"]), st.integers(0, 30)), min_size=1, max_size=40))
def test_accepted_max_equals_high_water(spark, offs):
    rows = [("t", p, o, i) for i, (p, o) in enumerate(offs, start=1)]
    df = spark.createDataFrame(rows, "event_type string, partition string, offset long, arrival_seq long")
    acc = offsets.register_commits(df, rows_per_chunk=4).filter("accepted")
    a = {r.partition: r.high_water for r in offsets.high_water_offsets(acc).collect()}
    b = {r.partition: r.high_water for r in offsets.high_water_offsets(df).collect()}
    assert a == b


gap_st = st.lists(st.sampled_from([0, 1, 2, 5, 30, 120, 600]), min_size=1, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(gaps=gap_st, n=st.one_of(st.none(), st.integers(1, 6)), secs=st.one_of(st.none(), st.integers(1, 400)),
       chunk=st.integers(1, 9))
def test_greedy_windows_property(spark, gaps, n, secs, chunk):
    from datetime import timedelta
    from tidemark.plans.greedy import greedy_windows
    if n is None and secs is None:
        n = 3
    rows, ts = [], T0
    for o, g in enumerate(gaps):
        ts = ts + timedelta(seconds=g)
        rows.append(("k", o, ts))
    want, cur = set(), None
    for _, o, t in rows:
        if cur is None or (n and cur[1] >= n) or (secs and t >= cur[0] + timedelta(seconds=secs)):
            if cur is not None:
                want.add((cur[2], cur[1]))
            cur = [t, 0, o]
        cur[1] += 1
    want.add((cur[2], cur[1]))
    df = spark.createDataFrame(rows, "k string, o long, ts timestamp")
    got = {(r.first_offset, r.n_events) for r in
           greedy_windows(df, ["k"], "o", "ts", max_rows=n, max_seconds=secs, rows_per_chunk=chunk).collect()}
    assert got == want, (gaps, n, secs, chunk)


def test_numbering_the_log_shuffles_raw_columns_only(spark):
    """What follows from an event alone is added after the last shuffle."""
    import re
    from conftest import SF_SMALL
    from tidemark.sources import event_log as source
    log = source.derive_event_log(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", log._jdf.queryExecution().explainString(mode))
    names = {c.strip().split("#")[0] for cols in moved for c in cols.split(",")}
    assert {"event_id", "payload"} <= names
    assert not names & {"eid", "flow_id", "offset_text", "kind", "data_type", "data_op"}
    assert log.columns == source.LOG_COLUMNS
