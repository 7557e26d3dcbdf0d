"""Chunked running aggregates and greedy windows against brute force."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.plans.greedy import greedy_windows
from tidemark.plans.numbering import chunked_lag, chunked_running, offset_chunk


def test_chunked_running_equals_window(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), i, rnd.randrange(100)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    w = Window.partitionBy("k").orderBy("o")
    ref = df.select("k", "o", F.row_number().over(w).alias("rn"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("pm"),
                    F.sum("v").over(w).alias("s"))
    got = chunked_running(df, ["k"], ["o"], offset_chunk("o", 16), out="rn")
    got = chunked_running(got, ["k"], ["o"], offset_chunk("o", 16), out="pm", how="max", value="v", exclusive=True)
    got = chunked_running(got, ["k"], ["o"], offset_chunk("o", 16), out="s", how="sum", value="v")
    a = sorted(tuple(r) for r in ref.collect())
    b = sorted(tuple(r) for r in got.select("k", "o", "rn", "pm", "s").collect())
    assert a == b


def brute(rows, n, secs):
    out = {}
    for key in sorted({r[0] for r in rows}):
        cur = None
        for _, o, ts in sorted([r for r in rows if r[0] == key], key=lambda r: r[1]):
            if cur is None or (n and cur[1] >= n) or (secs and ts >= cur[0] + timedelta(seconds=secs)):
                cur = [ts, 0, o]
                out.setdefault(key, []).append(cur)
            cur[1] += 1
    return {(k, w[2], w[1]) for k, ws in out.items() for w in ws}


def test_greedy_windows_match_sequential(spark):
    rnd = random.Random(5)
    t0 = datetime(2024, 1, 1)
    rows = []
    for key in ("x", "y"):
        ts = t0
        for o in range(300):
            ts += timedelta(seconds=rnd.choice([1, 2, 3, 30, 200]))
            rows.append((key, o, ts))
    df = spark.createDataFrame(rows, "k string, o long, ts timestamp")
    for n, secs, chunk in [(4, 60, 7), (None, 100, 11), (3, None, 5), (10, 500, 1000)]:
        w = greedy_windows(df, ["k"], "o", "ts", max_rows=n, max_seconds=secs, rows_per_chunk=chunk)
        got = {(r.k, r.first_offset, r.n_events) for r in w.collect()}
        assert got == brute(rows, n, secs), (n, secs, chunk)


def test_chunked_lag_equals_window(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("abc"), o, rnd.randrange(1000)) for o in rnd.sample(range(2000), 600)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    ref = df.select("k", "o", F.lag("v").over(Window.partitionBy("k").orderBy("o")).alias("p"))
    got = chunked_lag(df, ["k"], "o", "v", offset_chunk("o", 50), "p").select("k", "o", "p")
    assert sorted(tuple(r) for r in ref.collect()) == sorted(tuple(r) for r in got.collect())


def test_greedy_time_may_step_back(spark):
    """The clock is the running maximum, across chunk borders too."""
    secs = [0, 50, 10, 70, 65, 200]
    rows = [("x", o, datetime(2024, 1, 1) + timedelta(seconds=t)) for o, t in enumerate(secs)]
    df = spark.createDataFrame(rows, "k string, o long, ts timestamp")
    for chunk in (2, 3, 100):
        w = greedy_windows(df, ["k"], "o", "ts", max_seconds=60, rows_per_chunk=chunk)
        assert sorted((r.first_offset, r.last_offset) for r in w.collect()) == [(0, 2), (3, 4), (5, 5)]


def test_greedy_scan_over_many_levels(spark):
    """Chunks of a few rows, composed two or three at a time over several
    levels: windows that end within a chunk, span many, or see tied times."""
    rnd = random.Random(11)
    rows = []
    for key, count in (("x", 150), ("y", 3), ("z", 61)):
        ts = datetime(2024, 1, 1)
        for o in range(count):
            ts += timedelta(seconds=rnd.choice([0, 0, 1, 5, 40, 300]))
            rows.append((key, o, ts))
    df = spark.createDataFrame(rows, "k string, o long, ts timestamp").cache()
    for n, secs, chunk, fan_in in [(25, 900, 4, 3), (None, 2000, 5, 2)]:
        w = greedy_windows(df, ["k"], "o", "ts", max_rows=n, max_seconds=secs, rows_per_chunk=chunk, fan_in=fan_in)
        got = {(r.k, r.first_offset, r.n_events) for r in w.collect()}
        assert got == brute(rows, n, secs), (n, secs, chunk, fan_in)


def test_maps_compose_associatively():
    """Any bracketing of neighbouring maps has the exits of the rows themselves."""
    from tidemark.plans import greedy
    rnd = random.Random(4)
    for _ in range(200):
        n, t = rnd.choice([(None, 9), (5, None), (6, 12)])
        ts, spans = 0, []
        for _ in range(4):
            times = []
            for _ in range(rnd.randint(1, 4)):
                ts += rnd.choice([0, 1, 3, 8])
                times.append(ts)
            spans.append(times)
        maps, at = [], 0
        for times in spans:
            runs = []
            for m in range(len(times) + 1):
                rest = times[m:]
                start = (-1, -1, -1)
                if rest:
                    start = (at + m, rest[0], 0)
                    for j, x in enumerate(rest):
                        if (n and start[2] >= n) or (t and x >= start[1] + t):
                            start = (at + m + j, x, 0)
                        start = (start[0], start[1], start[2] + 1)
                runs.append(greedy.Run(m, m, times[m - 1] if m else greedy._NEG,
                                       times[m] if rest else greedy._POS, *start))
            maps.append(greedy.Span(len(times), times[0], greedy._coalesce(runs)))
            at += len(times)
        a, b, c, d = maps
        two = lambda x, y: greedy._compose(x, y, n, t)
        ways = [two(two(two(a, b), c), d), two(a, two(b, two(c, d))), two(two(a, b), two(c, d))]
        first = spans[0][0]
        entries = [None] + [(-9, first - back, cnt) for back in range(0, (t or 3) + 1) for cnt in range(1, (n or 5) + 1)]
        for e in entries:
            step = e
            for m in maps:
                step = greedy._leave(m, step, n, t)
            assert {greedy._leave(w, e, n, t) for w in ways} == {step}, (n, t, e)
