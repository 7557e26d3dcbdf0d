"""Greedy count-or-time windows (A7 batching, C10/C11 commit flushes).

A window opens at a row and takes the following rows of its key while it
has fewer than ``max_rows`` rows and the row's time is before the opening
time + ``max_seconds`` (half-open); the first row breaking either opens the
next window.  Each window depends on where the previous one closed, so this
is neither a tumbling nor a session window.

It is computed exactly without giving a whole key to one task:

1. Rows of a key are numbered (chunked running count) and cut into chunks
   of ``rows_per_chunk`` rows.
2. Per (key, chunk), in parallel: the only unknown is how many leading rows
   ``m`` of the chunk are absorbed by a window opened in an earlier chunk.
   ``m`` is bounded (fewer than ``max_rows``, and only rows within
   ``max_seconds`` of the chunk's first row).  For every candidate ``m`` the
   chunk is simulated and its exit state (open window start, start time,
   rows so far) recorded; simulations share work through a memo of window
   starts already seen.  The map candidate -> exit is stored run-length
   encoded (paths merge quickly: a few rows per chunk).
3. These maps compose: up to ``FAN_IN`` neighbouring chunks become one map
   of their span, level by level, until one span is left; the entry states
   then travel back down.  A scan in log rounds: no task holds more than
   ``FAN_IN`` maps, however many chunks a key has.
4. Per (key, chunk), in parallel: rows are assigned to windows from the
   entry state and reduced to partial window aggregates, which a final
   grouped aggregate merges across chunk borders.

Time must be non-decreasing in the row order within a key (true for the
log's offsets, which follow event time, and for arrival order).
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.datetime import format_offset_datetime
from tidemark.plans.numbering import chunked_running_multi, offset_chunk

_BIG = np.iinfo(np.int64).max // 4
_NEG = -(1 << 62)
_POS = 1 << 62

#: Maps of neighbouring chunks that one task composes.
FAN_IN = 64
RUN_FIELDS = ("r_s", "r_e", "r_lo", "r_hi", "ex_start", "ex_t", "ex_cnt")


def _next_starts(ts: np.ndarray, n: int | None, t_us: int | None) -> np.ndarray:
    """Local index of the next window start for a window opened at each row."""
    L = len(ts)
    by_time = np.searchsorted(ts, ts + t_us, side="left") if t_us else np.full(L, _BIG)
    by_count = np.arange(L) + n if n else np.full(L, _BIG)
    return np.minimum(by_time, by_count)


def _absorbed(prefix_ts: np.ndarray, L: int, n: int | None, t_us: int | None,
              start_t: int, count: int) -> int:
    """Leading rows of a chunk taken by a window open at its start."""
    m = L
    if n:
        m = min(m, n - count)
    if t_us:
        m = min(m, int(np.searchsorted(prefix_ts, start_t + t_us, side="left")))
    return max(m, 0)


def _schema_keys(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


class Run(NamedTuple):
    """Entries of a span that absorb ``s`` .. ``e`` leading rows, by time those
    whose window ends in (lo, hi]; they leave the state (start, t, cnt), or
    with ``cnt`` below zero their own window still open."""
    s: int
    e: int
    lo: int
    hi: int
    start: int
    t: int
    cnt: int


class Span(NamedTuple):
    """Entry state -> exit state over ``rows`` consecutive rows of a key."""
    rows: int
    first_t: int
    runs: list[Run]


State = tuple[int, int, int]        # first row, its time, rows so far of the open window


def _leave(span: Span, state: State | None, n: int | None, t_us: int | None) -> State:
    """The window open after the span, given the one open before it."""
    if state is None:
        run = span.runs[0]
    else:
        end = state[1] + t_us if t_us else _POS
        run = next(r for r in span.runs if r.lo < end <= r.hi)
        if n and n - state[2] < run.s:
            run = next(r for r in span.runs if r.s <= n - state[2] <= r.e)
    return (state[0], state[1], state[2] + span.rows) if run.cnt < 0 else (run.start, run.t, run.cnt)


def _coalesce(runs: list[Run]) -> list[Run]:
    """Neighbouring runs with one exit as one; the last one has no end in time."""
    out: list[Run] = []
    for r in runs:
        if out and out[-1][4:] == r[4:]:
            out[-1] = out[-1]._replace(e=r.e, hi=r.hi)
        else:
            out.append(r)
    out[-1] = out[-1]._replace(hi=_POS)
    return out


def _compose(a: Span, b: Span, n: int | None, t_us: int | None) -> Span:
    """``a`` and then ``b``.  An entry that ``a`` settles leaves ``b`` in a known
    state; one whose window takes all of ``a`` goes on as a run of ``b``.  Runs
    that no window reaches (``n`` rows, or ``t_us`` after ``a``'s first row) go."""
    runs = []
    for r in a.runs:
        if r.cnt >= 0:
            runs.append(Run(*r[:4], *_leave(b, (r.start, r.t, r.cnt), n, t_us)))
            continue
        for q in b.runs:
            s, lo = a.rows + q.s, max(r.lo, q.lo)
            if not (n and s >= n) and not (t_us and lo >= a.first_t + t_us):
                runs.append(Run(s, a.rows + q.e, lo, q.hi, *q[4:]))
    return Span(a.rows + b.rows, a.first_t, _coalesce(runs))


def _spans(pdf: pd.DataFrame) -> list[Span]:
    """The maps of a group, in the order of their chunks."""
    pdf = pdf.sort_values("_c")
    return [Span(int(r["L"]), int(r["t0"]), [Run(*map(int, q)) for q in zip(*(r[f] for f in RUN_FIELDS))])
            for r in pdf.to_dict("records")]


def _entry_states(maps: DataFrame, keys: list[str], key_fields: list[T.StructField], n: int | None,
                  t_us: int | None, fan_in: int) -> DataFrame:
    """(keys, _c, in_start, in_t, in_cnt): the window open before each chunk
    (``in_start`` below zero: none), by an exclusive scan over the chunks' maps."""
    entry_schema = T.StructType([*key_fields, *[T.StructField(f, T.LongType())
                                                for f in ("_c", "in_start", "in_t", "in_cnt")]])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        span = reduce(lambda a, b: _compose(a, b, n, t_us), _spans(pdf))
        row = {k: pdf[k].iloc[0] for k in keys}
        row.update(_c=int(pdf["_c"].iloc[0]) // fan_in, L=span.rows, t0=span.first_t,
                   **{f: [r[j] for r in span.runs] for j, f in enumerate(RUN_FIELDS)})
        return pd.DataFrame([row])

    def descend(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_c")
        first = pdf.iloc[0]
        state = None if first["in_start"] < 0 else (int(first["in_start"]), int(first["in_t"]), int(first["in_cnt"]))
        states = []
        for span in _spans(pdf):
            states.append(state or (-1, 0, 0))
            state = _leave(span, state, n, t_us)
        out = pdf[[*keys, "_c"]].copy()
        out["in_start"], out["in_t"], out["in_cnt"] = (list(x) for x in zip(*states))
        return out

    span_no = F.floor(F.col("_c") / fan_in).cast("bigint")
    levels, chunks = [maps], (maps.agg(F.max("_c")).first()[0] or 0) + 1
    while chunks > fan_in:
        up = levels[-1].groupBy(*keys, span_no.alias("_span")).applyInPandas(compose, maps.schema)
        levels.append(up.checkpoint(eager=True))        # read on the way up and on the way down
        chunks = -(-chunks // fan_in)
    states = None
    for level in reversed(levels):
        level = level.withColumn("_span", span_no)
        if states is None:
            level = level.select("*", F.lit(-1).cast("bigint").alias("in_start"),
                                 F.lit(0).cast("bigint").alias("in_t"), F.lit(0).cast("bigint").alias("in_cnt"))
        else:
            level = _with_states(level, states, keys, "_span")
        states = level.groupBy(*keys, "_span").applyInPandas(descend, entry_schema)
    return states


def _with_states(df: DataFrame, states: DataFrame, keys: list[str], chunk: str) -> DataFrame:
    """``df`` with the entry state of its ``chunk``; keys may be null."""
    own = states.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_c").alias("_k"),
                        "in_start", "in_t", "in_cnt")
    same = [df[k].eqNullSafe(own[f"_k_{k}"]) for k in keys] + [df[chunk] == own["_k"]]
    return df.join(own, reduce(lambda x, y: x & y, same), "inner").drop("_k", *[f"_k_{k}" for k in keys])


def greedy_windows(df: DataFrame, keys: Sequence[str], order_col: str, ts_col: str,
                   max_rows: int | None = None, max_seconds: int | None = None,
                   value_col: str | None = None, rows_per_chunk: int = 1_000_000,
                   fan_in: int = FAN_IN) -> DataFrame:
    """Windows as rows: keys, window_start (row index), n_events,
    first_offset / last_offset (of ``order_col``), first_ts (micros) and
    max_value (max of ``value_col``, if given).  Time is the running maximum
    of ``ts_col`` along the row order, so it may step back in the input."""
    keys = list(keys)
    n = max_rows if max_rows and max_rows > 0 else None
    t_us = int(max_seconds * 1_000_000) if max_seconds and max_seconds > 0 else None
    val = F.col(value_col).cast("bigint") if value_col else F.lit(0).cast("bigint")
    base = df.select(*keys, F.col(order_col).alias("_o"), F.unix_micros(F.col(ts_col)).alias("_t"),
                     val.alias("_v"))
    # the clock is the running maximum: producers' event times may step back
    base = chunked_running_multi(base, keys, ["_o"], offset_chunk("_o", rows_per_chunk),
                                 [("_rn", "count", None), ("_clock", "max", "_t")])
    base = base.withColumn("_i", F.col("_rn") - 1).drop("_rn", "_t").withColumnRenamed("_clock", "_t") \
        .withColumn("_c", F.floor(F.col("_i") / rows_per_chunk).cast("bigint"))
    # The numbered rows feed two passes (candidates, assignment): write them
    # once to the checkpoint folder instead of recomputing the numbering.
    base = base.checkpoint(eager=True)
    key_fields = _schema_keys(df, keys)

    # -- 2. per chunk: exit state for every candidate number of absorbed rows,
    # run-length encoded (paths from different entries merge quickly, so a
    # chunk contributes a handful of runs, not one row per candidate)
    cand_schema = T.StructType([*key_fields, T.StructField("_c", T.LongType()),
                                T.StructField("L", T.LongType()), T.StructField("t0", T.LongType()),
                                *[T.StructField(f, T.ArrayType(T.LongType())) for f in RUN_FIELDS]])

    def candidates(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        ts = pdf["_t"].to_numpy(np.int64)
        idx = pdf["_i"].to_numpy(np.int64)
        L = len(ts)
        nxt = _next_starts(ts, n, t_us)
        M = L - 1
        if n:
            M = min(M, n - 1)
        if t_us:
            M = min(M, int(np.searchsorted(ts, ts[0] + t_us, side="left")))
        memo: dict[int, tuple[int, int, int]] = {}
        exits = []
        for m in range(0, M + 1):
            path = []
            x = m
            while x not in memo:
                path.append(x)
                y = int(nxt[x])
                if y >= L:
                    memo[x] = (int(idx[x]), int(ts[x]), L - x)
                    break
                x = y
            res = memo[x]
            for q in path:
                memo[q] = res
            exits.append(res)
        if M == L - 1:
            exits.append(None)          # the whole chunk absorbed: the open window passes through
        runs = {f: [] for f in RUN_FIELDS}
        m = 0
        while m < len(exits):
            e = m
            while e + 1 < len(exits) and exits[e + 1] == exits[m]:
                e += 1
            ex = exits[m] or (-1, -1, -1)
            runs["r_s"].append(m)
            runs["r_e"].append(e)
            # absorbing m rows by time means ts[m-1] < start + t <= ts[m]
            runs["r_lo"].append(int(ts[m - 1]) if m > 0 else _NEG)
            runs["r_hi"].append(int(ts[e]) if e < L and e < len(exits) - 1 else _POS)
            runs["ex_start"].append(ex[0])
            runs["ex_t"].append(ex[1])
            runs["ex_cnt"].append(ex[2] if exits[m] is not None else -1)
            m = e + 1
        row = {k: pdf[k].iloc[0] for k in keys}
        row.update(_c=int(pdf["_c"].iloc[0]), L=L, t0=int(ts[0]), **runs)
        return pd.DataFrame([row])

    # -- 4. per chunk: assign rows to windows from the entry state, partial aggregates
    part_schema = T.StructType([*key_fields, T.StructField("window_start", T.LongType()),
                                T.StructField("n_events", T.LongType()),
                                T.StructField("first_offset", T.LongType()),
                                T.StructField("last_offset", T.LongType()),
                                T.StructField("first_ts", T.LongType()),
                                T.StructField("max_value", T.LongType())])

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        ts = pdf["_t"].to_numpy(np.int64)
        idx = pdf["_i"].to_numpy(np.int64)
        L = len(ts)
        in_start = int(pdf["in_start"].iloc[0])
        m = 0 if in_start < 0 else _absorbed(ts, L, n, t_us, int(pdf["in_t"].iloc[0]), int(pdf["in_cnt"].iloc[0]))
        wstart = np.empty(L, dtype=np.int64)
        wstart[:min(m, L)] = in_start
        if m < L:
            nxt = _next_starts(ts, n, t_us)
            x = m
            while x < L:
                y = min(int(nxt[x]), L)
                wstart[x:y] = idx[x]
                x = y
        g = pd.DataFrame({"window_start": wstart, "_o": pdf["_o"].to_numpy(np.int64), "_t": ts,
                          "_v": pdf["_v"].to_numpy(np.int64)})
        agg = g.groupby("window_start", sort=False).agg(
            n_events=("_o", "size"), first_offset=("_o", "min"), last_offset=("_o", "max"),
            first_ts=("_t", "min"), max_value=("_v", "max")).reset_index()
        for k in keys:
            agg[k] = pdf[k].iloc[0]
        return agg[[f.name for f in part_schema.fields]]

    maps = base.groupBy(*keys, "_c").applyInPandas(candidates, cand_schema).checkpoint(eager=True)
    rows = _with_states(base, _entry_states(maps, keys, key_fields, n, t_us, fan_in), keys, "_c")
    parts = rows.groupBy(*keys, "_c").applyInPandas(assign, part_schema)
    return (parts.groupBy(*keys, "window_start")
            .agg(F.sum("n_events").alias("n_events"), F.min("first_offset").alias("first_offset"),
                 F.max("last_offset").alias("last_offset"), F.min("first_ts").alias("first_ts"),
                 F.max("max_value").alias("max_value")))


# --------------------------------------------------------------------------- commit flushes

ARRIVAL_BASE = "2024-02-01 00:00:00"   # fixture: message k arrives k minutes after this


def arrival_time(arrival_seq: str = "arrival_seq"):
    return F.timestamp_seconds(F.unix_timestamp(F.lit(ARRIVAL_BASE)) + F.col(arrival_seq).cast("bigint") * 60)


def flush_timeline(registrations: DataFrame, keys: Sequence[str], interval_seconds: int) -> DataFrame:
    """The first accepted registration arms a one-shot timer; at +interval
    one flush carries the current high-water offset; the next accepted
    registration re-arms.  Windows are greedy in time with no count limit;
    the flushed offset is the window's max accepted offset (offsets only
    grow among accepted registrations)."""
    acc = registrations.filter(F.col("accepted")).withColumn("_arrived", arrival_time())
    w = greedy_windows(acc, keys, "arrival_seq", "_arrived", max_rows=None,
                       max_seconds=interval_seconds, value_col="offset")
    flush_at = F.timestamp_micros(F.col("first_ts") + F.lit(interval_seconds * 1_000_000))
    return w.select(*keys, format_offset_datetime(flush_at).alias("flush_at"),
                    F.col("n_events").alias("n_registrations"), F.col("max_value").alias("flushed_offset"))


def uncommitted_on_close(registrations: DataFrame, keys: Sequence[str], interval_seconds: int,
                         closed_at: str) -> DataFrame:
    """C11: closing cancels the pending timer without a last flush.  Per
    key: the last committed offset (flushes due by the close) and how many
    consumed messages lie above it, i.e. will be delivered again."""
    close = F.to_timestamp(F.lit(closed_at))
    reg = registrations.withColumn("_arrived", arrival_time()).filter(F.col("_arrived") <= close)
    acc = reg.filter(F.col("accepted"))
    w = greedy_windows(acc, keys, "arrival_seq", "_arrived", max_rows=None,
                       max_seconds=interval_seconds, value_col="offset")
    due = w.filter(F.timestamp_micros(F.col("first_ts") + F.lit(interval_seconds * 1_000_000)) <= close)
    committed = due.groupBy(*keys).agg(F.max("max_value").alias("committed_offset"))
    j = reg.join(committed, [*keys], "left")
    return (j.groupBy(*keys)
            .agg(F.max("committed_offset").alias("committed_offset"),
                 F.count_if(F.col("committed_offset").isNull()
                            | (F.col("offset") > F.col("committed_offset"))).cast("bigint").alias("n_at_risk")))
