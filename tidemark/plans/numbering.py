"""Running aggregates per key without sending a whole key to one task.

A plain ``row_number() OVER (PARTITION BY key ORDER BY ...)`` puts every row
of a key into one task.  A log partition can hold a third of all rows, so
instead the ordered rows of a key are cut into *chunks* by an expression
that is monotone in the sort order and bounds the rows per chunk (an offset
range, a time bucket, a hash prefix).  Then

1. the running aggregate is computed inside each (key, chunk) by a window,
2. each (key, chunk) is reduced to one total row (partial + final
   aggregate, map-side combined, tiny output),
3. the totals of all *earlier* chunks of the key are combined with a
   window over that small table,
4. the small prefix table is joined back on (key, chunk).  The big side is
   already hash-partitioned on exactly those columns by step 1, so only the
   small side moves; AQE turns it into a broadcast join once its real size
   is known to be under the broadcast threshold.

Exact for count / sum / max / min; the result equals the single-window form.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# how -> (aggregate of the value, aggregate of chunk totals, combine(local, prev))
_COMBINE = {
    "count": (lambda c: F.count(F.lit(1)), F.sum,
              lambda a, b: a + F.coalesce(b, F.lit(0))),
    "sum": (F.sum, F.sum,
            lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (F.max, F.max, lambda a, b: F.greatest(a, b)),
    "min": (F.min, F.min, lambda a, b: F.least(a, b)),
}


def chunked_running(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    chunk: Column, out: str, how: str = "count",
                    value: Column | str | None = None, exclusive: bool = False) -> DataFrame:
    """Add column ``out`` = running ``how`` of ``value`` per ``keys`` in ``order``.

    ``count`` is the 1-based row number.  ``exclusive`` excludes the current
    row (frame ends one row before it); the empty frame yields null for
    max/min and 0 for count/sum.  ``chunk`` must be non-decreasing along
    ``order`` within a key.
    """
    return chunked_running_multi(df, keys, order, chunk, [(out, how, value)], exclusive)


def chunked_running_multi(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                          chunk: Column, specs: Sequence[tuple[str, str, Column | str | None]],
                          exclusive: bool = False) -> DataFrame:
    """Several running aggregates in one pass (one window, one small prefix
    table, one join).  ``specs`` = [(out, how, value), ...]."""
    keys = list(keys)
    ck = "_chunk"
    data = df.withColumn(ck, chunk)
    part = [*keys, ck]
    w = Window.partitionBy(*part).orderBy(*order)
    w = w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    wprev = Window.partitionBy(*keys).orderBy(ck).rowsBetween(Window.unboundedPreceding, -1)
    tot_aggs, prev_cols, finals = [], [], []
    for n, (out, how, value) in enumerate(specs):
        per_row, per_prev, combine = _COMBINE[how]
        val = F.lit(1) if value is None else (F.col(value) if isinstance(value, str) else value)
        data = data.withColumn(f"_val{n}", val)
        data = data.withColumn(f"_local{n}", per_row(F.col(f"_val{n}")).over(w))
        tot_aggs.append(per_row(F.col(f"_val{n}")).alias(f"_tot{n}"))
        prev_cols.append(per_prev(F.col(f"_tot{n}")).over(wprev).alias(f"_prev{n}"))
        finals.append((out, combine(F.col(f"_local{n}"), F.col(f"_prev{n}"))))
    prefix = data.groupBy(*part).agg(*tot_aggs).select(*part, *prev_cols)
    joined = data.join(prefix, on=part, how="left")
    for out, expr in finals:
        joined = joined.withColumn(out, expr)
    drop = [ck] + [f"_{x}{n}" for n in range(len(specs)) for x in ("val", "local", "prev")]
    return joined.drop(*drop)


def offset_chunk(offset: Column | str, rows_per_chunk: int = 1 << 20) -> Column:
    """Chunk by offset range: offsets are unique within a log partition, so a
    chunk holds at most ``rows_per_chunk`` rows whatever the key skew."""
    o = F.col(offset) if isinstance(offset, str) else offset
    return F.floor(o / F.lit(rows_per_chunk)).cast("bigint")


def time_chunk(ts: Column | str, seconds: int = 3600) -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(t) / F.lit(seconds * 1_000_000)).cast("bigint")


def hash_prefix_chunk(hex_col: Column | str, digits: int = 4) -> Column:
    """Chunk by the leading hex digits of a uniformly distributed hash."""
    h = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("bigint")


def chunked_lag(df: DataFrame, keys: Sequence[str], order: str, value: str, chunk: Column,
                out: str) -> DataFrame:
    """``lag(value)`` per key in ``order`` without a whole key in one task.

    Inside a (key, chunk) the previous row comes from a window; the first
    row of a chunk takes the last row of the key's previous non-empty chunk,
    found in the small one-row-per-chunk table."""
    keys = list(keys)
    ck = "_chunk"
    data = df.withColumn(ck, chunk)
    part = [*keys, ck]
    w = Window.partitionBy(*part).orderBy(order)
    data = data.withColumn("_in_chunk", F.lag(value).over(w))
    last = data.groupBy(*part).agg(F.max_by(F.col(value), F.col(order)).alias("_last"))
    wprev = Window.partitionBy(*keys).orderBy(ck)
    prev = last.select(*part, F.lag("_last").over(wprev).alias("_prev_chunk_last"))
    first = F.min(order).over(Window.partitionBy(*part))
    j = data.join(prev, part, "left")
    return (j.withColumn(out, F.when(F.col(order) == first, F.col("_prev_chunk_last"))
                         .otherwise(F.col("_in_chunk")))
            .drop(ck, "_in_chunk", "_prev_chunk_last"))
