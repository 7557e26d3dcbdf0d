"""Joins of the log with small per-partition tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cursor, commit and run tables have one row per log partition (and group):
# bounded by the topic layout, not by data volume.  The bound is still
# checked before a broadcast.
MAX_BROADCAST_ROWS = 200_000


def collect_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS):
    """Rows of ``df`` if it has at most ``max_rows`` rows, else None.  The
    check collects at most ``max_rows + 1`` rows."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A broadcastable copy of ``df`` when its size is proven small (built
    from the rows already collected for the check, so the small side is not
    computed again), else ``df`` itself for a shuffle join or AQE's runtime
    choice."""
    rows = collect_small(df, max_rows)
    if rows is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
