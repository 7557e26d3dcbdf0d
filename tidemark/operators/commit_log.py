"""The commits table for many writers.

Each (event type, group) has a version line of its own (``log/<type>/<group>``),
so consumers of different groups or event types never meet.  A version names
the *deltas* that make up the pair's rows: Parquet folders ``data/put=<id>``,
partitioned by (event_type, group_id), with the rows one put has changed.
Reading merges them, the newest row per partition winning; after
``COMPACT_AFTER`` deltas a put writes the pair's whole state instead.

A put reads the state of its pairs, works out the new rows (one Spark job for
all pairs), writes them and then moves each pair's line by compare and set.  A
pair whose line was moved meanwhile is done again from the winner's state.  A
named writer's batch is recorded with the version, so a replayed micro-batch
changes nothing.  Pairs move one by one: a put of several pairs that dies half
way leaves whole pairs behind, and its repetition completes the rest.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.offsets import offset_to_long, require_offset
from tidemark.operators.commits import TABLE_COLUMNS, TABLE_KEYS, TABLE_SCHEMA, commit_put
from tidemark.plans.joins import MAX_BROADCAST_ROWS, collect_small
from tidemark.sources.version_log import VersionLog

COMPACT_AFTER = 8
RETRIES = 50
Pair = tuple[str, str]                  # event type, group
_LIVE = "event_type string, group_id string, put string, _version bigint"


def _line(spark: SparkSession, root: str, pair: Pair) -> VersionLog:
    return VersionLog(spark, f"{root}/log/{quote(pair[0], safe='')}/{quote(pair[1], safe='')}")


def pairs(spark: SparkSession, root: str) -> list[Pair]:
    """The (event type, group) pairs that have commits."""
    log = VersionLog(spark, f"{root}/log")
    if not log.fs.exists(log._path("")):
        return []
    return sorted((unquote(t.getPath().getName()), unquote(g.getPath().getName()))
                  for t in log.fs.listStatus(log._path("")) for g in log.fs.listStatus(t.getPath()))


def _merged(spark: SparkSession, root: str, entries: dict[Pair, dict]) -> DataFrame:
    """Rows of these pairs: per partition the one of the newest delta."""
    live = [(e, g, put, k) for (e, g), entry in entries.items() for k, put in enumerate(entry.get("deltas", []))]
    if not live:
        return spark.createDataFrame([], TABLE_SCHEMA).select(*TABLE_COLUMNS)
    paths = sorted({f"{root}/data/put={put}/" for _, _, put, _ in live})
    rows = spark.read.schema(TABLE_SCHEMA + ", put string").option("basePath", f"{root}/data").parquet(*paths)
    rows = rows.join(F.broadcast(spark.createDataFrame(live, _LIVE)), ["event_type", "group_id", "put"])
    newest = F.max_by(F.struct(*TABLE_COLUMNS[3:]), "_version").alias("_r")
    return rows.groupBy(*TABLE_KEYS).agg(newest).select(*TABLE_KEYS, "_r.*")


def read(spark: SparkSession, root: str, group_id: str | None = None, event_type: str | None = None) -> DataFrame:
    """The table, or the rows of one group or event type: only the lines and
    folders of those pairs are read."""
    wanted = [p for p in pairs(spark, root) if event_type in (None, p[0]) and group_id in (None, p[1])]
    return _merged(spark, root, {p: _line(spark, root, p).latest()[1] for p in wanted})


def _of_pairs(rows: DataFrame, wanted: list[Pair]) -> DataFrame:
    small = rows.sparkSession.createDataFrame(wanted, "event_type string, group_id string")
    return rows.join(F.broadcast(small), ["event_type", "group_id"], "left_semi")


def only_ahead(current: DataFrame, puts: DataFrame) -> DataFrame:
    """The puts whose checkpoint lies after the stored one."""
    stored = current.select(*TABLE_KEYS, F.col("checkpoint_id").alias("_stored"))
    ahead = F.col("_stored").isNull() | (offset_to_long("checkpoint_id") > require_offset("_stored"))
    return puts.join(stored, TABLE_KEYS, "left").filter(ahead).drop("_stored")


def put(spark: SparkSession, root: str, puts: DataFrame, writer: str | None = None, batch: int | None = None,
        forward: bool = False, before_append: Callable[[int], None] | None = None) -> int:
    """Apply ``puts`` (the columns of the table, ``put_seq`` if a key occurs
    more than once); returns the number of rounds it took.

    ``writer`` and ``batch`` name a repeatable put: pairs that already have it
    are left alone.  ``forward`` keeps only puts ahead of the stored
    checkpoint.  ``before_append(round)`` runs between reading and moving the
    lines (tests put a competing writer there)."""
    puts = puts.checkpoint(eager=True)                  # read once per round
    found = collect_small(puts.select("event_type", "group_id").distinct())
    if found is None:
        raise ValueError(f"a put of more than {MAX_BROADCAST_ROWS} (event type, group) pairs")
    pending = [(r["event_type"], r["group_id"]) for r in found]
    for attempt in range(1, RETRIES + 1):
        state = {p: _line(spark, root, p).latest() for p in pending}
        if writer is not None and batch is not None:
            state = {p: s for p, s in state.items() if s[1].get("done", {}).get(writer, -1) < batch}
        if not state:
            return attempt - 1
        current = _merged(spark, root, {p: entry for p, (_, entry) in state.items()})
        mine = _of_pairs(puts, list(state))
        if forward:
            mine = only_ahead(current, mine)
        whole = {p for p, (_, entry) in state.items() if len(entry.get("deltas", [])) >= COMPACT_AFTER}
        rows = commit_put(current, mine)
        changed = rows.join(mine.select(*TABLE_KEYS).distinct(), TABLE_KEYS, "left_semi")
        if whole:
            rest = rows.join(mine.select(*TABLE_KEYS).distinct(), TABLE_KEYS, "left_anti")
            changed = changed.unionByName(_of_pairs(rest, sorted(whole)).select(*changed.columns))
        name = uuid.uuid4().hex
        changed.select(*TABLE_COLUMNS).write.partitionBy("event_type", "group_id").parquet(f"{root}/data/put={name}")
        if before_append is not None:
            before_append(attempt)
        lost = []
        for p, (version, entry) in state.items():
            done = dict(entry.get("done", {}))
            if writer is not None and batch is not None:
                done[writer] = batch
            deltas = [name] if p in whole else [*entry.get("deltas", []), name]
            if not _line(spark, root, p).append(version + 1, {"deltas": deltas, "done": done}):
                lost.append(p)
        if not lost:
            return attempt
        pending = lost
        time.sleep(min(1.0, 0.02 * attempt))
    raise RuntimeError(f"{len(pending)} pairs of {root} were moved by others {RETRIES} times in a row")


def load(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """Store whole rows (an import, no put: counters stay) as the first
    version of pairs that have none."""
    name = uuid.uuid4().hex
    rows = rows.select(*TABLE_COLUMNS)
    rows.write.partitionBy("event_type", "group_id").parquet(f"{root}/data/put={name}")
    stored = spark.read.schema(TABLE_SCHEMA).parquet(f"{root}/data/put={name}")
    found = collect_small(stored.select("event_type", "group_id").distinct())
    if found is None:
        raise ValueError(f"more than {MAX_BROADCAST_ROWS} (event type, group) pairs")
    for r in found:
        if not _line(spark, root, (r["event_type"], r["group_id"])).append(1, {"deltas": [name], "done": {}}):
            raise RuntimeError(f"{r['event_type']}, {r['group_id']} of {root} have commits")


def vacuum(spark: SparkSession, root: str, keep: int = 10, min_age_seconds: int = 3600) -> int:
    """Delete the versions of each line beyond the ``keep`` newest and the
    deltas that no kept version names, if older than ``min_age_seconds`` (a put
    under way has written its delta but not yet named it)."""
    named = set()
    for p in pairs(spark, root):
        line = _line(spark, root, p)
        numbers = line.versions()
        for v in numbers[:-keep]:
            line.fs.delete(line._path(f"{v:012d}.json"), False)
        named |= {d for v in numbers[-keep:] for d in line.read(v)["deltas"]}
    data, gone = VersionLog(spark, f"{root}/data"), 0
    for st in data.fs.listStatus(data._path("")) if data.fs.exists(data._path("")) else []:
        old = st.getModificationTime() < (time.time() - min_age_seconds) * 1000
        if old and st.getPath().getName().removeprefix("put=") not in named:
            gone += bool(data.fs.delete(st.getPath(), True))
    return gone
