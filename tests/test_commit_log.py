"""The commits table with many writers."""

import glob
import os
import threading
from datetime import datetime

import pytest

from tidemark.operators import commit_log
from tidemark.operators.commits import TABLE_SCHEMA
from tidemark.sources.version_log import VersionLog

T0 = datetime(2024, 2, 1)


def puts(spark, *rows):
    """(group, event type, partition, checkpoint, supplied counter)"""
    return spark.createDataFrame([(p, c, "h", n, T0, None, e, g) for g, e, p, c, n in rows], TABLE_SCHEMA)


def state(spark, root, **of):
    return {(r.group_id, r.event_type, r.partition_id): (r.checkpoint_id, r.lease_counter)
            for r in commit_log.read(spark, root, **of).collect()}


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "commits")


def test_groups_and_types_have_their_own_lines(spark, root):
    assert state(spark, root) == {}
    commit_log.put(spark, root, puts(spark, ("g1", "t", "0", "5", None), ("g1", "u", "0", "7", None)))
    commit_log.put(spark, root, puts(spark, ("g2", "t", "0", "1", None)))
    before = set(glob.glob(f"{root}/**/*", recursive=True))
    commit_log.put(spark, root, puts(spark, ("g1", "t", "0", "6", None), ("g1", "t", "1", "2", None)))
    new = {os.path.relpath(p, root) for p in set(glob.glob(f"{root}/**/*", recursive=True)) - before}
    assert all("event_type=u" not in p and "group_id=g2" not in p for p in new)
    assert {p for p in new if p.endswith(".json")} == {"log/t/g1/000000000002.json"}
    assert state(spark, root) == {("g1", "t", "0"): ("6", 2), ("g1", "t", "1"): ("2", 1), ("g1", "u", "0"): ("7", 1),
                                  ("g2", "t", "0"): ("1", 1)}
    assert state(spark, root, group_id="g2") == {("g2", "t", "0"): ("1", 1)}
    assert state(spark, root, event_type="u") == {("g1", "u", "0"): ("7", 1)}


def test_a_lost_race_is_done_again_from_the_winners_state(spark, root):
    commit_log.put(spark, root, puts(spark, ("g", "t", "0", "5", 9)))

    def compete(attempt):
        if attempt == 1:
            commit_log.put(spark, root, puts(spark, ("g", "t", "0", "8", 40), ("g", "t", "1", "3", None)))

    rounds = commit_log.put(spark, root, puts(spark, ("g", "t", "0", "9", None), ("g", "u", "0", "1", None)), before_append=compete)
    assert rounds == 2
    assert state(spark, root) == {("g", "t", "0"): ("9", 41), ("g", "t", "1"): ("3", 1), ("g", "u", "0"): ("1", 1)}


def test_forward_puts_see_the_winner_too(spark, root):
    def compete(attempt):
        if attempt == 1:
            commit_log.put(spark, root, puts(spark, ("g", "t", "0", "80", None)))

    commit_log.put(spark, root, puts(spark, ("g", "t", "0", "9", None)), forward=True, before_append=compete)
    assert state(spark, root) == {("g", "t", "0"): ("80", 1)}


def test_concurrent_writers(spark, root):
    errors = []

    def work(group, event_type, n):
        try:
            for k in range(n):
                commit_log.put(spark, root, puts(spark, (group, event_type, "0", str(k), None)))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=x) for x in (
        ("g1", "t", 3), ("g1", "t", 3), ("g2", "t", 3), ("g1", "u", 3))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert {k: v[1] for k, v in state(spark, root).items()} == {("g1", "t", "0"): 6, ("g2", "t", "0"): 3, ("g1", "u", "0"): 3}


def test_deltas_are_merged_and_compacted(spark, root, monkeypatch):
    monkeypatch.setattr(commit_log, "COMPACT_AFTER", 3)
    commit_log.put(spark, root, puts(spark, ("g", "t", "keep", "1", None)))
    for k in range(8):
        commit_log.put(spark, root, puts(spark, ("g", "t", "0", str(k), None)))
        version, entry = commit_log._line(spark, root, ("t", "g")).latest()
        assert version == k + 2 and len(entry["deltas"]) <= 3
        assert state(spark, root) == {("g", "t", "keep"): ("1", 1), ("g", "t", "0"): (str(k), k + 1)}
    folders = len(glob.glob(f"{root}/data/put=*"))
    assert commit_log.vacuum(spark, root, keep=1, min_age_seconds=3600) == 0
    assert commit_log.vacuum(spark, root, keep=1, min_age_seconds=-5) == folders - len(entry["deltas"])
    assert state(spark, root) == {("g", "t", "keep"): ("1", 1), ("g", "t", "0"): ("7", 8)}


def test_a_replayed_batch_changes_nothing(spark, root):
    rows = puts(spark, ("g", "t", "0", "5", None), ("g", "u", "0", "5", None))
    commit_log.put(spark, root, puts(spark, ("g", "t", "0", "5", None)), writer="w", batch=0)     # died before pair u
    commit_log.put(spark, root, rows, writer="w", batch=0)
    assert commit_log.put(spark, root, rows, writer="w", batch=0) == 0
    assert state(spark, root) == {("g", "t", "0"): ("5", 1), ("g", "u", "0"): ("5", 1)}
    commit_log.put(spark, root, rows, writer="other", batch=0)
    assert {v for v in state(spark, root).values()} == {("5", 2)}


def test_odd_names(spark, root):
    commit_log.put(spark, root, puts(spark, ("a/b %2", "x=y é", "0", "5", None)))
    assert state(spark, root) == {("a/b %2", "x=y é", "0"): ("5", 1)}
    commit_log.load(spark, root, puts(spark, ("new", "t", "0", "5", 7)))
    assert state(spark, root, group_id="new") == {("new", "t", "0"): ("5", 7)}
    with pytest.raises(RuntimeError, match="have commits"):
        commit_log.load(spark, root, puts(spark, ("new", "t", "0", "6", 7)))


def test_version_log(spark, tmp_path):
    a, b = VersionLog(spark, str(tmp_path / "line")), VersionLog(spark, str(tmp_path / "line"))
    assert a.latest() == (0, {})
    assert a.append(1, {"x": "é"}) and not b.append(1, {"x": 2}) and b.append(2, {})
    assert a.versions() == [1, 2] and a.read(1) == {"x": "é"} and a.latest() == (2, {})
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(k) if VersionLog(spark, a.root).append(3, {"by": k}) else None)
               for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and a.read(3) == {"by": won[0]}
    assert all(not n.startswith(".aside") for n in os.listdir(tmp_path / "line"))


def test_version_log_by_rename(spark, tmp_path):
    """The way of stores other than a local disk."""
    a, b = VersionLog(spark, str(tmp_path / "line")), VersionLog(spark, str(tmp_path / "line"))
    a.linked = b.linked = False
    assert a.append(1, {"x": 1}) and not b.append(1, {"x": 2}) and b.append(2, {}) and a.read(1) == {"x": 1}
    b.fs = _Blind(b.fs)               # the name is taken between the look and the rename
    assert not b.append(2, {"x": 3}) and a.read(2) == {}


class _Blind:
    """A file system that does not see a name at the first look."""

    def __init__(self, fs):
        self.fs, self.looks = fs, 0

    def exists(self, p):
        self.looks += 1
        return self.looks > 1 and self.fs.exists(p)

    def __getattr__(self, name):
        return getattr(self.fs, name)
