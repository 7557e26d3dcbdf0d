"""Live A8 and A10: limits that span micro-batches, against the batch operators."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import codec, consume
from tidemark.streaming import consume as streams
from tidemark.streaming import limits

# per partition: batches of this many events, 0 = keep-alive
RUNS = {"0": [2, 2, 0, 3, 0, 0, 1, 2], "1": [1, 0, 2, 0, 1, 0, 2, 1], "2": [3, 3, 3, 0, 0, 0, 1, 1]}


def land(root):
    """One file per batch round, all partitions in each; file times in that order."""
    os.makedirs(f"{root}/event_type=t")
    at = {p: 0 for p in RUNS}
    for k in range(8):
        lines = []
        for p, sizes in RUNS.items():
            events = [{"metadata": {"eid": f"{p}-{at[p] + j}", "occurred_at": "2024-01-01T00:00:00Z"}, "a": 1}
                      for j in range(sizes[k])]
            at[p] += sizes[k]
            line = {"cursor": {"partition": p, "offset": str(at[p] - 1)}}
            lines.append(json.dumps(line | ({"events": events} if events else {})))
        path = f"{root}/event_type=t/{k:03d}.txt"
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def expected(spark, root, stream_limit, keep_alive_limit):
    lines = spark.read.text(root).select("event_type", "value")
    m = codec.to_consumer_messages(codec.decode_batches(lines))
    d = consume.close_on_keep_alives(m.select(*limits.KEYS, "cursor_offset_long", "n_events"), keep_alive_limit)
    last = {r.partition: r.last for r in d.groupBy("partition").agg(F.max("cursor_offset_long").alias("last")).collect()}
    return sorted((p, o) for p, end in last.items() for o in range(end + 1) if not stream_limit or o < stream_limit)


@pytest.mark.parametrize("stream_limit, keep_alive_limit", [(0, 2), (5, 0), (7, 3)])
def test_limits_one_file_per_trigger(spark, tmp_path, stream_limit, keep_alive_limit):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    land(root)
    limits.consume_limited(spark, root, out, stream_limit, keep_alive_limit, max_files=1)
    got = sorted((r.partition, r.offset) for r in streams.read_events(spark, out).collect())
    assert got == expected(spark, root, stream_limit, keep_alive_limit)


def test_stops_when_all_partitions_are_closed(spark, tmp_path):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    land(root)
    limits.consume_limited(spark, root, out, stream_limit=2, partitions=3, max_files=1)
    got = sorted((r.partition, r.offset) for r in streams.read_events(spark, out).collect())
    assert got == [(p, o) for p in "012" for o in range(2)]
    # every partition holds two events by the third file: later files are left unread (one may be under way)
    assert len([d for d in os.listdir(f"{out}/limits") if d.startswith("batch_id")]) <= 5
