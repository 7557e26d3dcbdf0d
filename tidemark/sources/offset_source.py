"""A2: the segmented wire log as a stream addressed by offsets.

A Python data source whose stream offset is a map event type -> partition ->
last offset delivered.  A micro-batch takes whole segments that follow the
map's position without a gap, whatever the times or order in which files or
runs landed, so every partition is delivered in the order of its offsets; a
run that lands before its predecessor waits.  ``maxOffsetsPerTrigger`` bounds
a micro-batch (at least one segment), the partitions that are furthest behind
first.  ``start`` holds cursors: segments that end at or before them are never
opened.  One task reads one segment or, so that small segments cost no task
each, a run of segments that follow one another, as Arrow batches.

The source reads files with Arrow's file systems (local, HDFS, S3, GCS ...) in
Python workers.  It is shipped by value, so it imports nothing of the package.
"""

from __future__ import annotations

import bisect
import heapq
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "tidemark_offsets"
SCHEMA = "event_type string, partition string, segment_offset bigint, line bigint, value string"
READ_BYTES = 8 << 20
#: Offsets that one task reads at most, unless a single segment has more.
TASK_OFFSETS = 1 << 17


class Segments(InputPartition):
    """What one task reads: (event type, partition, first offset, folder) of
    each segment, in order; the first one's place is the task's."""

    def __init__(self, pieces: list[tuple[str, str, int, str]]):
        self.pieces = pieces
        self.event_type, self.partition, self.first, _ = pieces[0]


class OffsetLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> "OffsetLogReader":
        return OffsetLogReader(dict(self.options))


class OffsetLogReader(DataSourceStreamReader):
    """Options: ``path``; ``maxOffsetsPerTrigger``; ``start``, the cursors of a
    new stream (a partition without one begins at offset 0); ``resume``, the
    position at which this run of the query begins, since Spark asks for the
    latest offset before it tells the first (without it the first micro-batch
    is not bounded); ``eventTypes``; ``tasks``, into about how many tasks a
    micro-batch is dealt (0: one per segment).  ``batch_log.stream_offsets``
    sets them."""

    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.path = options["path"].rstrip("/")
        self.most = int(options.get("maxoffsetspertrigger") or 0)
        self.start = json.loads(options.get("start") or "{}")
        self.types = json.loads(options["eventtypes"]) if options.get("eventtypes") else None
        self.at = json.loads(options["resume"]) if options.get("resume") else None
        self.tasks = int(options.get("tasks") or 0)
        self.seen: set[str] = set()
        self.segments: dict[tuple[str, str], list[tuple[int, int, str]]] = {}

    def _files(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.path)

    def _refresh(self) -> None:
        """Take in the runs published since the last look."""
        import pyarrow.parquet as pq
        from pyarrow import fs
        store, root = self._files()
        listed = store.get_file_info(fs.FileSelector(f"{root}/log", allow_not_found=True))
        for info in sorted(listed, key=lambda i: i.base_name):
            if info.base_name in self.seen or not info.base_name.endswith(".json") or not info.base_name[:-5].isdigit():
                continue
            with store.open_input_stream(info.path) as f:
                run = json.loads(f.read())["run"]
            for part in store.get_file_info(fs.FileSelector(f"{root}/manifest/run={run}")):
                if not part.base_name.endswith(".parquet"):
                    continue
                for r in pq.read_table(store.open_input_file(part.path)).to_pylist():
                    if self.types is None or r["event_type"] in self.types:
                        folder = f"{self.path}/data/run={r['run']}/segment={r['segment']}"
                        self.segments.setdefault((r["event_type"], r["partition"]), []).append(
                            (r["first_offset"], r["last_offset"], folder))
            self.seen.add(info.base_name)
        for own in self.segments.values():
            own.sort()

    def _next(self, key: tuple[str, str], at: int) -> tuple[int, int, str] | None:
        """The segment that holds the offset after ``at``, if it has landed."""
        own = self.segments[key]
        k = bisect.bisect_right(own, at + 1, key=lambda s: s[0]) - 1
        return own[k] if k >= 0 and own[k][1] > at else None

    def initialOffset(self) -> dict:
        self.at = self.start
        return self.start

    def latestOffset(self) -> dict:
        self._refresh()
        most = self.most if self.at is not None else 0
        end = {e: dict(p) for e, p in (self.at or {}).items()}
        last = {k: int(end.get(k[0], {}).get(k[1], -1)) for k in self.segments}
        queue = [(own[-1][1] - last[k], k) for k, own in self.segments.items()]
        heap = [(-behind, k) for behind, k in queue if behind > 0]
        heapq.heapify(heap)
        taken = 0
        while heap:
            behind, k = heapq.heappop(heap)
            seg = self._next(k, last[k])
            if seg is None:                     # a gap: what comes before has not landed
                continue
            if taken and most and taken + seg[1] - last[k] > most:
                continue
            taken += seg[1] - last[k]
            last[k] = seg[1]
            end.setdefault(k[0], {})[k[1]] = seg[1]
            if (rest := self.segments[k][-1][1] - seg[1]) > 0:
                heapq.heappush(heap, (-rest, k))
        return end

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self._refresh()
        found = []
        for (event_type, partition), own in sorted(self.segments.items()):
            low = int(start.get(event_type, {}).get(partition, -1))
            high = int(end.get(event_type, {}).get(partition, -1))
            found += [(last - first + 1, (event_type, partition, first, folder))
                      for first, last, folder in own if last > low and last <= high]
        self.at = end
        return self._dealt(found)

    def _dealt(self, found: list) -> list[Segments]:
        """Cut the segments into runs of about equally many offsets, one per
        task: a segment belongs to the run in which its middle lies."""
        if not self.tasks:
            return [Segments([piece]) for _, piece in found]
        share = min(max(sum(n for n, _ in found) / self.tasks, 1), TASK_OFFSETS)
        runs: dict[int, list] = {}
        before = 0
        for n, piece in found:
            runs.setdefault(int((before + n / 2) // share), []).append(piece)
            before += n
        return [Segments(pieces) for pieces in runs.values()]

    def commit(self, end: dict) -> None:
        self.at = end

    def read(self, partition: Segments) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        for event_type, number, first, uri in partition.pieces:
            store, folder = fs.FileSystem.from_uri(uri)
            files = sorted(i.path for i in store.get_file_info(fs.FileSelector(folder)) if i.base_name.startswith("part-"))
            n = 0
            for path in files:
                with store.open_input_stream(path) as f:
                    rest = b""
                    while True:
                        block = f.read(READ_BYTES)
                        lines = (rest + block).split(b"\n")
                        rest = lines.pop()
                        if not block and rest:
                            lines, rest = [*lines, rest], b""
                        if lines:
                            k = len(lines)
                            yield pa.RecordBatch.from_arrays([
                                pa.array([event_type] * k, pa.string()), pa.array([number] * k, pa.string()),
                                pa.array([first] * k, pa.int64()), pa.array(range(n, n + k), pa.int64()),
                                pa.array(lines, pa.binary()).cast(pa.string())],
                                names=["event_type", "partition", "segment_offset", "line", "value"])
                            n += k
                        if not block:
                            break
