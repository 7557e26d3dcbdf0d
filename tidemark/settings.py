"""Consumer and producer parameters with the defaults of the data contract.

A consumer is (event type, group, partitions) plus its read limits; the
operators take these values as plain arguments, this module only keeps the
defaults together and derives the dependent values.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from tidemark.functions.offsets import BEGIN

# Defaults of the consumer / producer parameters.
COMMIT_INTERVAL_SECONDS = 30
BATCH_LIMIT = 0                      # 0 = the service default (one event per batch)
BATCH_FLUSH_TIMEOUT_SECONDS = 30
STREAM_LIMIT = 0                     # 0 = unlimited
STREAM_TIMEOUT_SECONDS = 0           # 0 = unlimited
STREAM_KEEP_ALIVE_LIMIT = 0          # 0 = never close on keep-alives
STALE_LEASE_SECONDS = 300
STALL_FACTOR = 1.5                   # no message within 1.5 x flush timeout = stalled
PUBLISH_PARALLELISM = 1
PUBLISH_TIMEOUT_SECONDS = 5


@dataclass(frozen=True)
class ConsumerSettings:
    event_type: str
    group_id: str
    offset: str | None = None                     # explicit start cursor; None = committed or start
    commit_interval_seconds: int = COMMIT_INTERVAL_SECONDS
    batch_limit: int = BATCH_LIMIT
    batch_flush_timeout_seconds: int = BATCH_FLUSH_TIMEOUT_SECONDS
    stream_limit: int = STREAM_LIMIT
    stream_timeout_seconds: int = STREAM_TIMEOUT_SECONDS
    stream_keep_alive_limit: int = STREAM_KEEP_ALIVE_LIMIT
    stale_lease_seconds: int = STALE_LEASE_SECONDS
    lease_holder: str = "tidemark"

    def read_from_start_of_stream(self) -> "ConsumerSettings":
        return replace(self, offset=BEGIN)

    def with_commit_interval(self, seconds: int) -> "ConsumerSettings":
        return replace(self, commit_interval_seconds=seconds)

    @property
    def stall_seconds(self) -> float:
        return self.batch_flush_timeout_seconds * STALL_FACTOR

    @property
    def effective_batch_limit(self) -> int:
        return self.batch_limit if self.batch_limit > 0 else 1


@dataclass(frozen=True)
class ProducerSettings:
    event_type: str
    parallelism: int = PUBLISH_PARALLELISM
    timeout_seconds: int = PUBLISH_TIMEOUT_SECONDS    # of one request: a batch run sends none
    run_timeout_seconds: float | None = None          # a run that takes longer publishes nothing
