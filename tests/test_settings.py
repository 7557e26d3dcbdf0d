"""Parameter defaults (the reference pins them in its property tests)."""

from tidemark.settings import ConsumerSettings, ProducerSettings


def test_consumer_defaults():
    c = ConsumerSettings("order.created", "g")
    assert c.offset is None
    assert c.commit_interval_seconds == 30
    assert (c.batch_limit, c.stream_limit, c.stream_keep_alive_limit) == (0, 0, 0)
    assert (c.batch_flush_timeout_seconds, c.stream_timeout_seconds) == (30, 0)
    assert c.stale_lease_seconds == 300
    assert c.stall_seconds == 45
    assert c.effective_batch_limit == 1


def test_consumer_builders():
    c = ConsumerSettings("t", "g").read_from_start_of_stream().with_commit_interval(10)
    assert c.offset == "BEGIN" and c.commit_interval_seconds == 10


def test_producer_defaults():
    p = ProducerSettings("t")
    assert (p.parallelism, p.timeout_seconds) == (1, 5)
