"""tidemark: a PySpark engine for partitioned, offset-addressed event logs.

Consumption (cursor-bounded reads, batching and stream limits), strict JSON
decoding with quarantine, publishing, high-water offset commits and leases,
all expressed as DataFrame / SQL / Structured Streaming jobs.
"""

from tidemark.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]
