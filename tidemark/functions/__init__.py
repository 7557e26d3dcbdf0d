"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from tidemark.functions.offsets import (  # noqa: F401
    offset_to_long, offset_error, offset_text, partition_key_hash,
)
from tidemark.functions.datetime import (  # noqa: F401
    parse_offset_datetime, datetime_error, format_offset_datetime,
)
from tidemark.functions.enums import normalise_data_op, normalise_category  # noqa: F401
