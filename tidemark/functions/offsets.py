"""Offsets and partition keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
BEGIN = "BEGIN"          # symbolic offset: start of the partition
OFFSET_WIDTH = 18        # server form of an offset: zero-padded to 18 digits
KEY_SEPARATOR = " - "    # partition key text is "{event type} - {partition}"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def offset_to_long(text: Column | str) -> Column:
    """All ASCII digits -> BIGINT, ``BEGIN`` -> 0, anything else -> null.

    Values past the 64-bit range are null as well (``try_cast``); pair with
    :func:`offset_error` to report, or :func:`require_offset` to fail."""
    t = _c(text)
    return (F.when(t.rlike("^[0-9]+$"), t.try_cast("bigint"))
            .when(t == F.lit(BEGIN), F.lit(0).cast("bigint")))


def offset_error(text: Column | str) -> Column:
    t = _c(text)
    return (F.when(t.isNull(), F.lit("missing"))
            .when(t == F.lit(BEGIN), F.lit(None).cast("string"))
            .when(~t.rlike("^[0-9]+$"), F.lit("invalid offset"))
            .when(t.try_cast("bigint").isNull(), F.lit("offset out of range")))


def require_offset(text: Column | str) -> Column:
    """Strict form: the query fails on the first invalid offset."""
    t = _c(text)
    return F.when(offset_error(t).isNull(), offset_to_long(t)).otherwise(
        F.raise_error(F.concat(F.lit("Invalid offset value: "), F.coalesce(t, F.lit("null")))))


def offset_text(offset: Column | str) -> Column:
    return F.lpad(_c(offset).cast("string"), OFFSET_WIDTH, "0")


def partition_key_hash(event_type: Column | str, partition: Column | str) -> Column:
    """MD5 hex of "{event type} - {partition}" read as an unsigned big integer
    and printed in base 16, so leading zero digits disappear."""
    h = F.md5(F.concat_ws(KEY_SEPARATOR, _c(event_type), _c(partition)))
    return F.regexp_replace(h, "^0+(?=.)", "")
