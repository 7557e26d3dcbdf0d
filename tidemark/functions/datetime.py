"""Strict ISO-8601 date-times with a zone offset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO local date, 'T', hours and minutes, optional seconds with
# an optional fraction of 1-9 digits, then 'Z' or an offset +hh:mm[:ss].
# Letters are case-insensitive.  Range checks (month 13, Feb 30, hour 25)
# are left to the timestamp cast, which rejects them.
ISO_OFFSET_DATE_TIME = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}"
    r"(:[0-9]{2}([.][0-9]{1,9})?)?"
    r"([Zz]|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$"
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_offset_datetime(text: Column | str) -> Column:
    """TIMESTAMP (UTC instant) for valid text, else null."""
    t = _c(text)
    # The cast wants an upper-case 'T'/'Z' and seconds; only minute-precision
    # text (no ':' at position 17) needs the seconds inserted.
    up = F.upper(t)
    norm = F.when(F.substring(t, 17, 1) == ":", up).otherwise(
        F.regexp_replace(up, r"T([0-9]{2}):([0-9]{2})(Z|[+-])", "T$1:$2:00$3"))
    return F.when(t.rlike(ISO_OFFSET_DATE_TIME), norm.try_cast("timestamp"))


def parse_offset_datetime_sql(text_sql: str) -> str:
    """SQL-text form of :func:`parse_offset_datetime` (for large expressions
    built as one SQL string)."""
    return (f"CASE WHEN {text_sql} RLIKE '{ISO_OFFSET_DATE_TIME}' THEN try_cast("
            f"CASE WHEN substring({text_sql}, 17, 1) = ':' THEN upper({text_sql}) "
            f"ELSE regexp_replace(upper({text_sql}), 'T([0-9]{{2}}):([0-9]{{2}})(Z|[+-])', 'T$1:$2:00$3') END "
            f"AS TIMESTAMP) END")


def datetime_error(text: Column | str) -> Column:
    t = _c(text)
    return F.when(parse_offset_datetime(t).isNull(), F.lit("not an offset date-time"))


def zone_offset(text: Column | str) -> Column:
    """The zone offset of a valid date-time text: ``Z`` or ``+hh:mm[:ss]``."""
    t = _c(text)
    return F.when(t.rlike(ISO_OFFSET_DATE_TIME), F.upper(F.regexp_extract(t, r"([Zz]|[+-][0-9:]+)$", 1)))


def format_offset_datetime(ts: Column | str, offset: Column | None = None) -> Column:
    """ISO offset date-time: seconds always, the fraction only as long as
    needed (microseconds at most).  In UTC with ``Z``, or as local time with
    the given :func:`zone_offset` (``Z`` where it is null or zero)."""
    if offset is not None:
        part = lambda k: F.coalesce(F.try_element_at(F.split(offset, ":"), F.lit(k)).try_cast("int"), F.lit(0))
        zero = offset.isNull() | (offset == "Z") | offset.rlike("^[+-]00:00(:00)?$")
        sign = F.when(offset.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
        secs = F.abs(part(1)) * 3600 + part(2) * 60 + part(3)
        local = format_offset_datetime(_c(ts) + F.make_dt_interval(secs=(sign * secs).cast("decimal(18,6)")))
        return F.when(zero, format_offset_datetime(ts)).otherwise(F.concat(F.regexp_replace(local, "Z$", ""), offset))
    t = _c(ts)
    frac = F.regexp_replace(F.date_format(t, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
                    F.lit("Z"))
