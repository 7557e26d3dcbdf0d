"""Closed enumerations with a catch-all for unknown text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract (case-sensitive), and the text an
# unknown value is read (and re-encoded) as.
DATA_OPS = ["C", "U", "D", "S"]
CATEGORIES = ["undefined", "data", "business"]
UNKNOWN_PREFIX, UNKNOWN_SUFFIX = "UnknownValue(", ")"


def _normalise(c: Column, known: list[str]) -> Column:
    return (F.when(c.isin(*known), c)
            .when(c.isNotNull(), F.concat(F.lit(UNKNOWN_PREFIX), c, F.lit(UNKNOWN_SUFFIX))))


def normalise_data_op(c: Column | str) -> Column:
    return _normalise(F.col(c) if isinstance(c, str) else c, DATA_OPS)


def normalise_category(c: Column | str) -> Column:
    return _normalise(F.col(c) if isinstance(c, str) else c, CATEGORIES)
