"""Type tests on VARIANT values (strict: no coercion of 5 to "5")."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vget(v: Column, path: str) -> Column:
    """Sub-value at ``path`` as VARIANT; SQL null if absent, VARIANT null if
    the JSON value is null."""
    return F.variant_get(v, path, "variant")


def vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_string(v: Column) -> Column:
    return vtype(v) == F.lit("STRING")


def is_json_null(v: Column) -> Column:
    return F.is_variant_null(v)


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def is_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def is_integral(v: Column) -> Column:
    """A JSON number within 64 bits and without a fraction."""
    n = F.try_variant_get(v, "$", "decimal(38,9)")
    return (vtype(v) == F.lit("BIGINT")) | (vtype(v).startswith("DECIMAL") & (n == F.try_variant_get(v, "$", "bigint")))


def is_string_array(v: Column) -> Column:
    arr = F.try_variant_get(v, "$", "array<variant>")
    return arr.isNotNull() & F.forall(arr, lambda x: vtype(x) == F.lit("STRING"))
