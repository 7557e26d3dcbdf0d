"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without its columns of these names, in any case."""
    gone = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in gone])


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` is the same on ASCII text)."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of all texts: sizes the work by what there is to do."""
    return docs.agg(F.sum(F.octet_length(col).cast("bigint"))).first()[0] or 0


def n_blocks(total: int, per_block: int) -> int:
    return max(1, math.ceil(total / per_block))


def row_key(*cols: str) -> Column:
    """Hash that tells apart rows that share a doc_id but differ in text."""
    return F.xxhash64(*[F.col(c) for c in cols])
