"""Documents in blocks of neighbouring doc_ids, and compact binary columns.

Duplicate-removal operators work on blocks: contiguous doc_id ranges of about
``block_bytes`` of text, so the order (block, place in block) is the order of
doc_id.  Blocks exchange fingerprints through buckets (hash prefixes).  Block
and bucket size grow with the square root of very large inputs, which keeps
the rows that one block sends to one bucket long enough to be worth a row.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

BLOCK_BYTES = 4 << 20
GROW_FROM = 1 << 35


class Layout(NamedTuple):
    blocks: int
    bucket_bits: int


def layout(docs: DataFrame) -> Layout:
    total = text_bytes(docs)
    size = BLOCK_BYTES * math.sqrt(max(1.0, total / GROW_FROM))
    n = max(1, math.ceil(total / size))
    return Layout(n, max(2, math.ceil(math.log2(n))))


def _search(sorted_values: list[int], x: Column) -> Column:
    """Number of ``sorted_values`` that are <= x, by binary search."""
    if not sorted_values:
        return F.lit(0)
    values = F.lit(sorted_values)

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        right = F.get(values, mid) <= x
        return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(
            F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"),
            F.when(right, s["hi"]).otherwise(mid).alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(sorted_values)).alias("hi"))
    steps = len(sorted_values).bit_length() + 1
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["lo"])


def in_blocks(docs: DataFrame, n: int) -> DataFrame:
    """(blk, doc_id, text) with ``n`` ranges of doc_id cut at quantiles.

    Rows without a doc_id have no place in the order: they go to blocks
    below zero, by the hash of their text."""
    cuts: list[int] = []
    if n > 1:
        at = [i / n for i in range(1, n)]
        row = docs.agg(F.percentile_approx("doc_id", at, max(10_000, 20 * n)).alias("q")).first()
        cuts = sorted(set(row["q"] or []))
    blk = F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(n))).otherwise(
        _search(cuts, F.col("doc_id"))).cast("int")
    return docs.select(blk.alias("blk"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


class Block(NamedTuple):
    """A block's rows in the order of doc_id (then text), so that every stage
    numbers its words or bytes alike; ``doc`` counts distinct doc_ids."""
    ids: list
    texts: list[bytes]
    doc: np.ndarray
    ordered: bool


def read_block(table: pa.Table) -> Block:
    ids = table.column("doc_id").to_pylist()
    texts = [t.encode() for t in table.column("text").to_pylist()]
    ordered = not ids or ids[0] is not None
    rank = sorted(range(len(ids)), key=(lambda i: (ids[i], texts[i])) if ordered else (lambda i: texts[i]))
    ids, texts = [ids[i] for i in rank], [texts[i] for i in rank]
    doc = np.cumsum([0] + [int(a != b) for a, b in zip(ids[1:], ids)]) if ids else np.zeros(0, int)
    return Block(ids, texts, doc, ordered)


def pack(values: np.ndarray) -> bytes:
    """Byte planes of the values: planes with little variety compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unpack(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(places: np.ndarray) -> bytes:
    """Ascending places as differences."""
    return pack(np.diff(places, prepend=0).astype(np.uint32))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint32).astype(np.int64))


def firsts(h: np.ndarray) -> np.ndarray:
    """For every element the index of the first equal element."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(len(h), bool)
    new[1:] = s[1:] != s[:-1]
    out = np.empty(len(h), np.int64)
    out[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else 0
    return out


def by_bucket(h: np.ndarray, bits: int):
    """(bucket, indices in ascending order) for every bucket that occurs."""
    b = (h >> np.uint64(64 - bits)).astype(np.uint32 if bits > 16 else np.uint16)
    order = np.argsort(b, kind="stable")
    s = b[order]
    cut = np.flatnonzero(np.diff(s)) + 1
    return ((int(s[i]), order[i:j]) for i, j in zip([0, *cut], [*cut, len(s)]) if j > i)
