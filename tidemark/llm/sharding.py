"""Sharding by jump consistent hashing (Lamping and Veach), in SQL functions.

``jump_hash`` runs the published loop: a 64-bit linear congruential generator
seeded with the key yields successive jump targets; the last one below the
number of shards is the shard.  Adding one shard moves 1/(n+1) of the keys and
all of them into the new shard.  The 64-bit state is kept as two 32-bit halves
so that no product overflows a BIGINT (ANSI mode stays on).

Defined results: a null doc_id hashes as key 0; a null text has size 1 and the
checksum of the empty text; rows that repeat a doc_id share a shard and get
slots of their own; an empty table gives an empty result; only doc_id and text
are read, so further columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.numbering import chunked_running
from .common import table

MULTIPLIER = 2862933555777941757
LOW32 = 0xFFFFFFFF
#: Slots are numbered in this many hash chunks per shard: a chunk of 3e10 rows
#: over 8 shards has about a million narrow rows, and the table of chunk totals
#: never has more than CHUNKS rows per shard.
CHUNKS = 4096


def _low_product(a: Column, b: int) -> Column:
    """Low 32 bits of a * b for 32-bit a and b, without exceeding 2**49."""
    low = a.bitwiseAND(F.lit(65535)) * F.lit(b)
    high = (F.shiftright(a, 16) * F.lit(b)).bitwiseAND(F.lit(65535)) * F.lit(65536)
    return (low + high).bitwiseAND(F.lit(LOW32))


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (int, 0 .. shards-1) of a BIGINT key."""
    if shards < 1:
        raise ValueError("shards must be positive")
    mh, ml = MULTIPLIER >> 32, MULTIPLIER & LOW32

    def step(s: Column, _: Column) -> Column:
        # state * MULTIPLIER + 1 mod 2**64, the low half first
        upper = F.shiftright(s["lo"], 16) * F.lit(ml)
        low = (s["lo"].bitwiseAND(F.lit(65535)) * F.lit(ml)
               + upper.bitwiseAND(F.lit(65535)) * F.lit(65536) + F.lit(1))
        hi = (F.shiftright(low, 32) + F.shiftright(upper, 16) + _low_product(s["hi"], ml)
              + _low_product(s["lo"], mh)).bitwiseAND(F.lit(LOW32))
        target = (s["j"] + 1) * (F.lit(2147483648.0) / (F.shiftright(hi, 1) + 1))
        moved = F.struct(hi.alias("hi"), low.bitwiseAND(F.lit(LOW32)).alias("lo"), s["j"].alias("b"),
                         target.cast("bigint").alias("j"))
        return F.when(s["j"] >= shards, s).otherwise(moved)

    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(LOW32)).alias("lo"),
                     F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"))
    # every step moves j up by at least one, so ``shards`` steps always suffice
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, text, size, text_crc32, law, shard, slot, grown_shard per row.

    The text goes along to its shard and slot, a null as null.  Slots number each shard's rows from 0 without a gap, chunk by chunk: the
    rows of a shard never meet in one task, only its chunk totals do."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", "text", (F.octet_length(text).cast("bigint") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), jump_hash(F.col("doc_id"), shards).alias("shard"),
        jump_hash(F.col("doc_id"), shards + 1).alias("grown_shard"))
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(CHUNKS))
    numbered = chunked_running(rows, ["shard"], ["doc_id", "size", "text_crc32", "text"], chunk, "slot")
    return numbered.select("doc_id", "text", "size", "text_crc32", "law", "shard",
                           (F.col("slot") - 1).cast("bigint").alias("slot"), "grown_shard")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard(table(spark, sf_dir, "documents"), 8)
    return rows.withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")))).drop("text")
