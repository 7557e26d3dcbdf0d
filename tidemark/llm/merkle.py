"""Merkle manifest of a table in van Emde Boas layout.

Every row is a leaf digest.  Leaves form *runs* (one per language), ordered by
doc_id; each run is a binary tree whose last node of a level may stand alone.
The subroots of the runs, in the order of their keys, form the tree of trees.

A run is cut into aligned subtrees of ``HEIGHT`` levels.  Each is built by one
group of at most 2**HEIGHT leaves and stored as one row of the manifest: its
nodes lie in van Emde Boas order, a tree being split at half its height into a
top tree followed by its bottom trees, recursively.  ``addresses`` gives the
place of every node by arithmetic on (depth, index); construction and the
retrieval of siblings use the same places.  The block roots are the leaves of
the next level of blocks, until one block per run remains.

Leaves get their positions by a range sort over (run, doc_id, digest): no task
holds a run.  Siblings travel down: those above a block are found once for the
block and joined to it, so only blocks and short lists of digests move.

Defined results: a null field enters its digest as ``-``; rows without a
doc_id come first in their run, rows of one doc_id in the order of their
digests (equal rows have equal digests, and each keeps its own place); a null
language is a run of its own before all others; an empty text is ``0:``.  A
run of one leaf has that leaf as its subroot, and a table of one run has that
run's subroot as its root; without any sibling the proof is the empty list.
An empty table gives an empty manifest and no rows.  Only the five named
columns are read, so further columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import table

#: Levels of a stored subtree: 4096 leaves, 8191 nodes of 32 bytes.
HEIGHT = 12
#: Above this many blocks their upper siblings are joined by a shuffle.
SMALL_BLOCKS = 1000
DIGEST = 32

BLOCK_SCHEMA = ("run string, block bigint, n bigint, ids array<bigint>, claims array<string>, "
                "nodes binary, root string")


class Manifest(NamedTuple):
    """``levels[0]`` has the blocks of leaves, each further one the blocks of
    block roots; ``runs`` (run, subroot); ``top`` the levels of the tree over
    the subroots."""
    levels: list[DataFrame]
    runs: DataFrame
    top: list[DataFrame]
    height: int


# ------------------------------------------------------------------ the layout

@lru_cache(None)
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """For each depth 0 .. height the places of its nodes, left to right, in
    the van Emde Boas order of a complete binary tree of that height."""
    if height == 0:
        return (np.zeros(1, np.int64),)
    up, low = _halves(height)
    first = (2 << up) - 1 + np.arange(2 << up, dtype=np.int64) * ((2 << low) - 1)
    return (*addresses(up), *((first[:, None] + below).ravel() for below in addresses(low)))


def _halves(height: int) -> tuple[int, int]:
    """Heights of the top tree and of its bottom trees."""
    up = (height + 1) // 2 - 1
    return up, height - up - 1


def _hash(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def fill(nodes: np.ndarray, base: int, height: int, leaves: list[bytes]) -> bytes:
    """Store the tree over ``leaves`` (hex digests, at most 2**height) from
    place ``base`` on and return its root.  Bottom trees first; the top tree
    then stands on the digests of their paired roots."""
    if height == 0:
        nodes[base] = np.frombuffer(bytes.fromhex(leaves[0].decode()), np.uint8)
        return leaves[0]
    up, low = _halves(height)
    first, size, width = base + (2 << up) - 1, (2 << low) - 1, 1 << low
    roots = [fill(nodes, first + k * size, low, leaves[k * width:(k + 1) * width])
             for k in range(-(-len(leaves) // width))]
    return fill(nodes, base, up, [_hash(roots[k:k + 2]) for k in range(0, len(roots), 2)])


def steps(nodes: np.ndarray, height: int, n: int) -> list[list[str]]:
    """For each of ``n`` leaves, bottom up, the step to the parent: ``L`` or
    ``R`` and the sibling's hex digest at that side, or an empty string where
    a node stands alone."""
    digests, levels = nodes.tobytes().hex(), []
    for depth in range(height, 0, -1):
        at, here = addresses(height)[depth], -(-n >> (height - depth)) if n else 0
        step = []
        for k in range(here):
            s = int(at[k ^ 1]) * 2 * DIGEST
            step.append("" if k ^ 1 >= here else "RL"[k & 1] + digests[s:s + 2 * DIGEST])
        levels.append(step)
    return [[step[k >> up] for up, step in enumerate(levels)] for k in range(n)]


# ------------------------------------------------------------------ the manifest

def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def run_key(lang: Column) -> Column:
    """Never null, and in the order of null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def _positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place in their run, and ``n``, its length.

    A range sort spreads each run over many tasks (rows that are equal in all
    of ``order`` by their number in the input); the id numbers the rows of
    each sorted part, and the few (run, part) counts shift them."""
    rows = rows.withColumn("tie", F.monotonically_increasing_id()).checkpoint()
    order = ["run", *order, "tie"]
    at = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    at = at.withColumn("at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("at", 33)
    counts = at.groupBy("run", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    run = Window.partitionBy("run")
    before = F.sum("here").over(run.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("run", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                           F.sum("here").over(run).alias("n"))
    return (at.withColumn("part", part).join(broadcast_if_small(counts), ["run", "part"])
            .withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift"))


def _tree_height(n: int, height: int) -> int:
    return min(height, (n - 1).bit_length())


def _blocks(rows: DataFrame, height: int) -> DataFrame:
    """Aligned subtrees over (run, pos, n, digest, doc_id, claim)."""
    def build(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        n, h = group.column("n")[0].as_py(), _tree_height(group.column("n")[0].as_py(), height)
        nodes = np.zeros(((2 << h) - 1, DIGEST), np.uint8)
        root = fill(nodes, 0, h, [d.encode() for d in group.column("digest").to_pylist()])
        return pa.table({
            "run": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "ids": pa.array([group.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "claims": pa.array([group.column("claim").to_pylist()], pa.list_(pa.string())),
            "nodes": pa.array([nodes.tobytes()], pa.binary()), "root": pa.array([root.decode()], pa.string())})

    rows = rows.withColumn("block", F.shiftright("pos", height))
    return rows.groupBy("run", "block").applyInArrow(build, BLOCK_SCHEMA).checkpoint()


def _forest(rows: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of blocks over ``rows`` and (run, subroot)."""
    levels = [_blocks(rows, height)]
    longest = levels[0].agg(F.max("n")).first()[0] or 0
    while longest > 1 << height:
        longest = -(-longest >> height)
        over = levels[-1].where(F.col("n") > (1 << height)).select(
            "run", F.col("block").alias("pos"), F.ceil(F.col("n") / (1 << height)).alias("n"),
            F.col("root").alias("digest"), F.lit(None).cast("bigint").alias("doc_id"),
            F.lit(None).cast("string").alias("claim"))
        levels.append(_blocks(over, height))
    done = [x.where(F.col("n") <= (1 << height)).select("run", F.col("root").alias("subroot")) for x in levels]
    runs = done[0]
    for x in done[1:]:
        runs = runs.unionByName(x)
    return levels, runs


def manifest(docs: DataFrame, claim: Column | None = None, height: int = HEIGHT) -> Manifest:
    """Trees over all rows of ``docs`` (doc_id, source, lang, n_chars, text).

    ``claim`` is a digest kept beside a leaf that does not enter any tree: what
    a reader presents for the row, null for the leaf itself."""
    claim = F.lit(None).cast("string") if claim is None else claim
    leaves = docs.select(run_key(F.col("lang")).alias("run"), F.col("doc_id").cast("bigint").alias("doc_id"),
                         leaf_digest(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text"))).alias("digest"),
                         claim.alias("claim"))
    levels, runs = _forest(_positions(leaves, ["doc_id", "digest"]), height)
    tops = runs.select(F.lit("").alias("run"), F.col("run").alias("key"), F.col("subroot").alias("digest"),
                       F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("claim"))
    tops = _positions(tops, ["key"])
    keys = tops.select(F.col("pos").alias("place"), "key", F.col("digest").alias("subroot"))
    top, _ = _forest(tops.drop("key"), height)
    return Manifest(levels, keys, top, height)


# -------------------------------------------------------------------- the proofs

def _climb(blocks: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """For each slot of ``blocks`` its whole list of steps: those inside the
    block, then those that ``above`` (run, block, subroot, root_all, upper)
    has for the block."""
    schema = ("run string, pos bigint, doc_id bigint, claim string, leaf string, subroot string, "
              "root string, steps array<string>")
    types = pa.schema([("run", pa.string()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("claim", pa.string()),
                       ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                       ("steps", pa.list_(pa.string()))])

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                n, h = len(b["ids"]), _tree_height(b["n"], height)
                nodes = np.frombuffer(b["nodes"], np.uint8).reshape(-1, DIGEST)
                leaves = nodes[addresses(h)[h][:n]].tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    pa.array([b["run"]] * n, pa.string()),
                    pa.array(np.arange(n) + (b["block"] << height), pa.int64()),
                    pa.array(b["ids"], pa.int64()), pa.array(b["claims"], pa.string()),
                    pa.array([leaves[k:k + 2 * DIGEST] for k in range(0, n * 2 * DIGEST, 2 * DIGEST)], pa.string()),
                    pa.array([b["subroot"]] * n, pa.string()), pa.array([b["root_all"]] * n, pa.string()),
                    pa.array([s + b["upper"] for s in steps(nodes, h, n)], pa.list_(pa.string())),
                ], schema=types)

    return blocks.drop("root").join(broadcast_if_small(above, SMALL_BLOCKS), ["run", "block"]).mapInArrow(unfold, schema)


def _descend(levels: list[DataFrame], roots: DataFrame, height: int) -> DataFrame:
    """Steps of the lowest slots.  ``roots`` (run, subroot, root_all, upper)
    has what lies above each run's own root."""
    below: DataFrame | None = None
    for k in range(len(levels) - 1, -1, -1):
        last = levels[k].where(F.col("n") <= (1 << height)).select("run", "block")
        above = roots.join(broadcast_if_small(last, SMALL_BLOCKS), "run").select(
            "run", "block", "subroot", "root_all", "upper")
        if below is not None:
            above = above.unionByName(below.select("run", F.col("pos").alias("block"), "subroot",
                                                   F.col("root").alias("root_all"), F.col("steps").alias("upper")))
        below = _climb(levels[k], above, height)
    return below


def proofs(m: Manifest) -> DataFrame:
    """doc_id, leaf, claim, subroot, root, steps (bottom up) of every row."""
    root = m.top[-1].where(F.col("n") <= (1 << m.height)).select(
        "run", F.lit("").alias("subroot"), F.col("root").alias("root_all"), F.array().cast("array<string>").alias("upper"))
    places = _descend(m.top, root, m.height).select(F.col("pos").alias("place"), F.col("root").alias("root_all"),
                                                    F.col("steps").alias("upper"))
    roots = m.runs.join(places, "place").select(F.col("key").alias("run"), "subroot", "root_all", "upper")
    return _descend(m.levels, roots, m.height).select("doc_id", "leaf", "claim", "subroot", "root", "steps")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    def up(digest: Column, step: Column) -> Column:
        sibling = F.substring(step, 2, 2 * DIGEST)
        left = F.when(step.startswith("L"), sibling).otherwise("")
        right = F.when(step.startswith("R"), sibling).otherwise("")
        return F.sha2(F.concat(left, digest, right).cast("binary"), 256)

    return F.aggregate(path, leaf, up)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")]
    rows = proofs(manifest(docs, F.when(tampered, leaf_digest(*fields))))
    siblings = F.array_join(F.transform("steps", lambda s: F.substring(s, 2, 2 * DIGEST)), "")
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                       fold(F.coalesce("claim", "leaf"), F.col("steps")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
