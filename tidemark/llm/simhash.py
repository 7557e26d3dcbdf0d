"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked within a
Hamming distance by the generalised pigeonhole principle.

Fingerprints: every shingle is hashed by XXH64 (seed 42); a bit is 1 if more
than half of the shingle hashes have it.  Linking works on distinct
fingerprints, so exact copies cost nothing.  The 64 bits are grouped into
partitions of correlated bits, and partition i gets a threshold t_i such that
the t_i sum to ``distance`` - m + 1: two fingerprints within the distance must
agree up to t_i bits in some partition i.  The number of partitions and the
unequal thresholds (-1: never probed) come from dynamic programming on
estimated candidate counts.  Probes enumerate the values within t_i of a
partition; whatever probes one value is verified on all 64 bits, so the
estimates steer cost only, never the result.  A group keeps a spanning forest
of its links, not every pair of a cluster.  Connected components follow from
alternating large-star and small-star steps.

Defined results: a text without words has fingerprint zero and links like any
other; fewer words than a shingle make one shingle; repeated rows stay and
share a component; a component without any doc_id has a null component_id; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import n_blocks, table

BITS = 64
SEED = 42
#: Fingerprints (lowest by hash) that cost estimates look at.
SAMPLE = 2048
#: Cost of one probe row in units of one candidate comparison.
PROBE_COST = 20
MAX_PROBES = 4096
#: Probes of one group, and of one block of a bucket with more.
BUCKET = 4096
#: Buckets of up to so many probes are compared pair by pair.
SMALL = 16
#: Rows of one fingerprint above which they are named by a size-checked broadcast.
COPIES = 1000
#: Fingerprints compared at once, and searches before those without any link are dropped.
STRIP, FIRST_SEARCHES = 256, 8


def _hashes(text: str, size: int) -> np.ndarray:
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - size + 1)


def _majority(h: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    if not len(h):
        return 0
    bits = np.unpackbits(h.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
    counts = np.add.reduceat(bits, np.arange(0, len(h), 255), axis=0).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, th, fp) per row; ``th`` is a hash of the text."""
    def run(batches):
        for batch in batches:
            fp = [_majority(_hashes(t or "", size)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("th"), pa.array(fp, pa.int64())],
                                  names=["doc_id", "th", "fp"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text").mapInArrow(
        run, "doc_id bigint, th bigint, fp bigint")


# ---------------------------------------------------------------- partitions

def _bit_matrix(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8), bitorder="little").reshape(-1, BITS)


def _correlation(fps: DataFrame) -> np.ndarray:
    """Absolute correlation of every two bits over all fingerprints: each task
    sends the 64 x 64 co-occurrence counts of what it reads."""
    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            b = _bit_matrix(batch.column("fp").to_numpy()).astype(np.float32)
            total, n = total + b.T @ b, n + len(b)
        yield pa.record_batch([pa.array(np.arange(BITS * BITS + 1), pa.int64()),
                               pa.array(np.append(total.ravel(), n), pa.float64())], names=["cell", "n"])
    rows = fps.select("fp").mapInArrow(run, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:
        flat[r["cell"]] = r["n"]
    n, both = max(flat[-1], 1.0), flat[:-1].reshape(BITS, BITS)
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs(both / n - np.outer(p, p)) / np.outer(sd, sd)


def _group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """m groups of nearly equal size; each grows by the bit most correlated with it."""
    left, groups = list(range(BITS)), []
    for i in range(m):
        want = BITS // m + (i < BITS % m)
        group = [max(left, key=lambda b: corr[b, left].sum())]
        left.remove(group[0])
        while len(group) < want:
            best = max(left, key=lambda b: corr[b, group].sum())
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def _allocate(bits: np.ndarray, groups: list[list[int]], n: int, distance: int) -> tuple[float, list[int]]:
    """Thresholds of least estimated cost: dynamic programming over partitions
    and the sum of (t_i + 1), which must reach ``distance`` + 1."""
    m, need = len(groups), distance + 1
    pairs = max(1, len(bits) * (len(bits) - 1) // 2)
    cost = []
    for g in groups:
        b = bits[:, g].astype(np.float32)
        differ = b.sum(1)[:, None] + b.sum(1)[None, :] - 2 * (b @ b.T)
        seen = np.bincount(differ.astype(np.int8).ravel(), minlength=need + 1)     # every pair twice, each row once
        seen[0] -= len(b)
        row = [0.0]
        for t in range(need):
            ball = sum(comb(len(g), j) for j in range(t + 1))
            share = max(seen[:t + 1].sum() / 2 / pairs, ball / 2.0 ** len(g))
            row.append(share * n * n / 2 + PROBE_COST * n * ball if ball <= MAX_PROBES else float("inf"))
        cost.append(row)                       # by t + 1
    best = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for have, (c, ts) in best.items():
            for more, extra in enumerate(row[:need - have + 1]):
                if have + more not in step or c + extra < step[have + more][0]:
                    step[have + more] = (c + extra, [*ts, more - 1])
        best = step
    return best.get(need, (float("inf"), [0] * m))


def plan(fps: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the partitions that are probed."""
    n = fps.count()
    sample = fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    bits = _bit_matrix(np.array([r["fp"] for r in sample], np.int64))
    corr, best = _correlation(fps), (float("inf"), [], [])
    for m in range(2, distance + 2):
        groups = _group_bits(corr, m)
        c, ts = _allocate(bits, groups, n, distance)
        if c < best[0] or not best[1]:
            best = (c, groups, ts)
    return [(g, t) for g, t in zip(best[1], best[2]) if t >= 0]


def _mask(bits) -> int:
    v = sum(1 << b for b in bits)
    return v - (1 << 64) if v >= 1 << 63 else v


# ------------------------------------------------------------------ linking

def _neighbours(part: int, group: list[int], t: int) -> Column:
    """array<struct<part, value>>: the partition's value with up to t bits flipped."""
    flips = [_mask(c) for j in range(t + 1) for c in combinations(group, j)]
    own = F.col("fp").bitwiseAND(F.lit(_mask(group)))
    return F.transform(F.lit(flips).cast("array<bigint>"), lambda f: F.struct(
        F.lit(part).alias("part"), own.bitwiseXOR(f).alias("value")))


def _has_neighbour(fp: np.ndarray, distance: int) -> np.ndarray:
    """True for fingerprints that have another one within ``distance``."""
    has = np.zeros(len(fp), bool)
    for k in range(0, len(fp), STRIP):
        strip = np.bitwise_count(fp[k:k + STRIP, None] ^ fp[None, :]) <= distance
        has[k:k + STRIP] = strip.sum(1) > 1         # itself is one
    return has


def _forest(fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span every component of distinct ``fp``: one less than its
    members, each a pair within ``distance``.  A search from one member after
    the other only looks at those not yet reached, so dense groups cost little."""
    links, searches = [], 0
    while len(fp) > 1:
        if searches == FIRST_SEARCHES:
            fp = fp[_has_neighbour(fp, distance)]
            if not len(fp):
                break
        searches += 1
        reached, fp = fp[:1], fp[1:]
        while len(reached) and len(fp):
            near = np.bitwise_count(reached[:STRIP, None] ^ fp[None, :]) <= distance
            hit = near.any(0)
            links.append((reached[:STRIP][near[:, hit].argmax(0)], fp[hit]))
            reached, fp = np.concatenate([reached[STRIP:], fp[hit]]), fp[~hit]
    return links


def _links(part: np.ndarray, value: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the buckets (part, value) of one group of probes: all
    pairs of a bucket of up to SMALL, a spanning forest of a larger one."""
    order = np.lexsort((fp, value, part))
    part, value, fp = part[order], value[order], fp[order].view(np.uint64)
    head = np.r_[True, (part[1:] != part[:-1]) | (value[1:] != value[:-1])]
    start = np.flatnonzero(head)
    size = np.diff(np.r_[start, len(fp)])
    bucket, few = np.repeat(np.arange(len(start)), size), np.repeat(size <= SMALL, size)
    links = []
    for lag in range(1, min(SMALL, len(fp))):
        at = np.flatnonzero((bucket[lag:] == bucket[:-lag]) & few[lag:])
        near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= distance]
        links.append((fp[near], fp[near + lag]))
    for k in np.flatnonzero(size > SMALL):
        links += _forest(np.unique(fp[start[k]:start[k] + size[k]]), distance)
    if not links:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y = (np.concatenate(side).view(np.int64) for side in zip(*links))
    x, y = x[x != y], y[x != y]
    pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
    return pairs[0], pairs[1]


def link(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b) with a < b: pairs of distinct fingerprints within ``distance``
    that connect whatever is within it, directly or over others.

    Every two fingerprints within the distance meet in a bucket (part, value).
    Buckets of up to BUCKET probes share groups of about that size; a larger
    one is dealt into blocks, and every two of its blocks make a group.  Each
    group keeps a spanning forest of its verified pairs, so what is shuffled
    grows with the fingerprints, not with the pairs of a cluster."""
    parts = plan(fps, distance)
    near = F.concat(*[_neighbours(i, g, t) for i, (g, t) in enumerate(parts)])
    probes = fps.select("fp", F.explode(near).alias("p")).select("fp", "p.part", "p.value")
    groups = n_blocks(fps.count() * sum(comb(len(g), j) for g, t in parts for j in range(t + 1)), BUCKET)
    blocks = broadcast_if_small(probes.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
                                .where(F.col("n") > BUCKET)
                                .select("part", "value", F.ceil(F.col("n") / BUCKET).cast("int").alias("k")))
    own = F.pmod(F.xxhash64("fp", F.lit(SEED)), F.col("k")).cast("int")
    others = F.transform(F.array_remove(F.sequence(F.lit(0), F.col("k") - 1), own), lambda j: F.struct(
        F.xxhash64("part", "value").alias("g"), F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    whole = F.array(F.struct(F.pmod(F.xxhash64("part", "value"), F.lit(groups)).alias("g"),
                             F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    dealt = probes.join(blocks, ["part", "value"], "left").select(
        "part", "value", "fp", F.explode(F.when(F.col("k").isNull(), whole).otherwise(others)).alias("to")).select(
        "part", "value", "fp", "to.g", "to.i", "to.j")

    def run(t: pa.Table) -> pa.Table:
        a, b = _links(*(t.column(c).to_numpy() for c in ("part", "value", "fp")), distance)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return dealt.groupBy("g", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of linked nodes of any ordered type: root is the smallest
    node of the component, which is no row itself.  Alternating large-star and small-star steps; every round is cut by a checkpoint."""
    def low(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("low"))

    edges = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).checkpoint()    # u > v
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = low(both.union(both.select("u", F.col("u").alias("v"))))
        large = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        m = low(large)
        small = (large.join(m, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .union(m).where("u != v").distinct())
        edges = small.checkpoint()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, th, fp, component_id, stays) per row: component_id is the
    smallest doc_id that is reachable over links, the document itself
    included.  ``stays`` marks each component's smallest doc_id (rows without
    doc_id come last, then by text hash)."""
    rows = fingerprints(docs, size).checkpoint()
    # nodes are ordered by document, so a component's root is its smallest document
    none = F.col("doc_id").isNull()
    first = F.min(F.struct(none.alias("none"), F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("id"), "th", "fp"))
    fps = rows.groupBy("fp").agg(first.alias("node"), F.count(F.lit(1)).alias("copies")).checkpoint()
    pairs = (link(fps.select("fp"), distance)
             .join(fps.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a")
             .join(fps.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b"))
    roots = components(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    of = fps.join(roots.withColumn("fp", F.col("node.fp")).drop("node"), "fp", "left").select(
        "fp", F.coalesce("root", "node").alias("least"), "copies")
    many = broadcast_if_small(of.where(F.col("copies") > COPIES).drop("copies"))
    few = of.where(F.col("copies") <= COPIES).drop("copies")
    rows = rows.join(many, "fp").unionByName(rows.join(many.select("fp"), "fp", "left_anti").join(few, "fp"))
    least = F.when(~F.col("least.none"), F.col("least.id"))
    stays = F.col("doc_id").eqNullSafe(least) & (F.col("th") == F.col("least.th"))
    return rows.select("doc_id", "th", "fp", least.alias("component_id"), stays.alias("stays"))


def one_of_each(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """One row of ``docs`` per component, with all columns."""
    found = near_duplicates(docs, size, distance).checkpoint()
    gone = broadcast_if_small(found.where(~F.col("stays")).select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_t")).distinct())
    th = F.xxhash64(docs["text"])
    left = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_d"]) & (th == gone["_t"]), "left_anti")
    again = found.where("stays").groupBy("doc_id", "th").count().where("count > 1")
    if again.isEmpty():
        return left
    return left.withColumn("_t", F.xxhash64("text")).dropDuplicates(["doc_id", "_t"]).drop("_t")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), size=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
