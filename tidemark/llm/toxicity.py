"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A text is the bag of the byte n-grams (sizes ``GRAMS``) of its lower-cased
words, word borders included.  Each n-gram hashes to an embedding; their mean
goes into a linear softmax over (clean, toxic).  Embeddings and softmax are
trained jointly (Adam, numpy) on the driver, from a bounded sample of labelled
rows; misspelt or inflected words share the vectors of the n-grams they keep.
Scoring is linear in the mean, so tasks carry one number per n-gram bucket:
embedding times difference of the softmax rows.

Only rows whose crc32(doc_id as text) mod 3 is not 1 are learned from.  The
sample takes up to ``PER_CLASS`` toxic and clean rows, lowest by hash.  The
mean weighs an n-gram by the logarithm of its rarity in the sample.  Scores
read nothing but the text.

Defined results: null and empty texts score like a text without n-grams (the
bias alone); without labels of both classes every score is the share of toxic
labels (0 if none); repeated rows score alike; rows with a null doc_id are
held in; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rolling
from .common import table, without

GRAMS = (4, 6)
BUCKET_BITS = 18
DIMENSIONS = 8
#: Bound of the training sample: rows by label.
PER_CLASS = {1: 1500, 0: 4000}
EPOCHS = 6
BATCH = 32
LEARN, DECAY = 0.01, 1e-4
#: Means are small (few n-grams of a text matter); the softmax sees them times SCALE.
SCALE = 50.0
#: An n-gram of a text counts so often at most in its mean; a mean is over PAD
#: n-grams at least; n-grams of fewer training rows than MIN_ROWS have no vector.
MOST, PAD, MIN_ROWS = 8, 100, 5
THRESHOLD = 0.7
_KEEP = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


class Model(NamedTuple):
    weight: np.ndarray      # logit per bucket, times SCALE
    bias: float


class Sample(NamedTuple):
    """Labelled bags, one after another in two flat arrays."""
    toxic: np.ndarray       # label of each bag
    bounds: np.ndarray      # bag i is bounds[i] .. bounds[i + 1]
    buckets: np.ndarray
    counts: np.ndarray


def subwords(text: str) -> np.ndarray:
    """Buckets of the n-grams that stay inside one word and its borders."""
    data = np.frombuffer(b" " + b" ".join(text.lower().encode().translate(_KEEP).split()) + b" ", np.uint8)
    space = np.concatenate([[0], np.cumsum(data == 0x20)])
    p, out = rolling.byte_prefix(data), []
    for n in GRAMS:
        if len(data) < n:
            continue
        inner = space[n - 1:-1] - space[1:len(space) - n + 1]
        h = rolling.window_hash(p, n)[inner == 0] + np.uint64(n)
        out.append(rolling.mix(h) >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their counts, at most MOST."""
    b, c = np.unique(subwords(text or ""), return_counts=True)
    return b, np.minimum(c, MOST).astype(np.uint8)


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == rest, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] = PER_CLASS) -> Sample:
    """Bags of at most ``per_class`` labelled rows by label, by doc_id and buckets;
    rows that repeat a doc_id and its buckets count once."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                         & ~held_out(F.col("doc_id"), 3, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = None
    for c in (0, 1):
        own = known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class[c])
        pick = own if pick is None else pick.unionByName(own)

    def run(batches):
        for batch in batches:
            rows = [bag(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()),
                                   pa.array([b.astype("<i4").tobytes() for b, _ in rows], pa.binary()),
                                   pa.array([c.tobytes() for _, c in rows], pa.binary())],
                                  names=["doc_id", "toxic", "buckets", "counts"])
    # at most the sum of per_class rows of two numbers: a proven bound for the broadcast
    rows = (docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id").select("doc_id", "toxic", "text")
            .mapInArrow(run, "doc_id bigint, toxic int, buckets binary, counts binary").toLocalIterator())
    toxic: list = []
    bounds, buckets, counts = [0], bytearray(), bytearray()
    by_doc: dict[int, list[int]] = {}
    own = lambda i: bytes(memoryview(buckets)[4 * bounds[i]:4 * bounds[i + 1]])
    for r in rows:
        b = bytes(r["buckets"])
        if any(own(i) == b for i in by_doc.get(r["doc_id"], ())):
            continue
        by_doc.setdefault(r["doc_id"], []).append(len(toxic))
        toxic.append(r["toxic"])
        buckets += b
        counts += r["counts"]
        bounds.append(len(counts))
    order = [i for d in sorted(by_doc) for i in sorted(by_doc[d], key=own)]
    return _ordered(toxic, bounds, np.frombuffer(buckets, "<i4"), np.frombuffer(counts, np.uint8), order)


def _ordered(toxic: list, bounds: list, buckets: np.ndarray, counts: np.ndarray, order: list) -> Sample:
    size = np.diff(bounds)[order]
    out = Sample(np.array(toxic, np.int64)[order], np.concatenate([[0], np.cumsum(size)]).astype(np.int64),
                 np.empty(len(buckets), np.int32), np.empty(len(counts), np.uint8))
    for k, i in enumerate(order):
        to = slice(out.bounds[k], out.bounds[k + 1])
        out.buckets[to], out.counts[to] = buckets[bounds[i]:bounds[i + 1]], counts[bounds[i]:bounds[i + 1]]
    return out


def train(rows: Sample, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Joint training of embeddings and softmax on labelled bags."""
    y, count = rows.toxic, len(rows.toxic)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(1 << BUCKET_BITS, np.float32),
                     float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    seen = np.zeros(1 << BUCKET_BITS, np.int64)
    for lo, hi in zip(rows.bounds, rows.bounds[1:]):
        seen[rows.buckets[lo:hi]] += 1          # buckets of a bag are distinct
    vocabulary = np.flatnonzero(seen >= MIN_ROWS)
    place = np.full(1 << BUCKET_BITS, -1, np.int32)
    place[vocabulary] = np.arange(len(vocabulary))
    rare = (SCALE * np.log(count / seen[vocabulary])).astype(np.float32)   # common n-grams say little
    # what the vocabulary keeps of each bag, bag after bag: places and shares
    places, shares = np.empty(len(rows.buckets), np.int32), np.empty(len(rows.buckets), np.float32)
    ends, n = [0], 0
    for lo, hi in zip(rows.bounds, rows.bounds[1:]):
        at, c = place[rows.buckets[lo:hi]], rows.counts[lo:hi]
        share = c / np.float32(max(PAD, float(c.sum(dtype=np.int64))))
        known = at >= 0
        at = at[known]
        places[n:n + len(at)], shares[n:n + len(at)] = at, share[known] * rare[at]
        n += len(at)
        ends.append(n)
    weight = np.array([1.0, ((y == 0).sum() / (y == 1).sum()) ** 0.5])[y]
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.05, (len(vocabulary), DIMENSIONS)).astype(np.float32)
    u = rng.normal(0, 0.3, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    params = [e, u, bias]
    mean, square, largest = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0.0
    step, steps = 0, epochs * -(-count // BATCH)
    for _ in range(epochs):
        order = rng.permutation(count)
        for lo in range(0, len(order), BATCH):
            part = order[lo:lo + BATCH]
            own = [slice(ends[i], ends[i + 1]) for i in part]
            used, at = np.unique(np.concatenate([places[o] for o in own]), return_inverse=True)
            bag = np.zeros((len(part), len(used)), np.float32)      # rows of the batch by their n-grams
            bag[np.repeat(np.arange(len(part)), [o.stop - o.start for o in own]), at] = np.concatenate(
                [shares[o] for o in own])
            x = bag @ e[used]
            z = x @ u + bias
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
            z[np.arange(len(part)), y[part]] -= 1
            z *= weight[part][:, None] / len(part)
            rate, step = LEARN * (1 - step / steps), step + 1
            # embeddings share one step size, set by the largest gradient: n-grams of
            # many rows move far, chance companions of a few rows hardly move
            g = bag.T @ (z @ u.T) + DECAY * e[used]
            largest = 0.99 * largest + 0.01 * float((g * g).max(initial=0.0))
            mean[0][used] = 0.9 * mean[0][used] + 0.1 * g
            e[used] -= rate * 10 * mean[0][used] / (np.sqrt(largest) + 1e-8)
            for k, g in ((1, x.T @ z), (2, z.sum(0))):
                mean[k], square[k] = 0.9 * mean[k] + 0.1 * g, 0.999 * square[k] + 0.001 * g * g
                params[k] -= (rate * (mean[k] / (1 - 0.9 ** step))
                              / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    out = np.zeros(1 << BUCKET_BITS, np.float32)
    out[vocabulary] = rare * (e @ (u[:, 1] - u[:, 0]))
    return Model(out, float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score, double in [0, 1], from ``text`` alone, as column
    ``name``; it replaces a column of that name in any case."""
    docs = without(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weight, bias = shared.value
        for batch in batches:
            out = []
            for t in batch.column("text").to_pylist():
                b, c = bag(t)
                z = bias + float(weight[b] @ c.astype(np.float32)) / max(PAD, int(c.sum(dtype=np.int64)))
                out.append(float(1 / (1 + np.exp(-np.clip(z, -50, 50)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())],
                                             names=[*batch.schema.names, name])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{name}` double"
    return docs.mapInArrow(run, ddl)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    return train(sample(docs, labels))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
