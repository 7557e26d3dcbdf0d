"""Language identification by string kernels.

The kernel of two texts counts the byte n-grams (sizes ``GRAMS``, lower case)
present in both, over all sizes together (blended spectrum), normalised by the
presence counts.  N-grams hash to 2**``BUCKET_BITS`` cells, so a text is a 0/1
row.  A Nystroem approximation stands on landmark texts; one-versus-rest
kernel ridge regression on it gives one score per language.  Tasks score by
batched matrix products: presence rows times landmark rows, times coefficients.

Only text and lang of rows whose crc32(doc_id as text) mod 4 is not 2 are
learned from: up to ``PER_LANGUAGE`` rows per language and ``MAX_ROWS`` in all,
chosen by hash, at least one of every language; up to ``LANDMARKS`` of each
language, ``MAX_LANDMARKS`` in all, are landmarks.  Predictions read the text.

Defined results: null texts and texts without a letter are ``und`` with score
0; if nothing can be learned every text is ``und``; equal scores go to the
first language by name; rows with a null doc_id are held in; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import rolling
from .common import free_name, table, without
from .toxicity import held_out

GRAMS = (2, 3, 4)
BUCKET_BITS = 15
PER_LANGUAGE = 300
#: Rows learned from in all, while there are fewer languages than this.
MAX_ROWS = 2400
LANDMARKS = 16
MAX_LANDMARKS = 512
RIDGE = 1e-3
BATCH = 64


class Model(NamedTuple):
    languages: list[str]
    landmarks: np.ndarray       # presence rows over the square root of their sums, cells by landmarks
    coefficients: np.ndarray    # landmarks by languages


def presence(texts: list[str]) -> np.ndarray:
    """0/1 rows (uint8): which n-gram cells occur in each text."""
    out = np.zeros((len(texts), 1 << BUCKET_BITS), np.uint8)
    for row, t in zip(out, texts):
        data = np.frombuffer(t.lower().encode(), np.uint8)
        p = rolling.byte_prefix(data)
        for n in GRAMS:
            if len(data) >= n:
                row[rolling.mix(rolling.window_hash(p, n) + np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)] = 1
    return out


def _normal(rows: np.ndarray) -> np.ndarray:
    """Rows of unit length: the dot product is then the normalised kernel."""
    return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True, dtype=np.float32), 1))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = MAX_ROWS) -> list[tuple[str, bytes]]:
    """[(lang, packed presence row)]: of each language the ``per_language``
    rows that come first by a hash of text and doc_id (fewer if the languages
    together would exceed ``most``), so every language has at least one.

    Rows far behind in the hash are left out by a bound per language; the
    language's first row is always within it, also where all its rows are
    equal.  Of the rest Spark keeps the first ones in each task before they
    meet."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id"), 4, 2))
    known = known.select("lang", "text", F.xxhash64("text", "doc_id").alias("place"))
    found = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).collect()
    if not found:
        return []
    each = max(1, min(per_language, most // len(found)))
    # twice the share of the places, which are uniform, and at least the first one
    bound = {r["lang"]: max(r["first"], -(1 << 63) + min((1 << 64) - 1, 2 * (each + 50) * (1 << 64) // r["n"])) for r in found}
    bounds = F.create_map(*[x for k, v in bound.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    first = Window.partitionBy("lang").orderBy("place")
    picked = (known.where(F.col("place") <= bounds[F.col("lang")]).withColumn("at", F.row_number().over(first))
              .where(F.col("at") <= each).select("lang", "text"))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                bits = np.packbits(presence(part.column("text").to_pylist()), axis=1)
                yield pa.record_batch([part.column("lang"), pa.array([b.tobytes() for b in bits], pa.binary())],
                                      names=["lang", "bits"])
    return sorted((r["lang"], bytes(r["bits"])) for r in picked.mapInArrow(run, "lang string, bits binary").collect())


def train(rows: list[tuple[str, bytes]]) -> Model:
    languages = sorted({r[0] for r in rows})
    bits = np.unpackbits(np.array([np.frombuffer(r[1], np.uint8) for r in rows]), axis=1)
    x = _normal(bits.astype(np.float32))
    y = np.array([[1.0 if r[0] == k else -1.0 for k in languages] for r in rows])
    rng, marks = np.random.default_rng(11), []
    each = max(1, min(LANDMARKS, MAX_LANDMARKS // len(languages)))
    for k in languages:
        own = np.array([i for i, r in enumerate(rows) if r[0] == k])
        marks += rng.permutation(own)[:each].tolist()
    marks = sorted(rng.permutation(marks)[:MAX_LANDMARKS].tolist())
    land = x[marks]
    k_nm, k_mm = (x @ land.T).astype(np.float64), (land @ land.T).astype(np.float64)
    # every language weighs the same, however many rows it has
    weight = 1.0 / (y > 0).sum(0)[[languages.index(r[0]) for r in rows]]
    left = k_nm.T @ (k_nm * weight[:, None]) + RIDGE * (k_mm + 1e-6 * np.eye(len(marks)))
    return Model(languages, land.T.copy(), np.linalg.solve(left, k_nm.T @ (y * weight[:, None])))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in [0, 1] from ``text`` alone;
    they replace columns of these names in any case."""
    docs = without(docs, "lang_pred", "score")
    mark = free_name(docs, "_letter")
    named = docs.withColumn(mark, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                letter = part.column(mark).to_pylist()
                lang, score = ["und"] * len(letter), np.zeros(len(letter))
                at = [i for i, ok in enumerate(letter) if ok] if m else []
                if at:
                    texts = part.column("text")
                    f = _normal(presence([texts[i].as_py() for i in at])) @ m.landmarks @ m.coefficients
                    best = f.argmax(1)
                    score[at] = (np.clip(f[np.arange(len(at)), best], -1, 1) + 1) / 2
                    for i, b in zip(at, best):
                        lang[i] = m.languages[b]
                names = part.schema.names[:-1]
                yield pa.record_batch([*[part.column(n) for n in names], pa.array(lang), pa.array(score)],
                                      names=[*names, "lang_pred", "score"])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return named.mapInArrow(run, ddl + ", lang_pred string, score double")


def fit(docs: DataFrame) -> Model | None:
    rows = sample(docs)
    return train(rows) if rows else None


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
