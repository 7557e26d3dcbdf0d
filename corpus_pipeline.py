"""Training-data pipeline: toxicity, near-duplicates, benchmark passages,
secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.  ``run`` writes
every stage as Parquet under the shared checkpoint folder and reads it again,
so a lost executor costs one stage's tasks, not the pipeline.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, secrets, simhash, toxicity
from tidemark.llm.common import free_name, table
from tidemark.plans.joins import broadcast_if_small
from tidemark.session import configure, scratch_path

#: No SQL: stages hold trained models, XXH64 fingerprints and a tokenizer.
ORACLE_SQL = None

#: Stages send texts to Python workers in Arrow batches of at most this many
#: bytes (Spark's default is 64 MB): an executor holds each batch off heap,
#: and the worker's arrays are several times its size.
ARROW_BATCH_BYTES = str(8 << 20)


def _prepare(spark: SparkSession) -> None:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    _prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "score")         # documents may have a column of that name
    return toxicity.score(docs, model, name).where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the smallest doc_id."""
    _prepare(spark)
    return simhash.one_of_each(docs, size=4, distance=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    _prepare(spark)
    found = decontaminate.hits(docs, table(spark, sf_dir, "benchmark"), size=10)
    gone = broadcast_if_small(found.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).distinct())
    same = docs["doc_id"].eqNullSafe(gone["_d"]) & (F.xxhash64(docs["text"]) == gone["_t"])
    return docs.join(gone, same, "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    _prepare(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, ids included, with their place in a sequence of at most 4096 tokens."""
    import public_tokenizers
    _prepare(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    _prepare(spark)
    docs, root = table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline", uuid.uuid4().hex)
    for k, (name, stage) in enumerate(STAGES):
        out = f"{root}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
