"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

1. Blocks hash every window of ``size`` consecutive words of one document and
   keep, per hash, the block's first occurrence; the others are settled there
   (a later document repeats it; the same document shares its fate).
2. The first occurrences meet in buckets of hash prefixes, where Spark brings
   the windows of all blocks together; all but the lowest block's are repeats.
3. Blocks get the answers back, and covered words merge into maximal removal
   intervals.

A window that is in a third of all documents sends one row entry per block,
not one per occurrence.  Hashes have 64 bits.

Defined results: null and empty texts have no words; documents shorter than a
window lose nothing; rows that share a doc_id are one document and never
remove each other's words; rows without a doc_id keep everything and remove
nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rolling
from .blocks import (Block, by_bucket, firsts, in_blocks, layout, pack, pack_sorted, read_block, unpack,
                     unpack_sorted)
from .common import table

SENT = pa.schema([("bucket", pa.int32()), ("blk", pa.int32()), ("hashes", pa.binary()), ("places", pa.binary())])
ANSWER = pa.schema([("blk", pa.int32()), ("places", pa.binary())])
KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept_text", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _windows(block: Block, size: int):
    """Word starts, document of each word, starts (word index) and hashes of
    the block's windows."""
    data = np.frombuffer(b" ".join(block.texts), np.uint8)
    start, h = rolling.word_hashes(data)
    ends = np.cumsum([len(t) + 1 for t in block.texts])
    row = np.searchsorted(ends, start, side="right")
    if len(h) < size or not block.ordered:
        return row, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w = rolling.mix(rolling.window_hash(rolling.prefix(h), size))
    whole = np.flatnonzero(row[size - 1:] == row[:len(row) - size + 1])
    return row, whole, w[whole]


def _send(bits: int, size: int):
    def send(rows: pa.Table) -> pa.Table:
        block, blk = read_block(rows), rows.column("blk")[0].as_py()
        _, _, h = _windows(block, size)
        first = np.flatnonzero(firsts(h) == np.arange(len(h)))
        out = [(b, blk, pack(h[first[i]]), pack_sorted(first[i])) for b, i in by_bucket(h[first], bits)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), SENT.types)] if out else
                        [pa.array([], t) for t in SENT.types], schema=SENT)
    return send


def _settle(rows: pa.Table) -> pa.Table:
    """Of equal hashes all but the lowest block's are answered: repeats."""
    blks = np.array(rows.column("blk").to_pylist())
    order = np.argsort(blks)
    parts = [(int(blks[i]), unpack(rows.column("hashes")[int(i)].as_py(), np.uint64),
              unpack_sorted(rows.column("places")[int(i)].as_py())) for i in order]
    h = np.concatenate([p[1] for p in parts])
    repeat = firsts(h) != np.arange(len(h))
    out, at = [], 0
    for blk, own, places in parts:
        hit = places[repeat[at:at + len(own)]]
        at += len(own)
        if len(hit):
            out.append((blk, pack_sorted(hit)))
    return pa.table([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())],
                    schema=ANSWER)


def _keep(size: int):
    def keep(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = read_block(rows)
        row, start, h = _windows(block, size)
        first = firsts(h)
        told = np.zeros(len(h), bool)
        for a in answers.column("places").to_pylist():
            told[unpack_sorted(a)] = True
        doc = block.doc[row[start]] if len(start) else np.zeros(0, int)
        hit = start[told[first] | (doc != doc[first])] if len(start) else start
        edge = np.zeros(len(row) + 1, np.int32)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + size, -1) if len(hit) else None
        gone = np.cumsum(edge[:-1]) > 0
        cut = np.searchsorted(row, np.arange(len(block.texts) + 1))
        n_words, texts = np.diff(cut), []
        n_gone = np.concatenate([[0], np.cumsum(gone)])[cut]
        n_gone = np.diff(n_gone)
        for i, t in enumerate(block.texts):
            words = t.split()
            texts.append(b" ".join(compress(words, ~gone[cut[i]:cut[i + 1]]) if n_gone[i] else words).decode())
        return pa.table([pa.array(block.ids, pa.int64()), pa.array(n_words), pa.array(n_gone), pa.array(texts)],
                        schema=KEPT)
    return keep


def remove_repeated_windows(docs: DataFrame, size: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) per row of ``docs``."""
    lay = layout(docs)
    blocks = in_blocks(docs, lay.blocks)
    sent = blocks.groupBy("blk").applyInArrow(_send(lay.bucket_bits, size), _ddl(SENT))
    answers = sent.groupBy("bucket").applyInArrow(_settle, _ddl(ANSWER))
    return blocks.groupBy("blk").cogroup(answers.groupBy("blk")).applyInArrow(_keep(size), _ddl(KEPT))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
