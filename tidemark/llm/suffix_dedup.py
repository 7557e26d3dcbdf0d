"""Suffix-array dedup of byte strings by prefix-free parsing.

Trigger positions are chosen by a rolling hash (the minimum of the ``GRAM``-byte
hashes inside each window of ``size`` bytes), so equal text is parsed alike
wherever it stands and every window has a trigger.  Windows that follow each
other and share a trigger form a phrase: their bytes, neighbours overlapping by
``size`` - 1, as phrases of a prefix-free parse overlap by the trigger.

1. Parse: blocks (doc_id ranges) turn their documents into phrases; equal
   phrases of a block are one entry.  Entries meet in buckets of the trigger's
   hash.
2. Dictionary and parse: equal phrases of several blocks are one dictionary
   entry; its first occurrence in corpus order (block, place) is the original,
   all other occurrences are repeats as a whole.  Most triggers have a single
   dictionary entry and are done.
3. Dictionary suffixes: where a trigger has several entries, the originals
   send their bytes, and the bucket sorts the suffixes of these entries to a
   depth of ``size`` bytes (ties in corpus order).  Neighbours that agree on
   ``size`` bytes are repeats of the first.  A trigger with very many entries (a
   line that is in a third of all documents) does not go to one bucket: each
   block sends its distinct suffixes, dealt by the hash of their bytes.
4. Blocks get both answers and merge the covered bytes into removal spans.

Equal windows have equal triggers at equal offsets, so they always meet in one
bucket: the suffix order is complete within each bucket, and buckets need no
order among themselves.  Phrase equality uses 64 + 48 bits of hash; step 3
compares the bytes.

Defined results: null and empty texts are zero bytes; documents shorter than a
window lose nothing; rows that share a doc_id are one document and never
remove each other's bytes; rows without a doc_id keep everything and remove
nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rolling
from .blocks import Block, by_bucket, firsts, in_blocks, layout, pack, pack_sorted, read_block, unpack, unpack_sorted
from .common import table

GRAM = 24
SEGMENT = 1 << 18          # window starts hashed at a time; places in a segment take PLACE_BITS
PLACE_BITS = 20
SORT_ROWS = 1 << 18         # suffixes sorted at a time
SPREAD_ENTRIES = 1 << 14    # entries whose suffixes are listed at a time
HOT_ENTRIES = 1024          # distinct phrases from which a trigger's suffixes are dealt out
WHOLE, ASKED, BYTES, HOT = 0, 1, 2, 3

ENTRY = "bucket int, blk int, triggers binary, phrases binary, places binary"
ANSWER = "blk int, kind int, bucket int, places binary"
TEXT = "bucket int, blk int, starts binary, docs binary, lengths binary, bytes binary"
KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


class Phrases(NamedTuple):
    trigger: np.ndarray     # hash of the trigger's bytes
    phrase: np.ndarray      # 48-bit hash of the phrase's bytes
    a: np.ndarray           # first and last window start
    b: np.ndarray
    doc: np.ndarray


def _joined(block: Block):
    """The block's bytes (one zero byte between rows), row starts and lengths."""
    data = np.frombuffer(b"\0".join(block.texts), np.uint8)
    lengths = np.array([len(t) for t in block.texts], np.int64)
    return data, np.cumsum(lengths + 1) - lengths - 1, lengths


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def _parse(block: Block, size: int, gram: int) -> Phrases:
    data, start, lengths = _joined(block)
    edge = np.zeros(len(data) + 1, np.int32)
    long = lengths >= size
    np.add.at(edge, start[long], 1)
    np.add.at(edge, start[long] + lengths[long] - size + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    parts = []
    mask = np.uint64((1 << PLACE_BITS) - 1)
    for lo in range(0, len(data) if block.ordered else 0, SEGMENT):
        own = np.flatnonzero(valid[lo:lo + SEGMENT])
        if not len(own):
            continue
        piece = data[lo:lo + SEGMENT + size - 1]
        p = rolling.byte_prefix(piece)
        g = rolling.mix(rolling.window_hash(p, gram))
        key = (g & ~mask) | np.arange(len(g), dtype=np.uint64)
        at = (_slide_min(key, size - gram + 1)[own] & mask).astype(np.int64)
        row = np.searchsorted(start, own + lo, side="right")
        new = np.ones(len(own), bool)
        new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        i = np.flatnonzero(new)
        a, t, b = own[i], at[i], own[np.append(i[1:], len(own)) - 1]
        shape = ((t - a) * 4096 + (b - a)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        e = rolling.mix(rolling.range_hash(p, a, b + size) + shape) >> np.uint64(16)
        parts.append(Phrases(g[t], e, a + lo, b + lo, block.doc[row[i] - 1]))
    if not parts:
        z = np.zeros(0, np.int64)
        return Phrases(z.astype(np.uint64), z.astype(np.uint64), z, z, z)
    return Phrases(*map(np.concatenate, zip(*parts)))


def _first_phrase(p: Phrases) -> np.ndarray:
    return firsts(rolling.mix(p.trigger + p.phrase * np.uint64(rolling.BASE)))


def _table(ddl: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))]
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, fields)], schema=pa.schema(fields))


def _send(bits: int, size: int, gram: int):
    def send(rows: pa.Table) -> pa.Table:
        blk, p = rows.column("blk")[0].as_py(), _parse(read_block(rows), size, gram)
        own = np.flatnonzero(_first_phrase(p) == np.arange(len(p.a)))
        return _table(ENTRY, [
            (b, blk, pack(p.trigger[own[i]]), pack(p.phrase[own[i]]), pack_sorted(own[i]))
            for b, i in by_bucket(p.trigger[own], bits)])
    return send


def _dictionary(rows: pa.Table) -> pa.Table:
    """Repeated phrases (WHOLE) and originals whose bytes are needed (ASKED)."""
    bucket, blks = rows.column("bucket")[0].as_py(), np.array(rows.column("blk").to_pylist())
    parts = [(int(blks[i]), unpack(rows.column("triggers")[int(i)].as_py(), np.uint64),
              unpack(rows.column("phrases")[int(i)].as_py(), np.uint64),
              unpack_sorted(rows.column("places")[int(i)].as_py())) for i in np.argsort(blks)]
    t, e = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    order = np.lexsort((e, t))
    ts, es = t[order], e[order]
    new_t = np.ones(len(t), bool)
    new_t[1:] = ts[1:] != ts[:-1]
    new = new_t.copy()
    new[1:] |= es[1:] != es[:-1]
    of = np.cumsum(new_t) - 1
    several = np.bincount(of, weights=new)[of]
    whole, asked, hot = (np.empty(len(t), bool) for _ in range(3))
    whole[order], hot[order] = ~new, new & (several >= HOT_ENTRIES)
    asked[order] = new & (several > 1) & (several < HOT_ENTRIES)
    out, at = [], 0
    for blk, own, _, places in parts:
        for kind, hit in ((WHOLE, whole), (ASKED, asked), (HOT, hot)):
            if len(told := places[hit[at:at + len(own)]]):
                out.append((blk, kind, bucket, pack_sorted(told)))
        at += len(own)
    return _table(ANSWER, out)


def _hot_suffixes(data: np.ndarray, p: Phrases, places: list[np.ndarray], size: int):
    """Places, documents and hashes of the windows of a block's hot entries,
    and for each the index of the block's first equal one."""
    i = np.sort(np.concatenate(places))
    n = p.b[i] - p.a[i] + 1
    at, doc, h = _spread(p.a[i], n), np.repeat(p.doc[i], n), []
    for lo in range(0, len(at), SEGMENT):
        own = at[lo:lo + SEGMENT]
        x = np.zeros(len(own), np.uint64)
        for j in range(size):
            x = x * np.uint64(rolling.BASE) + rolling.DIGIT[data[own + j]]
        h.append(rolling.mix(x))
    h = np.concatenate(h)
    return at, doc, h, firsts(h)


def _answers(table_: pa.Table, kind: int) -> list[np.ndarray]:
    return [unpack_sorted(places) for k, places in zip(table_.column("kind").to_pylist(),
                                                       table_.column("places").to_pylist()) if k == kind]


def _bytes(bits: int, size: int, gram: int):
    def send(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return _table(TEXT, [])
        block, blk = read_block(rows), rows.column("blk")[0].as_py()
        p, (data, _, _) = _parse(block, size, gram), _joined(block)
        out = []

        def add(bucket: int, a: np.ndarray, n: np.ndarray, doc: np.ndarray) -> None:
            out.append((bucket, blk, pack_sorted(a), pack_sorted(doc), pack(n.astype(np.uint32)),
                        data[_spread(a, n)].tobytes()))

        for kind, bucket, places in zip(*(asked.column(c).to_pylist() for c in ("kind", "bucket", "places"))):
            if kind == ASKED:
                i = unpack_sorted(places)
                add(bucket, p.a[i], p.b[i] - p.a[i] + size, p.doc[i])
        if hot := _answers(asked, HOT):
            at, doc, h, first = _hot_suffixes(data, p, hot, size)
            own = np.flatnonzero(first == np.arange(len(h)))
            for bucket, i in by_bucket(h[own], bits):
                add(bucket, at[own[i]], np.full(len(i), size), doc[own[i]])
        return _table(TEXT, out)
    return send


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Concatenated ranges start .. start + n - 1."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) + np.repeat(start - ends + n, n)


def _words(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each place, high byte first: a view of ``data``."""
    return np.ndarray(len(data) - 7, ">u8", data, strides=(1,))


def _suffixes(size: int):
    def settle(rows: pa.Table) -> pa.Table:
        """Sort the entries' suffixes to depth ``size``; answer the repeats."""
        bucket, blks = rows.column("bucket")[0].as_py(), np.array(rows.column("blk").to_pylist())
        col = lambda name, i: rows.column(name)[int(i)].as_py()
        order = np.argsort(blks)
        starts = [unpack_sorted(col("starts", i)) for i in order]
        docs = [unpack_sorted(col("docs", i)) for i in order]
        n = np.concatenate([unpack(col("lengths", i), np.uint32).astype(np.int64) for i in order])
        data = np.frombuffer(b"".join([*(col("bytes", i) for i in order), bytes(8)]), np.uint8)
        blk = np.repeat(blks[order], [len(s) for s in starts]).astype(np.int64)
        start, doc = np.concatenate(starts), np.concatenate(docs)
        m = n - size + 1                                        # suffixes with at least ``size`` bytes
        base, to = np.cumsum(n) - n, np.concatenate([[0], np.cumsum(m)])
        word = _words(data)
        depths = [*range(0, size - 7, 8)] + [size - 8] * (size % 8 > 0)   # the last eight bytes complete the depth
        # suffixes that start alike stay together, so parts can be sorted one by one
        parts = int(to[-1]) // SORT_ROWS + 1
        at = np.empty(to[-1], np.int32 if len(data) < 1 << 31 else np.int64)
        entry, part = np.empty(len(at), np.int32), np.empty(len(at), np.int32)
        for lo in range(0, len(n), SPREAD_ENTRIES):
            hi = min(lo + SPREAD_ENTRIES, len(n))
            own = slice(to[lo], to[hi])
            at[own] = _spread(base[lo:hi], m[lo:hi])
            entry[own] = np.repeat(np.arange(lo, hi), m[lo:hi])
            part[own] = rolling.mix(word[at[own]].astype(np.uint64)) % np.uint64(parts)
        hits = []
        for k in range(parts):
            own = np.flatnonzero(part == k)
            words = [word[at[own] + j].astype(np.uint64) for j in depths]
            order = np.lexsort(words[::-1])
            by = own[order]
            same = np.ones(len(by), bool)
            for w in words:
                w = w[order]
                same[1:] &= w[1:] == w[:-1]
            same[:1] = False
            head = by[np.flatnonzero(~same)][np.cumsum(~same) - 1] if len(by) else by
            e, f = entry[by], entry[head]
            hits.append(by[(blk[e] != blk[f]) | (doc[e] != doc[f])])
        hit = np.concatenate(hits)
        e = entry[hit]
        place = start[e] + at[hit] - base[e]
        out = [(int(k), BYTES, bucket, pack_sorted(np.unique(place[blk[e] == k]))) for k in np.unique(blk[e])]
        return _table(ANSWER, out)
    return settle


def _keep(size: int, gram: int):
    def keep(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = read_block(rows)
        data, start, lengths = _joined(block)
        p = _parse(block, size, gram)
        first = _first_phrase(p)
        told, single = np.zeros(len(p.a), bool), np.zeros(len(data) + 1, bool)
        for mark, kind in ((told, WHOLE), (single, BYTES)):
            for places in _answers(answers, kind):
                mark[places] = True
        if hot := _answers(answers, HOT):
            at, doc, _, head = _hot_suffixes(data, p, hot, size)
            single[at[(doc != doc[head]) | single[at[head]]]] = True
        whole = told[first] | (p.doc != p.doc[first])
        # an original's other occurrences in its own document share its single windows
        some = np.concatenate([[0], np.cumsum(single, dtype=np.int32)])
        again = np.flatnonzero(~whole & (first != np.arange(len(first))))
        again = again[some[p.b[first[again]] + 1] > some[p.a[first[again]]]]
        n = p.b[again] - p.a[again] + 1
        to, of = _spread(p.a[again], n), _spread(p.a[first[again]], n)
        single[to[single[of]]] = True
        edge = np.zeros(len(data) + size + 1, np.int32)
        lone = np.flatnonzero(single)
        for i, j in ((p.a[whole], p.b[whole] + size), (lone, lone + size)):
            np.add.at(edge, i, 1)
            np.add.at(edge, j, -1)
        gone = np.cumsum(edge[:len(data) + 1]) > 0
        run = gone & ~np.concatenate([[False], gone[:-1]])
        n_gone, n_run = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (gone, run))
        end = start + lengths
        removed, spans = n_gone[end] - n_gone[start], n_run[end] - n_run[start]
        kept = [t if not r else data[s:e][~gone[s:e]].tobytes()
                for t, s, e, r in zip(block.texts, start, end, removed)]
        return _table(KEPT, list(zip(block.ids, lengths.tolist(), removed.tolist(), spans.tolist(), kept)))
    return keep


def remove_repeated_bytes(docs: DataFrame, size: int = 50, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) per row of ``docs``."""
    if not 8 <= gram <= size < 2048:
        raise ValueError("8 <= gram <= size < 2048")
    lay = layout(docs)
    blocks = in_blocks(docs, lay.blocks)
    entries = blocks.groupBy("blk").applyInArrow(_send(lay.bucket_bits, size, gram), ENTRY)
    answers = entries.groupBy("bucket").applyInArrow(_dictionary, ANSWER)
    asked = answers.where(F.col("kind").isin(ASKED, HOT))
    texts = blocks.groupBy("blk").cogroup(asked.groupBy("blk")).applyInArrow(_bytes(lay.bucket_bits, size, gram), TEXT)
    single = texts.groupBy("bucket").applyInArrow(_suffixes(size), ANSWER)
    told = answers.where(F.col("kind").isin(WHOLE, HOT)).unionByName(single)
    return blocks.groupBy("blk").cogroup(told.groupBy("blk")).applyInArrow(_keep(size, gram), KEPT)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
