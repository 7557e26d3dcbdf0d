"""Best-fit packing of tokenised documents by exact-complement hashing.

1. Tokenise every text; documents longer than a sequence are cut into pieces.
2. Count pieces by length (at most ``context`` lengths) and plan on these
   counts alone: the longest open length starts a sequence; if the gap is a
   length, or the sum of two or three lengths, that is still available, the
   combination closes the sequence exactly; else the best-fitting length goes
   in and the rest of the gap is tried again.  A planned pattern is used as
   often as the counts allow, so the plan is a bounded table of patterns, not
   of pieces: every use brings a length below what the pattern needs of it.
3. Number the pieces of each length (chunk by chunk, no length in one task)
   and look up each number's pattern, sequence and offset in the plan.  The
   token ids travel with their piece, so the rows of a sequence, ordered by
   offset, are the packed sequence itself.

Tokens come from the tokenizer; texts are split at white space first and
tasks keep the ids of the strings between, since no token spans white space.

Defined results: a null or empty text is the end id alone; every row is a
document of its own, repeated rows too; pieces of equal length are taken in
the order of their hash; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.numbering import chunked_running
from ..session import scratch_path
from .byte_bpe import gather, slices
from .common import n_blocks, table

CONTEXT = 4096
END_ID = 1
#: Strings whose ids a task keeps; when full, the store starts anew.
KEEP_STRINGS = 1_200_000
ROWS_PER_CHUNK = 100_000
#: Text bytes that a task tokenises together.
BATCH_BYTES = 1 << 20
#: Bound of the ids that one chunk of a length holds.
CHUNK_BYTES = 8 << 20
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_MARKS = ",.!?;:%&$*#|()[]"


class _Encoder:
    """Little-endian 32-bit ids of texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kept: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The texts are cut at white space together, equal strings coded as
        one; each string is looked up once and the ids gathered by arrays."""
        raw = [_lower(t).encode() + b" " for t in texts]
        data = b"".join(raw)
        marks = np.frombuffer(data, np.uint8)
        cuts = np.flatnonzero((marks == 32) | (marks == 9) | (marks == 10) | (marks == 13)) + 1
        offsets = np.concatenate([[0], cuts]).astype(np.int32)      # every string with the blank behind it
        coded = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = coded.dictionary_encode()
        own = pc.binary_slice(coded.dictionary, 0, -1).cast(pa.string()).to_numpy(zero_copy_only=False).tolist()
        new = set(own).difference(self.kept)
        if len(self.kept) + len(new) > KEEP_STRINGS:
            self.kept = {"": b""}
            new = set(own).difference(self.kept)
        self._learn(new)
        found = list(map(self.kept.__getitem__, own))
        ids, total = gather(coded.indices.to_numpy(), np.frombuffer(b"".join(found), "<u4"),
                            np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4))
        at = total[np.searchsorted(offsets, np.cumsum([0, *map(len, raw)], dtype=np.int64))]
        return [ids[i:j].tobytes() for i, j in zip(at, at[1:])]

    def _learn(self, new: set[str]) -> None:
        """Ids of new strings.  Letters before a run of marks are encoded by
        themselves, and so are the marks: no token spans a letter and a mark.
        A word of a-z is one unit of the tokenizer's model."""
        marked = []
        for s in new:
            word = s.rstrip(_MARKS)
            if word != s and word.isalpha() and max(word) < "\u0100":
                marked.append((s, word, s[len(word):]))
        plain = new.difference(m[0] for m in marked).union(m[1] for m in marked).union(m[2] for m in marked)
        rest = []
        tokenize = self.tokenizer.model.tokenize
        for s in plain.difference(self.kept):
            if s.isascii() and s.isalpha() and s.islower():
                self.kept[s] = array("I", [t.id for t in tokenize(s)]).tobytes()
            else:
                rest.append(s)
        for at in range(0, len(rest), 10_000):
            part = rest[at:at + 10_000]
            for s, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.kept[s] = array("I", e.ids).tobytes()
        for s, word, tail in marked:
            self.kept[s] = self.kept[word] + self.kept[tail]


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    """One tokenizer for all tasks of a worker process, read once; each task
    starts with an empty store, so idle workers hold no strings."""
    return _Encoder(path)


def _lower(text: str) -> str:
    """Lower case where that is sure to be what the tokenizer does first: in
    Latin-1 no letter composes or changes length."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def pieces(docs: DataFrame, tokenizer: str, context: int = CONTEXT, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and (unless told not to) ids, little-endian 32 bits."""
    schema = PIECES + (", ids binary" if with_ids else "")

    def run(batches):
        encoder, end = _encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        encoder.kept = {"": b""}
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            for part in slices(batch, size, BATCH_BYTES):
                rows = []
                for doc, ids in zip(part.column("doc_id").to_pylist(),
                                    encoder.encode([t or "" for t in part.column("text").to_pylist()])):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * context)):
                        own = ids[at:at + 4 * context]
                        rows.append((doc, k, at // 4, len(own) // 4, zlib.crc32(own), own))
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:5 + with_ids]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
        encoder.kept = {"": b""}
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


# --------------------------------------------------------------------- plan

def _complement(open_: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three lengths that sum to ``gap``, longest first; ``open_``
    holds how many of each length are available."""
    if open_[gap]:
        return [gap]
    lengths = np.flatnonzero(open_[:gap])
    if not len(lengths) or gap > 3 * lengths[-1]:
        return None
    pair = _pair(open_, gap, int(lengths[-1]))
    if pair:
        return pair
    for a in lengths[::-1]:
        a = int(a)
        if 3 * a < gap:
            return None
        open_[a] -= 1
        rest = gap - a
        pair = _pair(open_, rest, min(a, rest - 1)) if rest > 1 else None
        open_[a] += 1
        if pair:
            return [a, *pair]
    return None


def _pair(open_: np.ndarray, total: int, most: int) -> list[int] | None:
    """Two available lengths of this sum, the longer one at most ``most``."""
    lo, hi = (total + 1) // 2, min(most, total - 1)
    if hi < lo:
        return None
    both = np.flatnonzero((open_[lo:hi + 1] > 0) & (open_[total - hi:total - lo + 1][::-1] > 0))
    for i in both[::-1]:
        a = lo + int(i)
        if 2 * a != total or open_[a] > 1:
            return [a, total - a]
    return None


def plan(counts: np.ndarray, context: int) -> np.ndarray:
    """Rows (length, rank, uses, need, sequence, offset): ranks rank .. rank +
    uses * need - 1 of ``length`` go, ``need`` to a sequence, to ``uses``
    sequences from ``sequence`` on, side by side from ``offset`` on."""
    left = counts.astype(np.int64).copy()
    taken, rows, sequence = [0] * (context + 1), array("q"), 0
    longest = context
    while True:
        while longest and not left[longest]:
            longest -= 1
        if not longest:
            break
        used, gap = {longest: 1}, context - longest
        left[longest] -= 1
        while gap:
            fit = _complement(left, gap)
            if fit is None:
                fits = np.flatnonzero(left[:gap + 1])
                if not len(fits):
                    break
                fit = [int(fits[-1])]
            for n in fit:
                left[n] -= 1
                used[n] = used.get(n, 0) + 1
                gap -= n
        more = min(int(left[n]) // k for n, k in used.items())
        uses, offset = 1 + more, 0
        for n, k in used.items():
            left[n] -= more * k
            rows.extend((n, taken[n], uses, k, sequence, offset))
            taken[n] += uses * k
            offset += n * k
        sequence += uses
    return np.array(rows, np.int64).reshape(-1, 6)


def pack(parts: DataFrame, context: int = CONTEXT) -> DataFrame:
    """``parts`` (doc_id, piece, length, ...) with sequence_id and offset; all
    columns of ``parts`` go along, the ids among them."""
    spark = parts.sparkSession
    counts = np.zeros(context + 1, np.int64)
    for r in parts.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    rows = plan(counts, context)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    shared = spark.sparkContext.broadcast(rows)
    chunks, order = F.lit(n_blocks(int(counts.sum()), ROWS_PER_CHUNK)), ["doc_id", "piece", "ids_crc32"]
    if "ids" in parts.columns:      # chunks by length: few for most, more where many long pieces meet
        own = [n_blocks(4 * n * int(c), CHUNK_BYTES) for n, c in enumerate(counts)]
        own = F.split(F.lit(",".join(map(str, own))), ",").cast("array<bigint>")     # one constant
        chunks = F.greatest(chunks.cast("bigint"), F.get(own, F.col("length").cast("int")))
        order.append("ids")
    ranked = chunked_running(parts, ["length"], order, F.pmod(F.xxhash64("doc_id", "piece"), chunks), "_rank").select(*parts.columns, "_rank")

    def place(batches):
        t = shared.value
        key = (t[:, 0] << 40) + t[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy() - 1
            row = t[np.searchsorted(key, (length << 40) + rank, side="right") - 1]
            nth, slot = np.divmod(rank - row[:, 1], row[:, 3])
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.record_batch([*[batch.column(n) for n in names], pa.array(row[:, 4] + nth, pa.int64()),
                                   pa.array(row[:, 5] + slot * length, pa.int64())],
                                  names=[*names, "sequence_id", "offset"])
    ddl = ", ".join(f"{n} {t}" for n, t in parts.dtypes) + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, ddl)


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces of ``docs`` with their ids and places.  The pieces are written
    once, under the shared checkpoint folder and by column: counting and
    numbering them does not read the ids."""
    parts = pieces(docs, tokenizer)
    out = scratch_path(docs.sparkSession, "packing", uuid.uuid4().hex)
    parts.write.option("compression", "zstd").parquet(out)
    return pack(docs.sparkSession.read.schema(parts.schema).parquet(out))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    rows = packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
