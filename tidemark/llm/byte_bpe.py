"""Byte-level BPE encoding and decoding of whole texts.

A text of up to ``CHUNK`` bytes is one chunk.  A longer one is cut into chunks
that overlap, which are dealt out and pre-tokenised side by side.  A match of
the pattern depends on nothing before its start, so two scans that share one
boundary agree from there on: ``stitch`` walks a text's chunks and passes from
one to the next at the first boundary that both found in their overlap.  The
last ``MARGIN`` characters before a cut are not believed, since a match there
may look beyond it.  Where no boundary is shared (a run of letters or of blanks
longer than the overlap) the text is scanned on from the last sure boundary,
over one, two, four ... more chunks.  The stitched parts are dealt out again,
their pieces encoded, and the ids put together in order.

Pieces of a batch are dictionary-coded, so each different piece is encoded once
per batch, by the public library's merge loop; ids are then gathered by
arrays.  The pattern of word, number, sign and blank runs is scanned by
character classes in numpy, any other pattern by ``regex``.  Decoding
concatenates the raw bytes of the ids.

Defined results: a null or empty text has no ids and decodes to no bytes;
special tokens do not exist, their strings are ordinary text; rows are
independent, so repeated rows, ties and null doc_ids give one result each; an
empty table gives none.  Ids outside the vocabulary fail in ``decode``; null
ids decode as none.  Only doc_id and text are read, so further columns of any
name are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Characters of a chunk, shared with the next one, and not believed before a cut.
CHUNK, OVERLAP, MARGIN = 1 << 15, 1 << 9, 16
#: Text bytes whose pieces are worked on together.
BATCH_BYTES = 4 << 20
GATHER = 1 << 17
#: Ids decoded together.
BATCH_IDS = 1 << 20

#: Fixed value: the pattern whose matches ``_scan_classes`` finds.
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Scan = Callable[[str], np.ndarray]


class Vocabulary(NamedTuple):
    """Content of a file of ``base64 rank`` lines, and the pattern of pieces."""
    content: bytes
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> "Vocabulary":
        with open(path, "rb") as f:
            return cls(f.read(), pattern)


@lru_cache(2)
def _ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


@lru_cache(2)
def _encoder(vocabulary: Vocabulary):
    import tiktoken
    return tiktoken.Encoding("vocabulary", pat_str=vocabulary.pattern, mergeable_ranks=_ranks(vocabulary.content),
                             special_tokens={})


# ------------------------------------------------------------- pre-tokenisation

BLANK, LETTER, NUMBER, SIGN = range(4)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    import regex
    table = np.full(0x110000, SIGN, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for cls, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(m[0][0]), ord(m[0][-1])
            table[a:b + 1] = cls
    return table


def _scan_classes(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of the characters that start a match of ``RUNS``; ``first`` marks
    the first character of every text in ``chars``.

    A run of one class is a piece.  A space before a run belongs to it; other
    blanks before it are one piece but for their last, which stands alone.  An
    apostrophe that starts a piece takes its ending from the letters after."""
    n = len(chars)
    cls = _classes()[chars]
    blank = cls == BLANK
    new = first.copy()
    new[1:] |= cls[1:] != cls[:-1]
    last_blank = np.zeros(n, bool)          # a blank with no blank after it, in a text that goes on
    last_blank[:-1] = blank[:-1] & ~blank[1:] & ~first[1:]
    after_space = np.zeros(n, bool)
    after_space[1:] = (chars[:-1] == 32) & ~first[1:]
    start = np.where(blank, new | last_blank, new & ~after_space)
    quote = np.flatnonzero((chars == 39) & start)
    if len(quote):
        pad = np.concatenate([chars, np.zeros(3, chars.dtype)])
        edge = np.concatenate([first, np.ones(3, bool)])
        a, b = pad[quote + 1], pad[quote + 2]
        same1, same2 = ~edge[quote + 1], ~edge[quote + 1] & ~edge[quote + 2]
        one = same1 & np.isin(a, [ord(c) for c in "stmd"])
        two = same2 & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e")))
                       | ((a == ord("l")) & (b == ord("l"))))
        start[quote[one | two] + 1] = False
        for found, size in ((one, 2), (two, 3)):
            rest = quote[found] + size
            rest = rest[rest < n]
            start[rest[~first[rest] & (cls[rest] == LETTER)]] = True
    return start


def _chars(text: bytes | str) -> np.ndarray:
    text = text if isinstance(text, str) else text.decode()
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def scanner(pattern: str) -> Scan:
    """Function from a text to the places where its pieces start."""
    if pattern == RUNS:
        def scan(text: str) -> np.ndarray:
            chars = _chars(text)
            first = np.zeros(len(chars), bool)
            first[:1] = True
            return np.flatnonzero(_scan_classes(chars, first))
        return scan
    import regex
    compiled = regex.compile(pattern)
    return lambda text: np.array([m.start() for m in compiled.finditer(text)], np.int64)


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """(place, chunk) of a text, each sharing ``overlap`` characters with the next."""
    step = chunk - overlap
    return [(at, text[at:at + chunk]) for at in range(0, max(1, len(text) - overlap), step)]


def stitch(chunks: list[tuple[int, str, np.ndarray]], scan: Scan, margin: int) -> Iterator[tuple[str, np.ndarray]]:
    """(text, piece starts in it) of the parts that the chunks (place, text,
    places of starts) agree on; the parts follow one another without a gap."""
    at, text, starts = chunks[0]
    k, since, more = 0, at, 1
    while k + 1 < len(chunks):
        safe = at + len(text) - margin
        sure = starts[(starts >= since) & (starts <= safe)]
        nxt = chunks[k + 1]
        common = np.intersect1d(sure, nxt[2][nxt[2] <= safe])
        if len(common):
            to = int(common[0])
            yield text[since - at:to - at], sure[sure < to] - since
            k, since, more = k + 1, to, 1
            at, text, starts = nxt
            continue
        to = int(sure[-1]) if len(sure) else since
        more = 1 if to > since else 2 * more
        yield text[since - at:to - at], sure[sure < to] - since
        parts = [text[to - at:]]
        end = at + len(text)
        for _ in range(min(more, len(chunks) - 1 - k)):
            k += 1
            parts.append(chunks[k][1][end - chunks[k][0]:])
            end = chunks[k][0] + len(chunks[k][1])
        at, since, text = to, to, "".join(parts)
        starts = scan(text) + at
    yield text[since - at:], starts[starts >= since] - since


# --------------------------------------------------------------------- encoding

def gather(codes: np.ndarray, values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the runs ``codes`` of ``values`` (run i ends at ends[i])
    and the running total of their lengths, from 0; index arrays are made for
    ``GATHER`` runs at a time."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum((ends - begins)[codes])])
    out = np.empty(total[-1], values.dtype)
    for lo in range(0, len(codes), GATHER):
        t, first = total[lo:lo + GATHER + 1], begins[codes[lo:lo + GATHER]]
        out[t[0]:t[-1]] = values[np.repeat(first - t[:-1], np.diff(t)) + np.arange(t[0], t[-1])]
    return out, total


def encode_pieces(vocabulary: Vocabulary, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces of ``data`` that start at these bytes, and the running
    number of ids before each piece."""
    encoder, ranks = _encoder(vocabulary), _ranks(vocabulary.content)
    offsets = np.append(starts, len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    pieces = pieces.dictionary_encode()
    ids, ends = [], []
    for piece in pieces.dictionary.to_pylist():
        whole = ranks.get(piece)
        if whole is None:
            ids.extend(encoder._encode_single_piece(piece))
        else:
            ids.append(whole)
        ends.append(len(ids))
    return gather(pieces.indices.to_numpy(), np.array(ids, np.int32), np.array(ends, np.int64))


def _places(chars: np.ndarray) -> np.ndarray:
    """Byte place of every character, and the end."""
    size = np.ones(len(chars), np.int64)
    for bound in (0x80, 0x800, 0x10000):
        size += chars >= bound
    return np.concatenate([[0], np.cumsum(size)])


def _encode_texts(vocabulary: Vocabulary, texts: pa.Array) -> pa.ListArray:
    """Ids of every text of a batch, pre-tokenised together."""
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    data = b"".join(texts.cast(pa.binary()).to_pylist())
    if vocabulary.pattern == RUNS:
        chars = _chars(data)
        places = _places(chars)
        first = np.zeros(len(chars) + 1, bool)
        first[np.searchsorted(places, ends[:-1])] = True
        starts = places[:-1][_scan_classes(chars, first[:-1])]
    else:
        scan = scanner(vocabulary.pattern)
        starts = np.concatenate([np.zeros(0, np.int64), *(
            at + _places(_chars(t))[scan(t)] for at, t in zip(ends, texts.to_pylist()))])
    ids, total = encode_pieces(vocabulary, data, starts)
    return pa.ListArray.from_arrays(total[np.searchsorted(starts, ends)].astype(np.int32), pa.array(ids))


def slices(batch: pa.RecordBatch, size: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, of these sizes, in runs of about ``most`` together."""
    group, at = np.cumsum(size) // most, 0
    for to in [*(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]:
        if to > at:
            yield batch.slice(at, to - at)
        at = to


def _by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        yield from slices(batch, size, BATCH_BYTES)


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK, overlap: int = OVERLAP,
           margin: int = MARGIN) -> DataFrame:
    """doc_id, ids (array<int>) of every row's whole text."""
    if not 0 <= margin < overlap < chunk:
        raise ValueError("margin < overlap < chunk is needed")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)     # a vocabulary file, whatever the input
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.octet_length("text") > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_text(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), _encode_texts(sent.value, part.column("text"))], ["doc_id", "ids"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text"))):
                cuts = cut(text.as_py(), chunk, overlap)
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([row.as_py()] * len(cuts), pa.int64()),
                    "doc_id": pa.array([doc_id.as_py()] * len(cuts), pa.int64()),
                    "at": pa.array([at for at, _ in cuts], pa.int64()), "text": pa.array([t for _, t in cuts], pa.string())})

    def boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(sent.value.pattern)
        for batch in batches:
            starts = [scan(t).tolist() for t in batch.column("text").to_pylist()]
            yield batch.append_column("starts", pa.array(starts, pa.list_(pa.int32())))

    def stitched(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        pieces = [(at, t, np.array(s, np.int64) + at) for at, t, s in zip(
            *(group.column(c).to_pylist() for c in ("at", "text", "starts")))]
        parts = [p for p in stitch(pieces, scanner(sent.value.pattern), margin) if p[0]]
        return pa.table({
            "row": pa.array([key[0].as_py()] * len(parts), pa.int64()),
            "doc_id": pa.array([key[1].as_py()] * len(parts), pa.int64()),
            "part": pa.array(range(len(parts)), pa.int32()), "text": pa.array([t for t, _ in parts], pa.string()),
            "starts": pa.array([s.tolist() for _, s in parts], pa.list_(pa.int32()))})

    def part_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_text(batches):
            texts, count = part.column("text").to_pylist(), [0, *map(len, part.column("starts"))]
            data = "".join(texts)
            before = np.cumsum([0, *map(len, texts)])
            own = np.repeat(before[:-1], count[1:])
            places = _places(_chars(data))
            starts = places[part.column("starts").flatten().to_numpy(zero_copy_only=False) + own]
            ids, total = encode_pieces(sent.value, data.encode(), starts)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("row", "doc_id", "part")),
                 pa.ListArray.from_arrays(total[np.cumsum(count)].astype(np.int32), pa.array(ids))],
                ["row", "doc_id", "part", "ids"])

    short = texts.where(~long).mapInArrow(whole, "doc_id bigint, ids array<int>")
    cuts = (texts.where(long).withColumn("row", F.monotonically_increasing_id())
            .mapInArrow(chunks, "row bigint, doc_id bigint, at bigint, text string")
            .repartition("row", "at")
            .mapInArrow(boundaries, "row bigint, doc_id bigint, at bigint, text string, starts array<int>"))
    parts = (cuts.groupBy("row", "doc_id")
             .applyInArrow(stitched, "row bigint, doc_id bigint, part int, text string, starts array<int>")
             .repartition("row", "part")
             .mapInArrow(part_ids, "row bigint, doc_id bigint, part int, ids array<int>"))
    joined = parts.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    return short.unionByName(joined.select("doc_id", F.flatten("parts.ids").alias("ids")))


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` (doc_id, ids) with ``bytes``, the raw bytes of the ids."""
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def sizes(ids: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = sorted(_ranks(sent.value.content).items(), key=lambda x: x[1])
        place = np.full(by_id[-1][1] + 1, -1, np.int64)
        place[[i for _, i in by_id]] = np.arange(len(by_id))
        values = np.frombuffer(b"".join(b for b, _ in by_id), np.uint8)
        ends = np.cumsum([len(b) for b, _ in by_id])
        for part in (p for batch in batches for p in slices(batch, sizes(batch.column("ids")), BATCH_IDS)):
            ids = part.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            count = sizes(ids)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(place) or (place[flat] < 0).any()):
                raise ValueError("an id is outside the vocabulary")
            data, total = gather(place[flat], values, ends)
            at = total[np.concatenate([[0], np.cumsum(count)])].astype(np.int32)
            raws = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, raws], ["doc_id", "ids", "bytes"])

    return rows.select("doc_id", "ids").mapInArrow(raw, "doc_id bigint, ids array<int>, bytes binary")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = decode(encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
