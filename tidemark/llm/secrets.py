"""Secret scans: fixed patterns plus windowed Shannon entropy, in SQL functions.

Base spans are the leftmost non-overlapping matches of three patterns per
text, kept if long enough.  The method adds, per character class, candidate
strings (maximal runs of the class) whose sliding window of ``WINDOW``
characters reaches the class's entropy threshold; overlapping windows merge
into one span.  Entropy comes from incremental counts: one character enters,
one leaves, and the sum of count * log2(count) changes by table differences,
held as integers (scale 1e6) so that no rounding error accumulates.
A candidate is suppressed if each of its parts between ``- _ / + =`` is on the
allow-list (words, numbers, known placeholders), so words, dated or numbered
slugs and paths of them are, or if it is a UUID; leading symbols do not count.
One other part, a key behind a path or a placeholder say, and the candidate
stays whole.  Base spans always stay.

Spans cover the whole match (for ``assign``: keyword through value) in code
points, end exclusive, ordered by start, then kind in the order of KINDS.

Defined results: null and empty texts have no spans; every row gives one row,
repeated rows too; an empty table gives an empty result; only doc_id and text
are read, so further columns of any name are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Fixed values of the contract.
ASSIGN = ("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
# Runs are maximal, so asking for their length in the pattern (12 after AKIA, 32)
# finds the same spans as dropping short matches of ``+``, without the many
# short matches; a short assignment does use up its text and is dropped after.
BASE = [("assign", ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]{12,}+", 0, 16), ("hex", "[0-9a-f]{32,}+", 0, 32)]
# Method parameters: kind, alphabet, bits that a window must reach.
WINDOW = 20
CLASSES = [
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 3.9),
    ("entropy_hex", "0123456789abcdefABCDEF", 3.0),
]
KINDS = [b[0] for b in BASE] + [c[0] for c in CLASSES]
# Each part between symbols is a word, a number or a placeholder with at most a
# number behind; parts are atomic, so no run is tried in more than one way.
_PART = ("(?>(?i:example|placeholder|changeme|redacted|your(?:key|token|secret))[0-9]*+(?![A-Za-z0-9])"
         "|[A-Z]?[a-z]++|[A-Z]++|[0-9]++)")
ALLOW = (f"^[-_/+=]*+(?:{_PART}(?:[-_/+=]++|$))++$"
         "|^[-_/+=]*+[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")
SCALE = 1_000_000
BLOCK = 256

_SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """Spans of the matches of ``pattern`` whose ``group`` has ``least`` characters.

    Matches and the gaps between them alternate, so start positions are
    running sums of their lengths, taken block by block."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    lengths = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), found.alias("m"), value.alias("v")),
                          lambda x: F.struct(F.length(x["g"]).alias("g"), F.length(x["m"]).alias("m"),
                                             F.length(x["v"]).alias("v")))
    return F.when(F.size(found) > 0, _positions(lengths, kind, least)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, not at each of its uses
    (a lambda's body is evaluated anew for every element)."""
    return F.transform(F.array(value), body)[0]


def _block_numbers(items: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))


def _positions(lengths: Column, kind: int, least: int) -> Column:
    """Spans from (gap, match, value) lengths; two levels keep appends short."""
    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["m"]).alias("end"))
        out = F.when(x["v"] >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct((start + x["m"]).alias("at"), out.alias("out"))

    def block(acc: Column, i: Column, lengths: Column) -> Column:
        inner = F.aggregate(F.slice(lengths, i * BLOCK + 1, BLOCK),
                            F.struct(acc["at"].alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out")), place)
        return F.transform(F.array(inner), lambda r: F.struct(
            r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))[0]

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("out"))
    return _once(lengths, lambda x: F.aggregate(_block_numbers(x), start, lambda a, i: block(a, i, x),
                                                lambda a: F.flatten(a["out"])))


def _c_log_c(n: int) -> int:
    return round(n * math.log2(n) * SCALE) if n else 0


def entropy_runs(text: Column, alphabet: str, threshold: float) -> Column:
    """array<struct<start,end>> of merged windows of ``text`` at or over
    ``threshold`` bits; every character of ``text`` is in ``alphabet``."""
    most = math.floor((math.log2(WINDOW) - threshold) * WINDOW * SCALE)   # sum of c log c at the threshold
    enter = F.array(*[F.lit(_c_log_c(n + 1) - _c_log_c(n)) for n in range(WINDOW + 1)])
    cells = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    # the entering and the leaving character of every step, worked out once
    late = F.slice(F.concat(F.array_repeat(F.lit(-1), WINDOW), cells), F.lit(1), F.length(text))
    moves = F.arrays_zip(cells.alias("new"), late.alias("out"))

    def step(s: Column, x: Column) -> Column:
        # the leaving character first, then the entering one
        i = s["i"] + 1
        less = F.when(x["out"] >= 0, F.get(enter, F.get(s["c"], x["out"]) - 1)).otherwise(F.lit(0))
        kept = F.transform(s["c"], lambda v, k: v - F.when(k == x["out"], 1).otherwise(0))
        return F.transform(F.array(F.struct(kept.alias("c"), (s["e"] - less).alias("e"))), lambda k: (
            F.transform(F.array(k["e"] + F.get(enter, F.get(k["c"], x["new"]))), lambda e: F.struct(
                i.alias("i"),
                F.transform(k["c"], lambda v, j: v + F.when(j == x["new"], 1).otherwise(0)).alias("c"),
                e.alias("e"),
                F.when((i >= WINDOW - 1) & (e <= most), F.when(s["b"] >= i - WINDOW + 1, s["a"])
                       .otherwise(i - WINDOW + 1)).otherwise(s["a"]).alias("a"),
                F.when((i >= WINDOW - 1) & (e <= most), i + 1).otherwise(s["b"]).alias("b"),
                F.when((i >= WINDOW - 1) & (e <= most) & (s["b"] >= 0) & (s["b"] < i - WINDOW + 1),
                       F.concat(s["out"], F.array(F.struct(s["a"].alias("start"), s["b"].alias("end")))))
                .otherwise(s["out"]).alias("out")))[0]))[0]

    start = F.struct(F.lit(-1).alias("i"), F.array_repeat(F.lit(0), len(alphabet)).alias("c"), F.lit(0).alias("e"), F.lit(-1).alias("a"),
                     F.lit(-1).alias("b"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    done = lambda s: F.when(s["b"] >= 0, F.concat(s["out"], F.array(
        F.struct(s["a"].alias("start"), s["b"].alias("end"))))).otherwise(s["out"])
    return F.aggregate(moves, start, step, done)


def _class_pattern(alphabet: str) -> str:
    inside = alphabet.replace("-", "") + ("-" if "-" in alphabet else "")
    return f"[{inside}]{{{WINDOW},}}+"


def _entropy_spans(text: Column, candidates: Column, kind: int, alphabet: str, threshold: float) -> Column:
    """Entropy spans inside the candidate spans, allow-list applied."""
    def of(c: Column) -> Column:
        word = F.substring(text, c["start"] + 1, c["end"] - c["start"])
        runs = F.transform(entropy_runs(word, alphabet, threshold), lambda r: F.struct(
            (c["start"] + r["start"]).alias("start"), F.lit(kind).alias("kind"), (c["start"] + r["end"]).alias("end")))
        return F.when(word.rlike(ALLOW), F.array().cast(f"array<{_SPAN}>")).otherwise(runs)
    return F.flatten(F.transform(candidates, of))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_spans``: array<struct<start, kind, end>> ordered by
    start and kind; ``kind`` indexes KINDS."""
    df = docs.withColumn("_t", F.coalesce(F.col("text"), F.lit("")))
    names = []
    for k, (kind, pattern, group, least) in enumerate(BASE):
        df = df.withColumn(f"_s{k}", _spans(F.col("_t"), pattern, k, group, least))
        names.append(f"_s{k}")
    for k, (kind, alphabet, threshold) in enumerate(CLASSES, len(BASE)):
        df = df.withColumn(f"_c{k}", _spans(F.col("_t"), _class_pattern(alphabet), k, 0, WINDOW))
        df = df.withColumn(f"_s{k}", F.when(F.size(f"_c{k}") > 0, _entropy_spans(
            F.col("_t"), F.col(f"_c{k}"), k, alphabet, threshold)).otherwise(F.array().cast(f"array<{_SPAN}>"))).drop(f"_c{k}")
        names.append(f"_s{k}")
    return df.withColumn("_spans", F.array_sort(F.concat(*names))).drop("_t", *names)


def _in_blocks(items: Column, start: Column, step, out: str, text: bool = False) -> Column:
    """State after folding ``items`` in blocks, its ``out`` the array of all
    that the steps appended: appending within a block keeps the arrays short.

    ``start`` is a struct of carried fields, ``step(state, item)`` returns the
    next state, ``out`` last.  With ``text`` the carried ``rest`` of a text is
    cut off block by block too, at the block's last ``end``."""
    def block(acc: Column, i: Column, items: Column) -> Column:
        own = F.slice(items, i * BLOCK + 1, BLOCK)
        first = F.struct(acc["at"].alias("at"), acc["rest"].alias("rest"), F.array().cast(f"array<{out}>").alias("out"))
        if not text:
            return F.transform(F.array(F.aggregate(own, first, step)), lambda r: F.struct(
                r["at"].alias("at"), r["rest"].alias("rest"), F.concat(acc["out"], F.array(r["out"])).alias("out")))[0]
        size = F.element_at(own, -1)["end"] - acc["at"]
        first = first.withField("rest", F.substring(acc["rest"], F.lit(1), size))
        return F.transform(F.array(F.aggregate(own, first, step)), lambda r: F.struct(
            r["at"].alias("at"), F.substr(acc["rest"], size + 1).alias("rest"),
            F.concat(acc["out"], F.array(r["out"])).alias("out")))[0]

    start = F.struct(start["at"].alias("at"), start["rest"].alias("rest"), F.array().cast(f"array<array<{out}>>").alias("out"))
    return _once(items, lambda x: F.aggregate(_block_numbers(x), start, lambda a, i: block(a, i, x)))


def _merged(spans: Column) -> Column:
    """Maximal intervals covered by the spans, which are ordered by start."""
    def merge(acc: Column, s: Column) -> Column:
        a, b = acc["at"]["a"], acc["at"]["b"]
        joins = b >= s["start"]
        at = F.struct(F.when(joins, a).otherwise(s["start"]).alias("a"),
                      F.when(joins, F.greatest(b, s["end"])).otherwise(s["end"]).alias("b"))
        out = F.when(joins | (b < 0), acc["out"]).otherwise(
            F.concat(acc["out"], F.array(F.struct(a.alias("start"), b.alias("end")))))
        return F.struct(at.alias("at"), acc["rest"].alias("rest"), out.alias("out"))

    none = F.struct(F.struct(F.lit(-1).alias("a"), F.lit(-1).alias("b")).alias("at"), F.lit("").alias("rest"))
    return F.transform(F.array(_in_blocks(spans, none, merge, "struct<start:int,end:int>")), lambda r: F.concat(
        F.flatten(r["out"]), F.array(F.struct(r["at"]["a"].alias("start"), r["at"]["b"].alias("end")))))[0]


def _gaps(text: Column, intervals: Column) -> Column:
    """The parts of ``text`` before, between and after the intervals; the text
    is walked with a carried rest, never from its start."""
    def cut(acc: Column, x: Column) -> Column:
        return F.struct(x["end"].alias("at"), F.substr(acc["rest"], x["end"] - acc["at"] + 1).alias("rest"),
                        F.concat(acc["out"], F.array(F.substring(acc["rest"], F.lit(1), x["start"] - acc["at"]))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), text.alias("rest"))
    return F.transform(F.array(_in_blocks(intervals, start, cut, "string", text=True)), lambda r: F.concat(
        F.flatten(r["out"]), F.array(r["rest"])))[0]


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` (overlaps merged) replaced by ``mark``.

    Columns stay as they are; ``n_chars``, if there, is set to the length of
    a changed text."""
    cols = docs.columns
    some = F.size("_spans") > 0
    found = find_secrets(docs).withColumn("_m", F.when(some, _merged(F.col("_spans"))))
    df = found.withColumn("_new", F.when(some, F.array_join(_gaps(F.col("text"), F.col("_m")), mark)).otherwise(F.col("text")))
    out = []
    for c in cols:
        if c == "text":
            out.append(F.col("_new").alias("text"))
        elif c == "n_chars":
            out.append(F.when(some, F.length("_new").cast(dict(docs.dtypes)[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{b[0]}") for k, b in enumerate(BASE)],
        F.sha2(_joined(F.filter("_spans", lambda s: s["kind"] < len(BASE))), 256).alias("base_sha256"),
        _joined(F.col("_spans")).alias("spans"))
