"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``size`` consecutive words of a benchmark item; an item with fewer
words (but some) is one window.  Both sides keep, of the hashes of their
``GRAM``-word grams, the minimum of every ``size - GRAM + 1`` consecutive ones.
Any shared run of ``size`` words therefore shares a fingerprint.

1. Document fingerprints meet the distinct benchmark fingerprints.
2. Each hit is extended in its document to the windows that contain the gram;
   their words are compared with the item windows as text, so the hits are
   exact whatever the hashes do.
3. Hit windows merge into hit words and item lists per document.

Items below ``size`` words have no such guarantee; their windows are looked up
as whole grams of their own length, one pass per length that occurs (at most
``size`` - 1).

Benchmark tables are broadcast only if their row count has been checked; else
Spark joins by shuffle, and step 1 moves hashes, never texts.

Defined results: a null or empty text has no words and no hits; items without
words have no window; rows that share doc_id and text share their result, rows
that share only doc_id are told apart by their text; null item_ids are not
listed; empty tables give empty results or no hits; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import lower_ascii, table

# Fixed value of the contract: characters that no word has (after lower-casing A-Z).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 5


def words(text: Column) -> Column:
    # splitting is several times faster than extracting millions of matches
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _run(array: Column, start: Column, n: int) -> Column:
    """Words start .. start + n - 1 (from 0) as one text."""
    return F.array_join(F.slice(array, start + 1, n), " ")


def fingerprints(array: Column, size: int, gram: int = GRAM) -> Column:
    """array<struct<pos, h>>: winnowed grams of a word array with ``size`` words at least.

    A gram stays if it is the minimum of some window of grams, that is, if the
    largest of the minima of the windows it is in is its own hash."""
    width = size - gram + 1
    hashes = F.transform(array, lambda w: F.xxhash64(w))

    def grams(hw: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hw) - gram),
                           lambda i: F.xxhash64(*[F.get(hw, i + j) for j in range(gram)]))

    def minima(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - width + 1), lambda i: F.array_min(F.slice(h, i, width)))

    def chosen(g: Column) -> Column:
        h, low = g["h"], g["low"]
        all_ = F.transform(h, lambda x, i: F.struct(i.alias("pos"), x.alias("h"), (x == F.array_max(F.slice(
            low, F.greatest(i - (width - 2), F.lit(1)), F.least(i + 1, F.lit(width))))).alias("keep")))
        return F.transform(F.filter(all_, lambda x: x["keep"]), lambda x: F.struct(x["pos"], x["h"]))

    # nested one-element transforms name intermediate arrays, so each is computed once per row
    named = F.transform(F.transform(F.transform(F.array(hashes), grams), lambda h: F.struct(
        h.alias("h"), minima(h).alias("low"))), chosen)
    return F.when(F.size(array) >= size, F.element_at(named, 1))


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """(win, n, item_id): the distinct windows of every item."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - n)).alias("i")
    return (w.select("item_id", "w", n.alias("n"), at)
            .select(F.array_join(F.slice("w", F.col("i") + 1, F.col("n")), " ").alias("win"), "n", "item_id").distinct())


def _candidates(docs: DataFrame, items: DataFrame, wins: DataFrame, size: int) -> DataFrame:
    """(doc_id, th, s, n): places where a window of n words may start."""
    own = items.select(words(F.col("text")).alias("w"))
    marks = broadcast_if_small(own.select(F.explode(fingerprints(F.col("w"), size)).alias("f"))
                               .select(F.col("f.h").alias("h")).distinct())
    found = (docs.select("doc_id", "th", F.explode(fingerprints(F.col("w"), size)).alias("f"))
             .select("doc_id", "th", F.col("f.pos").alias("pos"), F.col("f.h").alias("h"))
             .join(marks, "h", "left_semi").select("doc_id", "th", "pos", F.lit(size).alias("n")))
    for (n,) in sorted(wins.where(F.col("n") < size).select("n").distinct().collect()):
        short = broadcast_if_small(wins.where(F.col("n") == n).select(F.xxhash64("win").alias("h")).distinct())
        run = (docs.select("doc_id", "th", F.posexplode(_short_grams(F.col("w"), n)).alias("pos", "h"))
               .join(short, "h", "left_semi").select("doc_id", "th", "pos", F.lit(n).alias("n")))
        found = found.unionByName(run)
    return found


def _short_grams(w: Column, n: int) -> Column:
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(_run(w, i, n))))


def hits(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, th, s, n, win): every occurrence of an item window in ``docs``;
    ``th`` is the hash of the row's text."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("w"))
    wins = item_windows(items, size)
    reach = size - GRAM
    places = (_candidates(rows, items, wins, size).groupBy("doc_id", "th", "n")
              .agg(F.collect_set("pos").alias("pos")).checkpoint())
    keys = broadcast_if_small(places.select("doc_id", "th").distinct())
    near = rows.join(keys, rows.doc_id.eqNullSafe(keys.doc_id) & (rows.th == keys.th), "left_semi").select(
        F.col("doc_id").alias("d"), F.col("th").alias("t"), "w")
    at = near.join(places, near.d.eqNullSafe(places.doc_id) & (near.t == places.th))
    # a long window holds the gram; a short one starts at its place
    last = F.size("w") - F.col("n")
    starts = F.when(F.col("n") < size, F.col("pos")).otherwise(F.array_distinct(F.flatten(F.transform(
        "pos", lambda p: F.sequence(F.greatest(p - reach, F.lit(0)), F.greatest(F.least(p, last), F.lit(0)))))))
    runs = at.select("doc_id", "th", "n", "w", F.explode(starts).alias("s")).where(F.col("s") + F.col("n") <= F.size("w"))
    runs = runs.select("doc_id", "th", "s", "n", F.array_join(F.slice("w", F.col("s") + 1, F.col("n")), " ").alias("win"))
    known = broadcast_if_small(wins.select("win", "n").distinct())
    return runs.join(known, ["win", "n"], "left_semi").distinct()


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, th, n_words, n_hit, item_ids) per row of ``docs``; item_ids are
    texts in the order of their characters."""
    found = hits(docs, items, size).checkpoint()
    cover = F.array_distinct(F.flatten(F.transform("at", lambda x: F.sequence(x["s"], x["s"] + x["n"] - 1))))
    per_doc = found.groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "n")).alias("at")).select(
        "doc_id", "th", F.size(cover).alias("n_hit"))
    wins = broadcast_if_small(item_windows(items, size))
    named = (found.select("doc_id", "th", "win", "n").distinct().join(wins, ["win", "n"])
             .groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))
    both = per_doc.join(named, per_doc.doc_id.eqNullSafe(named.doc_id) & (per_doc.th == named.th), "left").select(
        per_doc.doc_id.alias("d"), per_doc.th.alias("t"), "n_hit", "item_ids")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(words(F.col("text"))).alias("n_words"))
    return (rows.join(both, rows.doc_id.eqNullSafe(both.d) & (rows.th == both.t), "left")
            .select("doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), F.col("n_hit").cast("bigint").alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
