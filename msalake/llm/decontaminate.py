"""Benchmark decontamination by SimHash of item-sized windows. DataFrame functions only.

1. Items and documents are cut into words (lower case) and into shingles of ``n`` words. A document's window is as long as an
   item. Where a shingle of a document also occurs in an item, the item may start that many words before: those are the
   windows that are fingerprinted, each once, for each item length. A window as similar as the threshold asks shares most of
   its shingles with the item, so no such window is left out; the item that proposed a window is not kept.
2. A fingerprint has 64 bits, each the sign of a sum over the window's shingles. A shingle's vote is the square root of its weight
   (how few items hold it): then a weighted Jaccard similarity ``s`` means a cosine of 2 s / (1 + s) at least, whatever the weights.
   At ``SIMILARITY`` that is 8 / 9 and 9.7 differing bits on average; ``RADIUS`` is five standard deviations (2.9) beyond.
3. ``radius`` + 1 blocks of bits: fingerprints within ``radius`` agree in one block at least, so a join on (block, bits, length)
   finds all of them. Beyond 16 blocks a pair would meet in several, and the length alone is joined.
4. Each candidate is verified by the exact weighted Jaccard similarity of the two shingle sets.

The benchmark's shingles are joined by value; they are broadcast only when counted and few, otherwise both sides are shuffled.

Defined results: NULL and wordless texts and items match nothing; items shorter than ``n`` words are one shingle of all their
words and match a document holding these words in a row; NULL ids count as one id after all others; rows that repeat an id are judged together, and repeated items each match. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import LAST_ID, WORD, settled

N = 5
SIMILARITY = 0.8
RADIUS = 24
FEW = 500_000


def _id(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID))


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))


def _shingles(words: Column, n: int) -> Column:
    """Hash of each run of ``n`` words, in order. ``words`` is a column, not an expression, or each step would build it anew."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))


def _bit(i: int) -> Column:
    return F.lit((1 << i) if i < 63 else -(1 << 63)).cast("long")


def _fingerprint(features: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, print)`` from rows ``(keys, shingle, weight)``: each bit the sign of the sum of its votes."""
    votes = [F.sum(F.when(F.col("shingle").bitwiseAND(_bit(i)) != 0, F.col("vote")).otherwise(-F.col("vote"))).alias(f"_{i}") for i in range(64)]
    bits = F.lit(0).cast("long")
    for i in range(64):
        bits = bits.bitwiseOR(F.when(F.col(f"_{i}") > 0, _bit(i)).otherwise(F.lit(0).cast("long")))
    return features.withColumn("vote", F.sqrt("weight")).groupBy(*keys).agg(*votes, F.sum("weight").alias("total")).select(*keys, bits.alias("print"), "total")


def _blocks(radius: int) -> Column:
    """``radius`` + 1 runs of bits that make up the fingerprint: two prints within ``radius`` share one of them. One empty run beyond 16."""
    if radius > 15:
        return F.array(F.struct(F.lit(0).alias("block"), F.lit(0).cast("long").alias("bits")))
    edges = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    part = lambda lo, hi: F.shiftrightunsigned("print", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))
    return F.array(*[F.struct(F.lit(b).alias("block"), part(lo, hi).alias("bits")) for b, (lo, hi) in enumerate(zip(edges, edges[1:]))])


def matches(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
            n: int = N, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``(key, item, start_word, end_word, similarity)``: for each document and item the most similar window, the first of equal ones."""
    if not 0 <= radius < 64:
        raise ValueError("radius must lie between 0 and 63")
    named = items.select(F.col(item).alias("item"), _words(item_text).alias("words")).where(F.size("words") > 0)
    named = named.select("item", "words", F.size("words").alias("length"), F.least(F.size("words"), F.lit(n)).alias("k"))
    sizes = sorted(r.k for r in named.select("k").distinct().collect())  # at most n numbers
    grams = None
    for k in sizes:
        one = named.where(F.col("k") == k).select("item", "length", "k", F.posexplode_outer(_shingles(F.col("words"), k)).alias("offset", "shingle"))
        grams = one if grams is None else grams.unionAll(one)
    if grams is None:
        grams = named.select("item", "length", "k", F.lit(0).alias("offset"), F.lit(0).cast("long").alias("shingle")).limit(0)
    grams = settled(grams)
    total = max(1, named.count())
    holders = grams.select("item", "k", "shingle").distinct().groupBy("k", "shingle").agg(F.count("*").alias("holders"))
    weights = settled(holders.select("k", "shingle", F.log1p(F.lit(float(total)) / F.col("holders")).alias("weight")))
    proposals = settled(grams.select("k", "shingle", "length", "offset").distinct())
    small = (lambda df: F.broadcast(df)) if proposals.limit(FEW + 1).count() <= FEW else (lambda df: df)
    default = float(math.log1p(total))

    seeds = None
    for k in sizes:
        cut = docs.select(_id(key).alias("doc"), _words(text).alias("words")).select("doc", F.size("words").alias("n_words"), _shingles(F.col("words"), k).alias("all"))
        # The outer form: for the plain one Spark would infer a filter that builds the whole array once more for each word.
        seen = cut.select("doc", "n_words", F.posexplode_outer("all").alias("at", "shingle"))
        hit = seen.join(small(proposals.where(F.col("k") == k).drop("k")), "shingle")
        start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.col("n_words") - F.col("length")))
        one = hit.select("doc", start.alias("start"), "length", F.lit(k).alias("k")).distinct()
        seeds = one if seeds is None else seeds.unionAll(one)
    if seeds is None:
        seeds = docs.select(_id(key).alias("doc"), F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(0).alias("k")).limit(0)
    # The windows of one document, at most one for each of its words and item lengths.
    windows = settled(seeds.groupBy("doc").agg(F.collect_set(F.struct("start", "length", "k")).alias("windows")))
    texts = docs.select(_id(key).alias("_doc"), F.col(text).alias("_text"))
    held = texts.join(windows.hint("merge"), F.col("_doc") == F.col("doc")).select("doc", _words("_text").alias("words"), F.explode("windows").alias("w"))
    spans = held.select("doc", "w.*", F.slice("words", F.col("w.start") + 1, F.col("w.length")).alias("part"))
    features = None
    for k in sizes or [n]:
        one = spans.where(F.col("k") == k).select("doc", "start", "length", "k", F.explode_outer(F.array_distinct(_shingles(F.col("part"), k))).alias("shingle")).where("shingle is not null")
        features = one if features is None else features.unionAll(one)
    # Rows that repeat an id put their windows together; a shingle counts once for each window.
    weighed = settled(features.distinct().join(small(weights), ["k", "shingle"], "left").withColumn("weight", F.coalesce("weight", F.lit(default))))
    held_items = grams.select("item", "length", "k", "shingle").distinct().join(weights, ["k", "shingle"])
    held_items = settled(held_items)
    window_prints = _fingerprint(weighed, ["doc", "start", "length"])
    item_prints = _fingerprint(held_items, ["item", "length"])
    left = window_prints.select("doc", "start", "length", F.col("print").alias("p"), F.col("total").alias("window_total"), F.explode(_blocks(radius)).alias("b"))
    right = item_prints.select("item", "length", F.col("print").alias("q"), F.col("total").alias("item_total"), F.explode(_blocks(radius)).alias("b"))
    near = left.join(right, ["length", "b"]).where(F.bit_count(F.col("p").bitwiseXOR(F.col("q"))) <= radius)
    # No pair is more similar than the smaller total is to the larger one.
    near = near.where(F.least("window_total", "item_total") >= (similarity - 1e-6) * F.greatest("window_total", "item_total"))
    near = settled(near.select("doc", "start", "length", "item", "window_total", "item_total").distinct())
    both = near.join(weighed, ["doc", "start", "length"]).join(held_items.select("item", "shingle"), ["item", "shingle"])
    shared = both.groupBy("doc", "start", "length", "item", "window_total", "item_total").agg(F.sum("weight").alias("common"))
    judged = shared.withColumn("similarity", F.col("common") / (F.col("window_total") + F.col("item_total") - F.col("common")))
    good = judged.where(F.col("similarity") >= similarity - 1e-9)
    best = good.groupBy("doc", "item").agg(F.max(F.struct(F.round("similarity", 9).alias("similarity"), (-F.col("start")).alias("back"), "length")).alias("m"))
    at = -F.col("m.back")
    return best.select(F.col("doc").alias(key), F.col("item").alias(item), at.cast("long").alias("start_word"), (at + F.col("m.length")).cast("long").alias("end_word"), "m.similarity")


def clean(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    found = matches(docs, items, key=key, **options).select(F.col(key).alias("_found")).distinct()
    return docs.join(found.hint("merge"), _id(key) == F.col("_found"), "left_anti")
