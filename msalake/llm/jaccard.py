"""Exact Jaccard join of word n-gram sets, by the prefixes of globally ordered sets.

1. Order. n-grams of many documents come last, the others by how frequent their words make them, then by value. The frequent
   ones are counted level by level: first words, then only n-grams whose words are all frequent. A list of items found in a
   share ``theta`` of all documents has at most ``mean set size / theta`` entries, so both lists may be sent to every task
   whatever the input; all other words count as that share.
2. Prefix tree. Two sets of similarity ``t`` or more share an item among the first ``n - ceil(t n) + 1`` of their ordered items.
   Those prefixes, of one member for each class of equal sets, are stored as a table of tree nodes, range-partitioned by item,
   so that even one item may span many tasks, and traversed in order of size. Each member of a node meets the first one of like
   size and the one before it: as many pairs as rows.
3. Classes. Pairs that prove similar are links, their components the classes that go on. Only nodes at which members of different
   classes stand are left; there, first the nearest two members of each two classes meet, then, once those have merged, all
   members of different classes that pass the bounds.
4. Bounds. What two members have left beyond the node must reach the overlap that their sizes ask for. And the parities of a
   set's items in bins (as many as items, rounded up to a power of 2, ``SKETCH`` at least) differ between two sets in at most as
   many bins as the sets have items that are not shared.
   Both bounds are exact: they never lose a link. Pairs are compared inside cells of a node of about ``CELL`` members on a side
   and come out only if they pass.
5. Verify. Every comparison is exact, on whole sets. Only texts of pairs are shuffled for it, and few others: a filter of ``SLOTS``
   bits, sent to every task, tells most of the rest where they are read.

Copies of one set are one member. ``components`` are exact: no cap on members, nodes or candidates.

Defined results: NULL ids count as one id after all others; NULL and wordless texts have an empty set and link with nothing;
texts of fewer than ``n`` words are one gram; rows that repeat an id each follow their own text. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import components, settled
from .substring import LAST_ID

N = 5
PERCENT = 80
THETA = 0.001
LEAST_FREQUENT = 64
CELL = 1024
AT_ONCE = 65_536
SKETCH = 1024
SLOTS = 1 << 25


class Sets:
    """Distinct n-grams of each document of a block, sorted by document, then value."""

    def __init__(self, block: W.Block, n: int):
        start, value = block.grams(n)
        short = np.flatnonzero((block.n > 0) & (block.n < n))
        if len(short):
            start = np.concatenate([start, block.first[short]])
            value = np.concatenate([value, block.span(block.first[short], block.first[short + 1])])
        doc = block.doc[start] if len(start) else np.zeros(0, np.int64)
        order = np.lexsort((value, doc))
        doc, value, start = doc[order], value[order], start[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        self.doc, self.value, self.start = doc[new], value[new], start[new]
        self.size = np.bincount(self.doc, minlength=len(block.n)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])


def _counts(values: list[np.ndarray]) -> pa.RecordBatch:
    """Documents per item of one batch. What a batch holds once only is left out: an item of a share of all documents shows more
    often in most batches, and any list of frequent items gives an order, and so the same links."""
    value, n = np.unique(np.concatenate(values) if values else np.zeros(0, np.uint64), return_counts=True)
    value, n = value[n > 1], n[n > 1]
    return pa.RecordBatch.from_arrays([pa.array(W.signed(value)), pa.array(n.astype(np.int64))], ["item", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for _, _, block in W.blocks(batch.column("text"), lower=True):
            order = np.lexsort((block.value, block.doc))
            value, doc = block.value[order], block.doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
            found.append(value[new])
        yield _counts(found)


def _all_frequent(block: W.Block, frequent: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Whether the words from ``start`` on, up to ``n`` inside the document, are all frequent."""
    rare = np.concatenate([[0], np.cumsum(~np.isin(block.value, frequent))])
    return rare[np.minimum(start + n, block.first[1:][block.doc[start]])] == rare[start]


def _count_grams(words, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, block in W.blocks(batch.column("text"), lower=True):
                sets = Sets(block, n)
                found.append(sets.value[_all_frequent(block, words.value[0], sets.start, n)])
            yield _counts(found)

    return run


def _frequent(counted: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Items of ``least`` documents or more, sorted, and how far they lie above ``least`` on a scale of whole numbers.
    There are at most (items of all documents) / least of them, see the module's text."""
    rows = counted.groupBy("item").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toArrow()
    item = np.asarray(rows["item"]).astype(np.int64).view(np.uint64)
    order = np.argsort(item)
    return item[order], np.round(16 * np.log2(np.asarray(rows["n"])[order] / least)).astype(np.int64)


def _describe(words, grams, n: int, percent: int):
    """Per document: size, 128 bits of the set, ordered prefix (empty for a repeated set of one block), parities of its bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            for a, b, block in W.blocks(batch.column("text"), lower=True):
                sets = Sets(block, n)
                low, high = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                np.add.at(low, sets.doc, W.mix(sets.value))
                np.add.at(high, sets.doc, W.mix(sets.value ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
                seen = np.lexsort((ids[a:b], high, low))
                once = np.ones(b - a, bool)
                once[seen[1:]] = (low[seen[1:]] != low[seen[:-1]]) | (high[seen[1:]] != high[seen[:-1]])
                late = np.isin(sets.value, grams.value[0])
                item, level = words.value
                at = np.minimum(np.searchsorted(item, block.value), max(len(item) - 1, 0))
                often = np.concatenate([[0], np.cumsum(np.where(item[at] == block.value, level[at], 0) if len(item) else np.zeros(len(block.value), np.int64))])
                often = often[np.minimum(sets.start + n, block.first[1:][sets.doc])] - often[sets.start]
                order = np.lexsort((sets.value, often, late, sets.doc))
                length = np.where(sets.size > 0, sets.size - (sets.size * percent + 99) // 100 + 1, 0) * once
                take = np.arange(len(order)) - sets.first[sets.doc] < length[sets.doc]
                prefix = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(W.signed(sets.value[order][take])))
                bits = np.maximum(SKETCH, 1 << np.ceil(np.log2(np.maximum(sets.size, 1))).astype(np.int64))
                ends = np.concatenate([[0], np.cumsum(bits)])
                bins = ends[sets.doc] + (W.mix(sets.value) % bits[sets.doc].astype(np.uint64)).astype(np.int64)
                odd = np.packbits((np.bincount(bins, minlength=ends[-1]) & 1).astype(np.uint8))
                sketch = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((ends // 8).astype(np.int32)), pa.py_buffer(odd)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b]), pa.array(sets.size), pa.array(W.signed(low)), pa.array(W.signed(high)), prefix, sketch],
                    ["id", "size", "low", "high", "prefix", "sketch"])

    return run


def _nodes(percent: int):
    """Traverses tree nodes from rows sorted by item, size and member. Rows of nodes with several members come out, each with the
    first member of its step of sizes and the member before it; rows at the ends of a batch come out in any case."""
    width = math.log(100 / percent) if percent < 100 else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # item, member and step of the last row, and its head
        for batch in batches:
            if not batch.num_rows:
                continue
            item, rep, size, pos = (np.asarray(batch.column(c)) for c in ("item", "rep", "size", "pos"))
            step = np.floor(np.log(size) / width).astype(np.int64)
            new, other = np.ones(len(item), bool), np.ones(len(item), bool)
            new[1:] = item[1:] != item[:-1]
            other[1:] = new[1:] | (step[1:] != step[:-1])
            previous = np.concatenate([rep[:1], rep[:-1]])
            head = rep[np.maximum.accumulate(np.where(other, np.arange(len(item)), 0))]
            if before is not None and before[0] == item[0]:
                new[0], previous[0] = False, before[1]
                if before[2] == step[0]:
                    to = int(np.flatnonzero(other[1:])[0]) + 1 if other[1:].any() else len(item)
                    head[:to] = before[3]
            before = (item[-1], rep[-1], step[-1], head[-1])
            keep = ~new
            keep[:-1] |= ~new[1:]
            keep[[0, -1]] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (item, rep, size, pos, head)] + [pa.array(previous[keep], mask=new[keep])],
                ["item", "rep", "size", "pos", "head", "previous"])

    return run


class Sketches:
    """Sketches of some sets, as rows of 64-bit words by length; one that is twice as long is also kept folded in half."""

    def __init__(self, found: list[bytes]):
        self.words = np.array([len(x) // 8 for x in found], np.int64)
        self.row, self.table = {}, {}
        for words in np.unique(self.words):
            same, twice = (np.flatnonzero(self.words == w) for w in (words, 2 * words))
            flat = [np.frombuffer(b"".join(found[i] for i in at), np.uint64).reshape(len(at), w) for at, w in ((same, words), (twice, 2 * words))]
            self.row[words] = np.full(len(found), -1)
            self.row[words][np.concatenate([same, twice])] = np.arange(len(same) + len(twice))
            self.table[words] = np.concatenate([flat[0], flat[1][:, :words] ^ flat[1][:, words:]])

    def take(self, words: int, at: np.ndarray) -> np.ndarray:
        return self.table[words][self.row[words][at]]


def _near(size_x, size_y, one: Sketches, x: np.ndarray, two: Sketches, y: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows ``x``, ``y`` may be similar enough by their sizes and parities, and in how many bins those differ."""
    good = np.flatnonzero(100 * np.minimum(size_x, size_y) >= percent * np.maximum(size_x, size_y))
    words = np.minimum(one.words[x[good]], two.words[y[good]])
    apart = np.zeros(len(good), np.int64)
    for w in np.unique(words):
        same = np.flatnonzero(words == w)
        for at in np.array_split(same, len(same) * int(w) // (1 << 22) + 1):
            apart[at] = np.bitwise_count(one.take(w, x[good[at]]) ^ two.take(w, y[good[at]])).sum(1, dtype=np.int64)
    fits = apart * (100 + percent) <= (size_x + size_y)[good] * (100 - percent)
    return good[fits], apart[fits]


def _filter(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [np.asarray(batch.column(c)) for c in ("size_a", "size_b")]
            # One table for both sides, so that each length has its folded rows.
            both, at = Sketches(batch.column("sketch_a").to_pylist() + batch.column("sketch_b").to_pylist()), np.arange(batch.num_rows)
            good, _ = _near(*size, both, at, both, at + batch.num_rows, percent)
            yield batch.select(["a", "b"]).take(pa.array(good))

    return run


def _cells(percent: int, nearest: bool):
    """Compares members of different classes inside each cell ``(item, u, v)``, from rows sorted by cell. ``nearest`` gives one
    pair for each two classes of a cell, else all pairs that pass the bounds come out. About ``AT_ONCE`` rows, or one cell, are held."""

    def pairs(c: dict[str, np.ndarray], new: np.ndarray) -> pa.RecordBatch:
        sketches = Sketches(c["sketch"].tolist())
        size = np.diff(np.append(new, len(c["item"])))
        stop, at, step, found = np.repeat(new + size, size), np.arange(len(c["item"])), 1, []
        while len(at := at[at + step < stop[at]]):
            x, y = at, at + step
            step += 1
            sum_, left = c["size"][x] + c["size"][y], np.minimum(c["size"][x] - c["pos"][x], c["size"][y] - c["pos"][y])
            # Two buckets of a node meet in one cell, members of one bucket in the cell of that bucket alone.
            ok = (c["root"][x] != c["root"][y]) & (left * (100 + percent) >= sum_ * percent) & ((c["bucket"][x] != c["bucket"][y]) | (c["u"][x] == c["v"][x]))
            x, y = x[ok], y[ok]
            good, apart = _near(c["size"][x], c["size"][y], sketches, x, sketches, y, percent)
            found.append(np.stack([x[good], y[good], apart]))
        x, y, apart = np.concatenate([*found, np.zeros((3, 0), np.int64)], axis=1)
        if nearest:
            low, high = np.minimum(c["root"][x], c["root"][y]), np.maximum(c["root"][x], c["root"][y])
            cell = np.searchsorted(new, x, "right")
            order = np.lexsort((apart, high, low, cell))
            cell, low, high = cell[order], low[order], high[order]
            first = np.ones(len(order), bool)
            first[1:] = (cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            x, y = x[order[first]], y[order[first]]
        a, b = c["rep"][x], c["rep"][y]
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows:
                waiting.append({n: np.array(batch.column(n).to_pylist() + [None], object)[:-1] if n == "sketch" else np.asarray(batch.column(n)) for n in batch.schema.names})
                rows += batch.num_rows
            if not waiting or (batch is not None and rows < AT_ONCE):
                continue
            c = {n: np.concatenate([w[n] for w in waiting]) for n in waiting[0]}
            change = np.ones(rows, bool)
            change[1:] = (c["item"][1:] != c["item"][:-1]) | (c["u"][1:] != c["u"][:-1]) | (c["v"][1:] != c["v"][:-1])
            new = np.flatnonzero(change)
            cut = rows if batch is None else int(new[-1])  # the last cell may go on in the next batch
            if cut:
                yield pairs({n: v[:cut] for n, v in c.items()}, new[new < cut])
            waiting, rows = [{n: v[cut:] for n, v in c.items()}] if cut < rows else [], rows - cut

    return run


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = np.asarray(batch.column("a")), np.asarray(batch.column("b"))
            right = batch.column("text_b")
            for at, to, block in W.blocks(batch.column("text_a"), lower=True):
                one, two = Sets(block, n), [(i, Sets(x, n)) for i, _, x in W.blocks(right.slice(at, to - at), lower=True)]
                size = np.concatenate([s.size for _, s in two])
                doc = np.concatenate([s.doc + i for i, s in two])
                value = np.concatenate([s.value for _, s in two])
                key = [W.mix(v + W.mix((d + 1).astype(np.uint64))) for v, d in ((one.value, one.doc), (value, doc))]
                common = np.bincount(doc[np.isin(key[1], key[0])], minlength=to - at)
                union = one.size + size - common
                good = (union > 0) & (100 * common >= percent * union)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[at:to][good]), pa.array(b[at:to][good]), pa.array(common[good].astype(np.int64)), pa.array(union[good].astype(np.int64))],
                    ["a", "b", "common", "union"])

    return run


def among(rows: DataFrame, ids: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``rows`` whose ``id`` is one of ``ids(id)``, and about ``ids / slots`` of the others, without a shuffle of ``rows``.

    The filter has ``slots`` bits in rows of 64, whatever the input, so it may be sent to every task. The more ids, the more others stay.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(slots))
    word, bit = F.shiftright(slot, 6).alias("_word"), slot.bitwiseAND(63).cast("int")
    marks = ids.select(word, bit.alias("_bit")).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    return rows.withColumn("_word", word).join(F.broadcast(marks), "_word").where(F.getbit("_bits", bit) == 1).select(*rows.columns)


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar enough, with intersection and union."""
    right = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    both = right.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(n, percent), "a long, b long, common long, union long")


def describe(docs: DataFrame, *, key: str, text: str, n: int, percent: int, theta: float) -> tuple[DataFrame, DataFrame]:
    """Texts ``(id, text)`` and, written, ``(id, size, low, high, prefix, sketch)``."""
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(text).alias("text"))
    context = docs.sparkSession.sparkContext
    least = max(LEAST_FREQUENT, int(np.ceil(theta * texts.count())))
    words = context.broadcast(_frequent(texts.select("text").mapInArrow(_count_words, "item long, n long"), least))
    grams = context.broadcast(_frequent(texts.select("text").mapInArrow(_count_grams(words, n), "item long, n long"), least))
    return texts, settled(texts.mapInArrow(_describe(words, grams, n, percent), "id long, size long, low long, high long, prefix array<bigint>, sketch binary"))


def _open_nodes(nodes: DataFrame, own: DataFrame) -> DataFrame:
    """``(item, rep, size, pos)`` of the nodes that may hold a pair which has not met, one node for all with the same members.

    Two members that stood in one partition have met. Of nodes with the same members the first in the global order has the
    least position of each member, so no pair passes at another one only. An id with several texts stands for sets of different
    order, so its nodes all stay.
    """
    again = own.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select("rep", F.lit(True).alias("again"))
    counted = nodes.join(again, "rep", "left").groupBy("item").agg(
        F.bit_xor(F.xxhash64("rep")).alias("low"), F.bit_xor(F.xxhash64(F.lit("high"), "rep")).alias("high"), F.count("*").alias("members"),
        F.count("previous").alias("met"), F.sum("pos").alias("at"), F.max("again").alias("again"))
    least = counted.where("members > 2 or members = 2 and met = 0").groupBy("low", "high", "members", F.when(F.col("again"), F.col("item")).alias("alone")).agg(
        F.min_by("item", F.struct("at", "item")).alias("item"))
    return nodes.select("item", "rep", "size", "pos").join(least.select("item"), "item", "left_semi")


def link(docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT, theta: float = THETA) -> DataFrame:
    """Per row: key, ``n_shingles``, ``component_id`` (least id reachable by links), ``n_verified`` (links compared on the way)."""
    texts, sets = describe(docs, key=key, text=text, n=n, percent=percent, theta=theta)
    full = sets.where("size > 0")
    classes = settled(full.select("id", "size", "low", "high").join(
        full.groupBy("low", "high", "size").agg(F.min("id").alias("rep")), ["low", "high", "size"]).select("id", "size", "rep"))
    # One member for each class of equal sets. Prefixes are read once, so they are not written again.
    members = full.join(classes.where("id = rep").select("id"), "id", "left_semi").withColumnRenamed("id", "rep")
    own = settled(members.select("rep", "size", "sketch"))

    entries = members.select(F.posexplode("prefix").alias("pos", "item"), "rep", "size").select("item", "rep", "size", F.col("pos").cast("long").alias("pos"))
    ordered = entries.repartitionByRange("item", "size", "rep").sortWithinPartitions("item", "size", "rep")
    nodes = settled(ordered.mapInArrow(_nodes(percent), "item long, rep long, size long, pos long, head long, previous long"))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = settled(pairs)
        some = among(texts, pairs.select(F.explode(F.array("a", "b")).alias("id")))
        return settled(verify(pairs, some, n, percent).select("a", "b"))

    side = lambda x: own.select(F.col("rep").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    met = nodes.select("rep", F.explode(F.array_distinct(F.array("head", "previous"))).alias("with")).where("rep <> with")
    met = settled(met.select(F.least("rep", "with").alias("a"), F.greatest("rep", "with").alias("b")).distinct())
    links = verified(met.join(side("a"), "a").join(side("b"), "b").mapInArrow(_filter(percent), "a long, b long"))

    open_ = settled(_open_nodes(nodes, own))
    for nearest in (True, False):
        found = components(links).select(F.col("node").alias("rep"), "root")
        placed = open_.join(found, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        split = placed.groupBy("item").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("members")).where("x < y")
        ends = placed.join(split.select("item", F.ceil(F.col("members") / CELL).alias("sides")), "item").join(own.select("rep", "sketch"), "rep")
        dealt = ends.withColumn("bucket", F.pmod(F.xxhash64("rep"), "sides")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
        dealt = dealt.select("item", F.least("bucket", "other").alias("u"), F.greatest("bucket", "other").alias("v"), "bucket", "rep", "root", "size", "pos", "sketch")
        cells = dealt.repartition("item", "u", "v").sortWithinPartitions("item", "u", "v", "rep")
        links = settled(links.unionAll(verified(cells.mapInArrow(_cells(percent, nearest), "a long, b long").distinct())).distinct())

    final = components(links).withColumnRenamed("node", "rep")
    degree = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("n_verified"))
    joined = classes.join(final, "rep", "left").join(degree, "rep", "left").select(
        "id", "size", F.coalesce("root", "rep").alias("component_id"), F.coalesce("n_verified", F.lit(0)).alias("n_verified"))
    alone = sets.where("size = 0").select("id", "size", F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_verified"))
    return joined.unionAll(alone).select(F.col("id").alias(key), F.col("size").alias("n_shingles"), "component_id", "n_verified")
