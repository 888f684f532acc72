"""Removal of word spans that an earlier document, or an earlier place of the same one, already holds.

The words of a document walk through a De Bruijn graph whose edges are token k-mers. Of the k-mers inside each window of
``length`` words the one with the least value is the window's anchor; neighbouring windows with one anchor form a piece, the
nonbranching stretch of the walk around that edge. Equal windows have equal anchors, so only pieces of one anchor can share
windows.

1. Pieces compact: equal ones, of whatever number of copies, become one row with its source, the least document id.
2. An anchor with one piece only lies on a nonbranching path: the piece is new in its source and repeated elsewhere.
3. An anchor with several pieces is a branch. Only there, and only in the source of each piece, are single windows compared.
4. Each document looks its pieces and windows up among those it is the source of: what it holds but is not the source of
   is repeated. Word coordinates turn windows into maximal spans, and repeats inside one document are found by position.

A piece is known by 128 bits (anchor and content), a window by 128 bits (anchor and words); both from whole texts.
About 2 / (length - k + 2) of all words become rows. No group is gathered: every step is a combining aggregate or a join
with one unique side, so that hot anchors split over tasks.

Defined results: NULL text has no words; NULL ids count as one id after all others; rows that repeat an id are judged against
smaller ids and themselves, not against each other. Texts shorter than ``length`` words stay whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

LENGTH = 20
K = 8
LAST_ID = (1 << 63) - 1


class Pieces:
    """Windows and pieces of one block: ``start[i]`` is a window's first word, ``piece[i]`` its piece."""

    def __init__(self, block: W.Block, length: int, k: int):
        self.start, self.window = block.grams(length)
        at, value = block.grams(k)
        low = np.full(len(block.value), np.iinfo(np.uint64).max, np.uint64)
        low[at] = value
        wide, reach = length - k + 1, 1
        while reach * 2 <= wide:
            low[: len(low) - reach] = np.minimum(low[: len(low) - reach], low[reach:])
            reach *= 2
        rest = wide - reach
        if rest:
            low[: len(low) - rest] = np.minimum(low[: len(low) - rest], low[rest:].copy())
        anchor, self.doc = low[self.start], block.doc[self.start]
        new = np.ones(len(self.start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (self.doc[1:] != self.doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new))[: len(first)] - 1
        self.piece = np.cumsum(new) - 1
        self.anchor, self.piece_doc = anchor[first], self.doc[first]
        self.content = block.span(self.start[first], self.start[last] + length) if len(first) else np.zeros(0, np.uint64)


def _own(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One value for a pair of value and document."""
    return W.mix(values + W.mix(doc.astype(np.uint64) + np.uint64(1)))


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of all list entries."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    counts = np.asarray(column.value_lengths().fill_null(0))
    return np.repeat(np.arange(len(column)), counts), np.asarray(column.flatten()).astype(np.int64).view(np.uint64)


def _least(keys: list[np.ndarray], ids: np.ndarray) -> list[np.ndarray]:
    """Each key once, with its least id."""
    order = np.lexsort((ids, *keys))
    keys, ids = [x[order] for x in keys], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in keys], axis=0)
    return [*[x[new] for x in keys], ids[new]]


def _emit_pieces(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            for a, _, block in W.blocks(batch.column("text")):
                p = Pieces(block, length, k)
                anchor, content, source = _least([p.anchor, p.content], ids[a + p.piece_doc])
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(anchor)), pa.array(W.signed(content)), pa.array(source)], ["anchor", "content", "source"])

    return run


def _emit_windows(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            row, content = _lists(batch.column("branches"))
            asked = _own(content, row)
            for a, _, block in W.blocks(batch.column("text")):
                p = Pieces(block, length, k)
                pick = np.isin(_own(p.content, p.piece_doc + a), asked)[p.piece]
                anchor, window, source = _least([p.anchor[p.piece][pick], p.window[pick]], ids[a + p.doc[pick]])
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(anchor)), pa.array(W.signed(window)), pa.array(source)], ["anchor", "window", "source"])

    return run


def _cut(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            own = {}
            for name in ("pieces", "branches", "windows"):
                row, value = _lists(batch.column(name))
                own[name] = _own(value, row)
            for a, b, block in W.blocks(batch.column("text")):
                p = Pieces(block, length, k)
                key = _own(p.content, p.piece_doc + a)
                new_piece, branch = np.isin(key, own["pieces"]), np.isin(key, own["branches"])
                repeated = ~new_piece[p.piece]
                check = (new_piece & branch)[p.piece]
                window = _own(p.window, p.doc + a)
                repeated[check] |= ~np.isin(window[check], own["windows"])
                _, first = np.unique(window, return_index=True)
                again = np.ones(len(window), bool)
                again[first] = False
                hit = p.start[repeated | again]
                edge = np.zeros(len(block.value) + 1, np.int64)
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                yield _rows(ids[a:b], block, gone)

    return run


def _rows(ids: np.ndarray, block: W.Block, gone: np.ndarray) -> pa.RecordBatch:
    data, n = block.data.copy(), len(ids)
    kept = np.flatnonzero(~gone)
    size = np.zeros(len(data) + 1, np.int64)
    size[block.starts[kept]] += 1
    size[block.ends[kept]] -= 1
    joined = kept[:-1][block.doc[kept[1:]] == block.doc[kept[:-1]]] if len(kept) else kept
    size = np.cumsum(size)[:-1] > 0
    size[block.ends[joined]] = True
    data[block.ends[joined]] = 0x20
    before = np.concatenate([[0], np.cumsum(size)])
    first_byte = np.append(block.starts, len(data))[block.first]
    text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(before[first_byte].astype(np.int64)), pa.py_buffer(data[size]))
    # spans of removed words, in word numbers of their document
    edge = np.zeros(len(gone), bool)
    edge[1:] = (gone[1:] != gone[:-1]) | (block.doc[1:] != block.doc[:-1])
    edge[:1] = True
    at = np.flatnonzero(edge)
    to = np.append(at[1:], len(gone))[: len(at)]
    cut = gone[at]
    at, to = at[cut], to[cut]
    doc = block.doc[at]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(at - block.first[doc]), pa.array(to - block.first[doc])], ["start", "end"]))
    removed = np.bincount(block.doc[gone], minlength=n).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(block.n.astype(np.int64)), pa.array(removed), text.cast(pa.string()), spans],
        ["id", "n_words", "n_removed", "kept_text", "spans"])


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = K) -> DataFrame:
    """Per document: key, ``n_words``, ``n_removed``, ``kept_text``, ``spans`` (removed words, start and end)."""
    if not 0 < k <= length:
        raise ValueError("k must lie between 1 and length")
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(text).alias("text"))
    # The same columns everywhere, and an inner join, which Spark leaves above the aggregate: pieces and texts are shuffled once
    # each and read again. Merge joins at every size keep texts out of a plan that changes with the data.
    pieces = (
        texts.select("id", "text").mapInArrow(_emit_pieces(length, k), "anchor long, content long, source long")
        .where("anchor is not null").groupBy("anchor", "content").agg(F.min("source").alias("source")).where("source is not null")
    )
    branching = pieces.groupBy("anchor").agg(F.count("*").alias("n"), F.min("source").alias("s")).where("n > 1 and s is not null").select("anchor")
    branches = pieces.join(branching, "anchor").groupBy("source").agg(F.collect_list("content").alias("branches"))
    sources = pieces.groupBy("source").agg(F.collect_list("content").alias("pieces"))
    at_branches = texts.join(branches.hint("merge"), texts["id"] == branches["source"]).select("id", "text", "branches")
    windows = (
        at_branches.mapInArrow(_emit_windows(length, k), "anchor long, window long, source long")
        .groupBy("anchor", "window").agg(F.min("source").alias("source"))
        .groupBy("source").agg(F.collect_list("window").alias("windows"))
    )
    known = texts.join(sources.hint("merge"), texts["id"] == sources["source"], "left").drop("source")
    known = known.join(branches.hint("merge"), known["id"] == branches["source"], "left").drop("source")
    known = known.join(windows.hint("merge"), known["id"] == windows["source"], "left").drop("source")
    out = known.select("id", "text", "pieces", "branches", "windows").mapInArrow(
        _cut(length, k), "id long, n_words long, n_removed long, kept_text string, spans array<struct<start:bigint,end:bigint>>")
    return out.withColumnRenamed("id", key)
