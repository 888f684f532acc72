"""Toxicity by class-conditional Kneser-Ney language models.

Two word models, of toxic and of ordinary documents, give each word its log-likelihood after the word before it. Counts are
discounted and back off from word pairs to words (by the number of different words they follow), from words to word stems,
and from stems to counts shared by both classes, so that what neither class has seen counts the same in both. The
length-normalised difference of the two log-likelihoods, over the whole text, its most toxic ``SPAN`` words and word, becomes
a score by logistic calibration on labelled documents that the models have not seen.

Fitting takes at most ``SAMPLE`` labelled documents of each class (those of least hash), a third of them for calibration; its
counts are aggregated by Spark, and items seen less than ``LEAST`` times, or pairs less than ``LEAST_PAIRS``, are left to the backoff. Scoring covers every document and whole texts.

Defined results: NULL and wordless texts have no likelihoods, and get the score of a text without evidence; several labels of
one document count as the largest; NULL labels, and those of documents that are not there, are ignored; without labels of both classes
every score is 0. The models of a class of too few labelled documents are calibrated on those they have seen. Rows that repeat
an id are scored each on its own. A score depends on the text only; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import labelled
from . import words as W
from .store import settled

SAMPLE = 6000
SPAN = 8
DISCOUNT = 0.75
THRESHOLD = 0.7
LEAST = 2
SHRINK = 6.0
LEAST_PAIRS = 3
KINDS = WORD, PAIR, STEM, FOLLOWERS = range(4)


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def _items(block: W.Block) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Words at which an item of each kind ends, and its value."""
    at, pair = block.grams(2)
    return {WORD: (np.arange(len(block.value)), block.value), PAIR: (at + 1, pair), STEM: (np.arange(len(block.stem)), block.stem)}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(kind, item, first, word, label, n)``: ``first`` and ``word`` are the words of a pair; ``first`` is the stem of a word."""
    for batch in batches:
        toxic = np.asarray(batch.column("toxic")).astype(bool)
        for a, _, block in W.blocks(batch.column("text"), lower=True, trim=True):
            for kind, (at, value) in _items(block).items():
                mark = toxic[a + block.doc[at]] if len(at) else np.zeros(0, bool)
                for label in (False, True):
                    item, where, n = np.unique(value[mark == label], return_index=True, return_counts=True)
                    last = at[mark == label][where]
                    first = block.value[last - 1] if kind == PAIR else block.stem[last]
                    word = block.value[last] if kind == PAIR else np.zeros(len(last), np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(item), kind, np.int32)), pa.array(W.signed(item)), pa.array(W.signed(first)), pa.array(W.signed(word)),
                         pa.array(np.full(len(item), int(label), np.int32)), pa.array(n.astype(np.int64))],
                        ["kind", "item", "first", "word", "label", "n"])


def _trust(n: np.ndarray) -> np.ndarray:
    """Share of a log-likelihood difference that ``n`` counts support; the rest stays with the shared backoff."""
    return n / (n + SHRINK)


class Models:
    """Log-likelihood differences of words and pairs, and the calibration."""

    def __init__(self, counts: dict):
        # counts of a kind: sorted items and counts per class; for words also stems and preceding types, for pairs their words
        self.stems, n = counts[STEM]
        shared = (n.sum(1) + 1.0) / (n.sum() + len(n) + 1.0)
        self.rare = 1.0 / (n.sum() + len(n) + 1.0)
        lost = np.array([DISCOUNT * (n[:, c] > 0).sum() / max(n[:, c].sum(), 1.0) for c in (0, 1)]).clip(0.05, 1.0)
        mass = np.maximum(n - DISCOUNT, 0) / np.maximum(n.sum(0), 1.0) + lost * shared[:, None]
        self.stem_gain = np.log(mass[:, 1] / mass[:, 0]) * _trust(n.sum(1))
        self.stem_unseen = float(np.log(lost[1] / lost[0]))
        self.words, n, stem, follows = counts[WORD][0], counts[WORD][1], counts[WORD][2], counts[WORD][3]
        base = mass[np.clip(stem, 0, max(len(mass) - 1, 0))] if len(mass) else np.full((len(n), 2), self.rare)
        follows = np.maximum(follows, n > 0)
        lost = np.array([DISCOUNT * (follows[:, c] > 0).sum() / max(follows[:, c].sum(), 1.0) for c in (0, 1)]).clip(0.05, 1.0)
        inside = ((n.sum(1) + 1.0) / (np.bincount(np.clip(stem, 0, None), n.sum(1) + 1.0, minlength=max(len(mass), 1))[np.clip(stem, 0, None)]))[:, None]
        self.word_mass = np.maximum(follows - DISCOUNT, 0) / np.maximum(follows.sum(0), 1.0) + lost * base * inside
        self.word_gain = np.log(self.word_mass[:, 1] / self.word_mass[:, 0]) * _trust(follows.sum(1))
        self.pairs, n, first, second = counts[PAIR]
        start = counts[WORD][1][first].astype(float)
        types = counts[FOLLOWERS][first]
        back = np.minimum(DISCOUNT * types / np.maximum(start, 1), 1.0)
        back[start == 0] = 1.0
        both = np.maximum(n - DISCOUNT, 0) / np.maximum(start, 1) + np.maximum(back, 0.05) * self.word_mass[second]
        self.pair_gain = np.log(both[:, 1] / both[:, 0]) * _trust(n.sum(1))
        self.weights = np.zeros(4)

    @staticmethod
    def _find(table: np.ndarray, value: np.ndarray) -> np.ndarray:
        if not len(table):
            return np.full(len(value), -1)
        at = np.searchsorted(table, value)
        at[at == len(table)] = 0
        at[table[at] != value] = -1
        return at

    def gains(self, block: W.Block) -> np.ndarray:
        """Toxic minus ordinary log-likelihood of each word after the one before it."""
        at = self._find(self.words, block.value)
        out = np.where(at >= 0, self.word_gain[at] if len(self.word_gain) else 0.0, 0.0)
        new = np.flatnonzero(at < 0)
        stem = self._find(self.stems, block.stem[new])
        out[new] = np.where(stem >= 0, self.stem_gain[stem] if len(self.stem_gain) else 0.0, self.stem_unseen)
        pair_at, pair = block.grams(2)
        found = self._find(self.pairs, pair)
        out[pair_at[found >= 0] + 1] = self.pair_gain[found[found >= 0]]
        return out

    def figures(self, block: W.Block) -> np.ndarray:
        """Per document: mean gain, highest mean gain of ``SPAN`` words, highest gain of a word, 1."""
        gain, n = self.gains(block), len(block.n)
        out = np.zeros((n, 4))
        out[:, 3] = 1
        full = np.flatnonzero(block.n)
        if not len(full):
            return out
        first, end = block.first[:-1][full], block.first[1:][full]
        sums = np.concatenate([[0], np.cumsum(gain)])
        out[full, 0] = (sums[end] - sums[first]) / (end - first)
        at = np.arange(len(gain))
        stop = np.minimum(at + SPAN, block.first[1:][block.doc])
        low = np.minimum(at, np.maximum(stop - SPAN, block.first[:-1][block.doc]))
        out[full, 1] = np.maximum.reduceat((sums[stop] - sums[low]) / SPAN, first)
        out[full, 2] = np.maximum.reduceat(gain, first)
        return out

    def calibrate(self, x: np.ndarray, toxic: np.ndarray) -> None:
        """Logistic regression by Newton steps, each class with half of the weight, a small ridge."""
        share = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1)) * len(x)
        w = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (share * (p - toxic)) + 1e-2 * w
            bend = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
            move = np.linalg.solve(bend, slope)
            w -= np.clip(move, -5, 5)
            if np.abs(move).max() < 1e-9:
                break
        self.weights = w

    def score(self, block: W.Block) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.figures(block) @ self.weights, -30, 30)))


def _columns(rows: pa.Table, keys: list[str], *counts: list[str]) -> list[np.ndarray]:
    """Sorted by the first key: the keys as unsigned values, then each list of counts as a matrix."""
    got = [np.asarray(rows[k]).astype(np.int64).view(np.uint64) for k in keys]
    order = np.argsort(got[0])
    return [*[x[order] for x in got], *[np.column_stack([np.asarray(rows[c]) for c in names]).astype(float)[order] for names in counts]]


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Models | None:
    """Models of the labelled documents that are not held out; None without both classes."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").cast("string").alias("name"))
    chosen = labelled.sample(labelled.there(marks, docs, key), ["0", "1"], sample, F.xxhash64(F.lit("sample"), F.col("_key"))).withColumnRenamed("domain", "toxic")
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(key).alias("_doc"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_key"))
    counted = (
        rows.where("learn").select("text", "toxic")
        .mapInArrow(_count, "kind int, item long, first long, word long, label int, n long")
        .groupBy("kind", "item", "label").agg(F.sum("n").alias("n"), F.first("first").alias("first"), F.first("word").alias("word"))
    )
    counted = settled(counted)
    pairs = counted.where(F.col("kind") == PAIR)
    per_class = [F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)]
    types = [F.sum(F.when(F.col("label") == c, 1).otherwise(0)).alias(f"t{c}") for c in (0, 1)]
    of = lambda kind, least: counted.where(F.col("kind") == kind).groupBy("item").agg(
        *per_class, F.first("first").alias("first"), F.first("word").alias("word")).where(F.col("n0") + F.col("n1") >= least)
    follow = pairs.groupBy(F.col("first").alias("item")).agg(*types)
    before = pairs.groupBy(F.col("word").alias("item")).agg(*types).select("item", F.col("t0").alias("b0"), F.col("t1").alias("b1"))
    word_rows = of(WORD, LEAST).join(follow, "item", "left").join(before, "item", "left").fillna(0).toArrow()
    words, stem, n, followers, preceders = _columns(word_rows, ["item", "first"], ["n0", "n1"], ["t0", "t1"], ["b0", "b1"])
    if not len(words) or not (n.sum(0) > 0).all():
        return None
    stems, _, stem_n = _columns(of(STEM, LEAST).toArrow(), ["item", "first"], ["n0", "n1"])
    pair_rows = of(PAIR, LEAST_PAIRS).toArrow()
    pair, first, pair_n = _columns(pair_rows, ["item", "first"], ["n0", "n1"])
    second = Models._find(words, _columns(pair_rows, ["item", "word"])[1])
    first = Models._find(words, first)
    whole = (first >= 0) & (second >= 0)
    models = Models({WORD: (words, n, Models._find(stems, stem), preceders), STEM: (stems, stem_n), FOLLOWERS: followers,
                     PAIR: (pair[whole], pair_n[whole], first[whole], second[whole])})
    shared = context.broadcast(models)
    seen = rows.where("check").select("text", "toxic").mapInArrow(_features(shared), "a double, b double, c double, d double, toxic int").toArrow()
    toxic = np.asarray(seen["toxic"]).astype(bool)
    if not toxic.any() or toxic.all():
        return None
    models.calibrate(np.column_stack([np.asarray(seen[c]) for c in "abcd"]), toxic)
    return models


def _features(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column("toxic"))
            for a, b, block in W.blocks(batch.column("text"), lower=True, trim=True):
                x = models.value.figures(block)
                yield pa.RecordBatch.from_arrays([*[pa.array(x[:, i]) for i in range(4)], pa.array(toxic[a:b].astype(np.int32))], ["a", "b", "c", "d", "toxic"])

    return run


def _score(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [models.value.score(block) for _, _, block in W.blocks(batch.column("_text"), lower=True, trim=True)]
            score = pa.array(np.concatenate(found) if found else np.zeros(0))
            kept = [i for i, name in enumerate(batch.schema.names) if name != "_text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], score], [*[batch.schema.names[i] for i in kept], "score"])

    return run


def score(docs: DataFrame, models: Models | None, *, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of toxicity at even odds; columns named ``_text`` or ``score`` are replaced."""
    rest = [c for c in docs.columns if c not in ("_text", "score")]
    if models is None:
        return docs.select(*rest, F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(models)
    given = docs.select(*rest, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema) + ", score double"
    return given.mapInArrow(_score(shared), schema)
