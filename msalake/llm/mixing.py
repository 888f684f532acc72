"""Document rates that bring expected domain totals to target weights.

1. Domains are those of the labelled documents that are there: the values of ``by`` (quality and toxicity). A naive Bayes model over
   hashed words and word shapes, calibrated by multinomial logistic regression on labelled documents it has not seen, gives every
   document the posterior of each domain: a document belongs to all domains in part. Labels of other documents count neither as
   domains nor in priors and samples.
2. Rates ``r >= 0``, one for each document, minimise half the squared distance between the expected domain shares
   ``sum(words * posterior * r) / sum(words)`` and the targets, plus ``pull / 2`` times the mean squared distance of ``r`` from 1.
   Accelerated projected gradient steps with a ``pull`` that matters give a start: each needs the expected shares only, a few
   sums over all documents, which Spark aggregates.
3. The pull then goes towards 0, where it only chooses among rates that reach the targets. At the optimum a rate is
   ``max(0, 1 - posterior . price)``, with one price for each domain: damped Newton steps on the prices, each from sums over all
   documents, go on until every share is within ``TOLERANCE`` of its target (relative). Targets that no rates reach are
   approached as closely as rates can, and a warning gives the shares reached.
   No step writes a table, and a lost executor costs one step.

The classifier is fitted on at most ``SAMPLE`` labelled documents of each domain (of least hash); posteriors, sums and rates cover
every document and whole texts.

Defined results: NULL text has no words, the prior as posterior and weighs nothing; rows that repeat an id are documents of
their own; labels with a NULL are ignored, of several for one id the least counts; targets are scaled to the domains that have
labelled documents, a domain without target gets 0; without such documents, or with one domain only, every rate is 1. The model of a
domain of too few labelled documents is calibrated on those it has seen. Other columns pass through.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled
from . import words as W
from .store import settled

SAMPLE = 2500
BUCKETS = 1 << 14
SHAPES = 4
STEPS = 40
PULL = 0.02
LEAST_PULL = 1e-8
TOLERANCE = 0.005
ROUNDS = 30
#: Share of each domain, "quality-toxic", in the mixture.
TARGETS = {"1-0": 0.90, "0-0": 0.08, "1-1": 0.01, "0-1": 0.01}


def _features(block: W.Block) -> list[np.ndarray]:
    """For each word: the bucket of its value, and of its shape."""
    value = block.value
    again = np.zeros(len(value), bool)
    again[1:] = (value[1:] == value[:-1]) & (block.doc[1:] == block.doc[:-1])
    capital = np.concatenate([[0], np.cumsum((block.data >= 65) & (block.data <= 90))])
    loud = (capital[block.ends] - capital[block.starts]) * 2 > block.ends - block.starts
    return [(value >> np.uint64(50)).astype(np.int64), BUCKETS + 2 * again + loud]


def _sums(block: W.Block, per_word: np.ndarray) -> np.ndarray:
    total = np.zeros((len(per_word) + 1, per_word.shape[1]))
    np.cumsum(per_word, axis=0, out=total[1:])
    return total[block.first[1:]] - total[block.first[:-1]]


class Domains:
    """Log-likelihoods of features by domain, and the calibration of their means."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + 0.5
        words, shapes = smooth[:BUCKETS], smooth[BUCKETS:]
        self.gain = np.log(np.concatenate([words / words.sum(0), shapes / shapes.sum(0)])).astype(np.float32)
        self.weights = np.zeros((2 * len(names) + 1, len(names)))

    def inputs(self, block: W.Block) -> np.ndarray:
        n = np.maximum(block.n, 1)[:, None]
        found = [_sums(block, self.gain[at]) / n for at in _features(block)]
        x = np.concatenate([*[f - f.mean(1, keepdims=True) for f in found], np.ones((len(n), 1))], axis=1)
        x[block.n == 0, :-1] = 0
        return x

    def posterior(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def calibrate(self, x: np.ndarray, label: np.ndarray, prior: np.ndarray) -> None:
        """Multinomial logistic regression, each domain weighed by its prior, by gradient steps with momentum on scaled inputs."""
        scale = np.maximum(np.abs(x).mean(0), 1e-9)
        z, truth = x / scale, np.eye(len(self.names))[label]
        share = prior[label] / np.maximum(np.bincount(label, minlength=len(prior)), 1)[label]
        w, speed = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for _ in range(1500):
            p = z @ w
            p = np.exp(p - p.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            speed = 0.9 * speed - 0.5 * (z.T @ (share[:, None] * (p - truth)) + 1e-5 * w)
            w = w + speed
        self.weights = w / scale[:, None]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = np.asarray(batch.column("domain"))
        for a, _, block in W.blocks(batch.column("text")):
            of = label[a + block.doc] if len(block.doc) else np.zeros(0, np.int64)
            for at in _features(block):
                key, n = np.unique(of.astype(np.int64) * (BUCKETS + SHAPES) + at, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])


def _inputs(domains):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("domain")
            for a, b, block in W.blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(list(domains.value.inputs(block)), pa.list_(pa.float64())), label.slice(a, b - a)], ["x", "domain"])

    return run


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", by: tuple[str, ...] = ("quality", "toxic"), sample: int = SAMPLE) -> Domains | None:
    full = labels
    for column in (key, *by):
        full = full.where(F.col(column).isNotNull())
    marks = full.select(F.col(key).alias("_key"), F.concat_ws("-", *[F.col(c).cast("string") for c in by]).alias("name")).groupBy("_key").agg(F.min("name").alias("name"))
    marks = labelled.there(marks, docs, key)
    sizes = {r.name: r.n for r in marks.groupBy("name").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if len(names) < 2:
        return None
    chosen = labelled.sample(marks, names, sample, F.xxhash64(F.lit("mix"), "_key"))
    rows = docs.select(F.col(key).alias("_doc"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_key"))
    found = rows.where("learn").select("text", "domain").mapInArrow(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(names), BUCKETS + SHAPES))
    counts.reshape(-1)[np.asarray(found["key"])] = np.asarray(found["n"])
    domains = Domains(names, counts.T)
    shared = docs.sparkSession.sparkContext.broadcast(domains)
    seen = rows.where("check").select("text", "domain").mapInArrow(_inputs(shared), "x array<double>, domain int").toArrow()
    prior = np.array([sizes[n] for n in names], float)
    domains.calibrate(np.array(seen["x"].to_pylist()), np.asarray(seen["domain"]), prior / prior.sum())
    return domains


def _posteriors(domains):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [i for i, name in enumerate(batch.schema.names) if name != "_text"]
            n, post = [np.zeros(0, np.int64)], []
            for _, _, block in W.blocks(batch.column("_text")):
                n.append(block.n.astype(np.int64))
                post.append(domains.value.posterior(domains.value.inputs(block)))
            flat = np.concatenate(post).reshape(-1) if post else np.zeros(0)
            k = len(domains.value.names)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in rest], pa.array(np.concatenate(n)), lists], [*[batch.schema.names[i] for i in rest], "n_words", "posterior"])

    return run


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, k)


def _rates(posterior: np.ndarray, gaps: np.ndarray, pull: float) -> np.ndarray:
    """Rates after the steps whose gaps (expected shares minus targets) are given, and the point at which the next gap is taken."""
    rate = point = np.ones(len(posterior))
    for step, gap in enumerate(gaps):
        after = np.maximum(0.0, point - (posterior @ gap + pull * (point - 1)) / (1 + pull))
        point, rate = after + step / (step + 3) * (after - rate), after
    return np.stack([rate, point])


def _shares(gaps: np.ndarray, pull: float, k: int, which: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for batch in batches:
            p = _matrix(batch.column("posterior"), k)
            total += (np.asarray(batch.column("n_words")) * _rates(p, gaps, pull)[which]) @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(total)], ["k", "total"])

    return run


def _trials(prices: np.ndarray):
    """For each row of prices: half the sum of words * rate ** 2, the domain totals, and how fast these fall with the prices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, k = prices.shape
        total = np.zeros((t, 1 + k + k * k))
        for batch in batches:
            p, n = _matrix(batch.column("posterior"), k), np.asarray(batch.column("n_words")).astype(float)
            for i, price in enumerate(prices):
                rate = np.maximum(0.0, 1 - p @ price)
                total[i, 0] += n @ rate ** 2 / 2
                total[i, 1:k + 1] += (n * rate) @ p
                total[i, k + 1:] += ((p * (n * (rate > 0))[:, None]).T @ p).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], ["k", "total"])

    return run


def _measured(table: DataFrame, prices: np.ndarray, words: float) -> np.ndarray:
    t, k = prices.shape
    rows = table.select("n_words", "posterior").mapInArrow(_trials(prices), "k long, total double").groupBy("k").agg(F.sum("total").alias("total"))
    out = np.zeros(t * (1 + k + k * k))
    for r in rows.collect():  # a few numbers for each pair of domains
        out[r.k] = r.total
    return out.reshape(t, -1) / words


def largest_gap(shares: np.ndarray, wanted: np.ndarray) -> float:
    """Relative to the target; absolute where the target is 0."""
    return float((np.abs(shares - wanted) / np.where(wanted > 0, wanted, 1.0)).max())


def reach(table: DataFrame, words: float, wanted: np.ndarray, price: np.ndarray, *, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Prices at which the shares of ``table`` (``n_words``, ``posterior``) are the targets, and the shares reached."""
    k, pull = len(wanted), PULL
    lengths = np.array([1, 0.5, 0.25, 0.1, 0.03, 0.01])
    at, now = price, _measured(table, price[None], words)[0]
    best, shares = at, now[1:k + 1]
    for _ in range(ROUNDS):
        if largest_gap(shares, wanted) <= tolerance:
            break
        pull = max(pull / 10, LEAST_PULL)
        slope = now[1:k + 1] - wanted - pull * at
        if pull == LEAST_PULL and np.abs(slope).max() < 1e-9:
            break
        move = np.linalg.solve(now[k + 1:].reshape(k, k) + pull * np.eye(k), slope)
        tried = at + lengths[:, None] * move
        found = _measured(table, tried, words)
        least = int(np.argmin(found[:, 0] + tried @ wanted + pull / 2 * (tried ** 2).sum(1)))
        at, now = tried[least], found[least]
        if np.square(now[1:k + 1] - wanted).sum() < np.square(shares - wanted).sum():
            best, shares = at, now[1:k + 1]
    return best, shares


def _final(price: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = np.round(np.maximum(0.0, 1 - _matrix(batch.column("posterior"), len(price)) @ price), 6)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, "rate"])

    return run


def _expected(table: DataFrame, gaps: np.ndarray, pull: float, k: int, which: int) -> np.ndarray:
    rows = table.select("n_words", "posterior").mapInArrow(_shares(gaps, pull, k, which), "k long, total double").groupBy("k").agg(F.sum("total").alias("total"))
    out = np.zeros(k)
    for r in rows.collect():  # one number for each domain
        out[r.k] = r.total
    return out


def mix(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", targets: dict[str, float] | None = None, by: tuple[str, ...] = ("quality", "toxic"),
        steps: int = STEPS, pull: float = PULL) -> DataFrame:
    """``docs`` with ``n_words``, ``domain`` (likeliest), ``rate`` and ``copies``: the rate rounded up or down by the hash of the key."""
    made = ("n_words", "posterior", "domain", "rate", "copies", "_text")
    rest = [c for c in docs.columns if c not in made]
    domains = fit(docs, labels, key=key, text=text, by=by)
    if domains is None:
        count = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")
        return docs.select(*rest, count.alias("n_words"), F.lit(None).cast("string").alias("domain"), F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"))
    wanted = np.array([max((targets or TARGETS).get(n, 0.0), 0.0) for n in domains.names])
    wanted = wanted / wanted.sum() if wanted.sum() else np.full(len(wanted), 1 / len(wanted))
    k, shared = len(wanted), docs.sparkSession.sparkContext.broadcast(domains)
    kept = docs.select(*rest)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    table = settled(docs.select(*rest, F.col(text).alias("_text")).mapInArrow(_posteriors(shared), f"{schema}, n_words long, posterior array<double>"))
    gaps = np.zeros((0, k))
    words = float(table.agg(F.sum("n_words")).first()[0] or 0)
    for _ in range(steps if words else 0):
        gap = _expected(table, gaps, pull, k, 1) / words - wanted
        gaps = np.vstack([gaps, gap])
        if len(gaps) > 2 and np.abs(gaps[-1] - gaps[-2]).max() < 1e-4:
            break
    price = gaps[-1] / pull if len(gaps) and pull else np.zeros(k)
    if words:
        price, shares = reach(table, words, wanted, price)
        if largest_gap(shares, wanted) > TOLERANCE:
            warnings.warn(f"no rates found that reach the targets of {domains.names}: {wanted.tolist()}; shares reached: {shares.tolist()}", stacklevel=2)
    names = F.array(*map(F.lit, domains.names))
    out = table.mapInArrow(_final(price), f"{schema}, n_words long, posterior array<double>, rate double")
    likeliest = F.get(names, (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int"))
    part = F.pmod(F.xxhash64(F.lit("copies"), F.col(key)), F.lit(1 << 20)) / F.lit(1 << 20)
    copies = F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("long")
    return out.select(*rest, "n_words", likeliest.alias("domain"), "rate", copies.cast("long").alias("copies"))
