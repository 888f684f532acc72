"""Nearest neighbours by cosine with collision-counting hashing.

Vectors are scaled to unit length and projected onto ``PROJECTIONS`` directions (random orthonormal bases, stacked). The index of
a shard is one sorted array per projection. A query opens a window around its own value in every array; all windows widen together
with a radius, which is all that virtual rehashing needs, and every vector counts in how many windows it lies. A vector within the
radius lies in a known number of them but for a chance of ``MISS``; whoever reaches that number is verified by its exact
cosine. The radius grows by ``GROWTH``, never beyond the distance of the k-th neighbour found so far; once it gets there, any
nearer vector has been verified but for that chance. Beyond radius 2, where all unit vectors lie, the rest is verified.

The threshold is the ``MISS`` quantile of the counts of ``SAMPLE`` random directions at the radius, drawn once from a fixed seed:
it depends on no data. Every row is indexed, each query meets every shard, no list of candidates is capped.

Results for special cases: rows without id, and vectors that are null, empty, zero or hold null or non-finite components, take no
part. Vectors of different lengths are no neighbours. A query's own row is every row of its id. Repeated rows are neighbours one by
one; a query row that repeats exactly is asked once, rows of one id with different vectors are asked each. Ties go to the
smaller id. Fewer candidates than ``k`` all come out. Only the columns named are read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .vectors import finite, matrices, met

PROJECTIONS = 64
HALF_WIDTH = 1.4
MISS = 0.001
START, GROWTH = 0.2, 1.4
SAMPLE = 20_000
SEED = 20_011
FOUND = "query long, asked long, vec_id long, score double"


@lru_cache(maxsize=8)
def directions(dim: int) -> np.ndarray:
    """``PROJECTIONS`` rows of length ``sqrt(dim)``, orthogonal within each run of ``dim``."""
    rng = np.random.default_rng([SEED, dim])
    bases = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-PROJECTIONS // dim))]
    return np.concatenate(bases)[:PROJECTIONS] * np.sqrt(dim)


@lru_cache(maxsize=8)
def threshold(dim: int) -> int:
    """Windows that a vector at the radius lies in, but for a chance of ``MISS``."""
    away = np.random.default_rng([SEED, dim, 1]).standard_normal((SAMPLE, dim))
    away /= np.linalg.norm(away, axis=1)[:, None]
    counts = np.concatenate([(np.abs(part @ directions(dim).T) <= HALF_WIDTH).sum(axis=1) for part in np.array_split(away, 20)])
    return int(np.quantile(counts, MISS, method="lower"))


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Each row divided by a power of two near its largest component: same cosines, no overflow."""
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1))[1][:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component on, so that equal vectors have equal scores."""
    dot, left, right = (np.zeros(len(a)) for _ in range(3))
    for x, y in zip(a.T, b.T):
        dot += x * y
        left += x * x
        right += y * y
    return np.clip(dot / np.sqrt(left * right), -1.0, 1.0)


class Shard:
    """One sorted array per projection over the vectors of a shard."""

    def __init__(self, matrix: np.ndarray):
        self.size, dim = matrix.shape
        self.unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
        values = (self.unit @ directions(dim).T).T
        self.order = np.argsort(values, axis=1).ravel()
        # array j is shifted by j steps, so that one search finds the borders of every window
        self.starts = np.arange(len(values)) * self.size
        self.shift = np.arange(len(values)) * 4.0 * np.sqrt(dim)
        self.flat = (np.sort(values, axis=1) + self.shift[:, None]).ravel()
        self.needed = threshold(dim)

    def nearest(self, query: np.ndarray, barred: np.ndarray, k: int) -> np.ndarray:
        """Rows whose cosine reaches the k-th best, within rounding; ``barred`` rows are the query's own."""
        at = self.shift + directions(len(query)) @ query
        low = high = np.clip(np.searchsorted(self.flat, at), self.starts, self.starts + self.size)
        counts, open_rows = np.zeros(self.size, dtype=np.int64), ~barred
        rows, scores, radius = np.zeros(0, dtype=np.int64), np.zeros(0), START
        while True:
            wider = (np.searchsorted(self.flat, at - HALF_WIDTH * radius), np.searchsorted(self.flat, at + HALF_WIDTH * radius, "right"))
            wider = [np.clip(w, self.starts, self.starts + self.size) for w in wider]
            first, length = np.concatenate([wider[0], high]), np.concatenate([low - wider[0], wider[1] - high])
            low, high = wider
            ends = np.cumsum(length)
            inside = np.arange(ends[-1]) + np.repeat(first - ends + length, length)
            counts += np.bincount(self.order[inside], minlength=self.size)
            reached = open_rows if radius >= 2 else open_rows & (counts >= self.needed)
            new = np.flatnonzero(reached)
            open_rows[new] = False
            rows, scores = np.concatenate([rows, new]), np.concatenate([scores, self.unit[new] @ query])
            if len(rows) >= k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= least - 1e-12
                rows, scores = rows[keep], scores[keep]
                limit = np.sqrt(max(0.0, 2 - 2 * least))
            else:
                limit = np.inf
            if limit <= radius or radius >= 2:
                return rows
            radius = min(radius * GROWTH, max(limit, START))


def _kernel(k: int):
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        theirs, ids = rows["vec_id"].to_numpy(), queries["query"].to_numpy()
        asked = queries["asked"].to_numpy()
        asking = {matrix.shape[1]: (which, matrix) for which, matrix in matrices(queries, "vector")}
        for held, matrix in matrices(rows, "vector"):
            if matrix.shape[1] not in asking:
                continue
            which, wanted = asking[matrix.shape[1]]
            matrix, wanted, names = scaled(matrix), scaled(wanted), theirs[held]
            shard = Shard(matrix)
            for q, vector in zip(which, wanted):
                near = shard.nearest(vector / np.linalg.norm(vector), names == ids[q], k)
                exact = cosines(np.broadcast_to(vector, (len(near), len(vector))), matrix[near])
                best = np.lexsort((names[near], -exact))[:k]
                found.append((np.full(len(best), ids[q]), np.full(len(best), asked[q]), names[near][best], exact[best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 3 + [np.zeros(0)]
        return pa.table(dict(zip(("query", "asked", "vec_id", "score"), columns)))

    return search


def search(vectors: DataFrame, is_query: Column, *, id: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for the rows where ``is_query`` holds, their ``k`` nearest rows, nearest first."""
    data = F.col(vector).cast("array<double>")
    usable = F.col(id).isNotNull() & finite(data)
    rows = vectors.where(usable).select(F.col(id).cast("long").alias("vec_id"), data.alias("vector"), is_query.alias("asks"), F.monotonically_increasing_id().alias("_at"))
    rows = rows.where(F.exists("vector", lambda x: x != 0))
    queries = rows.where("asks").select(F.col("vec_id").alias("query"), F.xxhash64("vec_id", "vector").alias("asked"), "vector")
    queries = queries.dropDuplicates(["query", "asked"])
    size = rows.agg(F.count("*").alias("rows"), F.count_if("asks").alias("queries")).first()
    near = met(queries, rows.drop("asks"), _kernel(k), FOUND, n_rows=size["rows"], n_queries=size["queries"], spread="_at", by="asked")
    order = Window.partitionBy("query", "asked").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
