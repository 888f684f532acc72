import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from msalake.llm import collision

SCHEMA = "vec_id long, embedding array<double>, score string, rank int"


def table(spark, vectors, partitions=3):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", i if i is None else i % 3) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(vectors, step, k):
    held = [(i, np.array(v, dtype=float)) for i, v in vectors if i is not None and usable(v)]
    out, asked = [], set()
    for q, x in held:
        if q % step or (q, tuple(x)) in asked:
            continue
        asked.add((q, tuple(x)))
        scores = []
        for i, y in held:
            if i != q and len(x) == len(y):
                dot = left = right = 0.0
                for a, b in zip(x, y):
                    dot, left, right = dot + a * b, left + a * a, right + b * b
                scores.append((-max(-1.0, min(1.0, dot / math.sqrt(left * right))), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, vectors, step=50, k=5):
    got = collision.search(table(spark, vectors), F.col("vec_id") % step == 0, k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("dim", [3, 64, 200])
def test_recall_and_scores_against_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    vectors = [(i, rng.standard_normal(dim).astype(np.float32)) for i in range(3000)]
    want, got = brute(vectors, 50, 5), run(spark, vectors)
    pairs = {(q, i): s for q, _, i, s in want}
    hit = [(q, i, s) for q, _, i, s in got if (q, i) in pairs]
    assert len(got) == len(want) and len(hit) >= 0.99 * len(want)
    assert all(s == pairs[q, i] for q, i, s in hit)


def test_many_copies_and_near_copies_tie_by_id(spark):
    rng = np.random.default_rng(5)
    one = rng.standard_normal(16)
    vectors = [(i, one if i % 3 else one + 1e-7 * rng.standard_normal(16)) for i in range(1200)]
    vectors += [(2000 + i, rng.standard_normal(16)) for i in range(300)]
    assert run(spark, vectors) == brute(vectors, 50, 5)


def test_rows_that_take_no_part_and_mixed_lengths(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.standard_normal(8 if i % 2 else 5)) for i in range(60)]
    vectors += [(100, None), (150, []), (200, [0.0] * 8), (250, [1, None, 1, 1, 1]), (300, [float("nan")] * 8), (350, [float("inf")] + [1] * 7),
                (None, [1.0] * 8), (400, [1e200] * 5), (450, [1e-200] * 5), (500, [2.0] * 9)]
    got = run(spark, vectors)
    assert {q for q, *_ in got} == {0, 50, 400, 450}
    big = [r for r in got if r[0] == 400]
    assert big[0][:3] == (400, 1, 450) and abs(big[0][3] - 1) < 1e-12
    small = [v for v in vectors if v[0] not in (400, 450)]
    assert [r for r in run(spark, small)] == brute(small, 50, 5)


def test_repeated_ids_and_rows(spark):
    rng = np.random.default_rng(7)
    vectors = [(i, rng.standard_normal(6)) for i in range(40)]
    vectors += [(0, vectors[0][1]), (50, vectors[3][1]), (50, vectors[3][1]), (7, vectors[7][1]), (0, rng.standard_normal(6))]
    assert run(spark, vectors) == brute(vectors, 50, 5)


def test_fewer_candidates_than_asked_and_empty_table(spark):
    assert [r[:3] for r in run(spark, [(0, [1, 0]), (1, [0, 1]), (2, [1, 1])])] == [(0, 1, 2), (0, 2, 1)]
    assert run(spark, [(0, [1, 0])]) == []
    assert run(spark, []) == []
