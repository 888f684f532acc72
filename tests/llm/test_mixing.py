import random
import warnings

import numpy as np
from pyspark.sql import functions as F

from msalake.llm import mixing


def exact(p, n, wanted, pull):
    """The same problem solved on one machine by many plain steps."""
    r = np.ones(len(p))
    for _ in range(20000):
        gap = (n * r) @ p / n.sum() - wanted
        r = np.maximum(0, r - (p @ gap + pull * (r - 1)) / (1 + pull))
    return r


def test_rates_match_targets(spark, documents):
    rng = random.Random(1)
    good, junk = [f"good{i}" for i in range(300)], [f"JUNK{i}" for i in range(50)]
    rows, marks = [], []
    for i in range(900):
        bad = i % 3 == 0
        rows.append((i, " ".join(rng.choice(junk if bad else good) for _ in range(rng.randint(5, 60))), "s"))
        if i % 2:
            marks.append((i, 0 if bad else 1, 0))
    marks += [(None, 1, 0), (3, None, 0)]
    rows += [(5000, None), (5001, " "), (None, "good1 good2"), (7, rows[7][1])]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    docs = documents(*rows).withColumn("rate", F.lit("clash"))
    out = mixing.mix(docs, labels, targets={"1-0": 0.9, "0-0": 0.1}).collect()
    assert len(out) == len(rows) and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in out)
    words = {d: sum(r.n_words * r.rate for r in out if r.domain == d) for d in ("1-0", "0-0")}
    assert abs(words["1-0"] / sum(words.values()) - 0.9) < 0.03
    truth = {i: "0-0" if i % 3 == 0 else "1-0" for i in range(900)}
    assert sum(r.domain == truth[r.doc_id] for r in out if r.doc_id in truth) >= 0.97 * 900


def test_steps_reach_the_optimum():
    rng = np.random.RandomState(3)
    p, n, wanted = rng.dirichlet([0.3, 0.2, 0.5], 500), rng.randint(1, 900, 500).astype(float), np.array([0.7, 0.2, 0.1])
    gaps = np.zeros((0, 3))
    for _ in range(mixing.STEPS):
        point = mixing._rates(p, gaps, 0.02)[1]
        gaps = np.vstack([gaps, (n * point) @ p / n.sum() - wanted])
    got, want = mixing._rates(p, gaps, 0.02)[0], exact(p, n, wanted, 0.02)
    assert np.abs((n * got) @ p / n.sum() - (n * want) @ p / n.sum()).max() < 2e-3 and (got >= 0).all()


def test_small_targets_are_reached(spark, documents):
    """Four domains with shares far from the targets: each total within a fifth of its target, the small ones too."""
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(2000):
        name = rng.choices(["1-0", "0-0", "1-1", "0-1"], [0.70, 0.17, 0.10, 0.03])[0]
        rows.append((i, " ".join(f"{name}w{rng.randrange(60)}" for _ in range(40)), "s"))
        marks.append((i, int(name[0]), int(name[2])))
    out = mixing.mix(documents(*rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    for name, target in mixing.TARGETS.items():
        share = sum(r.n_words * r.rate for r in out if r.domain == name) / sum(r.n_words for r in out)
        assert abs(share / target - 1) < 0.2, (name, share)


def test_prices_reach_the_targets(spark):
    rng = np.random.RandomState(4)
    p, n, wanted = rng.dirichlet([0.7, 0.02, 0.1, 0.17], 3000), rng.randint(1, 900, 3000), np.array([0.9, 0.01, 0.01, 0.08])
    table = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_words long, posterior array<double>")
    price, shares = mixing.reach(table, float(n.sum()), wanted, np.zeros(4))
    reached = (n * np.maximum(0, 1 - p @ price)) @ p / n.sum()
    assert np.abs(reached - shares).max() < 1e-9 and mixing.largest_gap(reached, wanted) <= mixing.TOLERANCE


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = mixing.mix(documents((1, "a b"), (2, None)), none).collect()
    assert sorted((r.doc_id, r.n_words, r.rate, r.copies) for r in out) == [(1, 2, 1.0, 1), (2, 0, 1.0, 1)]
    assert mixing.mix(documents((1, "a")).limit(0), none).count() == 0


def test_labels_of_documents_that_are_gone(spark, documents):
    """They make no domain, have no part in a prior and take no place in a sample."""
    rng = random.Random(5)
    rows, marks = [], []
    for i in range(600):
        bad = i % 4 == 0
        rows.append((i, " ".join(f"{'junk' if bad else 'good'}{rng.randrange(80)}" for _ in range(30)), "s"))
        marks.append((i, int(not bad), 0))
    gone = [(10_000 + i, i % 2, 1) for i in range(500)] + [(20_000 + i, 0, 0) for i in range(5000)]
    frame = lambda m: spark.createDataFrame(m, "doc_id long, quality int, toxic int")
    taken = lambda rows: sorted((r.doc_id, r.domain, r.rate, r.copies) for r in rows)
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        out = mixing.mix(documents(*rows), frame(marks + gone)).collect()
        alone = mixing.mix(documents(*rows), frame(marks)).collect()
    assert taken(out) == taken(alone)
    share = sum(r.n_words * r.rate for r in out if r.domain == "0-0") / sum(r.n_words for r in out)
    assert abs(share - 0.08 / 0.98) < 0.02 and abs(sum(r.n_words * r.rate for r in out) / sum(r.n_words for r in out) - 1) < 0.01
    small = mixing.fit(documents(*rows), frame(marks + gone), sample=60)
    assert small.names == ["0-0", "1-0"]


def test_few_labels(spark, documents):
    """A domain of one labelled document is mixed like the others, whatever the side its hash deals it to."""
    for only in (1, 5, 9):
        rows = [(i, " ".join(f"{'junk' if i == only or i >= 40 else 'good'}{(i + j) % 7}" for j in range(30))) for i in range(50)]
        marks = [(i, int(i != only), 0) for i in range(40)]
        out = mixing.mix(documents(*rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
        assert {r.doc_id for r in out if r.domain == "0-0"} == {only, *range(40, 50)}
        share = sum(r.n_words * r.rate for r in out if r.domain == "0-0") / sum(r.n_words for r in out)
        assert abs(share - 0.08 / 0.98) < 0.02
