import random
import re

import pytest
from pyspark.sql import functions as F

from msalake.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, n=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def brute(rows, percent=80):
    sets = {i: grams(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed, size):
    rng = random.Random(seed)
    rows, bases = [], []
    say = lambda n: [rng.choice("abcdefghij") + str(rng.randrange(size)) for _ in range(n)]
    passage = say(40)
    for i in range(60):
        bases.append(say(rng.randint(1, 120)) + (passage if rng.random() < 0.4 else []))
    for i in range(420):
        words = list(rng.choice(bases[:3] if rng.random() < 0.5 else bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.randint(0, 2)] = say(rng.randint(0, 2))
        rows.append((i * 7 % 1000, (rng.choice([" ", "\n", "\t "])).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(2000, None), (2001, ""), (2002, "A b"), (2003, "a B"), (2004, "é " * 500), (2005, "é " * 480)]


@pytest.mark.parametrize("seed,size,cell,least", [(1, 1000, 64, 100), (2, 40, 3, 5), (3, 2, 2, 10)])
def test_brute_force(documents, monkeypatch, seed, size, cell, least):
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "AT_ONCE", 50)
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", least)
    rows = corpus(seed, size)
    out = jaccard.link(documents(*rows).withColumn("size", F.lit(1)).withColumn("key", F.lit("x"))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows)


def test_edges(documents):
    text = " ".join(f"x{i}" for i in range(30))
    out = jaccard.link(documents((None, text), (5, text), (5, text), (6, "other words here"), (9, " "), (8, None))).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(5, 5), (5, 5), (6, 6), (8, 8), (9, 9), (jaccard.LAST_ID, 5)]
    assert jaccard.link(documents((1, "a")).limit(0)).count() == 0


def test_sketches_of_two_lengths_fold():
    rng = random.Random(5)
    at = {m: [rng.getrandbits(m) for _ in range(3)] for m in (64, 128, 256)}
    kept = [(m, x) for m, found in at.items() for x in found]
    sketches = jaccard.Sketches([x.to_bytes(m // 8, "little") for m, x in kept])
    fold = lambda m, x, to: x if m == to else (x >> to) ^ (x & ((1 << to) - 1))
    for i, (m, x) in enumerate(kept):
        for j, (k, y) in enumerate(kept):
            if max(m, k) <= 2 * min(m, k):
                size, one, two = jaccard.np.array([10**6]), jaccard.np.array([i]), jaccard.np.array([j])
                good, apart = jaccard._near(size, size, sketches, one, sketches, two, 80)
                assert len(good) == 1 and apart[0] == (fold(m, x, min(m, k)) ^ fold(k, y, min(m, k))).bit_count()


def test_one_group_of_near_copies_makes_no_square_of_pairs(documents, monkeypatch):
    """300 near copies of one text, all linked in chains: the pairs that are compared stay in proportion to the rows."""
    base, compared = [f"w{i}" for i in range(200)], []
    rows = [(i, " ".join(base[:i % 20] + [f"x{i}"] + base[i % 20:])) for i in range(300)]
    real = jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda pairs, *rest: compared.append(pairs.count()) or real(pairs, *rest))
    out = jaccard.link(documents(*rows)).collect()
    assert {r.component_id for r in out} == {0}
    assert sum(compared) < 40 * len(rows)


def test_a_shared_passage_is_one_node(spark, documents, monkeypatch):
    """Passages of 40 words in three documents each, or in two: their n-grams have the same members and are compared at one node."""
    rng, rows, seen = random.Random(7), [], spark.sparkContext.accumulator(0)
    for group in range(20):
        for i in range(2 + group % 2):
            side = [[f"d{group}.{i}.{rng.randrange(10**6)}" for _ in range(30)] for _ in range(2)]
            rows.append((len(rows), " ".join([*side[0], *(f"p{group}.{k}" for k in range(40)), *side[1]])))
    real = jaccard._cells

    def counting(*args):
        run = real(*args)

        def count(batches):
            def note(batch):
                seen.add(batch.num_rows)
                return batch

            return run(note(b) for b in batches)

        return count

    monkeypatch.setattr(jaccard, "_cells", counting)
    out = jaccard.link(documents(*rows)).collect()
    assert {r.component_id for r in out} == {i for i, _ in rows}
    # Per round: three rows for each of the ten passages that three documents hold, more only where a prefix ends between their n-grams.
    assert 0 < seen.value < 150


def test_an_id_with_several_texts_keeps_all_its_nodes(documents, monkeypatch):
    rng = random.Random(3)
    rows = corpus(4, 30)[:150]
    rows = [(i if rng.random() < 0.7 else 5, t) for i, t in rows]
    kept = jaccard.link(documents(*rows)).select("doc_id", "component_id").distinct().collect()
    monkeypatch.setattr(jaccard, "_open_nodes", lambda nodes, own: nodes.select("item", "rep", "size", "pos"))
    assert sorted(kept) == sorted(jaccard.link(documents(*rows)).select("doc_id", "component_id").distinct().collect())


def test_only_texts_of_pairs_are_shuffled(spark, documents, monkeypatch):
    """One pair among 2,000 documents: its texts reach the join of the verification by a filter, not by a shuffle of all texts."""
    rows = [(i, " ".join(f"w{i}.{k}" for k in range(30))) for i in range(2000)]
    rows[7], shuffled = (7, rows[3][1] + " end"), []
    real = jaccard.verify

    def noting(pairs, texts, *rest):
        plan = texts._jdf.queryExecution().executedPlan().toString()
        shuffled.append((texts.count(), "hashpartitioning(id#" in plan))
        return real(pairs, texts, *rest)

    monkeypatch.setattr(jaccard, "verify", noting)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = {r.doc_id: r.component_id for r in jaccard.link(documents(*rows)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert out == {i: 3 if i == 7 else i for i, _ in rows}
    assert shuffled[0][0] == 2 and not any(by_id for _, by_id in shuffled)


def test_a_full_filter_loses_no_id(spark):
    rows = spark.range(-500, 500).select("id", F.lit("x").alias("text"))
    wanted = rows.where("id % 3 = 0").select("id")
    for slots in (64, 1 << 12, 1 << 25):
        kept = {r.id for r in jaccard.among(rows, wanted, slots).collect()}
        assert kept >= {i for i in range(-500, 500) if i % 3 == 0}
    assert len(kept) < 340
    assert jaccard.among(rows, wanted.where("id > 1000")).count() == 0
