import math
import random
import re

from pyspark.sql import functions as F

from msalake.llm import decontaminate

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, items, n=5, similarity=0.8):
    """Every window of an item's length in every document, by exact weighted similarity."""
    words = {i: WORD.findall((t or "").lower()) for i, t in items}
    words = {i: w for i, w in words.items() if w}
    grams = lambda w, k: {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
    sets = {i: grams(w, min(n, len(w))) for i, w in words.items()}
    holders = {}
    for s in sets.values():
        for g in s:
            holders[g] = holders.get(g, 0) + 1
    weight = lambda g: math.log1p(len(words) / holders.get(g, 1))
    found = set()
    for d, t in docs:
        w = WORD.findall((t or "").lower())
        for i, s in sets.items():
            size, k = len(words[i]), min(n, len(words[i]))
            for at in range(max(1, len(w) - size + 1)):
                here = grams(w[at:at + size], k)
                if here & s and sum(map(weight, here & s)) / sum(map(weight, here | s)) >= similarity - 1e-9:
                    found.add((d, i))
                    break
    return found


def test_brute_force(spark, documents):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, say(rng.randint(12, 50))) for i in range(40)] + [(90, ["Tiny", "item"]), (91, ["one", "two", "three"])]
    rows = []
    for d in range(150):
        text = say(rng.randint(0, 80))
        if rng.random() < 0.6:
            piece = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                piece[rng.randrange(len(piece))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = piece if rng.random() < 0.8 else piece[: len(piece) // 2]
        rows.append((d, " ".join(text).upper() if d % 7 == 0 else "\n".join(text)))
    rows += [(500, None), (501, ""), (502, "TINY ITEM"), (None, "x one two three y"), (503, "one two"), (503, "three")]
    items = [(i, " ".join(w)) for i, w in items] + [(92, None), (93, " "), (94, items[3][1] and " ".join(items[3][1]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(*rows).withColumn("words", F.lit(1)).withColumn("length", F.lit(2))
    out = decontaminate.matches(docs, bench).collect()
    named = [(decontaminate.LAST_ID if d is None else d, t) for d, t in rows if d != 503] + [(503, "one two")]
    got, want = {(r.doc_id, r.item_id) for r in out}, brute(named, items)
    assert (got - want, want - got) == (set(), set())
    assert len(out) == len({(r.doc_id, r.item_id) for r in out})
    kept = {r.doc_id for r in decontaminate.clean(docs, bench).collect()}
    assert kept == {d for d, _ in rows} - {r.doc_id for r in out} - {None}


def test_planted_positions(spark, documents):
    item = " ".join(f"q{i}" for i in range(20))
    out = decontaminate.matches(documents((1, "a b " + item + " c"), (2, item + " " + item)), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.start_word, r.end_word, r.similarity) for r in out.collect()) == [(1, 7, 2, 22, 1.0), (2, 7, 0, 20, 1.0)]


def test_no_pair_at_the_threshold_is_lost(spark, documents):
    """Items of 50 words with one inner word changed have similarity 41 / 51; a radius of 15 loses about one in fifty."""
    items = [(i, [f"t{i}x{j}" for j in range(50)]) for i in range(400)]
    docs = documents(*[(i, " ".join([*w[:25], "changed", *w[26:]])) for i, w in items])
    out = decontaminate.matches(docs, spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in out.collect()} == {(i, i) for i in range(400)}


def test_empty(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(documents((1, "a b")), none).count() == 0
    assert decontaminate.clean(documents((1, "a b")), none).count() == 1
    assert decontaminate.matches(documents((1, "a")).limit(0), none).count() == 0


def test_blocks_find_all_within_radius(spark):
    rng = random.Random(1)
    for radius in (3, 15):
        for _ in range(20):
            x = rng.getrandbits(64)
            y = x
            for b in rng.sample(range(64), radius):
                y ^= 1 << b
            signed = [v - (1 << 64) if v >> 63 else v for v in (x, y)]
            a, b = [r.b for r in spark.createDataFrame([(v,) for v in signed], "print long").coalesce(1).select(decontaminate._blocks(radius).alias("b")).collect()]
            assert any(p == q for p, q in zip(a, b))
