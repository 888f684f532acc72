import random
import zlib

from pyspark.sql import functions as F

from msalake.llm import toxicity


def test_held_out_accuracy(spark, documents):
    rng = random.Random(3)
    plain = [f"word{i}" for i in range(800)]
    rude = ["grubble", "snarfing", "zubwort", "zubzort", "zubquort"]
    rows, marks = [], []
    for i in range(1500):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.25
        for _ in range(rng.randint(1, 3) if bad else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(rude) + rng.choice(["", ".", ","]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    marks += [(marks[0][0], None), (None, 1), (99999, 1)]
    rows += [(5000, None), (5001, ""), (5002, "\n "), (5003, "zubnovel words"), (None, "grubble"), (7, rows[7][1])]
    docs = documents(*rows).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    models = toxicity.fit(docs, labels)
    out = toxicity.score(docs.drop("lang"), models).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    truth = dict(marks[:1500])
    judged = [(truth[r.doc_id], r.score >= toxicity.THRESHOLD) for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(judged) > 300 and sum(bool(t) == p for t, p in judged) >= 0.97 * len(judged)
    empty = {r.doc_id: r.score for r in out if r.doc_id in (5000, 5001, 5002)}
    assert len(set(empty.values())) == 1 and empty[5000] < 0.5


def test_fold_never_seen(spark, documents):
    """Held-out labels do not change the models."""
    rows = [(i, f"aaa bbb c{i % 9} " + ("ugly" if i % 4 == 0 else "nice")) for i in range(400)]
    marks = [(i, int(i % 4 == 0)) for i in range(400)]
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in marks]
    docs = documents(*rows)
    scores = [sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(m, "doc_id long, toxic int"))).collect())
              for m in (marks, flipped)]
    assert scores[0] == scores[1]


def test_without_labels(spark, documents):
    docs = documents((1, "a b"), (2, None))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, none) is None
    assert [r.score for r in toxicity.score(docs, None).collect()] == [0.0, 0.0]
    assert toxicity.score(docs.limit(0), None).count() == 0


def test_few_labels_and_labels_of_documents_that_are_gone(spark, documents):
    """Two toxic documents, wherever their hash deals them, are enough to find others; labels without a document take no place in a sample."""
    free = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 3 != 1]
    ask = spark.createDataFrame([(i,) for i in free], "i long").where(F.pmod(F.xxhash64(F.lit("part"), "i"), F.lit(3)) == 0)
    check = {r.i for r in ask.collect()}
    learn = [i for i in free if i not in check]
    for bad in (learn[:2], sorted(check)[:2]):
        plain = [i for i in free if i not in bad][:300]
        say = lambda i: f"alpha beta w{i % 11} gamma w{i % 7} delta"
        rows = [(i, say(i)) for i in plain] + [(i, say(i) + " grubble snarf grubble snarf") for i in bad] + [(9000, "alpha grubble snarf beta"), (9001, say(3))]
        marks = [(i, int(i in bad)) for i in plain + bad] + [(50_000 + i, i % 2) for i in range(3000)]
        docs = documents(*rows)
        models = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"), sample=400)
        found = {r.doc_id: r.score >= toxicity.THRESHOLD for r in toxicity.score(docs, models).collect()}
        assert found[9000] and not found[9001] and {i for i in plain + bad if found[i]} == set(bad)
