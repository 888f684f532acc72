import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from msalake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


TEXTS = [None, "", " \n\t", "a b c", "x\ny\nx\n\n x\nx", "a b c d e f g h " * 3, "w " * 30, "# $$ %a\x0b|é\U0001f600 <b>", " ".join(f"w{i % 17}" for i in range(200)),
         "one two three four five six seven eight nine " + "z " * 7 + "one two three four five six seven eight nine", "a b   c"]


def test_base_counts(spark, documents):
    docs = documents(*[(i, t) for i, t in enumerate(TEXTS)], (3, "a b c"))
    out = quality.judge(docs.withColumn("_words", F.lit(1)), spark.createDataFrame([], "doc_id long, quality int"))
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect())
    assert got == sorted([(i, *brute(t)) for i, t in enumerate(TEXTS)] + [(3, *brute("a b c"))])
    for r in out.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)  # without labels the base rules stand alone


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (200, 3, 0.05), (5000, 60, 0.02), (50, 49, 0.02)])
def test_binomial_tail(spark, n, k, p):
    got = spark.range(1).select(quality.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("t")).first().t
    exact = 1.0 if k > n * p else sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
    assert got == pytest.approx(exact, rel=1e-9)


def test_cutoffs_hold_the_risk(spark, documents):
    """Good documents have few symbols, bad ones many: the tightest safe cutoff parts them in the stratum with labels only."""
    good = [(i, " ".join(f"word{i}x{j}" for j in range(30)), "s", "en") for i in range(900)]
    bad = [(1000 + i, " ".join(f"## $$ %% word{i}y{j}" for j in range(30)), "s", lang) for i, lang in enumerate(["en", "de", None] * 3)]
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000)) for r in good + bad] + [(None, 1)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.judge(documents(*good, *bad), labels).collect()}
    assert all(out[r[0]].kept for r in good)
    assert [out[r[0]].kept for r in bad] == [r[3] != "en" for r in bad]
    assert out[1000].failed_rules and "symbol_share" in out[1000].failed_rules


def test_empty(spark, documents):
    docs = documents((1, "a")).limit(0)
    assert quality.judge(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
