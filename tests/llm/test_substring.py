import random
import re

import pytest
from pyspark.sql import functions as F

from msalake.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length):
    seen, out = {}, {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        words, gone = WORD.findall(text or ""), set()
        for i in range(len(words) - length + 1):
            if tuple(words[i:i + length]) in seen:
                gone.update(range(i, i + length))
            else:
                seen[tuple(words[i:i + length])] = key
        out[key] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def corpus(seed, vocabulary):
    rng = random.Random(seed)
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [say(rng.randint(15, 80)) for _ in range(6)]
    rows = []
    for i in range(150):
        parts = [w for _ in range(rng.randint(0, 4)) for w in (rng.choice(shared) if rng.random() < 0.5 else say(rng.randint(0, 40)))]
        rows.append((i * 3, rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(1000 + i, rows[7][1]) for i in range(30)] + [(2000, None), (2001, ""), (2002, " \n"), (2003, "é" * 50), (2004, "w " * 3000)]
    return rows


@pytest.mark.parametrize("seed,size", [(1, 400), (2, 3), (3, 40)])
@pytest.mark.parametrize("length,k", [(20, 8), (6, 2)])
def test_brute_force(documents, seed, size, length, k):
    rows = corpus(seed, [f"w{i}é" for i in range(size)])
    out = substring.remove_repeats(documents(*rows).withColumn("pieces", F.lit(1)), length=length, k=k).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in out} == brute(rows, length)
    for r in out:
        words = WORD.findall(dict(rows)[r.doc_id] or "")
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        kept = [w for i, w in enumerate(words) if not any(s.start <= i < s.end for s in r.spans)]
        assert " ".join(kept) == r.kept_text


def test_edges(documents):
    text = " ".join(f"x{i}" for i in range(30))
    out = substring.remove_repeats(documents((None, text), (5, text), (5, text), (6, text))).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == [(5, 0), (5, 0), (6, 30), (substring.LAST_ID, 30)]
    assert substring.remove_repeats(documents((1, "a")).limit(0)).count() == 0
