import random

import numpy as np
from pyspark.sql import functions as F

from msalake.operators import diversity


def identity(a, b):
    same = sum(x == y and x != "-" for x, y in zip(a, b))
    width = sum(not (x == "-" and y == "-") for x, y in zip(a, b))
    return 100.0 * same / width if width else 0.0


def greedy(seqs, t):
    free, n = [True] * len(seqs), 0
    for i in range(len(seqs)):
        if free[i]:
            n += 1
            free[i] = False
            for j in range(i + 1, len(seqs)):
                if free[j] and identity(seqs[i], seqs[j]) >= t:
                    free[j] = False
    return n


def neff(seqs, t):
    return sum(1.0 / (1 + sum(j != i and identity(a, b) >= t for j, b in enumerate(seqs))) for i, a in enumerate(seqs))


def families(seed, n_families, size, width, alphabet="ACDEF-"):
    rng = random.Random(seed)
    out = []
    for _ in range(n_families):
        base = [rng.choice(alphabet) for _ in range(width)]
        for _ in range(size):
            rate = rng.choice([0.0, 0.1, 0.2, 0.4])
            out.append("".join(rng.choice(alphabet) if rng.random() < rate else c for c in base))
    rng.shuffle(out)
    return out


def test_hand_computed(table, rows):
    seqs = ["ACDE", "ACDF", "----", "GGGG", "ACDE", "----", "AC--"]
    df = table("msa_id string, row_idx long, seq string", *[("m", i, s) for i, s in enumerate(seqs)], ("w", 0, "AC"), ("w", 1, "A"))
    assert rows(diversity.msa_size(df), "msa_id", "nseq", "ncol", "status") == [("m", 7, 4, "ok"), ("w", 2, 2, "error")]
    # ACDE leads ACDF (75 %) and its copy; AC-- shares 2 of 4 columns; gap-only rows stay alone.
    got = dict(rows(diversity.hobohm_clusters(df.where("msa_id = 'm'"), threshold=62.0)))
    assert got == {"m": 5}
    assert dict(rows(diversity.effective_count(df.where("msa_id = 'm'"), threshold=80.0))) == {"m": 6.0}


def test_matches_brute_force_with_tiny_blocks(spark, rows):
    data, want = [], {}
    for m in range(12):
        seqs = families(m, 1 + m % 4, 4 + m, 20 + m)
        data += [(m, i, s) for i, s in enumerate(seqs)]
        want[m] = {t: (greedy(seqs, t), neff(seqs, t)) for t in (40.0, 62.0, 80.0)}
    df = spark.createDataFrame(data, "msa_id long, row_idx long, seq string").cache()
    for t, block in ((40.0, 7), (62.0, 5), (80.0, 3), (62.0, 2048)):
        clusters = dict(rows(diversity.hobohm_clusters(df, threshold=t, block=block)))
        counts = dict(rows(diversity.effective_count(df, threshold=t, block=block)))
        for m in want:
            assert clusters[m] == want[m][t][0]
            assert abs(counts[m] - want[m][t][1]) < 1e-9
    df.unpersist()


def test_identity_matrix():
    import pandas as pd

    a = diversity.residue_matrix(pd.Series(["AC-β", "A---"]))
    got = diversity.identity_matrix(a, a)
    assert np.allclose(got, [[100.0, 100.0 / 3], [100.0 / 3, 100.0]])


def test_small_blocks_use_every_partition_and_copies_need_none(spark):
    """Many small alignments stay spread though they have few bytes; one of copies only is settled without a comparison."""
    rows = spark.range(1200).select((F.col("id") % 300).alias("msa_id"), F.col("id").alias("row_idx"), F.when(F.col("id") % 3 == 0, "ACDE").otherwise(F.concat(F.lit("AC"), F.when(F.col("id") < 600, "WY").otherwise("DE"))).alias("seq"))
    unique, _ = diversity.distinct_rows(rows, "msa_id")
    parts = diversity._leaders(unique.select("msa_id", "first_idx", "seq"), "msa_id", "bigint", 62.0)
    assert parts.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    stats = {r.msa_id: (r.clusters62, r.neff80) for r in diversity.alignment_stats(rows).collect()}
    assert len(stats) == 300 and all(stats[k] == ((1, 1.0) if k % 3 == 0 else (2, 2.0)) for k in stats)
    one = diversity.neighbour_counts(unique.where("msa_id % 3 = 0"), "msa_id", 80.0)
    assert {tuple(r) for r in one.select("copies", "neighbours").collect()} == {(4, 4)} and one.count() == 100
