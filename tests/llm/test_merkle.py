import hashlib
import random

import pytest
from pyspark.sql import functions as F

from msalake.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grow(digests, fanout):
    """Levels of a plain tree, and each leaf's siblings as (before, after)."""
    levels, proofs = [digests], [[] for _ in digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        for i in range(len(digests)):
            p = i // fanout ** (len(levels) - 1)
            run = below[p // fanout * fanout:(p // fanout + 1) * fanout]
            proofs[i].append(("".join(run[:p % fanout]), "".join(run[p % fanout + 1:])))
        levels.append([H(*below[i:i + fanout]) for i in range(0, len(below), fanout)])
    return levels[-1][0], proofs


def plain(rows, fanout):
    """rows (id, group, leaf) -> sorted (id, leaf, subroot, root, proof)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees.append((members, *grow([m[2] for m in members], fanout)))
    root, above = grow([t[1] for t in trees], fanout) if trees else (None, [])
    return sorted(((m[0], m[2], subroot, root, H(*[x for step in own + up for x in step]))
                   for (members, subroot, proofs), up in zip(trees, above) for m, own in zip(members, proofs)), key=repr)


def run(spark, rows, fanout=8, partitions=5):
    df = spark.createDataFrame(rows, "id long, lang string, leaf string").repartition(partitions)
    out = merkle.manifest(df.select("*", F.lit(1).alias("path"), F.lit(2).alias("grp"), F.lit(3).alias("pos")), group="lang", fanout=fanout)
    out = out.withColumn("proof", merkle.proof_digest(F.col("path"))).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path")))
    got = out.collect()
    assert all(r.folded == r.root for r in got)
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.proof) for r in got), key=repr)


@pytest.mark.parametrize("fanout", [2, 8])
def test_trees_of_every_shape_equal_plain_ones(spark, fanout):
    rows = []
    for g, n in (("a", 1), ("b", 8), ("é", 9), (None, 64), ("", 65), ("z", 73)):
        rows += [(i * 3, g, H(str(g), str(i))) for i in range(n)]
    random.Random(1).shuffle(rows)
    assert run(spark, rows, fanout) == plain(rows, fanout)


def test_more_groups_than_the_fanout(spark):
    rows = [(i, f"g{i % 19}", H(str(i))) for i in range(60)]
    assert run(spark, rows) == plain(rows, 8)


def test_null_and_repeated_ids_and_repeated_rows(spark):
    rows = [(None, "a", H("x")), (None, "a", H("y")), (7, "a", H("q")), (7, "a", H("p")), *[(9, "a", H("same"))] * 20, (None, None, H("z"))]
    assert run(spark, rows) == plain(rows, 8)


def test_one_row_and_empty_table(spark):
    assert run(spark, [(1, None, H("x"))]) == [(1, H("x"), H("x"), H("x"), H())]
    assert run(spark, []) == []


def test_leaf_fields(spark):
    long = "ß" * 200_000
    rows = [(1, None, "en", 3, ""), (None, "s", None, None, long), (2, "7:x", "en", 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = df.select("doc_id", merkle.leaf(*[F.col(c) for c in df.columns]).alias("leaf")).collect()
    assert {r.doc_id: r.leaf for r in got} == {r[0]: H(*map(field, r)) for r in rows}


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    rows = [(i, "en", H(str(i))) for i in range(100)]
    out = merkle.manifest(spark.createDataFrame(rows, "id long, group string, leaf string"))
    wrong = out.select(merkle.fold(F.sha2("leaf", 256), F.col("path")).alias("f"), "root")
    assert wrong.where("f = root").isEmpty()


def test_carried_columns_keep_their_rows(spark):
    rows = [(i, "en", H(str(i)), f"c{i}", i) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, group string, leaf string, digest string, n long")
    got = merkle.manifest(df, carry=("digest", "n")).select("id", "digest", "n").collect()
    assert sorted(map(tuple, got)) == [(i, f"c{i}", i) for i in range(30)]
