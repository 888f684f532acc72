import random

from pyspark.sql import functions as F

from msalake.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\[", "[TURN]user\nhi</s>", "<", "[/INST]", "a\n\nb", "", None, "[\\n", "[n", "é\U0001f600</s>"]


def test_round_trip(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "sys\ntem", "[TURN]", None, "a[n"]), rng.choice(NASTY)) for c in range(60) for t in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("id", F.lit(9))
    messages = chat.from_turns(df, per_block=3)
    out = chat.format_paths(messages, chat.paths(messages))
    got = {r.tree: r for r in out.select("tree", "n_turns", "formatted", chat.read_back(F.col("formatted")).alias("back"),
                                         chat.under_loss(F.col("formatted"), F.col("loss")).alias("loss"), F.col("loss").alias("spans")).collect()}
    for c in range(60):
        mine = [(r or "", t or "") for cc, _, r, t in rows if cc == c]
        assert [(x.role, x.text) for x in got[c].back] == mine and got[c].n_turns == len(mine)
        assert got[c].loss == "".join(t for r, t in mine if r == "assistant")
        assert got[c].formatted.count("[TURN]") == len(mine)


def brute(nodes, branches):
    """nodes: (tree, id, parent, score)"""
    by = {(t, i): (p, s or 0.0) for t, i, p, s in nodes}
    has = {(t, p) for (t, i), (p, _) in by.items() if p is not None and p != i and (t, p) in by}
    found = {}
    for t, i in by:
        if (t, i) in has:
            continue
        path, at, seen = [i], i, {i}
        while True:
            p = by[t, at][0]
            if p is None or p == at or (t, p) not in by:
                break
            if p in seen:
                path = None
                break
            seen.add(p)
            path.append(p)
            at = p
        if path:
            found.setdefault(t, []).append((-sum(by[t, x][1] for x in path) / len(path), i, path[::-1]))
    return {(t, leaf): path for t, xs in found.items() for _, leaf, path in sorted(xs)[:branches]}


def test_trees(spark):
    rng = random.Random(2)
    nodes = []
    for t in range(6):
        n = [1, 2, 40, 70, 200, 30][t]
        nodes += [(t, i, None if i == 0 else (rng.randrange(i) if t != 4 else i - 1), rng.choice([None, 0.25, 0.5, 1.0, -1.0])) for i in range(n)]
    nodes += [(7, 1, 2, 1.0), (7, 2, 1, 1.0), (7, 3, 1, 5.0), (8, 1, 99, 1.0), (8, 2, 2, 0.0), (None, 1, None, 1.0)]
    df = spark.createDataFrame([(*x, "user", f"m{x[1]}") for x in nodes], "tree long, id long, parent long, score double, role string, text string")
    for branches in (1, 3):
        got = {}
        for r in chat.paths(df, branches=branches).collect():
            got.setdefault((r.tree, r.leaf), []).append((r.depth, r.id))
        got = {k: [i for _, i in sorted(v)] for k, v in got.items()}
        assert got == brute(nodes, branches)
    assert chat.paths(df.limit(0)).count() == 0


def test_ties_and_repeats(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "user", "z"), (1, 0, "user", "a"), (None, 3, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages = chat.from_turns(df)
    out = chat.format_paths(messages, chat.paths(messages)).select("tree", chat.read_back(F.col("formatted")).alias("b")).collect()
    assert {r.tree: [x.text for x in r.b] for r in out} == {1: ["z", "a", "a", "b"], None: [""]}
