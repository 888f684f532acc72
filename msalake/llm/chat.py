"""Reply trees formatted as conversations, with a reversible template.

A message names its parent; a tree is a root and all that hangs on it. Self-joins that double their reach find for each
message its root and its depth, then the best leaves of each tree are ranked by the score of their whole path, and halving
reaches walk from each chosen leaf back to the root, so that a path of ``n`` messages takes ``log2(n)`` joins and ``n`` rows.
Each chosen path becomes one text.

Template: ``[TURN]``, role, line break, text, then ``</s>`` after an answer and ``[/INST]`` after anything else. Roles and texts
are escaped so that neither holds a control string; see ``escape``.

Defined results: NULL text is an empty one; NULL roles are written as empty; a message whose parent is missing, NULL or itself is
a root; messages on a cycle of parents belong to no tree and are left out; repeated ids must be made unique by the caller, as
``from_turns`` does; equal scores go to the smaller leaf id. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settled

OPEN, HEAD, ANSWER_END, OTHER_END = "[TURN]", "\n", "</s>", "[/INST]"


def escape(text: Column) -> Column:
    """Puts a backslash after every ``<``, ``[`` and backslash: no control string is left, and nothing is lost."""
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def escape_role(role: Column) -> Column:
    """As ``escape``; a line break becomes ``[n``, which no escaped text holds."""
    return F.replace(escape(role), F.lit("\n"), F.lit("[n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("[n"), F.lit("\n")))


def from_turns(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", per_block: int = 4096) -> DataFrame:
    """Rows of linear conversations as messages ``(tree, id, parent, score, role, text)``: each answers the one before it.

    Rows of equal turn follow each other by role, then text. Conversations are numbered in blocks of turns, so that a very
    long one is not ordered by one task.
    """
    base = rows.select(F.col(conv).alias("tree"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocked = base.withColumn("_b", F.floor(F.coalesce(F.col("turn"), F.lit(0)) / per_block))
    sizes = blocked.groupBy("tree", "_b").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("tree").alias("_tree"), F.col("_b").alias("_block"), F.coalesce(F.sum("_n").over(
        Window.partitionBy("tree").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("tree", "_b").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    numbered = blocked.withColumn("_i", inside).join(before, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_b") == F.col("_block")))
    at = (F.col("_i") + F.col("_before")).cast("long")
    return numbered.select("tree", at.alias("id"), F.when(at > 1, at - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def paths(messages: DataFrame, *, branches: int = 1) -> DataFrame:
    """``(tree, leaf, rank, depth, id)`` for the messages on the ``branches`` best root-to-leaf paths of each tree.

    ``tree`` groups ids: ids and parents are unique inside one tree only. The score of a path is the mean score of its messages.
    """
    nodes = messages.select("tree", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    ids = nodes.select(F.col("tree").alias("t"), F.col("id").alias("p"))
    linked = nodes.join(ids, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("p")) & (F.col("parent") != F.col("id")), "left")
    # jump: the ancestor 2**k steps up (NULL beyond the root), sum and steps: score and messages from here to just below it.
    # Messages whose jump has passed the root are done and only looked up; each round joins the others.
    step = settled(linked.select("tree", "id", F.col("p").alias("jump"), F.col("score").alias("sum"), F.lit(1).cast("long").alias("steps")))
    jumps, done, total = [step.where("jump is not null")], step.where("jump is null"), step.count()
    while not jumps[-1].isEmpty() and 2 ** (len(jumps) - 1) <= total:  # what still jumps then is on a cycle, or hangs on one
        low = jumps[-1]
        state = low.unionAll(done)
        up = state.select(F.col("tree").alias("t"), F.col("id").alias("u"), F.col("jump").alias("far"), F.col("sum").alias("more"), F.col("steps").alias("n"))
        after = settled(low.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("jump") == F.col("u"))).select(
            "tree", "id", F.col("far").alias("jump"), (F.col("sum") + F.col("more")).alias("sum"), (F.col("steps") + F.col("n")).alias("steps")))
        jumps.append(after.where("jump is not null"))
        done = done.unionAll(after.where("jump is null"))
    parents = step.where("jump is not null").select("tree", F.col("jump").alias("id")).distinct()
    leaves = done.join(parents, done["tree"].eqNullSafe(parents["tree"]) & (done["id"] == parents["id"]), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc(F.col("sum") / F.col("steps")), "id"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= branches)
    found = chosen.select("tree", F.col("id").alias("leaf"), "rank", F.col("steps").alias("depth"), "id")
    for k in range(len(jumps) - 1, -1, -1):
        reach = jumps[k].select(F.col("tree").alias("t"), F.col("id").alias("u"), F.col("jump").alias("far"))
        higher = found.join(reach, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("u"))).select(
            "tree", "leaf", "rank", (F.col("depth") - (1 << k)).alias("depth"), F.col("far").alias("id"))
        found = settled(found.unionAll(higher)) if k % 4 == 0 else found.unionAll(higher)
    return found


def format_paths(messages: DataFrame, chosen: DataFrame, *, answer: str = "assistant") -> DataFrame:
    """``(tree, leaf, rank, n_turns, formatted, loss)``: one text for each path, ``loss`` the code points that are trained on.

    One output row holds one conversation, so a conversation must fit into memory; nothing else is gathered.
    """
    body = messages.select(F.col("tree").alias("t"), F.col("id").alias("u"), "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = chosen.join(body, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("u")))
    role = F.coalesce("role", F.lit(""))
    mine = role == answer
    piece = turns.select("tree", "leaf", "rank", F.struct(
        F.col("depth").alias("depth"), F.concat(F.lit(OPEN), escape_role(role), F.lit(HEAD)).alias("head"), escape(F.col("text")).alias("body"),
        F.when(mine, F.lit(ANSWER_END)).otherwise(F.lit(OTHER_END)).alias("end"), mine.alias("answer")).alias("piece"))
    ordered = piece.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(acc, p):
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.when(p["answer"], F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
        return F.struct((end + F.length(p["end"])).cast("long").alias("at"), F.concat(acc["spans"], span).alias("spans"))

    return ordered.select(
        "tree", "leaf", "rank", F.size("pieces").cast("long").alias("n_turns"),
        F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["end"]))).alias("formatted"),
        F.aggregate("pieces", zero, add)["spans"].alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, text>>``."""
    turns = F.filter(F.split(formatted, r"\[TURN\]", -1), lambda x, i: i > 0)
    return F.transform(turns, lambda x: F.struct(
        unescape_role(F.substring_index(x, HEAD, 1)).alias("role"),
        unescape(F.regexp_replace(F.regexp_replace(x, r"^[^\n]*\n", ""), r"(?:</s>|\[/INST\])\z", "")).alias("text")))


def under_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))))
