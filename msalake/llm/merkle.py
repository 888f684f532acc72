"""Merkle manifest of a table: every row a leaf, a tree of digests per group, one root, and a proof for each row.

Digests are lowercase hex SHA-256. The leaves of a group ascend by id (NULL first, equal ids by leaf); while a group has several
nodes, every ``fanout`` consecutive ones become the digest of their concatenation. What remains is the group's subroot; subroots,
ascending by group (NULL first, bytewise), form a tree of the same kind, whose last node is the root. A run's children are spread
by conditional aggregates into one column per slot: all slots joined are hashed, all but a row's own are its siblings.

Positions come from a range partitioning that is written once, so no group meets in one task. Levels shrink by ``fanout``; only
the lowest one is joined to the leaves. A parent holds at most ``fanout`` digests.

Results for special cases: a NULL field is ``-``, an empty one ``0:``; texts are hashed whole; repeated rows are leaves of their
own with equal digests; a NULL group is a group; an empty table has no rows, hence no root. Only the columns named are read, so
other columns and their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settled

FANOUT = 8
STEP = "struct<before:string,after:string>"


def leaf(*fields: Column) -> Column:
    """The digest of a row: each field as UTF-8 byte count, ``:`` and value, or ``-``."""
    texts = [field.cast("string") for field in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["after"]))), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its siblings."""
    return F.aggregate(path, digest, lambda below, step: F.sha2(F.concat(step["before"], below, step["after"]), 256))


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, the place from 0 inside ``grp``, and ``n``, the nodes of ``grp``."""
    keys = [F.col(c).asc_nulls_first() for c in ["grp", *order]]
    tied = nodes.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*keys, F.col("_tie")).sortWithinPartitions(*keys).drop("_tie")
    dealt = settled(dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    inside = Window.partitionBy("grp")
    runs = dealt.groupBy("part", "grp").agg(F.min("at").alias("start"), F.count("*").alias("rows")).select(
        "part", "grp", "start", F.sum("rows").over(inside.orderBy("part")).alias("upto"), "rows", F.sum("rows").over(inside).alias("n"))
    runs = runs.select("part", "grp", (F.col("start") - F.col("upto") + F.col("rows")).alias("shift"), "n")
    return dealt.join(runs, ["part", "grp"]).withColumn("pos", F.col("at") - F.col("shift")).drop("part", "at", "shift")


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """One row per run: its children's digests in ``slots``, and the node they become."""
    slot = F.col("pos") % fanout
    spread = nodes.where("n > 1").groupBy("grp", F.floor(F.col("pos") / fanout).alias("up")).agg(
        F.first("n").alias("below"), *[F.max(F.when(slot == i, F.col("digest"))).alias(f"slot{i}") for i in range(fanout)])
    slots = [F.col(f"slot{i}") for i in range(fanout)]
    return spread.select("grp", F.col("up").alias("pos"), F.ceil(F.col("below") / fanout).alias("n"),
                         F.sha2(F.concat_ws("", *slots), 256).alias("digest"), F.filter(F.array(*slots), lambda s: s.isNotNull()).alias("slots"))


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The inner levels, lowest first, until each group has one node."""
    found = []
    while True:
        up = settled(_parents(nodes, fanout))
        if up.isEmpty():
            return found
        found.append(up)
        nodes = up


def _under(nodes: DataFrame, above: DataFrame | None, tops: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with ``path``, ``subroot`` and ``root``: from the parent's path, or from the group's where a node has no parent."""
    alone = nodes.where("n = 1").join(tops, "grp")
    if above is None:
        return alone
    parent = above.select("grp", F.col("pos").alias("up"), F.col("slots").alias("run"), F.col("path").alias("rest"), "subroot", "root")
    own = (F.col("pos") % fanout).cast("int")
    step = F.struct(F.concat_ws("", F.slice("run", F.lit(1), own)).alias("before"),
                    F.concat_ws("", F.slice("run", own + 2, F.lit(fanout))).alias("after"))
    held = nodes.where("n > 1").withColumn("up", F.floor(F.col("pos") / fanout)).join(parent, ["grp", "up"])
    held = held.withColumn("path", F.concat(F.array(step), "rest"))
    columns = [*nodes.columns, "path", "subroot", "root"]
    return held.select(*columns).unionByName(alone.select(*columns))


def _proofs(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    known = None
    for level in reversed(levels):
        known = _under(level, known, tops, fanout)
    return _under(nodes, known, tops, fanout)


def manifest(rows: DataFrame, *, id: str = "id", group: str = "group", digest: str = "leaf", carry: tuple[str, ...] = (), fanout: int = FANOUT) -> DataFrame:
    """``(id, leaf, *carry, subroot, root, path)`` for each row. ``carry`` names columns to hand through."""
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # NULL first, then bytewise
    given = rows.select(F.col(id).alias("id"), F.col(digest).alias("digest"), key.alias("grp"), F.struct(F.lit(0), *carry).alias("carried"))
    leaves = settled(_placed(given, ["id", "digest"]))
    levels = _levels(leaves, fanout)
    tops = [level.where("n = 1").select("grp", "digest") for level in [leaves, *levels]]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionAll(more)
    upper = settled(_placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest"), ["member"]))
    upper_levels = _levels(upper, fanout)
    last = (upper_levels[-1] if upper_levels else upper).where("n = 1").select(F.col("digest").alias("root"))
    ends = last.select(F.lit("").alias("grp"), F.lit(None).cast("string").alias("subroot"), "root", F.array().cast(f"array<{STEP}>").alias("path"))
    proven = settled(_proofs(upper, upper_levels, ends, fanout).select(F.col("member").alias("grp"), F.col("digest").alias("subroot"), "root", "path"))
    out = _proofs(leaves, levels, proven, fanout)
    return out.select("id", F.col("digest").alias("leaf"), *[F.col("carried")[c].alias(c) for c in carry], "subroot", "root", "path")
