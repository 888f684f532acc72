"""Alignment size, identity clusters and the effective number of sequences.

Identity of two aligned rows is ``100 * equal residues / columns that are not gaps in both``; two rows that share
no residue column have identity 0. Exact copies of a row are counted once and weighted, so a group of copies costs
one row, and an alignment of copies only needs no comparison. No pair of rows is ever emitted: tasks compare blocks of at most
``block`` rows and return one number or one flag per row. Blocks are dealt over all shuffle partitions, however few bytes they have.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import cut_lineage, spread_evenly

BLOCK = 2048
GAPS = "-."


def msa_size(rows: DataFrame, key: str = "msa_id") -> DataFrame:
    """``(key, nseq, ncol, status, issue)``; rows of unequal width are an error."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("nseq"), F.max(F.length("seq")).cast("long").alias("ncol"),
                                  F.min(F.length("seq")).alias("_min"))
    issue = F.when(F.col("_min") != F.col("ncol"), "Rows of the alignment differ in width.")
    return sizes.select(key, "nseq", "ncol", F.when(issue.isNull(), "ok").otherwise("error").alias("status"), issue.alias("issue"))


def distinct_rows(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences ``(key, seq, first_idx, copies)`` with residues, and the number of gap-only rows."""
    counted = rows.select(key, "row_idx", F.translate(F.upper("seq"), ".", "-").alias("seq")).groupBy(key, "seq").agg(
        F.min("row_idx").alias("first_idx"), F.count("*").alias("copies"))
    gap_only = F.translate(F.col("seq"), "-", "") == ""
    blank = counted.where(gap_only).groupBy(key).agg(F.sum("copies").alias("n_blank"))
    return counted.where(~gap_only), blank


def residue_matrix(seqs: pd.Series) -> np.ndarray:
    width = int(seqs.str.len().max())
    text = np.array(seqs.str.pad(width, side="right", fillchar="-").tolist(), dtype=f"U{width}")
    return text.view(np.uint32).reshape(len(seqs), width)


def identity_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Percent identity of every row of ``a`` with every row of ``b``."""
    gap = ord("-")
    matches = np.zeros((len(a), len(b)), dtype=np.float32)
    for symbol in np.intersect1d(a, b):
        if symbol != gap:
            matches += (a == symbol).astype(np.float32) @ (b == symbol).astype(np.float32).T
    both_gaps = (a == gap).astype(np.float32) @ (b == gap).astype(np.float32).T
    width = (a.shape[1] - both_gaps).astype(np.float64)
    return np.divide(100.0 * matches, width, out=np.zeros_like(width), where=width > 0)


def _widen(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])), constant_values=ord("-"))


def _identity(a: pd.Series, b: pd.Series) -> np.ndarray:
    left, right = residue_matrix(a), residue_matrix(b)
    width = max(left.shape[1], right.shape[1])
    return identity_matrix(_widen(left, width), _widen(right, width))


def neighbour_counts(unique: DataFrame, key: str, threshold: float, block: int = BLOCK) -> DataFrame:
    """``(key, first_idx, copies, neighbours)``: rows within ``threshold`` of each distinct row, itself included.

    Blocks are formed by distance to the first row of the alignment. Rows at or above the threshold differ in at
    most ``(1 - t) * width`` columns, and so do their distances to any third row; with bins of that width only
    equal and adjacent bins can hold neighbours. Small alignments are one block.
    """
    # The first row and the width come from one aggregate per alignment.
    facts = unique.groupBy(key).agg(
        F.count("*").alias("_n"), F.max(F.length("seq")).alias("_width"), F.min_by("seq", "first_idx").alias("_pivot"),
        F.min("first_idx").alias("first_idx"), F.min("copies").alias("copies"))
    compared = facts.where((F.col("_n") > 1) | F.lit(threshold > 100)).drop("first_idx", "copies")
    alone = facts.where((F.col("_n") == 1) & F.lit(threshold <= 100)).select(key, "first_idx", "copies", F.col("copies").alias("neighbours"))
    placed = unique.join(compared, key)
    differing = F.size(F.filter(F.zip_with(F.split("seq", ""), F.split("_pivot", ""), lambda x, y: x != y), lambda d: d))
    bin_width = F.floor(F.lit(1.0 - threshold / 100.0) * F.col("_width") + 1e-9) + 1
    # One small alignment needs no bins, so its distances are not computed.
    binned = placed.withColumn("_bin", F.when(F.col("_n") <= block, F.lit(0)).otherwise(F.floor(differing / bin_width)).cast("int"))
    sizes = binned.groupBy(key, "_bin").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("_chunks"))
    layout = sizes.groupBy(key).agg(F.collect_list(F.struct("_bin", "_chunks")).alias("_layout"))
    rows = binned.join(layout, key).select(key, "seq", "first_idx", "copies", "_bin", "_layout")

    def chunks(at):
        return F.aggregate(F.filter("_layout", lambda s: s["_bin"] == at), F.lit(0), lambda acc, s: acc + s["_chunks"])

    b = F.col("_bin")
    own = F.pmod(F.xxhash64("seq"), chunks(b)).cast("int")
    chunked = rows.withColumn("_c", own).withColumns({"_same": chunks(b), "_up": chunks(b + 1), "_down": chunks(b - 1)})

    def pairs(count: str, make):
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), make)).otherwise(
            F.array().cast("array<struct<a:int,ac:int,b:int,bc:int,left:boolean>>"))

    c = F.col("_c")

    def tile(a, ac, bb, bc, left):
        return F.struct(a.cast("int").alias("a"), ac.cast("int").alias("ac"), bb.cast("int").alias("b"),
                        bc.cast("int").alias("bc"), left.alias("left"))

    tiles = F.concat(
        pairs("_same", lambda o: tile(b, F.least(c, o), b, F.greatest(c, o), c <= o)),
        pairs("_up", lambda o: tile(b, c, b + 1, o, F.lit(True))),
        pairs("_down", lambda o: tile(b - 1, o, b, c, F.lit(False))))
    placed_tiles = chunked.select(key, "first_idx", "copies", "seq", F.explode(tiles).alias("t")).select(
        key, "t.*", "first_idx", "copies", "seq")

    key_type = dict(unique.dtypes)[key]

    def count_tile(pdf: pd.DataFrame) -> pd.DataFrame:
        one_tile = (pdf["a"].iloc[0] == pdf["b"].iloc[0]) and (pdf["ac"].iloc[0] == pdf["bc"].iloc[0])
        left = pdf[pdf["left"]]
        right = left if one_tile else pdf[~pdf["left"]]
        if left.empty or right.empty:
            return pd.DataFrame({key: [], "first_idx": [], "copies": [], "part": []})
        near = _identity(left["seq"], right["seq"]) >= threshold
        parts = [left[[key, "first_idx", "copies"]].assign(part=near @ right["copies"].to_numpy())]
        if not one_tile:
            parts.append(right[[key, "first_idx", "copies"]].assign(part=left["copies"].to_numpy() @ near))
        return pd.concat(parts)

    tile_keys = [key, "a", "ac", "b", "bc"]
    counted = spread_evenly(placed_tiles, *tile_keys).groupBy(*tile_keys).applyInPandas(
        count_tile, schema=f"{key} {key_type}, first_idx long, copies long, part long")
    return counted.groupBy(key, "first_idx", "copies").agg(F.sum("part").alias("neighbours")).unionByName(alone)


def effective_count(rows: DataFrame, key: str = "msa_id", threshold: float = 80.0, block: int = BLOCK) -> DataFrame:
    """``(key, neff)``: each row weighs one over the number of rows within the threshold. Gap-only rows weigh 1."""
    unique, blank = distinct_rows(rows, key)
    weights = neighbour_counts(unique, key, threshold, block).groupBy(key).agg(
        F.sum(F.col("copies") / F.col("neighbours")).alias("_w"))
    return weights.join(blank, key, "full_outer").select(
        key, (F.coalesce("_w", F.lit(0.0)) + F.coalesce("n_blank", F.lit(0))).alias("neff"))


def hobohm_clusters(rows: DataFrame, key: str = "msa_id", threshold: float = 62.0, block: int = BLOCK) -> DataFrame:
    """``(key, n_clusters)`` of the greedy clustering: in row order, an unclaimed row leads a cluster and claims the
    later unclaimed rows within the threshold.

    Each round settles the first ``block`` unclaimed rows of every alignment exactly as the greedy rule does, then
    lets the new leaders claim the remaining rows, block by block. Work is rows times leaders, never all pairs;
    an alignment of at most ``block`` distinct rows takes one round.
    """
    unique, blank = distinct_rows(rows, key)
    key_type = dict(rows.dtypes)[key]
    open_rows = unique.select(key, "first_idx", "seq")
    small = open_rows.groupBy(key).agg(F.count("*").alias("_n"))
    sized = open_rows.join(small, key)
    counts = _leaders(sized.where(F.col("_n").between(2, block)).drop("_n"), key, key_type, threshold).groupBy(key).agg(
        F.count("*").alias("n")).unionByName(small.where("_n = 1").select(key, F.col("_n").alias("n")))
    large = cut_lineage(sized.where((F.col("_n") > block) & (F.col("_n") > 1)).drop("_n"))
    while not large.isEmpty():
        front = _front(large, key, block)
        leaders = cut_lineage(_leaders(front, key, key_type, threshold))
        counts = counts.unionByName(leaders.groupBy(key).agg(F.count("*").alias("n")))
        rest = large.join(front.select(key, "first_idx"), [key, "first_idx"], "left_anti")
        large = cut_lineage(_unclaimed(rest, leaders, key, key_type, threshold, block))
    totals = counts.groupBy(key).agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    return totals.join(blank, key, "full_outer").select(
        key, (F.coalesce("n", zero) + F.coalesce("n_blank", zero)).alias("n_clusters"))


def _front(rows: DataFrame, key: str, block: int) -> DataFrame:
    """The first ``block`` rows of each alignment; the group limit trims each map task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy("first_idx"))
    return rows.withColumn("_rn", rank).where(F.col("_rn") <= block).drop("_rn")


def _leaders(front: DataFrame, key: str, key_type: str, threshold: float) -> DataFrame:
    def lead(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("first_idx")
        near = _identity(ordered["seq"], ordered["seq"]) >= threshold
        free = np.ones(len(ordered), dtype=bool)
        chosen = []
        for i in range(len(ordered)):
            if free[i]:
                chosen.append(i)
                free &= ~near[i]
        return ordered.iloc[chosen][[key, "first_idx", "seq"]]

    return spread_evenly(front, key).groupBy(key).applyInPandas(lead, schema=f"{key} {key_type}, first_idx long, seq string")


def _unclaimed(rest: DataFrame, leaders: DataFrame, key: str, key_type: str, threshold: float, block: int) -> DataFrame:
    sizes = rest.groupBy(key).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("_chunks"))
    chunked = rest.join(sizes, key).withColumn("_c", F.pmod(F.xxhash64("seq"), F.col("_chunks")).cast("int")).drop("_chunks")
    copies = leaders.join(sizes, key).withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")

    def keep(rows: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
        if len(rows) and len(heads):
            rows = rows[~(_identity(rows["seq"], heads["seq"]) >= threshold).any(axis=1)]
        return rows[[key, "first_idx", "seq"]]

    return spread_evenly(chunked, key, "_c").groupBy(key, "_c").cogroup(spread_evenly(copies, key, "_c").groupBy(key, "_c")).applyInPandas(
        keep, schema=f"{key} {key_type}, first_idx long, seq string")


def alignment_stats(rows: DataFrame, key: str = "msa_id", cluster_threshold: float = 62.0, neff_threshold: float = 80.0,
                    block: int = BLOCK) -> DataFrame:
    """``(key, nseq, ncol, clusters62, neff80, status, issue)``."""
    sizes = msa_size(rows, key)
    clusters = hobohm_clusters(rows, key, cluster_threshold, block).withColumnRenamed("n_clusters", "clusters62")
    neff = effective_count(rows, key, neff_threshold, block).withColumnRenamed("neff", "neff80")
    return sizes.join(clusters, key, "left").join(neff, key, "left").select(
        key, "nseq", "ncol", "clusters62", "neff80", "status", "issue")
