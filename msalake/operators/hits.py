"""Homolog hits: cleaning, first-row dedup, new hits, counts and member expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import salted_join
from ..functions.text import first_token, hit_sequence


def clean_hits(hits: DataFrame, name: str = "target", seq: str = "tseq") -> DataFrame:
    """Normalised ``name`` and ``seq``; rows without a name or without a letter are dropped."""
    keep = [c for c in hits.columns if c not in (name, seq)]
    cleaned = hits.select(*keep, first_token(name).alias("name"), hit_sequence(seq).alias("seq"))
    return cleaned.where("name is not null and seq is not null")


def all_hits(cleaned: DataFrame, key: str = "msa_id") -> DataFrame:
    """The first row (``line_no``) of each name per key."""
    return cleaned.groupBy(key, "name").agg(F.min(F.struct("line_no", "seq")).alias("h")).select(
        key, "name", F.col("h.line_no").alias("line_no"), F.col("h.seq").alias("seq"))


def seed_ids(seed_rows: DataFrame, key: str = "msa_id") -> DataFrame:
    return seed_rows.select(key, first_token("name").alias("name")).distinct()


def with_library(hits: DataFrame, libraries: DataFrame, key: str = "msa_id") -> DataFrame:
    """Adds ``library``. Keys that share their seed rows name one library, ``libraries(key, library)``, a row for each key.

    Its seeds are ``(library, name)``, and ``library`` is the key that ``new_hits`` and ``hit_rows`` join them by; they are never
    repeated for each key.
    """
    return hits.join(libraries, key, "left")


def new_hits(hits: DataFrame, seeds: DataFrame, key: str = "msa_id") -> DataFrame:
    return hits.join(seeds, [key, "name"], "left_anti")


def hit_counts(targets: DataFrame, hits: DataFrame, seeds: DataFrame, key: str = "msa_id", by: str | None = None) -> DataFrame:
    """``(key, n_hits, n_new_hits)`` over the raw hit rows; a key without hits gets zeros. ``by`` is what seeds are joined by, if not the key."""
    by = by or key
    marked = hits.select(*dict.fromkeys([key, by]), first_token("name").alias("name")).join(seeds.withColumn("_seed", F.lit(True)), [by, "name"], "left")
    counts = marked.groupBy(key).agg(F.count("*").alias("n_hits"), F.count_if(F.col("_seed").isNull()).alias("n_new_hits"))
    zero = F.lit(0).cast("long")
    return targets.select(key).distinct().join(counts, key, "left").select(
        key, F.coalesce("n_hits", zero).alias("n_hits"), F.coalesce("n_new_hits", zero).alias("n_new_hits"))


def hit_rows(aligned: DataFrame, seeds: DataFrame, key: str = "msa_id") -> DataFrame:
    """Rows of an expanded alignment that are not seed rows."""
    return aligned.withColumn("_id", first_token("name")).join(
        seeds.withColumnRenamed("name", "_id"), [key, "_id"], "left_anti").drop("_id")


def expand_members(centroid_hits: DataFrame, members: DataFrame, key: str = "msa_id", rows_per_salt: int = 1_000_000) -> DataFrame:
    """Every member of each hit centroid's cluster, in hit order then member order.

    ``centroid_hits(key, line_no, name)``, ``members(centroid, member_ord, member, seq)``. Only clusters of hit centroids are
    counted and joined; a large cluster, a centroid that many keys hit, and one that is both are dealt over several tasks.
    """
    hits = centroid_hits.groupBy(key, F.col("name").alias("centroid")).agg(F.min("line_no").alias("line_no"))
    wanted = members.select("centroid", "member_ord", "member", "seq").join(hits.select("centroid").distinct(), "centroid", "left_semi")
    joined = salted_join(hits, wanted, ["centroid"], rows_per_salt)
    return joined.select(key, F.struct("line_no", "member_ord").alias("line_no"), F.col("member").alias("name"), "seq")


def member_counts(centroid_hits: DataFrame, centroids: DataFrame, members: DataFrame, libraries: DataFrame, seeds: DataFrame, number: Column, key: str = "msa_id") -> DataFrame:
    """``(key, n_members, member_sum, n_new)`` of the distinct members that ``expand_members`` lists, without listing them.

    ``centroids(centroid, cluster)`` and ``members(cluster, member)``: centroids of one cluster share its members. A key takes each
    cluster once. Members of one cluster only are counted with it, and so are those that a library holds (``with_library``); members
    of several clusters are listed for each key, as they count once. ``number`` is what ``member_sum`` sums over ``member``.
    """
    met = centroid_hits.select(key, F.col("name").alias("centroid")).join(centroids.select("centroid", "cluster").distinct(), "centroid").select(key, "cluster").distinct()
    members = members.select("cluster", "member").distinct()
    places = members.groupBy("member").agg(F.min("cluster").alias("cluster"), F.count("*").alias("_n"))
    single = places.where("_n = 1").select("cluster", "member")
    shared = members.join(places.where("_n > 1").select("member"), "member", "left_semi")
    known = seeds.select("library", F.col("name").alias("member"), F.lit(1).alias("_known"))
    sizes = single.groupBy("cluster").agg(F.count("*").alias("n_members"), F.sum(number).alias("member_sum"))
    held = single.join(known, "member").groupBy("cluster", "library").agg(F.count("*").alias("_held"))
    whole = with_library(met.join(sizes, "cluster"), libraries, key).join(held, ["cluster", "library"], "left").select(
        key, "n_members", "member_sum", (F.col("n_members") - F.coalesce("_held", F.lit(0))).alias("n_new"))
    listed = with_library(met.join(shared, "cluster").select(key, "member").distinct(), libraries, key).join(known, ["library", "member"], "left").select(
        key, F.lit(1).cast("long").alias("n_members"), number.alias("member_sum"), F.col("_known").isNull().cast("long").alias("n_new"))
    sums = [F.sum(c).alias(c) for c in ("n_members", "member_sum", "n_new")]
    return whole.unionByName(listed).groupBy(key).agg(*sums)
