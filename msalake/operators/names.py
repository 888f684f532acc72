"""Matching requested ids to alignment rows, and row orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import name_variants


def resolve_names(requests: DataFrame, rows: DataFrame, key: str = "msa_id", fallback: bool = False) -> DataFrame:
    """``(key, name, row_idx)``: the row that answers the first matching id of each key.

    ``requests(key, id_ord, id)``, ``rows(key, row_idx, name)``. Both sides meet on name variants; earlier ids,
    then earlier variants win, and a variant shared by rows belongs to the earliest row. With ``fallback`` a key
    without a match gets its first row; otherwise its name is NULL.
    """
    offered = rows.select(key, "row_idx", "name", F.posexplode(name_variants("name")).alias("v_ord", "variant"))
    lookup = offered.groupBy(key, "variant").agg(
        F.min(F.struct("row_idx", "v_ord", "name")).alias("row"))
    asked = requests.select(key, "id_ord", F.posexplode(name_variants("id")).alias("v_ord", "variant"))
    best = asked.join(lookup, [key, "variant"]).groupBy(key).agg(
        F.min_by("row", F.struct("id_ord", "v_ord")).alias("row"))
    out = requests.select(key).distinct().join(best, key, "left")
    if fallback:
        firsts = rows.groupBy(key).agg(F.min(F.struct("row_idx", F.lit(0).alias("v_ord"), "name")).alias("first"))
        out = out.join(firsts, key, "left").withColumn("row", F.coalesce("row", "first"))
    return out.select(key, F.col("row.name").alias("name"), F.col("row.row_idx").alias("row_idx"))


def reorder_like(aligned: DataFrame, source: DataFrame, key: str = "msa_id") -> DataFrame:
    """Aligned rows with the ``rec_idx`` of their source record, and per-key ``status, issue``.

    Row counts must agree and every source name must be aligned.
    """
    joined = source.select(key, "rec_idx", "name").join(aligned.select(key, "name", "seq"), [key, "name"], "left")
    n_source = source.groupBy(key).agg(F.count("*").alias("n_in"))
    n_out = aligned.groupBy(key).agg(F.count("*").alias("n_out"))
    absent = joined.where("seq is null").groupBy(key).agg(F.min_by("name", "rec_idx").alias("absent"))
    checks = n_source.join(n_out, key, "left").join(absent, key, "left").select(
        key,
        F.when(F.coalesce("n_out", F.lit(0)) != F.col("n_in"),
               F.concat(F.lit("The alignment has "), F.coalesce("n_out", F.lit(0)), F.lit(" rows instead of "), "n_in", F.lit(".")))
        .when(F.col("absent").isNotNull(), F.concat(F.lit("The alignment has no row of "), "absent", F.lit("."))).alias("issue"))
    return joined.join(checks, key).select(
        key, "rec_idx", "name", "seq", F.when(F.col("issue").isNull(), "ok").otherwise("error").alias("status"), "issue")


def priority_order(rows: DataFrame, priority: DataFrame, key: str = "msa_id") -> DataFrame:
    """Add ``order_key``: listed names first in list order, then the other rows in their own order.

    The sort key is a struct, so no ranking pass is needed before export.
    """
    listed = priority.groupBy(key, "name").agg(F.min("prio").alias("prio"))
    return rows.join(listed, [key, "name"], "left").withColumn(
        "order_key", F.struct(F.col("prio").isNull().alias("rest"), F.coalesce("prio", F.lit(0)).alias("prio"), "row_idx")
    ).drop("prio")
