"""Outputs of an expanded alignment, at the level of all hits or of their centroids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codemap import format_code_map
from ..functions.ordered import cut_lineage
from ..sources.stockholm import CODE_FEATURE, CODE_MAP_FEATURE
from . import columns, names


def level_alignment(seed_rows: DataFrame, seed_cols: DataFrame, new_hits: DataFrame, aligned_rows: DataFrame,
                    aligned_cols: DataFrame, key: str = "msa_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows and columns that a level's outputs are made of, and ``(key, issue)`` of seeds that lack theirs.

    A seed with new hits takes its alignment with them; one without keeps its own rows and columns. New hits without an
    aligned row are an issue.
    """
    grown = new_hits.select(key).distinct()
    here = aligned_rows.select(key).distinct()
    kept = seed_rows.select(key).distinct().join(grown, key, "left_anti")
    fields, cells = [key, "row_idx", "name", "seq"], [key, "pid", "col_idx", "rf", "aligned"]
    rows = aligned_rows.select(*fields).join(grown, key, "left_semi").unionByName(seed_rows.select(*fields).join(kept, key, "left_semi"))
    cols = aligned_cols.select(*cells).join(grown, key, "left_semi").unionByName(seed_cols.select(*cells).join(kept, key, "left_semi"))
    lacking = grown.join(here, key, "left_anti").select(key, F.lit("New hits of the seed have no alignment.").alias("issue"))
    return rows, cols, lacking


def restored_outputs(rows: DataFrame, cols: DataFrame, seed_codes: DataFrame, priority: DataFrame, key: str = "msa_id") -> dict[str, DataFrame]:
    """``full_rows, match_rows, full_cols, match_cols`` of one level: seed rows first, the archived seed codes on the match columns.

    ``seed_codes`` are those of ``columns.seed_match_codes``: the k-th match column of any level gets the k-th code.
    """
    keys = [key, "pid"]
    full = cut_lineage(columns.project_codes(cols, seed_codes, keys))  # read by the mask, both column tables and the blocks
    return {"full_rows": names.priority_order(rows, priority, key),
            "match_rows": names.priority_order(columns.match_only_rows(rows, full, key), priority, key),
            "full_cols": full, "match_cols": columns.match_columns(full, keys)}


def annotated(rows: DataFrame, cols: DataFrame, code_map: DataFrame, key: str = "msa_id") -> DataFrame:
    """Rows with their restored exon annotation in the form that the Stockholm sink takes.

    ``rows`` carry ``order_key``: listed rows come in list order, the others behind them in row order.
    """
    place = F.when(F.col("order_key.rest"), F.col("order_key.row_idx") + (1 << 40)).otherwise(F.col("order_key.prio"))
    sequence = rows.select(key, F.lit("seq").alias("kind"), F.col("name").alias("seq_name"), F.lit(None).cast("string").alias("feature"),
                           place.cast("long").alias("ord"), F.col("seq").alias("value"))
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_idx", "code"))), lambda c: c["code"]), "")
    entries = F.array_sort(F.collect_list(F.struct("code", "s_exon_id")))

    def annotation(kind: str, feature: str, value: DataFrame) -> DataFrame:
        return value.select(key, F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("seq_name"), F.lit(feature).alias("feature"), F.lit(0).cast("long").alias("ord"), "value")

    return sequence.unionByName(annotation("GC", CODE_FEATURE, cols.groupBy(key).agg(codes.alias("value")))).unionByName(
        annotation("GF", CODE_MAP_FEATURE, code_map.groupBy(key).agg(format_code_map(entries).alias("value"))))
