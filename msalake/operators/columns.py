"""Column-level work on alignments: match states, exon codes, projections and code blocks.

Alignments are ``msa_cols(key, col_idx, code, rf, aligned)`` rows with dense 1-based ``col_idx``. Running counts
use spans, so one very wide or very hot alignment does not end in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codemap import MISSING_CODE
from ..functions.ordered import SPAN, running_sum, with_previous


def match_state(default_aligned: bool) -> Column:
    """``aligned`` if present, else ``rf`` (``.``, ``-`` and blank are no match), else the default."""
    return F.coalesce(
        F.when(F.col("aligned").isNotNull(), F.col("aligned") == "1"),
        F.when(F.col("rf").isNotNull(), ~F.col("rf").isin(".", "-", " ")),
        F.lit(default_aligned),
    )


def column_issues(annotations: DataFrame, key: str = "msa_id") -> DataFrame:
    """Length and alphabet checks of ``(key, ncol, codes, rf, aligned)`` annotation lines."""
    def wrong_length(name: str, feature: str) -> Column:
        return F.when(
            F.length(name) != F.col("ncol"),
            F.concat(F.lit(f"{feature} annotation has "), F.length(name), F.lit(" characters, but the MSA has "),
                     "ncol", F.lit(" columns.")))

    issue = F.coalesce(
        wrong_length("codes", "SExonCode"), wrong_length("aligned", "Aligned"), wrong_length("rf", "RF"),
        F.when(F.col("aligned").rlike("[^01]"), "Aligned annotation has characters other than 0 and 1."))
    return annotations.select(key, F.when(issue.isNull(), "ok").otherwise("error").alias("status"), issue.alias("issue"))


def exon_codes(cols: DataFrame) -> DataFrame:
    """Code per column, ``.`` where there is no annotation."""
    return cols.withColumn("code", F.coalesce("code", F.lit(MISSING_CODE)))


def seed_match_codes(seed_cols: DataFrame, keys: list[str], span: int = SPAN) -> DataFrame:
    """``(keys, match_idx, code)``: codes of the seed's match columns, numbered from 1."""
    masked = exon_codes(seed_cols).withColumn("_m", match_state(True))
    counted = running_sum(masked, keys, "col_idx", F.col("_m"), "match_idx", span)
    return counted.where("_m").select(*keys, "match_idx", "code")


def project_codes(cols: DataFrame, seed_codes: DataFrame, keys: list[str], span: int = SPAN) -> DataFrame:
    """The k-th match column gets the k-th seed code; insert columns and columns past the last code get ``.``."""
    masked = cols.drop("code").withColumn("is_match", match_state(False))
    counted = running_sum(masked, keys, "col_idx", F.col("is_match"), "_k", span).withColumn(
        "match_idx", F.when(F.col("is_match"), F.col("_k"))).drop("_k")
    joined = counted.join(seed_codes.select(*keys, "match_idx", "code"), [*keys, "match_idx"], "left")
    return joined.withColumn("code", F.coalesce("code", F.lit(MISSING_CODE)))


def match_columns(projected: DataFrame, keys: list[str]) -> DataFrame:
    """The match-only alignment: match columns renumbered from 1."""
    return projected.where("is_match").drop("col_idx").withColumnRenamed("match_idx", "col_idx").select(
        *keys, "col_idx", "code", F.lit(True).alias("is_match"))


def match_only_rows(rows: DataFrame, cols: DataFrame, key: str = "msa_id") -> DataFrame:
    """``msa_rows`` reduced to their match columns; ``cols`` carries ``is_match``."""
    # The mask is one boolean per column and row work stays in the row, so cells are never exploded.
    flags = F.transform(F.array_sort(F.collect_list(F.struct("col_idx", "is_match"))), lambda c: c["is_match"])
    masks = cols.groupBy(key).agg(flags.alias("_mask"))
    # Joining skips NULLs, so insert columns fall out.
    kept = F.zip_with(F.split("seq", ""), F.coalesce("_mask", F.array().cast("array<boolean>")), lambda c, m: F.when(m, c))
    return rows.join(masks, key, "left").withColumn("seq", F.array_join(kept, "")).drop("_mask")


def column_blocks(cols: DataFrame, keys: list[str], span: int = SPAN) -> DataFrame:
    """Maximal runs of one code: ``(keys, code, start_col, end_col, n_columns)``; ``.`` runs give no row."""
    coded = exon_codes(cols.select(*keys, "col_idx", "code"))
    marked = with_previous(coded, keys, "col_idx", "code", "_prev", span)
    numbered = running_sum(marked, keys, "col_idx", ~F.col("_prev").eqNullSafe(F.col("code")), "_run", span)
    runs = numbered.where(F.col("code") != MISSING_CODE).groupBy(*keys, "_run", "code").agg(
        F.min("col_idx").alias("start_col"), F.max("col_idx").alias("end_col"))
    return runs.drop("_run").withColumn("n_columns", F.col("end_col") - F.col("start_col") + 1)


def block_table(cols: DataFrame, code_map: DataFrame, key: str, alignment: str, pid: str = "pid", span: int = SPAN) -> DataFrame:
    """The typed block table of one alignment label; codes outside the map get an empty exon id.

    ``cols`` carries ``pid`` per alignment.
    """
    blocks = column_blocks(cols, [key, pid], span)
    return blocks.join(code_map.select(key, "code", "s_exon_id"), [key, "code"], "left").select(
        key, F.lit(alignment).alias("alignment"), F.col(pid).alias("pid"), "code",
        F.coalesce("s_exon_id", F.lit("")).alias("s_exon_id"), "start_col", "end_col", "n_columns")


def block_tables(parts: dict[str, DataFrame], code_map: DataFrame, key: str, span: int = SPAN) -> DataFrame:
    """Blocks of several labelled alignments (``expanded_match``, ``expanded_full``, ...) of one seed."""
    return reduce(DataFrame.unionByName, [block_table(c, code_map, key, label, span=span) for label, c in parts.items()])
