"""Query versus reference comparison and the validation row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import col


def compare_pair(query: Column | str, reference: Column | str) -> Column:
    """struct(identical, mismatches, insertions, deletions) of two ungapped sequences; NULL if either is NULL.

    Equal lengths are compared position by position. Otherwise the length difference is the net indel count
    (insertions: the reference is longer) and mismatches are NULL. No pairwise aligner is run.
    """
    q, r = F.upper(col(query)), F.upper(col(reference))
    gap = F.length(r) - F.length(q)
    differing = F.size(F.filter(F.zip_with(F.split(q, ""), F.split(r, ""), lambda a, b: a != b), lambda d: d))
    mismatches = F.when(q == r, 0).when(gap == 0, differing)
    return F.when(q.isNotNull() & r.isNotNull(), F.struct(
        (q == r).alias("identical"), mismatches.cast("long").alias("mismatches"),
        F.greatest(gap, F.lit(0)).cast("long").alias("insertions"),
        F.greatest(-gap, F.lit(0)).cast("long").alias("deletions")))


def comparison_warning(has_expansion: Column) -> Column:
    """Indel text, else substitution text, else NULL, from the ``aln_*`` columns."""
    label = F.when(has_expansion, "Expanded query").otherwise("Seed query")
    indels = (F.coalesce("aln_insertions", F.lit(0)) != 0) | (F.coalesce("aln_deletions", F.lit(0)) != 0)
    return F.when(F.col("aln_identical").isNull(), F.lit(None).cast("string")).when(
        indels, F.concat(label, F.lit(": insertions or deletions against the reference sequence."))).when(
        ~F.col("aln_identical"), F.concat(label, F.lit(": substitutions against the reference sequence.")))


_STATS = ("nseq", "ncol", "clusters62", "neff80")


def validation_rows(
    runs: DataFrame, stats: DataFrame, queries: DataFrame, references: DataFrame, key: str = "run_id"
) -> DataFrame:
    """One row per run: seed and expanded statistics side by side and the final query against the reference.

    ``runs(key, seed_msa, expanded_msa)`` with NULL ``expanded_msa`` when there is no expansion;
    ``stats(msa_id, nseq, ncol, clusters62, neff80)``; ``queries(msa_id, query_name, query_seq)``;
    ``references(key, reference_seq)``. Without a reference the comparison is NULL and the status ``ok``.
    """
    def side(name: str) -> DataFrame:
        return stats.select(F.col("msa_id").alias(f"{name}_msa"), *[F.col(s).alias(f"{name}_{s}") for s in _STATS])

    has_expansion = F.col("expanded_msa").isNotNull()
    joined = runs.join(side("seed"), "seed_msa", "left").join(side("expanded"), "expanded_msa", "left").withColumn(
        "msa_id", F.coalesce("expanded_msa", "seed_msa")).join(queries, "msa_id", "left").join(
        references.select(key, "reference_seq"), key, "left")
    compared = joined.withColumn("_c", compare_pair("query_seq", "reference_seq")).select(
        key, "seed_msa", "expanded_msa", *[f"{side_}_{s}" for s in _STATS for side_ in ("seed", "expanded")],
        F.when(F.col("reference_seq").isNotNull(), F.col("query_name")).alias("query_name"),
        F.col("_c.identical").alias("aln_identical"), F.col("_c.mismatches").alias("aln_mismatches"),
        F.col("_c.insertions").alias("aln_insertions"), F.col("_c.deletions").alias("aln_deletions"))
    warning = comparison_warning(has_expansion)
    return compared.select("*", F.array_compact(F.array(warning)).alias("warnings"),
                           F.when(warning.isNull(), "ok").otherwise("warn").alias("status"))
