"""Sample scores, normalisation and the median stability score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import cut_lineage
from ..sources.reports import report_counts, report_facts, report_headers

Normalization = Callable[[DataFrame], tuple[Column, Column, Column]]


def comparable_positions_normalization(scores: DataFrame) -> tuple[Column, Column, Column]:
    """``(normalized, denominator, issue)``: matched positions per hundred comparable ones, 0 when there are none."""
    n, m = F.col("comparable_positions").cast("double"), F.col("matched_positions").cast("double")
    empty = F.col("comparable_positions") == 0
    return (F.when(empty, F.lit(0.0)).otherwise(F.lit(100.0) * m / n), F.when(empty, F.lit(0.0)).otherwise(n),
            F.lit(None).cast("string"))


def self_reference_normalization(scores: DataFrame) -> tuple[Column, Column, Column]:
    """Raw score per hundred of the reference's score against itself (``self_score`` column)."""
    own = F.col("self_score")
    issue = F.when(own.isNull(), "self_reference_normalization requires a reference self score.").when(
        own == 0, "The reference scores 0 against itself, so nothing can be divided by it.")
    return F.when(issue.isNull(), F.lit(100.0) * F.col("raw_score") / F.nullif(own, F.lit(0.0))), own, issue


def no_normalization(scores: DataFrame) -> tuple[Column, Column, Column]:
    return F.col("raw_score"), F.lit(None).cast("double"), F.lit(None).cast("string")


def user_normalization(fn: Callable[[Column, Column], Column | tuple[Column, Column]]) -> Normalization:
    """Wrap ``fn(raw_score, self_score)`` returning a score column, or (score, denominator)."""

    def apply(scores: DataFrame) -> tuple[Column, Column, Column]:
        value = fn(F.col("raw_score"), F.col("self_score"))
        score, denominator = value if isinstance(value, tuple) else (value, F.lit(None).cast("double"))
        return score.cast("double"), denominator.cast("double"), F.lit(None).cast("string")

    return apply


def identity_counts(codes: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, matched_positions, comparable_positions)``: a position matches if any row marks it ``|``.

    Both levels combine before their shuffle, so a hot sample only ever sends one row per position.
    """
    per_position = codes.where("pos <> 0").groupBy(*keys, "pos").agg(F.bool_or(F.col("code") == "|").alias("m"))
    return per_position.groupBy(*keys).agg(
        F.count_if("m").alias("matched_positions"), F.count("*").alias("comparable_positions"))


def score_reports(lines: DataFrame, kind: str = "identity", key: str = "report_id") -> DataFrame:
    """Score records of report texts; ``kind`` is ``identity`` or ``profile``."""
    if kind == "profile":
        headers = report_headers(lines, key)
        issue = F.when(F.col("hhalign_score").isNull(), "The report gives no score.")
        return headers.select(
            key, F.lit("profile").alias("score_name"), F.col("hhalign_score").alias("raw_score"),
            F.lit(None).cast("long").alias("matched_positions"), F.lit(None).cast("long").alias("comparable_positions"),
            "probability", "e_value", "hhalign_score", F.when(issue.isNull(), "ok").otherwise("error").alias("status"),
            issue.alias("issue"))
    if kind != "identity":
        raise ValueError("kind must be identity or profile")
    # A row per report; settled once, so that the lines are made and read twice only.
    facts = cut_lineage(report_facts(lines, key))
    headers, counts = report_headers(lines, key, facts), report_counts(lines, key, facts)
    zero = F.lit(0).cast("long")
    return headers.join(counts, key, "left").select(
        key, F.lit("identity").alias("score_name"), F.coalesce("matched_positions", zero).cast("double").alias("raw_score"),
        F.coalesce("matched_positions", zero).alias("matched_positions"),
        F.coalesce("comparable_positions", zero).alias("comparable_positions"), "probability", "e_value", "hhalign_score",
        F.when(F.col("issue").isNull(), "ok").otherwise("error").alias("status"), "issue")


def column_consensus(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent non-gap residue per column (ties: smallest residue); ``cells(keys, col_idx, residue)``."""
    counts = cells.where(~F.col("residue").isin("-", ".")).groupBy(*keys, "col_idx", "residue").agg(F.count("*").alias("n"))
    return counts.groupBy(*keys, "col_idx").agg(
        F.min(F.struct((-F.col("n")).alias("o"), F.col("residue").alias("residue"))).alias("w")).select(
        *keys, "col_idx", F.col("w.residue").alias("consensus"))


def consensus_score(reference_rows: DataFrame, sample_rows: DataFrame, ref_keys: list[str], sample_keys: list[str]) -> DataFrame:
    """Default score: columns whose sample consensus equals the reference consensus.

    Comparable columns are those with a non-gap reference consensus. Rows are aligned already, so nothing is
    realigned; ``ref_keys`` is a prefix of ``sample_keys``.
    """
    def cells(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.select(*keys, F.posexplode(F.split(F.upper("seq"), "")).alias("col_idx", "residue"))

    reference = column_consensus(cells(reference_rows, ref_keys), ref_keys)
    sample = column_consensus(cells(sample_rows, sample_keys), sample_keys).withColumnRenamed("consensus", "_sample")
    comparable = reference.groupBy(*ref_keys).agg(F.count("*").alias("comparable_positions"))
    matched = sample.join(reference, [*ref_keys, "col_idx"]).groupBy(*sample_keys).agg(
        F.count_if(F.col("_sample") == F.col("consensus")).alias("matched_positions"))
    samples = sample_rows.select(*sample_keys).distinct()
    zero = F.lit(0).cast("long")
    return samples.join(comparable, ref_keys, "left").join(matched, sample_keys, "left").select(
        *sample_keys, F.coalesce("matched_positions", zero).cast("double").alias("raw_score"),
        F.coalesce("matched_positions", zero).alias("matched_positions"),
        F.coalesce("comparable_positions", zero).alias("comparable_positions"))


_OPTIONAL = {"matched_positions": "long", "comparable_positions": "long", "hhalign_score": "double",
             "probability": "double", "e_value": "double", "self_score": "double"}


def sample_scores(
    samples: DataFrame, scores: DataFrame, keys: list[str], normalization: Normalization = comparable_positions_normalization,
    self_scores: DataFrame | None = None, self_keys: list[str] | None = None,
) -> DataFrame:
    """The sample score table.

    ``samples(keys, sample_label, n_sequences_reference, n_sequences_sample)``, ``scores(keys, raw_score, …)``;
    ``self_scores(self_keys, raw_score)`` holds one reference-to-itself score per reference. Samples without a
    score are skipped.
    """
    table = samples.join(scores, keys)
    if self_scores is not None:
        own_keys = self_keys or keys[:-1]
        table = table.join(self_scores.select(*own_keys, F.col("raw_score").alias("self_score")), own_keys, "left")
    for name, dtype in _OPTIONAL.items():
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast(dtype))
    normalized, denominator, issue = normalization(table)
    return table.select(
        *keys, "sample_label", F.col("raw_score").cast("double").alias("raw_score"), denominator.alias("normalization_score"),
        normalized.alias("normalized_score"), normalized.alias("epli_component"), "n_sequences_reference",
        "n_sequences_sample", "matched_positions", "comparable_positions", "hhalign_score", "probability", "e_value",
        F.when(issue.isNull(), "ok").otherwise("error").alias("status"), issue.alias("issue"))


def epli(scores: DataFrame, keys: list[str], component: str = "epli_component") -> DataFrame:
    """Exact median of the components and their number.

    The median is read off each key's sorted rows, which may spill; no key's values are gathered or hashed.
    """
    order = Window.partitionBy(*keys).orderBy("_c")
    placed = scores.where(F.col(component).isNotNull()).select(*keys, F.col(component).cast("double").alias("_c")).select(
        "*", F.row_number().over(order).alias("_rank"), F.lead("_c").over(order).alias("_next"), F.count("*").over(Window.partitionBy(*keys)).alias("_all"))
    # The lower of the two middle rows; the upper one is this or the next.
    upper = F.when(F.col("_all") % 2 == 1, F.col("_c")).otherwise(F.col("_next"))
    return placed.where("_rank = (_all + 1) div 2").select(
        *keys, F.when(F.col("_c") == upper, F.col("_c")).otherwise(F.col("_c") * 0.5 + upper * 0.5).alias("epli"), F.col("_all").alias("n_samples"))


def epli_summary(scores: DataFrame, keys: list[str], count: int, fraction: float, seed: int, score_name: str,
                 normalization_name: str) -> DataFrame:
    return epli(scores, keys).select(
        "*", F.lit(count).alias("sample_count"), F.lit(float(fraction)).alias("sample_fraction"),
        F.lit(seed).cast("decimal(20,0)").alias("sample_seed"), F.lit(score_name).alias("score_function"),
        F.lit(normalization_name).alias("normalization_function"))


def align_samples(rows: DataFrame, keys: list[str], aligner: Callable, schema: str = "name string, seq string") -> DataFrame:
    """User aligner hook: ``aligner(list of (name, seq)) -> list of (name, aligned seq)`` per sample.

    One sample is what an aligner must see at once; samples run in parallel. Check the result with
    ``names.reorder_like``.
    """
    import pandas as pd

    fields = rows.select(*keys).schema
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", " + schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("rec_idx")
        aligned = aligner(list(zip(ordered["name"], ordered["seq"])))
        result = pd.DataFrame(aligned, columns=["name", "seq"])
        for i, key in enumerate(keys):
            result.insert(i, key, pdf[key].iloc[0])
        return result

    return rows.groupBy(*keys).applyInPandas(run, schema=out)
