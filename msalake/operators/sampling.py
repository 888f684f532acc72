"""Species universes and repeatable subsamples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import ranked
from ..functions.text import ungap

LOW_COMMON_SPECIES = 6  # Fixed value: a common universe this small draws a warning.


def validate_sampling(count: int, fraction: float, seed: int, strategy: str = "independent") -> None:
    if count < 0:
        raise ValueError("sample count must be non-negative")
    if not 0.0 < fraction <= 1.0:
        raise ValueError("sample fraction must be greater than 0 and at most 1")
    if seed < 0:
        raise ValueError("sample seed must be non-negative")
    if strategy not in ("independent", "common", "input"):
        raise ValueError("strategy must be independent, common or input")


def candidate_species(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct species of each candidate with ``ord`` of first sight."""
    return rows.where("species is not null and species <> ''").groupBy(*keys, "species").agg(F.min("row_idx").alias("ord"))


def common_universe(species: DataFrame, candidates: DataFrame, target: str = "target_id", cand: str = "pid_order") -> DataFrame:
    """Species present in every eligible candidate, in the order of the first one.

    ``species(target, cand, species, ord)``, ``candidates(target, cand, eligible)``. An N-way intersection is a count
    per (target, species) compared with the number of eligible candidates.
    """
    eligible = candidates.where("eligible").select(target, cand).distinct()
    totals = eligible.groupBy(target).agg(F.count("*").alias("n_candidates"))
    seen = species.join(eligible, [target, cand], "left_semi").groupBy(target, "species").agg(
        F.count("*").alias("n"), F.min_by("ord", cand).alias("ord"))
    return seen.join(totals, target).where("n = n_candidates").select(target, "ord", "species")


def universe_report(universe: DataFrame, references: DataFrame, strategy: str, target: str = "target_id") -> DataFrame:
    """``(target, n_species, status, warning, issue)``: the reference species must be in its universe."""
    sizes = universe.groupBy(target).agg(F.count("*").alias("n_species"))
    has_ref = universe.join(references.select(target, F.col("species")), [target, "species"], "left_semi").select(target).distinct().withColumn("_ref", F.lit(True))
    joined = references.join(sizes, target, "left").join(has_ref, target, "left")
    n = F.coalesce("n_species", F.lit(0))
    if strategy == "common":
        issue = F.when(F.col("_ref").isNull(), "The candidates that may be sampled have no reference species in common.")
        warning = F.when(n <= LOW_COMMON_SPECIES, "Few species are common to all candidates.")
    else:
        issue = F.when(F.col("_ref").isNull(), F.concat(
            F.lit("The reference's species, "), "species", F.lit(", is not among those to sample from.")))
        warning = F.lit(None).cast("string")
    return joined.select(
        target, n.alias("n_species"),
        F.when(issue.isNotNull(), "error").when(warning.isNotNull(), "warn").otherwise("ok").alias("status"),
        F.when(issue.isNull(), warning).alias("warning"), issue.alias("issue"))


def sample_label(index: Column | str, prefix: str = "subset") -> Column:
    """``prefix_001``: at least three digits, never fewer than the number has."""
    number = F.col(index) if isinstance(index, str) else index
    return F.format_string("%s_%03d", F.lit(prefix), number.cast("long"))


def draw_samples(
    members: DataFrame, keys: list[str], member: str, is_reference: Column, count: int, fraction: float, seed: int,
    prefix: str = "subset",
) -> DataFrame:
    """``(keys, sample, sample_label, draw, member)``: ``count`` samples without replacement per key.

    The reference is draw 0 of every sample. Of the ``n`` others, ``clamp(round_half_even(fraction * n), 1, n)``
    are drawn in the order of ``md5(seed|sample|member)``, so a sample depends on nothing but its key and seed.
    The rank is exact but never sorts a whole group: digests are split by their leading hex digits, and only the
    bucket counts are accumulated per sample.
    """
    validate_sampling(count, fraction, seed)
    flagged = members.select(*keys, member, is_reference.alias("_ref"))
    others = flagged.where(~F.col("_ref"))
    sizes = others.groupBy(*keys).agg(F.count("*").alias("_n"))
    keep = F.greatest(F.lit(1).cast("long"), F.least(F.col("_n"), F.bround(F.lit(float(fraction)) * F.col("_n").cast("double")).cast("long")))
    each = F.explode(F.sequence(F.lit(1), F.lit(count))).alias("sample")
    if count == 0:
        return flagged.limit(0).select(*keys, F.lit(0).alias("sample"), F.lit("").alias("sample_label"), F.lit(0).cast("long").alias("draw"), member)
    keyed = others.select(*keys, member, each).withColumn(
        "_h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("sample").cast("string"), F.col(member).cast("string"))))
    drawn = ranked(keyed, [*keys, "sample"], F.substring("_h", 1, 3), [F.col("_h"), F.col(member)], "draw").join(
        sizes.select(*keys, keep.alias("_keep")), keys).where("draw <= _keep")
    references = flagged.where("_ref").select(*keys, member, each).withColumn("draw", F.lit(0).cast("long"))
    both = drawn.select(*keys, "sample", "draw", member).unionByName(references.select(*keys, "sample", "draw", member))
    return both.select(*keys, "sample", sample_label("sample", prefix).alias("sample_label"), "draw", member)


def link_samples(samples: DataFrame, candidates: DataFrame, target: str = "target_id", cand: str = "pid_order") -> DataFrame:
    """Give every eligible candidate of a target the target's shared samples."""
    return candidates.where("eligible").select(target, cand).join(samples, target)


def materialise_samples(samples: DataFrame, rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Ungapped sequences of the sampled rows; ``rows`` carries the keys, ``member``, ``name`` and ``seq``."""
    return samples.join(rows, [*keys, member]).withColumn("seq", ungap("seq"))
