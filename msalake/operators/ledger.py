"""What each stage of a run did for each target.

A stage reports ``(target_id, status, issue)``. The ledger keeps the first stage in which a target failed; later stages work on
the targets still open, so a failed target keeps what the stages before it made, and nothing later.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The stages of a run, in order, as result records name them.
STAGES = ("target", "msa", "msa_expansion", "validation")


def entry(stage: str, report: DataFrame, step: int = 0) -> DataFrame:
    """``(target_id, at, stage, issue)`` of the targets that a stage, or one ``step`` of it, failed."""
    at = F.struct(F.lit(STAGES.index(stage)).alias("stage"), F.lit(step).alias("step"))
    return report.where("status = 'error'").select("target_id", at.alias("at"), F.lit(stage).alias("stage"), "issue")


def still_open(targets: DataFrame, entries: list[DataFrame]) -> DataFrame:
    for failed in entries:
        targets = targets.join(failed.select("target_id").distinct(), "target_id", "left_anti")
    return targets


def outcomes(targets: DataFrame, entries: list[DataFrame]) -> DataFrame:
    """``(target_id, failed_stage, issue)`` for every target; NULLs for one that no stage failed."""
    first = reduce(DataFrame.unionByName, entries).groupBy("target_id").agg(F.min_by(F.struct("stage", "issue"), F.struct("at", "issue")).alias("f"))
    return targets.select("target_id").distinct().join(first, "target_id", "left").select(
        "target_id", F.col("f.stage").alias("failed_stage"), F.col("f.issue").alias("issue"))
