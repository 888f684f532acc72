"""Sequence cleaning, labels and status words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import col
from .species import strip

# Status words per class.
OK_WORDS = ("ok", "done", "completed")
WARN_WORDS = ("warn", "warning", "warnings")
FAILED_WORDS = ("error", "failed")


def ungap(seq: Column | str) -> Column:
    return F.translate(col(seq), "-.", "")


def query_sequence(seq: Column | str) -> Column:
    return F.upper(ungap(seq))


def first_token(name: Column | str) -> Column:
    """First white-space token; NULL when the name is blank."""
    return F.nullif(F.regexp_extract(col(name), r"^\s*(\S+)", 1), F.lit(""))


def hit_sequence(seq: Column | str) -> Column:
    """Trimmed, ``-`` removed, upper case; NULL when no ASCII letter is left."""
    clean = F.upper(F.translate(strip(seq), "-", ""))
    return F.when(clean.rlike("[A-Za-z]"), clean)


def exon_sequence(seq: Column | str) -> Column:
    """NULL and blank become the empty string; ``*`` is removed."""
    clean = F.translate(F.coalesce(col(seq), F.lit("")), "*", "")
    return F.when(strip(clean) == "", "").otherwise(clean)


def pid_label(pid: Column | str) -> Column:
    return F.format_string("%.1f", F.bround(col(pid).cast("double"), 1))


def pid_key(pid: Column | str) -> Column:
    return F.format_string("pid_%.2f", F.bround(col(pid).cast("double"), 2))


def pid_thresholds_key(pids: Column | str) -> Column:
    """``10.0,20.0``: it stays text, so ``10.0`` never turns into ``10``."""
    return F.array_join(F.transform(col(pids), lambda p: p.cast("double").cast("string")), ",")


def truthy(value: Column | str, dtype: str) -> Column:
    """Booleans as they are, numbers equal to 1, text ``true`` in any case. Text ``1`` is false."""
    value = col(value)
    if dtype == "boolean":
        test = value
    elif dtype == "string":
        test = F.lower(value) == "true"
    else:
        test = value == 1
    return F.coalesce(test, F.lit(False))


def status_class(status: Column | str) -> Column:
    word = F.lower(col(status))
    return (
        F.when(word.isin(*OK_WORDS), "ok")
        .when(word.isin(*WARN_WORDS), "warn")
        .when(word.isin(*FAILED_WORDS), "failed")
        .otherwise("unknown")
    )
