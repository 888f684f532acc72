"""Text form of the exon code map: ``"a"=>"1_0","b"=>"2_0"``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ids import col

MISSING_CODE = "."
_QUOTED = r'"((?:[^"\\]|\\.)*)"'
PAIR_PATTERN = _QUOTED + "=>" + _QUOTED
# Possessive form for the whole-text check, so long maps never backtrack.
_WHOLE_PATTERN = r'^(?:,*+"(?:[^"\\]++|\\.)*+"=>"(?:[^"\\]++|\\.)*+")*+$'


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def code_map_entries(raw: Column | str) -> Column:
    """array<struct<code, s_exon_id>> in text order."""
    codes = F.regexp_extract_all(col(raw), F.lit(PAIR_PATTERN), F.lit(1))
    ids = F.regexp_extract_all(col(raw), F.lit(PAIR_PATTERN), F.lit(2))
    return F.zip_with(codes, ids, lambda c, i: F.struct(_unescape(c).alias("code"), _unescape(i).alias("s_exon_id")))


def code_map_issue(raw: Column | str) -> Column:
    """NULL for a well-formed map (or no map), else the reason."""
    entries = code_map_entries(raw)
    return (
        F.when(~col(raw).rlike(_WHOLE_PATTERN), "Invalid code map entry; expected quoted code=>s_exon_id pairs.")
        .when(F.exists(entries, lambda e: F.length(e["code"]) != 1), "A code must be exactly one character.")
        .when(F.exists(entries, lambda e: e["code"] == MISSING_CODE),
              ". is reserved for columns without s-exon provenance.")
    )


def explode_code_map(maps: DataFrame, key: str, raw: str) -> DataFrame:
    """``(key, code, s_exon_id)`` of well-formed maps; a repeated code keeps its last id."""
    rows = maps.where(code_map_issue(raw).isNull()).select(key, F.posexplode(code_map_entries(raw)).alias("ord", "e"))
    return rows.groupBy(key, F.col("e.code").alias("code")).agg(F.max_by("e.s_exon_id", "ord").alias("s_exon_id"))


def format_code_map(entries: Column | str) -> Column:
    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\$])', r"\\$1"), F.lit('"'))

    return F.array_join(
        F.transform(col(entries), lambda e: F.concat(quoted(e["code"]), F.lit("=>"), quoted(e["s_exon_id"]))), ","
    )
