"""Line deduplication by the number of distinct sites that show a line.

Each line has a HyperLogLog sketch of its sites; the sketches merge by aggregation. A line whose estimate is below half the
threshold cannot be boilerplate and one above twice the threshold is; lines between get an exact distinct count.

Defined results: a line is compared after trimming white space; an empty one is never removed. NULL text stays NULL and has no
lines; a NULL site is a site of its own. Each row is cleaned by its own lines, whether its id is NULL, repeated or neither: rows
get a written key of their own, and ids are not read. Removed lines vanish with their line break. All columns of the input come back, with ``text`` and ``n_chars`` (where present) renewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import settled

MIN_SITES = 10


def _lines(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """One row for each non-empty line: document, position, 128 bits of the line, site."""
    split = docs.select(F.col(key).alias("_key"), F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("none")).alias("_site"),
                        F.posexplode(F.split(F.col(text), "\n")).alias("_pos", "_line"))
    trimmed = split.withColumn("_line", F.regexp_replace("_line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")).where("_line <> ''")
    return trimmed.select("_key", "_pos", "_site", F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit("line"), "_line").alias("_h2"))


def boilerplate(docs: DataFrame, *, key: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``(_key, _pos)`` of every line shown by ``min_sites`` distinct sites or more."""
    lines = _lines(docs, key, text, site)
    spread = lines.groupBy("_h1", "_h2").agg(F.approx_count_distinct("_site", 0.13).alias("_about")).where(F.col("_about") >= min_sites / 2)
    # Written first, so that the join below shuffles both sides itself and Spark may split a line that is everywhere.
    maybe = settled(lines.join(settled(spread), ["_h1", "_h2"]))
    exact = (
        maybe.where(F.col("_about") <= 2 * min_sites).groupBy("_h1", "_h2", "_site").agg(F.lit(1).alias("_one"))
        .groupBy("_h1", "_h2").agg(F.count("*").alias("_sites")).where(F.col("_sites") >= min_sites).select("_h1", "_h2")
    )
    near = maybe.where(F.col("_about") <= 2 * min_sites).join(exact, ["_h1", "_h2"], "left_semi")
    return maybe.where(F.col("_about") > 2 * min_sites).select("_key", "_pos").unionAll(near.select("_key", "_pos")).distinct()


def clean(docs: DataFrame, *, text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` without boilerplate lines, and ``n_lines``, ``n_removed``."""
    rows = settled(docs.withColumn("_row", F.monotonically_increasing_id()))
    gone = boilerplate(rows, key="_row", text=text, site=site, min_sites=min_sites)
    # A list of one document's own lines: bounded by its text.
    marks = gone.groupBy("_key").agg(F.map_from_entries(F.collect_set(F.struct(F.col("_pos"), F.lit(True)))).alias("_gone"))
    # A merge join at every size: the plan for whole texts does not change with the number of marks.
    joined = rows.join(marks.hint("merge"), F.col("_row") == F.col("_key"), "left").drop("_key", "_row").withColumn("_lines", F.split(F.col(text), "\n"))
    flags = joined.withColumn("_flags", F.when(F.col("_gone").isNotNull(), _flags()))
    kept = F.filter(F.zip_with("_lines", "_flags", lambda x, f: F.when(~f, x)), lambda x: x.isNotNull())
    out = flags.withColumn("n_lines", F.coalesce(F.size("_lines"), F.lit(0)).cast("long")).withColumn(
        "n_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("long")).withColumn(
        text, F.when(F.col("_flags").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_flags").isNotNull(), F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return out.drop("_lines", "_gone", "_flags")


def _flags():
    """One truth value per line, in one pass over the sorted removed positions."""
    gone = F.array_sort(F.map_keys("_gone"))
    before = F.concat(F.array(F.lit(-1)), gone)
    after = F.concat(gone, F.array(F.size("_lines")))
    return F.slice(F.flatten(F.zip_with(before, after, lambda a, b: F.concat(
        F.array_repeat(F.lit(False), b - a - 1), F.array(F.lit(True))))), F.lit(1), F.size("_lines"))
