"""Transcript alignments from exon segments, and the exon each column came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import strip_version
from ..functions.ordered import SPAN, ranked, running_sum
from ..functions.text import exon_sequence

# Characters a column code may not use, and the ranges codes are drawn from.
RESERVED_SYMBOLS = " \t\n\r\v\f\\*>\"',-_/;#$.&!@[]"
SYMBOL_RANGES = ((33, 126), (0x00BC, 0x017F))
FALLBACK_SYMBOLS = [
    chr(c) for first, last in SYMBOL_RANGES for c in range(first, last + 1) if chr(c) not in RESERVED_SYMBOLS
]

QUERY_ONLY_PREFIX = "0_"


def _ok(issue: Column) -> Column:
    return F.when(issue.isNull(), "ok").otherwise("error").alias("status")


def path_exons(paths: DataFrame, keys: list[str], path: str = "path") -> DataFrame:
    """``(keys, exon_ord, s_exon_id)`` of a ``start/…/stop`` path."""
    exons = F.filter(F.split(path, "/"), lambda e: ~e.isin("", "start", "stop"))
    return paths.select(*keys, F.posexplode(exons).alias("exon_ord", "s_exon_id"))


def transcript_paths(requests: DataFrame, path_table: DataFrame) -> DataFrame:
    """Path of each requested transcript; exactly one table row may name it.

    ``requests(target_id, transcript_id)``, ``path_table(TranscriptIDCluster, Path)``, optionally keyed by
    ``target_id`` too when each target has its own table.
    """
    shared = ["target_id"] if "target_id" in path_table.columns else []
    rows = path_table.withColumn("_row", F.xxhash64(*path_table.columns, F.monotonically_increasing_id()))
    tokens = rows.select(*shared, "_row", "Path", F.explode(F.array_distinct(F.split("TranscriptIDCluster", "/"))).alias("token"))
    asked = requests.select("target_id", "transcript_id", F.explode(
        F.array_distinct(F.array("transcript_id", strip_version("transcript_id")))).alias("token"))
    found = asked.join(tokens, [*shared, "token"]).groupBy("target_id", "transcript_id").agg(
        F.min("_row").alias("_a"), F.max("_row").alias("_b"), F.min("Path").alias("path"))
    name = F.col("transcript_id")
    issue = F.when(F.col("_a").isNull(), F.concat(F.lit("Transcript "), name, F.lit(" has no path."))).when(
        F.col("_a") != F.col("_b"), F.concat(F.lit("Transcript "), name, F.lit(" has more than one path."))).when(
        F.size(F.filter(F.split("path", "/"), lambda e: ~e.isin("", "start", "stop"))) == 0,
        F.concat(F.lit("There is no exon on the path of "), name, F.lit(".")))
    return requests.select("target_id", "transcript_id").join(found, ["target_id", "transcript_id"], "left").select(
        "target_id", "transcript_id", F.when(issue.isNull(), F.col("path")).alias("path"), _ok(issue), issue.alias("issue"))


def query_only_sequences(wanted: DataFrame, s_exon_table: DataFrame) -> DataFrame:
    """Sequence of exons that have no alignment of their own: ``(target_id, s_exon_id, seq, status, issue)``.

    ``wanted(target_id, s_exon_id, gene_id, transcript_id)``. All matching table rows must agree after cleaning.
    """
    shared = ["target_id"] if "target_id" in s_exon_table.columns else []
    table = s_exon_table.select(
        *shared, F.col("S_exonID").alias("s_exon_id"), strip_version("GeneID").alias("_gene"),
        F.explode(F.array_distinct(F.split("TranscriptIDCluster", "/"))).alias("_token"),
        exon_sequence("S_exon_Sequence").alias("seq"))
    asked = wanted.select(
        "target_id", "s_exon_id", strip_version("gene_id").alias("_gene"),
        F.explode(F.array_distinct(F.array("transcript_id", strip_version("transcript_id")))).alias("_token"))
    found = asked.join(table, [*shared, "s_exon_id", "_gene", "_token"]).groupBy("target_id", "s_exon_id").agg(
        F.min("seq").alias("seq"), F.max("seq").alias("_last"))
    issue = F.when(F.col("seq").isNull(), F.concat(F.lit("The exon table has no sequence of "), "s_exon_id", F.lit("."))).when(
        F.col("seq") != F.col("_last"), F.concat(F.lit("The exon table has several sequences of "), "s_exon_id", F.lit(".")))
    return wanted.select("target_id", "s_exon_id").distinct().join(found, ["target_id", "s_exon_id"], "left").select(
        "target_id", "s_exon_id", F.when(issue.isNull(), F.col("seq")).alias("seq"), _ok(issue), issue.alias("issue"))


def exon_segments(exons: DataFrame, exon_rows: DataFrame, query_only: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segment rows in path order and per-target issues.

    ``exons(target_id, exon_ord, s_exon_id)``, ``exon_rows(target_id, s_exon_id, row_idx, name, seq)``,
    ``query_only(target_id, s_exon_id, seq, issue)``, ``genes(target_id, gene_id)``. A missing exon alignment is
    allowed for query-only ids; an empty one is skipped.
    """
    have = exon_rows.select("target_id", "s_exon_id").distinct().withColumn("_have", F.lit(True))
    tagged = exons.join(have, ["target_id", "s_exon_id"], "left")
    # Alignments know one gap character, so ``.`` of the exon files is read as ``-``.
    own = tagged.where("_have").drop("_have").join(exon_rows, ["target_id", "s_exon_id"]).select(
        "target_id", "exon_ord", "s_exon_id", "row_idx", "name", F.translate("seq", ".", "-").alias("seq"))
    absent = tagged.where("_have is null").drop("_have").join(
        query_only.select("target_id", "s_exon_id", "seq", F.col("issue").alias("_issue")), ["target_id", "s_exon_id"], "left")
    filled = absent.where(F.col("s_exon_id").startswith(QUERY_ONLY_PREFIX) & (F.col("seq") != "")).join(genes, "target_id").select(
        "target_id", "exon_ord", "s_exon_id", F.lit(1).cast("long").alias("row_idx"), strip_version("gene_id").alias("name"), "seq")
    problem = F.when(~F.col("s_exon_id").startswith(QUERY_ONLY_PREFIX),
                     F.concat(F.lit("There is no alignment of exon "), "s_exon_id", F.lit("."))).otherwise(F.col("_issue"))
    issues = absent.withColumn("p", problem).where("p is not null").groupBy("target_id").agg(
        F.min_by("p", "exon_ord").alias("issue"))
    return own.withColumn("row_idx", F.col("row_idx").cast("long")).unionByName(filled), issues


def assemble(segments: DataFrame, key: str = "target_id", seg: str = "exon_ord") -> tuple[DataFrame, DataFrame]:
    """Join the segments of each key into rows, by name, in segment order.

    ``segments(key, seg, row_idx, name, seq)``. Returns ``(key, row_idx, name, seq)`` and ``(key, status, issue)``.
    A row absent from a segment is padded with gaps. A later segment that shares no name with the rows before it
    is an error, and so are rows of unequal width in one segment. Of rows that repeat a name in a segment the first counts.
    Rows are ordered by first appearance (segment, row).
    """
    # Hot targets stay spread: rows meet the short width list of their target instead of a names x segments product.
    segments = segments.groupBy(key, seg, "name").agg(F.min_by("seq", "row_idx").alias("seq"), F.min("row_idx").alias("row_idx"))
    widths = segments.groupBy(key, seg).agg(F.max(F.length("seq")).alias("width"), F.min(F.length("seq")).alias("least"))
    layout = widths.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(seg).alias("s"), "width"))).alias("_layout"), F.bool_or(F.col("least") < F.col("width")).alias("_ragged"))
    named = segments.groupBy(key, "name").agg(
        F.min(F.struct(F.col(seg).alias("s"), "row_idx")).alias("_first"),
        F.collect_list(F.struct(F.col(seg).alias("s"), "seq")).alias("_parts"))
    rows = named.join(layout, key).select(
        key, "name", "_first",
        F.array_join(F.transform("_layout", lambda w: F.coalesce(
            F.try_element_at(F.map_from_entries("_parts"), w["s"]),
            F.repeat(F.lit("-"), w["width"]))), "").alias("seq"))
    # Segment numbers in the bucket keep each ranking window to the names first seen in one segment.
    ordered = ranked(rows, [key], F.col("_first.s"), [F.col("_first.row_idx"), F.col("name")], "row_idx").select(
        key, "row_idx", "name", "seq")
    # A segment is linked when one of its names was seen before; all but the first segment must be.
    later = F.filter(F.transform("_parts", lambda p: p["s"]), lambda s: s > F.col("_first.s"))
    linked = named.select(key, F.explode(later).alias("_s")).distinct().groupBy(key).agg(F.count("*").alias("_linked"))
    issue = F.when(F.col("_ragged"), "Rows of a segment differ in width.").when(F.size("_layout") - 1 > F.coalesce("_linked", F.lit(0)), "A segment has no row in common with those before it.")
    report = layout.join(linked, key, "left").select(key, _ok(issue), issue.alias("issue"))
    return ordered, report


def species_of_rows(rows: DataFrame, s_exon_table: DataFrame | None, key: str = "target_id") -> DataFrame:
    """Add ``species`` by gene name, the last table row wins; ``unknown`` without a match or a table.

    ``s_exon_table(GeneID, Species, row_no)``, optionally keyed.
    """
    if s_exon_table is None:
        return rows.withColumn("species", F.lit("unknown"))
    shared = [key] if key in s_exon_table.columns else []
    lookup = s_exon_table.groupBy(*shared, F.col("GeneID").alias("name")).agg(F.max_by("Species", "row_no").alias("species"))
    return rows.join(lookup, [*shared, "name"], "left").withColumn("species", F.coalesce("species", F.lit("unknown")))


def complete_code_map(code_map: DataFrame, exons: DataFrame, key: str = "target_id") -> tuple[DataFrame, DataFrame]:
    """Give query-only exons without a symbol the first unused symbols, in path order.

    ``code_map(key, code, s_exon_id)``, ``exons(key, exon_ord, s_exon_id)``. Returns the whole map and
    ``(key, issue)`` for exons that may not lack a symbol. The alphabet is fixed, so unused symbols are one short
    array per target.
    """
    used = code_map.groupBy(key).agg(F.collect_set("code").alias("_used"))
    positions = exons.groupBy(key, "s_exon_id").agg(F.min("exon_ord").alias("exon_ord"))
    lacking = positions.join(code_map.select(key, "s_exon_id").distinct(), [key, "s_exon_id"], "left_anti")
    bad = lacking.where(~F.col("s_exon_id").startswith(QUERY_ONLY_PREFIX)).groupBy(key).agg(
        F.concat(F.lit("No symbol for "), F.min_by("s_exon_id", "exon_ord"), F.lit(".")).alias("issue"))
    alphabet = F.array(*[F.lit(s) for s in FALLBACK_SYMBOLS])
    wanted = lacking.where(F.col("s_exon_id").startswith(QUERY_ONLY_PREFIX)).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("exon_ord", "s_exon_id"))).alias("_wanted"))
    given = wanted.join(used, key, "left").select(
        key, F.array_except(alphabet, F.coalesce("_used", F.array().cast("array<string>"))).alias("_free"),
        F.posexplode("_wanted").alias("_i", "w"))
    new = given.select(key, F.get("_free", F.col("_i")).alias("code"), F.col("w.s_exon_id").alias("s_exon_id"))
    out_of_symbols = new.where("code is null").groupBy(key).agg(
        F.concat(F.lit("All symbols are taken, none is left for "), F.min("s_exon_id"), F.lit(".")).alias("issue"))
    return code_map.select(key, "code", "s_exon_id").unionByName(new.where("code is not null")), bad.unionByName(out_of_symbols)


def project_symbols(
    references: DataFrame, symbols: DataFrame, code_map: DataFrame, key: str = "target_id", span: int = SPAN
) -> tuple[DataFrame, DataFrame]:
    """Exon code per column of the assembled alignment.

    ``references(key, exon_ord, s_exon_id, seq)`` is the reference row of each segment, ``symbols(key, symbols)``
    the per-residue symbols of the transcript. ``.`` gives ``.``; ``-`` gives the exon symbol; any other residue
    consumes one transcript symbol, which must belong to this exon if it is mapped at all.
    Returns ``(key, col_idx, code)`` and ``(key, status, issue)``.
    """
    # Two running sums in one: columns in the high half, residues in the low half. Cells are laid out only for the result itself.
    residues = F.length(F.translate("seq", ".-", ""))
    placed = running_sum(references, [key], "exon_ord", F.length("seq").cast("long") * F.lit(1 << 32) + residues, "_end", span).drop("exon_ord")
    # A map has one entry for each character of an alphabet. Codes and checks read the same columns, so that Spark shuffles them once.
    alphabet = code_map.groupBy(key).agg(F.collect_list(F.struct("code", "s_exon_id")).alias("_map"))
    own_codes = F.transform(F.filter("_map", lambda m: m["s_exon_id"] == F.col("s_exon_id")), lambda m: m["code"])
    coded = placed.join(alphabet, key, "left").withColumn("_exon_code", F.explode_outer(own_codes))
    cells = coded.select(key, "_exon_code", (F.shiftright("_end", 32) - F.length("seq")).alias("_offset"), F.posexplode_outer(F.split("seq", "")).alias("_p", "residue"))
    codes = cells.where("residue <> ''").select(
        key, (F.col("_offset") + F.col("_p") + 1).alias("col_idx"), F.when(F.col("residue") == ".", ".").otherwise(F.col("_exon_code")).alias("code"))

    joined = coded.join(symbols.select(key, "symbols"), key, "left").withColumn("_n", residues).withColumn("_from", F.col("_end").bitwiseAND(0xFFFFFFFF) - residues)
    own = F.substring(F.col("symbols"), (F.col("_from") + 1).cast("int"), F.col("_n").cast("int"))
    exon_of = lambda c: F.array_max(F.transform(F.filter("_map", lambda m: m["code"] == c), lambda m: m["s_exon_id"]))
    foreign = F.exists(F.array_distinct(F.split(own, "")), lambda c: F.coalesce(exon_of(c) != F.col("s_exon_id"), F.lit(False)))
    # Where a segment has a residue or a column, its end grows with its place.
    checks = joined.groupBy(key).agg(
        F.sum("_n").alias("_need"), F.max(F.length("symbols")).alias("_have"),
        F.min_by("s_exon_id", F.when(F.col("_exon_code").isNull() & (F.col("seq") != ""), F.col("_end"))).alias("_unmapped"),
        F.min_by("s_exon_id", F.when((F.col("_n") > 0) & foreign, F.col("_end"))).alias("_mismatch"))
    need = F.coalesce("_need", F.lit(0))
    issue = (
        F.when(F.col("_unmapped").isNotNull(), F.concat(F.lit("No symbol for "), "_unmapped", F.lit(".")))
        .when(F.col("_mismatch").isNotNull(), F.concat(F.lit("A residue's symbol belongs to another exon than "), "_mismatch", F.lit(".")))
        .when(F.col("_have") < need, "There are fewer symbols than residues in the reference row.")
        .when(F.col("_have") > need, "There are more symbols than residues in the reference row.")
    )
    return codes, checks.select(key, _ok(issue), issue.alias("issue"))
