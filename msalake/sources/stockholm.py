"""Stockholm, A3M and format-dispatched alignment scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import running_sum
from ..functions.species import strip
from .text import read_lines

# The exon provenance annotations of an alignment.
CODE_FEATURE = "SExonCode"
CODE_MAP_FEATURE = "SExonCodeMap"

HEADER = "# STOCKHOLM 1.0"


def classify_lines(lines: DataFrame) -> DataFrame:
    """Add ``kind, seq_name, feature, value``; header, terminator, blank and short lines are dropped.

    Kinds: ``comment``, ``GF``, ``GS``, ``GC``, ``GR``, ``seq``.
    """
    line, text = F.col("line"), strip("line")
    kind = (
        F.when(line.rlike("^#=G[FSCR]"), F.substring(line, 3, 2))
        .when(line.startswith("#"), "comment")
        .otherwise("seq")
    )
    tagged = lines.where(~((text == "") | text.startswith(HEADER[:11]) | text.startswith("//"))).withColumn("kind", kind)
    per_file, per_row = F.split(line, r"\s+", 3), F.split(line, r"\s+", 4)
    row = F.split(text, r"\s+", 2)
    k = F.col("kind")
    file_kind, row_kind = k.isin("GF", "GC"), k.isin("GS", "GR")
    value = (
        F.when(k == "comment", text)
        .when(file_kind, F.get(per_file, F.lit(2)))
        .when(row_kind, F.get(per_row, F.lit(3)))
        .otherwise(F.get(row, F.lit(1)))
    )
    parsed = tagged.select(
        "*",
        F.when(row_kind, F.get(per_row, F.lit(1))).when(k == "seq", row[0]).alias("seq_name"),
        F.when(file_kind, F.get(per_file, F.lit(1))).when(row_kind, F.get(per_row, F.lit(2))).alias("feature"),
        F.when(k.isin("GC", "GR", "seq"), F.translate(value, " ", "")).otherwise(value).alias("value"),
    )
    return parsed.where(F.col("value").isNotNull() & (F.col("value") != "")).drop("line")


def normalize_annotations(lines: DataFrame, key: str = "source") -> DataFrame:
    """``(key, kind, seq_name, feature, ord, value)``: fragments of a row are joined in line order.

    GF, GS and comment lines stay one row each; ``ord`` is the first line of the record.
    """
    parsed = classify_lines(lines)
    joined_kinds = F.col("kind").isin("GC", "GR", "seq")
    fragments = parsed.where(joined_kinds).groupBy(key, "kind", "seq_name", "feature").agg(
        F.min("line_no").alias("ord"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda p: p["value"]), "").alias("value"),
    )
    singles = parsed.where(~joined_kinds).select(key, "kind", "seq_name", "feature", F.col("line_no").alias("ord"), "value")
    return fragments.unionByName(singles).select(key, "kind", "seq_name", "feature", "ord", "value")


def strip_provenance(lines: DataFrame, key: str = "source") -> DataFrame:
    """Drop the exon provenance lines; add a header or terminator line where the file has none.

    Added lines get ``line_no`` 0 and last + 1.
    """
    line = F.col("line")
    provenance = line.startswith(f"#=GC {CODE_FEATURE}") | line.startswith(f"#=GF {CODE_MAP_FEATURE}")
    ends = lines.groupBy(key).agg(
        F.min_by("line", "line_no").alias("first"), F.max_by("line", "line_no").alias("last"),
        F.max("line_no").alias("n"),
    )
    header = ends.where(~strip("first").startswith(HEADER[:11])).select(key, F.lit(0).cast("long").alias("line_no"), F.lit(HEADER).alias("line"))
    closing = ends.where(strip("last") != "//").select(key, (F.col("n") + 1).alias("line_no"), F.lit("//").alias("line"))
    kept = lines.where(~provenance).select(key, F.col("line_no").cast("long").alias("line_no"), "line")
    return kept.unionByName(header).unionByName(closing)


def alignment_format(path: Column | str) -> Column:
    """``stockholm``, ``a3m``, ``fasta`` by file extension in any case; NULL otherwise."""
    name = F.lower(F.col(path) if isinstance(path, str) else path)
    return (
        F.when(name.rlike(r"\.(sto|stockholm)$"), "stockholm")
        .when(name.rlike(r"\.a3m$"), "a3m")
        .when(name.rlike(r"\.(fasta|fa)$"), "fasta")
    )


def insert_mask(seq: Column | str) -> Column:
    """``1`` per match column and ``0`` per insert column (lower case or ``.``) of one aligned row."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return F.regexp_replace(F.regexp_replace(seq, r"[^a-z.]", "1"), r"[a-z.]", "0")


def read_alignments(spark: SparkSession, path: str, **options) -> DataFrame:
    """``msa_rows`` over mixed files: ``(msa_id, format, row_idx, name, seq, status, issue)``.

    A file of unknown type gives one row with ``status = 'error'``.
    """
    lines = read_lines(spark, path, recursiveFileLookup="true", **options)
    return alignments_from_lines(lines)


def alignments_from_lines(lines: DataFrame) -> DataFrame:
    tagged = lines.withColumn("format", alignment_format("source"))
    stockholm = normalize_annotations(tagged.where("format = 'stockholm'").select("source", "line_no", "line"))
    stockholm_rows = stockholm.where("kind = 'seq'").select(
        F.col("source").alias("msa_id"), F.lit("stockholm").alias("format"), F.col("ord").alias("row_idx"),
        F.col("seq_name").alias("name"), F.col("value").alias("seq"),
    )
    fasta_like = _fasta_from_lines(tagged.where("format in ('fasta', 'a3m')"))
    unknown = tagged.where("format is null").select(F.col("source").alias("msa_id")).distinct()
    good = stockholm_rows.unionByName(fasta_like).select("*", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("issue"))
    bad = unknown.select(
        "msa_id", F.lit(None).cast("string").alias("format"), F.lit(None).cast("long").alias("row_idx"),
        F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("seq"),
        F.lit("error").alias("status"),
        F.concat(F.lit("No alignment format goes by this extension: "), F.col("msa_id")).alias("issue"),
    )
    empty = tagged.where("format = 'stockholm'").select(F.col("source").alias("msa_id")).distinct().join(
        stockholm_rows.select("msa_id").distinct(), "msa_id", "left_anti")
    blank = empty.select(
        "msa_id", F.lit("stockholm").alias("format"), F.lit(None).cast("long").alias("row_idx"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("seq"), F.lit("error").alias("status"),
        F.concat(F.lit("No sequence rows in: "), F.col("msa_id")).alias("issue"))
    return good.unionByName(bad).unionByName(blank)


def _fasta_from_lines(lines: DataFrame) -> DataFrame:
    counted = running_sum(lines, ["source"], "line_no", F.col("line").startswith(">"), "row_idx").where("row_idx > 0")
    text = F.regexp_replace("line", r"\s", "")
    is_name = F.col("line").startswith(">")
    parts = counted.groupBy("source", "format", "row_idx").agg(
        F.max(F.when(is_name, strip(F.expr("substring(line, 2)")))).alias("name"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~is_name, F.struct(F.col("line_no"), text.alias("t"))))),
                                 lambda p: p["t"]), "").alias("seq"),
    )
    return parts.select(F.col("source").alias("msa_id"), "format", "row_idx", "name", "seq")


def column_annotations(annotations: DataFrame, key: str = "source") -> DataFrame:
    """``msa_cols``: one row per column with its exon code, RF and Aligned characters (NULL where absent).

    ``Aligned`` follows the first row's insert mask when the file does not carry it.
    """
    first_rows = annotations.where("kind = 'seq'").groupBy(key).agg(F.min_by("value", "ord").alias("seq"))
    wide = annotations.where("kind = 'GC'").groupBy(key).agg(*[
        F.max(F.when(F.col("feature") == f, F.col("value"))).alias(a)
        for f, a in ((CODE_FEATURE, "codes"), ("RF", "rf_line"), ("Aligned", "aligned_line"))
    ])
    both = first_rows.join(wide, key, "left").withColumn(
        "mask", F.coalesce("aligned_line", F.when(F.col("seq").rlike("[a-z.]"), insert_mask("seq"))))
    # The lines are zipped before the explode, so each is split once.
    lines = {"ref_residue": "seq", "code": "codes", "rf": "rf_line", "aligned": "mask"}
    zipped = F.arrays_zip(*[F.coalesce(F.split(c, ""), F.array().cast("array<string>")).alias(n) for n, c in lines.items()])
    exploded = both.select(key, F.posexplode(zipped).alias("p", "c"))
    return exploded.where("c.ref_residue is not null").select(
        key, (F.col("p") + 1).alias("col_idx"), *[F.col(f"c.{n}").alias(n) for n in lines])
