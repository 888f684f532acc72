"""Line, FASTA and PIR scans that keep the order inside each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import strip_version
from ..functions.species import strip


def _with_file_order(raw: DataFrame, out: str) -> DataFrame:
    """Dense 1-based ordinal per file. Splits are numbered on their own, then offset by the splits before them."""
    rows = raw.select("*", F.input_file_name().alias("source"), F.input_file_block_start().alias("_block"),
                      F.monotonically_increasing_id().alias("_pos"))
    sizes = rows.groupBy("source", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("source", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("source", "_block").orderBy("_pos"))
    return rows.withColumn(out, inside).join(offsets, ["source", "_block"]).withColumn(
        out, F.col(out) + F.col("_offset")
    ).drop("_block", "_pos", "_offset")


def read_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """``(source, line_no, line)``; large files are split over tasks."""
    raw = spark.read.options(**options).text(path).withColumnRenamed("value", "line")
    return _with_file_order(raw, "line_no").select("source", "line_no", "line")


def read_fasta(spark: SparkSession, path: str, **options) -> DataFrame:
    """``(source, rec_idx, name, seq)``; the reader splits at record starts, so one file may use many tasks."""
    raw = spark.read.options(**options).text(path, lineSep="\n>").withColumnRenamed("value", "record")
    starts = raw.where(strip("record") != "")
    return _with_file_order(starts, "rec_idx").select("source", "rec_idx", *_record_fields(F.col("record")))


def parse_fasta(texts: DataFrame, content: str = "content") -> DataFrame:
    """Records of whole FASTA texts: every input column but ``content``, then ``rec_idx, name, seq``."""
    keep = [c for c in texts.columns if c != content]
    # What stands before the first record start is no record.
    records = F.filter(F.split(F.regexp_replace(F.col(content), "\r", ""), r"(?:^|\n)>"), lambda r, i: (i > 0) & (strip(r) != ""))
    rows = texts.select(*keep, F.posexplode(records).alias("rec_idx", "record"))
    return rows.select(*keep, (F.col("rec_idx") + 1).alias("rec_idx"), *_record_fields(F.col("record")))


def _record_fields(record: Column) -> list[Column]:
    header = F.split(F.regexp_replace(record, "^>", ""), "\n", 2)
    seq = F.upper(F.regexp_replace(F.get(header, F.lit(1)), r"\s", ""))
    return [strip(header[0]).alias("name"), F.when(seq != "", seq).alias("seq")]


def fasta_sequence(content: Column | str) -> Column:
    """The single-record form: every sequence line of the text joined, upper case; NULL when there is none."""
    lines = F.transform(F.split(content, "\n"), strip)
    body = F.array_join(F.filter(lines, lambda line: (line != "") & ~line.startswith(">")), "")
    return F.when(body != "", F.upper(body))


def read_pir(spark: SparkSession, path: str, **options) -> DataFrame:
    whole = spark.read.options(**options).text(path, wholetext=True)
    return parse_pir(whole.select(F.input_file_name().alias("source"), F.col("value").alias("content")))


def parse_pir(texts: DataFrame, content: str = "content") -> DataFrame:
    """Transcript entries: ``entry_idx, transcript_id, symbols, seq, issue``, one row per id token.

    An entry is ``>P1;ids``, a line of per-residue symbols and sequence lines closed by ``*``.
    """
    keep = [c for c in texts.columns if c != content]
    entries = F.filter(F.split(F.regexp_replace(F.col(content), "\r", ""), r"(?:^|\n)\s*>P1;"), lambda entry, i: i > 0)
    rows = texts.select(*keep, F.posexplode(entries).alias("entry_idx", "entry"))
    lines = F.split("entry", "\n", 3)
    parsed = rows.select(
        *keep,
        "entry_idx",
        strip(lines[0]).alias("ids"),
        strip(F.coalesce(F.get(lines, F.lit(1)), F.lit(""))).alias("symbols"),
        F.regexp_replace(F.regexp_replace(F.coalesce(F.get(lines, F.lit(2)), F.lit("")), r"\s", ""), r"\*.*$", "").alias("seq"),
    )
    tokens = F.filter(F.transform(F.split("ids", r"[\s/]+"), strip_version), lambda t: t != "")
    issue = F.when(F.length("symbols") != F.length("seq"), "An entry has more or fewer symbols than residues.")
    return parsed.select(*keep, "entry_idx", F.explode(F.array_distinct(tokens)).alias("transcript_id"), "symbols",
                         "seq", issue.alias("issue"))
