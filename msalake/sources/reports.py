"""Profile-aligner text reports: header figures and (position, code) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import SPAN, running_sum, with_last_known, with_previous

_NUMBER = r"([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"
BITS = 60
POSITIONS_DISAGREE = "Alignment positions do not agree."
_QUERY_ROW = r"\S+\s+(\d+)\s+(\S+)\s+(\d+)"


def report_facts(lines: DataFrame, key: str = "report_id") -> DataFrame:
    """``(key, line, last)`` of each report in one scan: its first ``Probab=`` line and its greatest line number."""
    # Grouped by the header's text, so that the scan keeps numbers only.
    found = lines.groupBy(key, F.when(F.col("line").startswith("Probab="), F.col("line")).alias("line")).agg(
        F.min("line_no").alias("at"), F.max("line_no").alias("last"))
    return found.groupBy(key).agg(F.min_by("line", F.when(F.col("line").isNotNull(), F.col("at"))).alias("line"), F.max("last").alias("last"))


def report_headers(lines: DataFrame, key: str = "report_id", facts: DataFrame | None = None) -> DataFrame:
    """``(key, probability, e_value, hhalign_score)`` of the first ``Probab=`` line; absent figures are NULL."""
    header = report_facts(lines, key) if facts is None else facts
    figures = [
        F.expr(f"try_cast(nullif(regexp_extract(line, r'{name}={_NUMBER}', 1), '') as double)").alias(alias)
        for name, alias in (("Probab", "probability"), ("E-value", "e_value"), ("Score", "hhalign_score"))
    ]
    return header.select(key, *figures)


def symbol_rows(lines: DataFrame, key: str = "report_id", span: int = SPAN, facts: DataFrame | None = None) -> DataFrame:
    """``(key, block, seq, start, codes, issue)``: every symbol row, cut to the columns of its block's query sequence.

    A block is the query row, symbol rows that start with white space, and a closing ``Confidence`` row. A block whose first row is
    no query row keeps the columns of the block before it. A report is read in one pass over its sorted lines; one with line numbers
    from ``span`` on is cut into spans.
    """
    told = lines.where("line <> ''").select(key, "line_no", "line")
    long = (report_facts(lines, key) if facts is None else facts).where(F.col("last") >= span).select(key)
    symbols = _placed(told.join(F.broadcast(long), key, "left_anti"), key).unionByName(_placed(told.join(F.broadcast(long), key, "left_semi"), key, span))
    return symbols.select(
        key, "block", F.col("_q.seq").alias("seq"), F.col("_q.start").alias("start"),
        F.substring("line", F.col("_q.at"), F.length("_q.seq")).alias("codes"),
        F.when(F.col("_q.start") + _residues("_q.seq") - 1 != F.col("_q.stop"), POSITIONS_DISAGREE).alias("issue"))


def _placed(told: DataFrame, key: str, span: int | None = None) -> DataFrame:
    """``(key, line, block, _q)`` of symbol rows below a query row; ``block`` is the number of blocks closed before."""
    header, closing = F.col("line").startswith("Probab="), F.col("line").startswith("Confidence")
    inside = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    if span is None:
        total = lambda df, value, out: df.withColumn(out, F.sum(value).over(inside))
        previous = lambda df, value, out: df.withColumn(out, F.lag(value).over(Window.partitionBy(key).orderBy("line_no")))
        known = lambda df, value, out: df.withColumn(out, F.last(value, ignorenulls=True).over(inside))
    else:
        total = lambda df, value, out: running_sum(df, [key], "line_no", value, out, span)
        previous = lambda df, value, out: with_previous(df, [key], "line_no", value, out, span)
        known = lambda df, value, out: with_last_known(df, [key], "line_no", value, out, span)
    # One running sum carries both counters: headers seen in the high half, closed blocks in the low half.
    packed = header.cast("long") * F.lit(1 << 32) + closing.cast("long")
    counted = total(told, packed, "_seen").where((F.col("_seen") >= 1 << 32) & ~header).select(
        key, "line_no", "line", closing.alias("_closing"), F.col("_seen").bitwiseAND(0xFFFFFFFF).alias("block"))
    # The first row of a block has the closing row of another one before it, or nothing.
    headed = previous(counted, "_closing", "_after").withColumn("_head", ~F.col("_closing") & F.coalesce("_after", F.lit(True)))
    query = F.regexp_extract("line", _QUERY_ROW, 2)
    parsed = headed.withColumn("_own", F.when(F.col("_head") & (query != ""), F.struct(
        F.instr(F.col("line"), query).alias("at"), query.alias("seq"),
        F.regexp_extract("line", _QUERY_ROW, 1).try_cast("int").alias("start"),
        F.regexp_extract("line", _QUERY_ROW, 3).try_cast("int").alias("stop"))))
    return known(parsed, "_own", "_q").where(
        F.col("_q").isNotNull() & ~F.col("_closing") & ~F.col("_head") & F.col("line").rlike(r"^\s")).select(key, "line", "block", "_q")


def report_codes(lines: DataFrame, key: str = "report_id") -> DataFrame:
    """``(key, pos, code, issue)``: one row per symbol under the query row of its block. Query gaps have position 0."""
    cells = symbol_rows(lines, key).select(key, "seq", "start", "issue", F.posexplode(F.split("codes", "")).alias("_i", "code"))
    before = _residues(F.substring("seq", F.lit(1), F.col("_i")))
    here = F.substring("seq", F.col("_i") + 1, F.lit(1))
    return cells.select(key, F.when(here == "-", 0).otherwise(F.col("start") + before).alias("pos"), "code", "issue")


def report_counts(lines: DataFrame, key: str = "report_id", facts: DataFrame | None = None) -> DataFrame:
    """``(key, matched_positions, comparable_positions, issue)`` of each report that has symbol rows.

    A symbol row becomes the bits of its residues, cut at every ``BITS`` positions: one word tells which positions it covers, one which
    of them it marks. Words of a report and stretch are joined by bitwise or, so rows may overlap, and bits are counted at the end.
    No row per symbol is ever made. Position 0 does not count.
    """
    seq, codes = F.col("seq"), F.col("codes")
    paired = F.filter(F.arrays_zip(F.split(seq, "").alias("s"), F.split(codes, "").alias("c")), lambda p: p["s"] != "-")
    marks = F.when(~seq.contains("-"), codes).otherwise(F.array_join(F.transform(paired, lambda p: p["c"]), ""))
    bits = F.replace(F.regexp_replace(marks, r"[^|]", "0"), F.lit("|"), F.lit("1"))
    rows = symbol_rows(lines, key, facts=facts).select(key, F.col("start").cast("long").alias("start"), bits.alias("bits"), F.col("issue").isNotNull().alias("issue")).where("bits <> '' and start is not null")
    stop = F.col("start") + F.length("bits") - 1
    stretch = lambda at: F.floor(at / F.lit(BITS))
    cut = rows.select(key, "issue", "start", "bits", stop.alias("stop"), F.explode(F.sequence(stretch(F.col("start")), stretch(stop))).alias("word"))
    low = F.greatest(F.col("start"), F.col("word") * BITS)
    piece = F.substring(F.col("bits"), (low - F.col("start") + 1).cast("int"), (F.least("stop", F.col("word") * BITS + BITS - 1) - low + 1).cast("int"))
    lead = F.repeat(F.lit("0"), (low - F.col("word") * BITS).cast("int"))
    number = lambda text: F.conv(F.rpad(F.concat(lead, text), BITS, "0"), 2, 10).cast("long")
    words = cut.select(key, "word", "issue", number(piece).alias("hit"), number(F.repeat(F.lit("1"), F.length(piece))).alias("there"))
    joined = words.groupBy(key, "word").agg(F.bit_or("hit").alias("hit"), F.bit_or("there").alias("there"), F.max("issue").alias("issue"))
    counted = F.when(F.col("word") == 0, (1 << BITS - 1) - 1).otherwise((1 << BITS) - 1)
    return joined.groupBy(key).agg(
        F.sum(F.bit_count(F.col("hit").bitwiseAND(counted))).cast("long").alias("matched_positions"),
        F.sum(F.bit_count(F.col("there").bitwiseAND(counted))).cast("long").alias("comparable_positions"),
        F.when(F.max("issue"), POSITIONS_DISAGREE).alias("issue"))


def _residues(seq: Column | str) -> Column:
    return F.length(F.replace(F.col(seq) if isinstance(seq, str) else seq, F.lit("-"), F.lit("")))
