"""Text exports. Formatting is column work; the writers keep row order inside each output folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import col
from ..sources.stockholm import HEADER
from .shards import write_shards

LINE_WIDTH = 60


def wrap_sequence(seq: Column | str) -> Column:
    """Upper case, one newline-terminated line per 60 characters."""
    return F.regexp_replace(F.upper(col(seq)), f"(.{{1,{LINE_WIDTH}}})", "$1\n")


def fasta_record(name: Column | str, seq: Column | str) -> Column:
    """``>name`` and wrapped sequence lines."""
    return F.concat(F.lit(">"), col(name), F.lit("\n"), wrap_sequence(seq))


def _write_ordered(df: DataFrame, path: str, key: str, order: list[Column | str], text: Column, shard_bytes: int | None = None) -> None:
    """With ``shard_bytes`` packed shards and an index; else one folder per key, records in order across its part files.

    Range partitions by (key, order) cut a hot key into several files that still follow each other.
    """
    if shard_bytes is not None:
        write_shards(df, path, key, order, text, shard_bytes)
        return
    ordered = df.select(key, text.alias("value"), F.struct(*order).alias("_o"))
    ordered.repartitionByRange(key, "_o").sortWithinPartitions(key, "_o").select(key, "value").write.mode(
        "overwrite").partitionBy(key).text(path)


def write_fasta(records: DataFrame, path: str, key: str = "msa_id", order: str = "rec_idx", shard_bytes: int | None = None) -> None:
    """Multi-record FASTA per key; records are followed by a blank line. ``shard_bytes`` packs many keys into a file (``sinks.shards``)."""
    _write_ordered(records, path, key, [order], fasta_record("name", "seq"), shard_bytes)


def stockholm_lines(annotations: DataFrame, key: str = "source") -> DataFrame:
    """``(key, section, ord, sub_ord, line)`` of normalised annotations, in Stockholm order.

    Header, comments, GF, GS, GC, then each sequence with its GR lines, then ``//``. ``annotations`` is the output
    of ``sources.stockholm.normalize_annotations``.
    """
    section = {"comment": 1, "GF": 2, "GS": 3, "GC": 4, "seq": 5, "GR": 5}
    number = F.create_map(*[F.lit(x) for pair in section.items() for x in pair])[F.col("kind")]
    k = F.col("kind")
    line = (
        F.when(k == "comment", F.col("value"))
        .when(k.isin("GF", "GC"), F.concat(F.lit("#="), "kind", F.lit(" "), "feature", F.lit(" "), "value"))
        .when(k.isin("GS", "GR"), F.concat(F.lit("#="), "kind", F.lit(" "), "seq_name", F.lit(" "), "feature", F.lit(" "), "value"))
        .otherwise(F.concat("seq_name", F.lit("\t"), "value"))
    )
    # GF and GS features stay together at the place of their first line.
    firsts = annotations.groupBy(key, "kind", "seq_name", "feature").agg(F.min("ord").alias("_first"))
    seqs = annotations.where("kind = 'seq'").select(key, "seq_name", F.col("ord").alias("_seq_ord"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("seq_name", "feature")]
    placed = annotations.alias("a").join(
        firsts.alias("f"), (F.col(f"a.{key}") == F.col(f"f.{key}")) & (F.col("a.kind") == F.col("f.kind")) & same[0] & same[1],
    ).select("a.*", "f._first").join(seqs, [key, "seq_name"], "left").where("kind <> 'GR' or _seq_ord is not null")
    at = F.when(k.isin("seq", "GR"), F.col("_seq_ord")).when(k == "comment", F.col("ord")).otherwise(F.col("_first"))
    sub = F.when(k == "seq", F.lit(-1).cast("long")).otherwise(F.col("ord"))
    body = placed.select(key, number.alias("section"), at.alias("ord"), sub.alias("sub_ord"), line.alias("line"))
    ids = annotations.select(key).distinct()
    zero = F.lit(0).cast("long")
    ends = ids.select(key, F.explode(F.array(
        F.struct(F.lit(0).alias("section"), F.lit(HEADER).alias("line")),
        F.struct(F.lit(9).alias("section"), F.lit("//").alias("line")))).alias("e")).select(
        key, "e.section", zero.alias("ord"), zero.alias("sub_ord"), "e.line")
    return body.unionByName(ends)


def write_stockholm(annotations: DataFrame, path: str, key: str = "source", shard_bytes: int | None = None) -> None:
    _write_ordered(stockholm_lines(annotations, key), path, key, ["section", "ord", "sub_ord"], F.col("line"), shard_bytes)


def write_a3m(rows: DataFrame, path: str, key: str = "msa_id", order: str = "row_idx", shard_bytes: int | None = None) -> None:
    """Match rows as A3M: one header and one unwrapped sequence line per row."""
    _write_ordered(rows, path, key, [order], F.concat(F.lit(">"), F.col("name"), F.lit("\n"), F.col("seq")), shard_bytes)


def write_species(species: DataFrame, path: str, key: str, order: str = "draw", shard_bytes: int | None = None) -> None:
    """One species per line and key."""
    _write_ordered(species, path, key, [order], F.col("species"), shard_bytes)


def specieslist_text(species: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """``(key, specieslist)`` as a comma list in order."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("species").alias("s"))))
    return species.groupBy(key).agg(F.array_join(F.transform(items, lambda p: p["s"]), ",").alias("specieslist"))


def write_table(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delimited with a header; NULL is the empty field, quotes inside a cell are doubled. ``sep='\\t'`` for block tables."""
    df.write.mode("overwrite").csv(path, header=True, sep=sep, nullValue="", emptyValue="", escape='"')


def write_json(df: DataFrame, path: str) -> None:
    """One object per line; NULL fields are written, so "absent" survives a round trip."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)
