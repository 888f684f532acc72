"""Delimited tables: explicit schemas only, so ids and threshold keys keep their text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.species import GENE_DATASET_SUFFIX, normalize_species, strip
from .text import read_lines

# The columns of the delimited files, by name.
PATH_TABLE = "TranscriptIDCluster STRING, Path STRING"
S_EXON_TABLE = "GeneID STRING, Species STRING, TranscriptIDCluster STRING, S_exonID STRING, S_exon_Sequence STRING"
CANDIDATE_SUMMARY = (
    "gene_id STRING, transcript_id STRING, pid DOUBLE, pid_order INT, eligible STRING, selected STRING, "
    "msa0_status STRING, msa0_issue STRING, epli DOUBLE, n_samples INT, n_sequences_msa0 INT, pid_sample_count INT, "
    "pid_sample_fraction DOUBLE, pid_sample_seed DECIMAL(20,0), sampling_strategy STRING, pid_thresholds_key STRING, "
    "effective_specieslist STRING, orthology STRING, specieslist_filter STRING, biomart_datasets_filter STRING, "
    "transcript_query_fingerprint STRING, selection_mode STRING, fasta_path STRING, stockholm_path STRING, "
    "sequence_fasta STRING, species_file STRING, scores_path STRING"
)
VALIDATION_STATS = (
    "input_id STRING, uniprot_id STRING, gene_id STRING, transcript_id STRING, pid DOUBLE, seed_path STRING, "
    "expanded_path STRING, seed_nseq INT, expanded_nseq INT, seed_ncol INT, expanded_ncol INT, seed_clusters62 INT, "
    "expanded_clusters62 INT, seed_neff80 DOUBLE, expanded_neff80 DOUBLE, query_name STRING, "
    "query_vs_uniprot_path STRING, aln_identical BOOLEAN, aln_mismatches INT, aln_insertions INT, aln_deletions INT"
)
HITS = "query STRING, target STRING, tseq STRING"


def split_cells(line: Column, sep: str = ",") -> Column:
    """The cells of one line; quotes are taken off, doubled quotes inside them become one."""
    mark = "\\t" if sep == "\t" else f"[{sep}]"
    pattern = mark + '(?:"(?:[^"]++|"")*+"[^' + mark.strip("[]") + "]*+|[^" + mark.strip("[]") + "]*+)"
    text = F.concat(F.lit(sep), F.regexp_replace(line, "\r$", ""))
    cells = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda c: F.substring(c, 2, 1 << 30))
    quoted = lambda c: c.startswith('"') & c.endswith('"') & (F.length(c) > 1)
    return F.transform(cells, lambda c: F.when(quoted(c), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def cells_to_row(names: Column, cells: Column, schema: str) -> Column:
    """``struct<fields of schema, issue>`` of a line under its own file's header.

    Columns are found by name; absent columns and empty cells are NULL. A cell that does not fit its type is NULL and named in
    ``issue``, as is a line whose number of cells differs from its header's.
    """
    wanted = StructType.fromDDL(schema).fields
    columns = F.array(*[F.lit(field.name) for field in wanted])
    # Lambdas bind the cells and then the found texts, so that neither expression is repeated for every column.
    found = F.transform(F.array(F.struct(names.alias("n"), cells.alias("c"))), lambda x: F.struct(
        F.transform(columns, lambda w: F.nullif(F.get(x["c"], (F.array_position(x["n"], w) - 1).cast("int")), F.lit(""))).alias("t"),
        F.size(x["n"]).alias("n"), F.size(x["c"]).alias("c")))

    def typed(x: Column) -> Column:
        fields, problems = [], [F.when(x["n"] != x["c"], F.format_string("%d cells under %d headers", x["c"], x["n"]))]
        for i, field in enumerate(wanted):
            text = F.get(x["t"], F.lit(i))
            value = text.try_cast(field.dataType)
            fields.append(value.alias(field.name))
            problems.append(F.when(text.isNotNull() & value.isNull(), F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), text)))
        return F.struct(*fields, F.nullif(F.concat_ws("; ", *problems), F.lit("")).alias("issue"))

    return F.get(F.transform(found, typed), F.lit(0))


def parse_table(lines: DataFrame, schema: str, sep: str = ",", key: str = "source") -> DataFrame:
    """``(key, line_no, <fields of schema>, issue)`` of ``lines(key, line_no, line)``, each file under its own header.

    The first line that is not blank is the header. Headers are found in one pass and joined by file; blank lines are skipped,
    every other line is a row.
    """
    full = lines.where((strip("line") != "") | F.col("line").contains(sep))
    headers = full.groupBy(key).agg(F.min(F.struct("line_no", "line")).alias("first")).select(
        key, F.col("first.line_no").alias("_at"), F.transform(split_cells(F.col("first.line"), sep), strip).alias("_names"))
    body = full.join(headers, key).where(F.col("line_no") > F.col("_at")).withColumn("_cells", split_cells(F.col("line"), sep))
    return body.select(key, "line_no", cells_to_row(F.col("_names"), F.col("_cells"), schema).alias("_r")).select(key, "line_no", "_r.*")


def read_table(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Delimited scan, each file matched by its own header: text first, then cast, so nothing is inferred.

    ``(source, line_no, <fields of schema>, issue)``; see :func:`parse_table`. A row ends at the end of its line."""
    return parse_table(read_lines(spark, path, recursiveFileLookup="true"), schema, sep)


def parse_hits(lines: DataFrame) -> DataFrame:
    """``(query, line_no, target, tseq)`` of tab lines with at least three fields."""
    fields = F.split("line", "\t")
    return lines.where(F.size(fields) >= 3).select(
        *[c for c in lines.columns if c not in ("line", "line_no")], fields[0].alias("query"), "line_no",
        fields[1].alias("target"), fields[2].alias("tseq"))


def parse_code_map(lines: DataFrame) -> DataFrame:
    """Exon symbol lines ``s_exon_id<TAB>symbol`` -> ``(..., s_exon_id, symbol, issue)``; blank lines skipped."""
    keep = [c for c in lines.columns if c != "line"]
    fields = F.split("line", "\t", 2)
    symbol = F.get(fields, F.lit(1))
    issue = F.when(symbol.isNull(), F.concat(F.lit("No symbol on this line: "), F.col("line"), F.lit("."))).when(
        F.length(symbol) != 1, F.concat(F.lit("Symbol is not one character: "), symbol, F.lit(".")))
    return lines.where(strip("line") != "").select(*keep, fields[0].alias("s_exon_id"), symbol.alias("symbol"), issue.alias("issue"))


def parse_dataset_registry(lines: DataFrame, line: str = "line") -> DataFrame:
    """Distinct gene dataset names of a registry dump."""
    fields = F.split(strip(line), "\t")
    name = strip(F.get(fields, F.lit(1)))
    return lines.where((fields[0] == "TableSet") & name.endswith(GENE_DATASET_SUFFIX)).select(name.alias("dataset")).distinct()


def log_species(line: Column | str) -> Column:
    """Species named by a download failure line; NULL when the line reports none."""
    line = F.col(line) if isinstance(line, str) else line
    # The two failure messages of the download log.
    missing = F.regexp_extract(line, r"It can not found ([A-Za-z0-9_]+) in biomart", 1)
    failed = F.regexp_extract(line, r"Download failed for \S+ in ([A-Za-z0-9_]+)", 1)
    return normalize_species(F.when(missing != "", missing).when(failed != "", failed))


def failed_species(errors: DataFrame, log_lines: DataFrame, key: str) -> DataFrame:
    """``(key, ord, species)``: species of the errors table, then of the log, first occurrence each.

    ``errors(key, row_no, Species)``, ``log_lines(key, line_no, line)``.
    """
    table = errors.select(key, F.lit(0).alias("part"), F.col("row_no").cast("long").alias("no"), normalize_species("Species").alias("species"))
    log = log_lines.select(key, F.lit(1).alias("part"), F.col("line_no").cast("long").alias("no"), log_species("line").alias("species"))
    named = table.unionByName(log).where("species is not null and species <> ''")
    return named.groupBy(key, "species").agg(F.min(F.struct("part", "no")).alias("ord")).select(key, "ord", "species")
