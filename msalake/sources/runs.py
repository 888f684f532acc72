"""Files of finished runs: what a folder tree holds, and the values they put in place of a result record's own.

A tree is read in one mixed scan; every file finds its run, and where it belongs to a seed its seed, by its path. Paths are compared
without their scheme, so that a record's absolute path meets the path of a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import col
from ..functions.paths import normalize_path, resolve_path
from ..functions.text import first_token, pid_key, pid_label
from .json import EXPANSION_FIELDS, TARGET_FIELDS, VALIDATION_FIELDS, parse_json
from .stockholm import alignment_format, classify_lines
from .tables import VALIDATION_STATS, cells_to_row, split_cells

DOCUMENTS = "{result.json,target.json,stage_state.json,stats.csv}"
SEQUENCES = "*.{fasta,fa,sto,stockholm}"
#: What a validation record and a row of a stats file have in common.
STATS = ("query_name", "seed_nseq", "seed_ncol", "seed_clusters62", "seed_neff80", "expanded_nseq", "expanded_ncol", "expanded_clusters62",
         "expanded_neff80", "aln_identical", "aln_mismatches", "aln_insertions", "aln_deletions")


def scan_runs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``documents(path, content)``, ``names(path, name)`` of sequence files, and ``files(path, size)`` under ``root``."""
    tree = spark.read.option("recursiveFileLookup", "true")
    path = F.col("_metadata.file_path").alias("path")
    documents = tree.option("pathGlobFilter", DOCUMENTS).text(root, wholetext=True).select(path, F.col("value").alias("content"))
    lines = tree.option("pathGlobFilter", SEQUENCES).text(root).select(path, F.col("value").alias("line"))
    files = tree.format("binaryFile").load(root).select("path", F.col("length").alias("size"))
    return documents, sequence_names(lines), files


def sequence_names(lines: DataFrame) -> DataFrame:
    """``(path, name)``: one row per FASTA record and per Stockholm row of ``lines(path, line)``."""
    tagged = lines.withColumn("format", alignment_format("path"))
    records = tagged.where("format = 'fasta' and startswith(line, '>')").select("path", first_token(F.expr("substring(line, 2)")).alias("name"))
    rows = classify_lines(tagged.where("format = 'stockholm'")).where("kind = 'seq'").select("path", first_token("seq_name").alias("name"))
    return records.unionAll(rows.distinct())


def bare(path: Column | str) -> Column:
    """A path without scheme and authority, in normal form."""
    return normalize_path(F.regexp_replace(col(path), "^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", ""))


def folder(path: Column | str, levels: int = 1) -> Column:
    return F.regexp_replace(col(path), "(?:/[^/]*){%d}$" % levels, "")


def documents_named(documents: DataFrame, name: str, key: str) -> DataFrame:
    return documents.where(F.col("path").endswith("/" + name)).select(folder("path").alias(key), "content")


def target_files(documents: DataFrame) -> DataFrame:
    """``(run, target, file_issue)`` of the ``target.json`` files; an unreadable one has no target."""
    parsed = parse_json("content", TARGET_FIELDS)
    whole = F.coalesce(parsed["ensembl_gene_id"].isNotNull() & parsed["transcript_id"].isNotNull() & parsed["input_id"].isNotNull()
                       & parsed["input_kind"].isNotNull(), F.lit(False))
    return documents_named(documents, "target.json", "run").select(
        "run", F.when(whole, parsed).alias("target"), F.when(~whole, "The target file is unreadable.").alias("file_issue"))


def first_row(content: Column, schema: str) -> Column:
    """The first data line of a small delimited file; NULL without one, or where a column of ``schema`` is not in its header."""
    lines = F.filter(F.split(F.regexp_replace(content, "\r", ""), "\n"), lambda line: F.trim(line) != "")
    wanted = F.array(*[F.lit(c.split()[0]) for c in schema.split(", ")])
    heads = F.transform(F.array(F.slice(lines, 1, 2)), lambda two: F.struct(
        F.transform(split_cells(F.get(two, F.lit(0))), F.trim).alias("names"), F.get(two, F.lit(1)).alias("line")))
    whole = F.filter(heads, lambda h: h["line"].isNotNull() & (F.size(F.array_except(wanted, h["names"])) == 0))
    return F.get(F.transform(whole, lambda h: cells_to_row(h["names"], split_cells(h["line"]), schema)), F.lit(0))


def stats_rows(results: DataFrame, seeds: DataFrame, documents: DataFrame) -> DataFrame:
    """``(run, seed_index, stats_path, found, readable, <stats>, stage_warnings)`` for each validation slot that has a seed.

    The file is where the record says, else ``validation/<pid>/stats.csv`` of the run. ``stage_warnings`` are those of the
    manifest in the validation folder of the seed.
    """
    slots = results.select("run", F.posexplode("validations").alias("p", "text")).select(
        "run", (F.col("p") + 1).alias("seed_index"), F.when(F.col("text").startswith("{"), parse_json("text", VALIDATION_FIELDS)).alias("v"))
    own = F.concat_ws("/", "run", F.lit("validation"), pid_key("pid"))
    wanted = slots.where("v is not null").join(seeds.select("run", "seed_index", "pid"), ["run", "seed_index"]).select(
        "run", "seed_index", F.coalesce(resolve_path("v.stats_path", "run"), F.concat(own, F.lit("/stats.csv"))).alias("stats_path"), own.alias("_own"))
    schema = ", ".join(f for f in VALIDATION_STATS.split(", ") if f.split()[0] in STATS)
    tables = documents.where(F.col("path").endswith(".csv")).select(
        bare("path").alias("_path"), F.lit(True).alias("_found"), first_row(F.col("content"), schema).alias("_row"))
    states = documents_named(documents, "stage_state.json", "_dir").select(
        bare("_dir").alias("_dir"), parse_json("content", "warnings ARRAY<STRING>")["warnings"].alias("_stage"))
    joined = wanted.join(tables, bare("stats_path") == F.col("_path"), "left").join(states, bare("_own") == F.col("_dir"), "left")
    return joined.select(
        "run", "seed_index", "stats_path", F.coalesce("_found", F.lit(False)).alias("found"),
        (F.col("_row").isNotNull() & F.col("_row.issue").isNull()).alias("readable"), *[F.col(f"_row.{c}").alias(c) for c in STATS],
        F.coalesce("_stage", F.array().cast("array<string>")).alias("stage_warnings"))


def expansion_paths(results: DataFrame, seeds: DataFrame, targets: DataFrame) -> DataFrame:
    """``(run, seed_index, <path fields>, counted)`` of every expansion slot that is an object: recorded paths, else the usual places,
    which need a target.

    ``targets(run, target)``. Fields that may be recorded as none (``seed_fasta``, ``s_exon_blocks_tsv``) stay NULL then.
    ``counted`` tells whether the record has its number of hits.
    """
    slots = results.select("run", F.posexplode("expansions").alias("p", "text")).where("startswith(text, '{')").select(
        "run", (F.col("p") + 1).alias("seed_index"), parse_json("text", EXPANSION_FIELDS).alias("e"), F.json_object_keys("text").alias("keys"))
    rows = slots.join(seeds.select("run", "seed_index", "pid", F.col("stockholm_path").alias("seed_path")), ["run", "seed_index"]).join(
        targets.select("run", F.col("target.ensembl_gene_id").alias("gene"), F.col("target.transcript_id").alias("transcript")), "run", "left")
    given = lambda f: resolve_path(f"e.{f}", "run")
    rows = rows.withColumn("run_dir", F.coalesce(
        given("run_dir"), folder(given("match_stockholm"), 2), F.concat("run", F.lit("/expansion/"), "gene", F.lit("/"), "transcript", F.lit("/"), pid_key("pid"))))
    at = lambda *parts: F.concat(F.col("run_dir"), *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    transcript, label = F.col("transcript"), pid_label("pid")
    usual = {
        "seed_stockholm": at("/seeds/seed_pid", label, ".sto"), "seed_fasta": at("/seeds/seed_pid", label, ".fasta"),
        "hits_fasta": at("/expanded_msa/", transcript, "_hits_raw.fasta"), "full_stockholm": at("/expanded_msa/", transcript, "_full.sto"),
        "match_stockholm": at("/expanded_msa/", transcript, "_matchonly.sto"), "a3m_path": at("/expanded_msa/", transcript, "_expanded.a3m"),
        "s_exon_blocks_tsv": at("/expanded_msa/", transcript, "_s_exon_blocks.tsv"), "db_dir": at("/dbs"), "hmm_dir": at("/hmm"), "logs_dir": at("/logs")}
    none_kept = ("seed_fasta", "s_exon_blocks_tsv")
    value = lambda f: F.coalesce(given(f), usual[f] if f not in none_kept else F.when(~F.array_contains("keys", f), usual[f]))
    return rows.select("run", "seed_index", "run_dir", *[value(f).alias(f) for f in usual], "seed_path",
                       F.array_contains("keys", "n_hits").alias("counted"))


def counted_hits(paths: DataFrame, names: DataFrame, files: DataFrame) -> DataFrame:
    """``(run, seed_index, n_hits, n_new_hits)`` from the sequence files of slots without recorded counts.

    Both the hits file and the seed's alignment must be there. Hits are records; new ones have a name that is no seed row's.
    """
    have = files.select(bare("path").alias("_p")).distinct()
    asked = paths.where("not counted").select("run", "seed_index", bare("hits_fasta").alias("_hits"), bare("seed_path").alias("_seed"))
    asked = asked.join(have.withColumnRenamed("_p", "_hits"), "_hits", "left_semi").join(have.withColumnRenamed("_p", "_seed"), "_seed", "left_semi")
    listed = names.select(bare("path").alias("_p"), "name")
    hits = asked.join(listed.withColumnRenamed("_p", "_hits"), "_hits", "left").select("run", "seed_index", "_seed", "name")
    per_name = hits.groupBy("run", "seed_index", "_seed", "name").agg(F.count("name").alias("n"))
    seed_names = listed.select(F.col("_p").alias("_seed"), "name").distinct().withColumn("_old", F.lit(True))
    marked = per_name.join(seed_names, ["_seed", "name"], "left")
    return marked.groupBy("run", "seed_index").agg(
        F.sum("n").alias("n_hits"), F.coalesce(F.sum(F.when(F.col("_old").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("n_new_hits"))
