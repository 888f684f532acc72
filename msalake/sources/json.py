"""Dumped metadata records, run manifests and result records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNIPROT_SCHEMA = (
    "primaryAccession STRING, organism STRUCT<scientificName: STRING>, sequence STRUCT<value: STRING>, "
    "uniProtKBCrossReferences ARRAY<STRUCT<database: STRING, id: STRING, isoformId: STRING, "
    "properties: ARRAY<STRUCT<key: STRING, value: STRING>>>>"
)
LOOKUP_SCHEMA = "id STRING, Parent STRING, species STRING"
HOMOLOGY_SCHEMA = "data ARRAY<STRUCT<homologies: ARRAY<STRUCT<type: STRING, target: STRUCT<species: STRING>>>>>"
MANIFEST_SCHEMA = (
    "schema_version INT, stage STRING, stage_key STRING, status STRING, action STRING, identity_hash STRING, "
    "outputs STRING, warnings ARRAY<STRING>, exception STRUCT<type: STRING, message: STRING>, started_at STRING, "
    "updated_at STRING, finished_at STRING"
)
TARGET_FIELDS = (
    "input_id STRING, input_kind STRING, uniprot_id STRING, ensembl_gene_id STRING, transcript_id STRING, "
    "ensembl_protein_id STRING, species STRING, uniprot_sequence_path STRING, ensembl_protein_sequence_path STRING, "
    "sequence_validated BOOLEAN, mapping_confirmed BOOLEAN, warnings ARRAY<STRING>"
)
SEED_FIELDS = (
    "pid DOUBLE, epli DOUBLE, stockholm_path STRING, fasta_path STRING, s_exon_blocks_tsv STRING, "
    "summary_path STRING, used_fallback_dir BOOLEAN"
)
EXPANSION_FIELDS = (
    "run_dir STRING, seed_stockholm STRING, seed_fasta STRING, match_stockholm STRING, full_stockholm STRING, "
    "a3m_path STRING, s_exon_blocks_tsv STRING, hits_fasta STRING, db_dir STRING, hmm_dir STRING, logs_dir STRING, "
    "n_hits BIGINT, n_new_hits BIGINT, status STRING"
)
VALIDATION_FIELDS = (
    "stats_path STRING, query_name STRING, query_vs_uniprot_path STRING, seed_nseq BIGINT, seed_ncol BIGINT, "
    "seed_clusters62 BIGINT, seed_neff80 DOUBLE, expanded_nseq BIGINT, expanded_ncol BIGINT, "
    "expanded_clusters62 BIGINT, expanded_neff80 DOUBLE, aln_identical BOOLEAN, aln_mismatches BIGINT, "
    "aln_insertions BIGINT, aln_deletions BIGINT, warnings ARRAY<STRING>, status STRING"
)


def _nested(fields: str) -> str:
    return ", ".join(f.replace(" ", ": ", 1) for f in fields.split(", "))


def result_schema(msa_section: str) -> str:
    """Result record; array slots are read as text first, so one malformed slot cannot spoil its record."""
    return (
        f"input_id STRING, status STRING, failed_stage STRING, warnings ARRAY<STRING>, stages ARRAY<STRING>, "
        f"target STRUCT<{_nested(TARGET_FIELDS)}>, {msa_section} STRUCT<seeds: ARRAY<STRUCT<{_nested(SEED_FIELDS)}>>, "
        f"status: STRING, warnings: ARRAY<STRING>, pid_summary: STRING, pid_sample_count: INT, "
        f"pid_sample_fraction: DOUBLE, pid_sample_seed: DECIMAL(20,0), sampling_strategy: STRING>, "
        f"expansions ARRAY<STRING>, validations ARRAY<STRING>"
    )


def uniprot_entries(records: DataFrame) -> DataFrame:
    """``(uniprot_id, species, protein_sequence, xrefs)`` of parsed records."""
    return records.select(
        F.col("primaryAccession").alias("uniprot_id"), F.col("organism.scientificName").alias("species"),
        F.upper("sequence.value").alias("protein_sequence"), F.col("uniProtKBCrossReferences").alias("xrefs"))


def read_uniprot(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Entries of one object per line, which splits large dumps over tasks, or with ``whole_files`` of files that hold one object, or
    one array of objects, over any number of lines."""
    return uniprot_entries(spark.read.schema(UNIPROT_SCHEMA).json(path, recursiveFileLookup=True, multiLine=whole_files))


def transcript_lookup(records: DataFrame) -> DataFrame:
    """``(transcript_id, ensembl_gene_id, species, issue)``; a record without a parent gene is an issue."""
    issue = F.when(F.col("Parent").isNull(),
                   F.concat(F.lit("The lookup of "), F.col("id"), F.lit(" names no gene.")))
    return records.select(F.col("id").alias("transcript_id"), F.col("Parent").alias("ensembl_gene_id"), "species",
                          issue.alias("issue"))


def read_transcript_lookup(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """See :func:`read_uniprot` for ``whole_files``."""
    return transcript_lookup(spark.read.schema(LOOKUP_SCHEMA).json(path, recursiveFileLookup=True, multiLine=whole_files))


def parse_json(text: Column | str, schema: str) -> Column:
    return F.from_json(F.col(text) if isinstance(text, str) else text, schema)


def manifests(texts: DataFrame, root: str | None = None) -> DataFrame:
    """Stage manifests of ``(state_path, content)``; text that is not a JSON object is skipped."""
    parsed = texts.select("state_path", F.get_json_object("content", "$").alias("object"))
    is_object = F.col("object").startswith("{")
    rows = parsed.where(is_object).select("state_path", parse_json("object", MANIFEST_SCHEMA).alias("m"))
    return rows.select("state_path", "m.*").distinct()


def read_manifests(spark: SparkSession, root: str, stage_keys: DataFrame | None = None) -> DataFrame:
    """All ``stage_state.json`` files under ``root``, optionally only the wanted ``stage_key`` rows."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="stage_state.json")
    found = manifests(raw.select(F.col("_metadata.file_path").alias("state_path"), F.col("value").alias("content")))
    return found if stage_keys is None else found.join(stage_keys.select("stage_key").distinct(), "stage_key", "left_semi")


def read_results(spark: SparkSession, root: str, msa_section: str = "msa") -> DataFrame:
    """``(run, record)`` for every ``result.json`` under ``root``; ``run`` is its folder."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="result.json")
    return parse_results(
        raw.select(F.regexp_replace("_metadata.file_path", "/result\\.json$", "").alias("run"), F.col("value").alias("content")),
        msa_section)


def parse_results(texts: DataFrame, msa_section: str = "msa") -> DataFrame:
    record = parse_json("content", result_schema(msa_section))
    return texts.select("run", record.alias("r")).select("run", "r.*").withColumnRenamed(msa_section, "msa")
