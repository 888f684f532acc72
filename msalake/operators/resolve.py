"""Cross-references, candidate validation and target resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import strip_version


def explode_xrefs(entries: DataFrame, key: str = "uniprot_id") -> DataFrame:
    """``(key, xref_ord, prop_ord, transcript_id, isoform_id, prop, value)`` of the Ensembl cross-references."""
    refs = entries.select(key, F.posexplode("xrefs").alias("xref_ord", "x")).where("x.database = 'Ensembl'")
    return refs.select(
        key, "xref_ord", F.col("x.id").alias("transcript_id"), F.col("x.isoformId").alias("isoform_id"),
        F.posexplode_outer("x.properties").alias("prop_ord", "p"),
    ).select(key, "xref_ord", "prop_ord", "transcript_id", "isoform_id", F.col("p.key").alias("prop"),
             F.col("p.value").alias("value"))


def transcript_map(xrefs: DataFrame, key: str = "uniprot_id") -> DataFrame:
    """One row per entry and transcript: ``ord`` of first sight, and the last gene, protein and isoform written."""
    at = F.struct("xref_ord", "prop_ord")

    def last(name: str, value=None):
        value = F.col("value") if value is None else value
        picked = F.when((F.col("prop") == name) if name else value.isNotNull(), value)
        return F.max_by(picked, F.when(picked.isNotNull(), at))

    return xrefs.where("transcript_id is not null").groupBy(key, "transcript_id").agg(
        F.min("xref_ord").alias("ord"), last("GeneId").alias("gene_id"), last("ProteinId").alias("protein_id"),
        last("", F.col("isoform_id")).alias("isoform_id"))


def default_genes(xrefs: DataFrame, key: str = "uniprot_id") -> DataFrame:
    """The first gene each entry names."""
    genes = xrefs.where("prop = 'GeneId' and value is not null")
    return genes.groupBy(key).agg(F.min_by("value", F.struct("xref_ord", "prop_ord")).alias("default_gene"))


def fill_default_genes(transcripts: DataFrame, defaults: DataFrame, key: str = "uniprot_id") -> DataFrame:
    return transcripts.join(defaults, key, "left").withColumn(
        "gene_id", F.coalesce("gene_id", "default_gene")).drop("default_gene")


def validate_candidates(transcripts: DataFrame, entries: DataFrame, proteins: DataFrame, key: str = "uniprot_id") -> DataFrame:
    """Transcripts whose protein equals the entry sequence.

    ``entries(key, species, protein_sequence)``, ``proteins(protein_id, seq)``. Identity of two proteins is string
    equality, so each sequence is reduced to its sha256 where it is scanned and only digests are shuffled.
    """
    with_core = transcripts.where("protein_id is not null").withColumn("_core", strip_version("protein_id"))
    known = proteins.select(strip_version("protein_id").alias("_core"), F.sha2(F.upper("seq"), 256).alias("_digest"))
    own = entries.select(key, "species", F.sha2(F.upper("protein_sequence"), 256).alias("_digest"))
    return with_core.join(own, key).join(known, ["_core", "_digest"], "left_semi").select(
        key, "ord", "transcript_id", "gene_id", "protein_id", "isoform_id", "species",
        F.lit(True).alias("sequence_validated"), F.lit(True).alias("mapping_confirmed"))


def choose_candidates(requests: DataFrame, candidates: DataFrame, key: str = "uniprot_id") -> DataFrame:
    """One candidate per request: the wanted transcript (with or without version), else the first in order.

    ``requests(key, wanted_transcript)``. Adds ``warnings, status, issue``.
    """
    wanted = requests.select(key, "wanted_transcript").withColumn("_core", strip_version("wanted_transcript"))
    rows = candidates.join(wanted, key)
    fits = F.col("_core").isNull() | (strip_version("transcript_id") == F.col("_core"))
    picked = [c for c in candidates.columns if c != key]
    chosen = rows.groupBy(key).agg(
        F.count("*").alias("n_candidates"),
        F.min_by(F.when(fits, F.struct(*picked)), F.when(fits, F.struct("ord", "transcript_id"))).alias("c"))
    out = wanted.drop("_core").join(chosen, key, "left")
    issue = F.when(F.col("n_candidates").isNull(), "No transcript of the entry has the entry's sequence.").when(
        F.col("c").isNull(),
        F.concat(F.lit("The transcript asked for, "), "wanted_transcript", F.lit(", has another sequence or belongs to another entry.")))
    warning = F.when(
        F.col("wanted_transcript").isNull() & (F.col("n_candidates") > 1),
        F.concat(F.lit("Several transcripts have the entry's sequence; the first is taken: "), "c.transcript_id", F.lit(".")))
    return out.select(key, "wanted_transcript", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), "c.*",
                      F.array_compact(F.array(warning)).alias("warnings"),
                      F.when(issue.isNull(), "ok").otherwise("error").alias("status"), issue.alias("issue"))


def resolve_targets(inputs: DataFrame, entries: DataFrame, proteins: DataFrame, lookup: DataFrame) -> DataFrame:
    """Resolve normalised inputs into targets.

    ``inputs(target_id, primary_id, input_kind, wanted_transcript, supplied_uniprot, ensembl_gene_id,
    ensembl_protein_id, species, status, issue)``; supplied values win over found ones. The lookup side is joined
    only to transcript inputs that lack a gene or a species.
    """
    inputs = inputs.select("target_id", "primary_id", "input_kind", "wanted_transcript", "supplied_uniprot",
                           "ensembl_gene_id", "ensembl_protein_id", "species", "status", "issue")
    usable = inputs.where("status = 'ok' and input_kind is not null")
    uniprot = usable.where("input_kind = 'uniprot'")
    # Entries shrink to the requested ones before anything is exploded.
    wanted_entries = entries.join(uniprot.select(F.col("primary_id").alias("uniprot_id")).distinct(), "uniprot_id", "left_semi")
    xrefs = explode_xrefs(wanted_entries)
    transcripts = fill_default_genes(transcript_map(xrefs), default_genes(xrefs))
    candidates = validate_candidates(transcripts, wanted_entries, proteins).withColumnsRenamed(
        {"species": "found_species"})
    per_target = uniprot.select("target_id", "wanted_transcript", F.col("primary_id").alias("uniprot_id"))
    chosen = choose_candidates(
        per_target, per_target.select("target_id", "uniprot_id").join(candidates, "uniprot_id").drop("uniprot_id"),
        "target_id").drop("wanted_transcript", "n_candidates").withColumnsRenamed({"status": "_s", "issue": "_i"})
    by_uniprot = uniprot.drop("status", "issue").join(chosen, "target_id", "left")
    gene = F.coalesce("ensembl_gene_id", "gene_id")
    issue = F.coalesce("_i", F.when(gene.isNull(), F.concat(F.lit("No gene is known for "), "primary_id", F.lit("."))))
    uniprot_targets = by_uniprot.select(
        "target_id", F.col("primary_id").alias("input_id"), "input_kind", F.col("primary_id").alias("uniprot_id"),
        gene.alias("ensembl_gene_id"), F.col("transcript_id"),
        F.coalesce("ensembl_protein_id", "protein_id").alias("ensembl_protein_id"),
        F.coalesce("species", "found_species").alias("species"), "sequence_validated", "mapping_confirmed",
        F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
        F.when(issue.isNull(), "ok").otherwise("error").alias("status"), issue.alias("issue"))

    found = lookup.select(strip_version("transcript_id").alias("_core"), F.col("ensembl_gene_id").alias("_gene"),
                          F.col("species").alias("_species"), F.col("issue").alias("_issue")).groupBy("_core").agg(
        F.max(F.struct("_gene", "_species", "_issue")).alias("m")).select("_core", "m.*")
    incomplete = F.col("ensembl_gene_id").isNull() | F.col("species").isNull()
    direct = usable.where("input_kind = 'ensembl_transcript'").withColumn(
        "_core", F.when(incomplete, strip_version("primary_id"))).join(found, "_core", "left")
    no_meta = F.when(incomplete, F.coalesce(
        "_issue", F.when(F.col("_gene").isNull(), F.concat(F.lit("No gene and species are known for transcript "), "primary_id", F.lit(".")))))
    transcript_targets = direct.select(
        "target_id", F.col("primary_id").alias("input_id"), "input_kind", F.col("supplied_uniprot").alias("uniprot_id"),
        F.coalesce("ensembl_gene_id", "_gene").alias("ensembl_gene_id"), F.col("primary_id").alias("transcript_id"),
        "ensembl_protein_id", F.coalesce("species", "_species").alias("species"),
        F.lit(None).cast("boolean").alias("sequence_validated"), F.lit(None).cast("boolean").alias("mapping_confirmed"),
        F.array().cast("array<string>").alias("warnings"),
        F.when(no_meta.isNull(), "ok").otherwise("error").alias("status"), no_meta.alias("issue"))

    # NULL conditions must not lose a row, so the bad side is the exact complement.
    is_usable = F.coalesce((F.col("status") == "ok") & F.col("input_kind").isNotNull(), F.lit(False))
    bad = inputs.where(~is_usable).select(
        "target_id", F.col("primary_id").alias("input_id"), "input_kind", F.col("supplied_uniprot").alias("uniprot_id"),
        "ensembl_gene_id", F.col("wanted_transcript").alias("transcript_id"), "ensembl_protein_id", "species",
        F.lit(None).cast("boolean").alias("sequence_validated"), F.lit(None).cast("boolean").alias("mapping_confirmed"),
        F.array().cast("array<string>").alias("warnings"), F.lit("error").alias("status"), "issue")
    return uniprot_targets.unionByName(transcript_targets).unionByName(bad)
