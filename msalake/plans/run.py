"""The whole run: from raw ids to one nested record per target, failed targets included."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import cut_lineage, merged
from ..functions.paths import TARGET_IDENTITY, identity_hash
from ..operators import candidates, catalogue, ledger, speciesfilter
from . import jobs


@dataclass
class AssemblyInput:
    """Exon tables of every candidate; all but ``candidates`` are keyed by ``(target_id, pid_order)``.

    ``candidates(target_id, pid_order, pid)``, ``paths(TranscriptIDCluster, Path)``, ``exon_rows(s_exon_id, row_idx, name, seq)``,
    ``s_exons`` as ``sources.tables.S_EXON_TABLE`` with ``row_no``.
    """

    candidates: DataFrame
    paths: DataFrame
    exon_rows: DataFrame
    s_exons: DataFrame


@dataclass
class ExpansionInput:
    """Search results of every seed, keyed by ``(target_id, pid)``; seeds that are not chosen are left out.

    ``seed_cols(col_idx, code, rf, aligned)``, ``code_map(code, s_exon_id)``, ``raw_hits(line_no, target, tseq)``,
    ``aligned_rows(row_idx, name, seq)`` and ``aligned_cols(col_idx, rf, aligned)`` of the seeds with new hits.
    ``centroid_members(centroid, member_ord, member, seq)`` is shared; with it come the centroid-level alignments.
    """

    seed_cols: DataFrame
    code_map: DataFrame
    raw_hits: DataFrame
    aligned_rows: DataFrame
    aligned_cols: DataFrame
    centroid_members: DataFrame | None = None
    centroid_rows: DataFrame | None = None
    centroid_cols: DataFrame | None = None


def _assembled(good: DataFrame, given: AssemblyInput) -> tuple[DataFrame, DataFrame]:
    """Candidate rows of the open targets, and ``(target_id, ord, warning)`` of the candidates that could not be assembled."""
    one = F.concat_ws("|", "target_id", F.col("pid_order").cast("string"))

    def of_one(df: DataFrame) -> DataFrame:
        return merged(df.join(good.select("target_id"), "target_id", "left_semi").withColumn("target_id", one).drop("pid_order"))

    index = given.candidates.join(good.select("target_id", "ensembl_gene_id", "transcript_id"), "target_id").withColumn("_one", one)
    requests = index.select(F.col("_one").alias("target_id"), F.col("ensembl_gene_id").alias("gene_id"), "transcript_id")
    built = jobs.assemble_job(requests, of_one(given.paths), of_one(given.exon_rows), of_one(given.s_exons))
    named = index.select("target_id", "pid_order", "pid", "_one")
    fine = built["report"].where("status = 'ok'").select(F.col("target_id").alias("_one"))
    rows = built["rows"].withColumnRenamed("target_id", "_one").join(named.join(fine, "_one", "left_semi"), "_one")
    failed = built["report"].where("status = 'error'").select(F.col("target_id").alias("_one"), "issue").join(named, "_one")
    text = F.concat(F.lit("Candidate "), F.col("pid").cast("string"), F.lit(" was not assembled: "), "issue")
    return (rows.select("target_id", "pid_order", "pid", "row_idx", "name", "species", "seq"),
            failed.select("target_id", F.col("pid_order").cast("long").alias("ord"), text.alias("warning")))


def _expanded(chosen: DataFrame, rows: DataFrame, given: ExpansionInput) -> dict[str, DataFrame]:
    """The expansion job over the chosen seeds, keyed by ``msa_id``."""
    index = chosen.select("target_id", "pid", "msa_id")

    def keyed(df: DataFrame | None, keep_pid: bool = False) -> DataFrame | None:
        return None if df is None else df.join(index, ["target_id", "pid"]).drop("target_id", *([] if keep_pid else ["pid"]))

    seed_rows = rows.join(index, ["target_id", "pid"]).select("msa_id", "row_idx", "name", "seq")
    return jobs.expand_job(seed_rows, keyed(given.seed_cols, True), keyed(given.code_map), keyed(given.raw_hits), keyed(given.aligned_rows),
                           keyed(given.aligned_cols, True), given.centroid_members, keyed(given.centroid_rows), keyed(given.centroid_cols, True))


def run_job(
    inputs: DataFrame, entries: DataFrame, proteins: DataFrame, lookup: DataFrame, requested: DataFrame,
    orthologs: DataFrame, registry: DataFrame | None, candidate_rows: DataFrame | None = None, expanded_rows: DataFrame | None = None,
    orthology: str = "1:n", sample_count: int = 45, fraction: float = 0.8, seed: int = 0, strategy: str = "independent",
    homology_failures: DataFrame | None = None, assembly: AssemblyInput | None = None, expansion: ExpansionInput | None = None,
) -> dict[str, DataFrame]:
    """Resolve, filter species, assemble, sample and select, expand, validate, and gather one record per target.

    Candidates come as ``candidate_rows`` or are assembled from ``assembly``. Expanded alignments come out of ``expansion``, or ready as
    ``expanded_rows(target_id, pid, row_idx, name, seq)``; with neither there is no expansion. ``homology_failures(target_id)`` are
    targets whose ortholog lookup failed. A target that fails stays in ``results`` and ``records`` with its failed stage and the parts
    made before: one that fails in expansion keeps its seeds and the expansions before the one that failed, and has no validations.
    """
    if (candidate_rows is None) == (assembly is None):
        raise ValueError("pass candidate_rows or assembly")
    # Tables of the targets grow with them: none is small enough to be broadcast, whatever it was made from.
    inputs, entries, proteins, lookup, requested, orthologs = map(merged, (inputs, entries, proteins, lookup, requested, orthologs))
    candidate_rows, expanded_rows, homology_failures = (df if df is None else merged(df) for df in (candidate_rows, expanded_rows, homology_failures))
    targets = cut_lineage(jobs.resolve_job(inputs, entries, proteins, lookup))
    book = [ledger.entry("target", targets)]
    good = targets.where("status = 'ok'")
    asked = requested.select("target_id").distinct().withColumn("_r", F.lit(True))
    facts = good.select("target_id", "ensembl_gene_id", "species", F.lit(orthology).alias("orthology")).join(asked, "target_id", "left")
    lost = (homology_failures.select("target_id").distinct() if homology_failures is not None else good.select("target_id").limit(0)).withColumn("_h", F.lit(True))
    facts = facts.join(lost, "target_id", "left").select(
        "*", F.coalesce("_r", F.lit(False)).alias("has_request"), F.coalesce("_h", F.lit(False)).alias("homology_failed")).drop("_r", "_h")
    species, species_report = map(cut_lineage, speciesfilter.compose_filters(facts, requested, orthologs, registry))
    book.append(ledger.entry("msa", species_report))
    known = entries.select("uniprot_id", F.col("protein_sequence").alias("uniprot_seq"))
    usable = ledger.still_open(good, book[1:]).join(known, "uniprot_id", "left").withColumn("has_reference", F.col("uniprot_id").isNotNull())
    usable = cut_lineage(usable)
    unbuilt = None
    if assembly is not None:
        candidate_rows, unbuilt = map(cut_lineage, _assembled(usable, assembly))
    picked = jobs.candidates_job(
        usable.select("target_id", "ensembl_gene_id", "transcript_id", "uniprot_id", "has_reference", "uniprot_seq"),
        candidate_rows, strategy, sample_count, fraction, seed, input_species=species if strategy == "input" else None)
    seeds = cut_lineage(picked["seeds"].withColumn("msa_id", F.concat_ws("|", F.lit("seed"), "target_id", F.col("pid").cast("string"))))
    book.append(ledger.entry("msa", candidates.selection_report(usable, seeds), 1))

    none = seeds.select("target_id", "seed_index", "msa_id", "pid")
    grown: dict[str, DataFrame] = {}
    if expansion is not None:
        grown = _expanded(seeds, candidate_rows, expansion)
        lacking = cut_lineage(none.join(grown["issues"].groupBy("msa_id").agg(F.min("issue").alias("issue")), "msa_id"))
        stop = lacking.groupBy("target_id").agg(F.min("seed_index").alias("_stop"))
        book.append(ledger.entry("msa_expansion", lacking.groupBy("target_id").agg(F.min_by("issue", "seed_index").alias("issue")).withColumn("status", F.lit("error"))))
        slots = none.join(stop, "target_id", "left").where("_stop is null or seed_index < _stop").join(grown["counts"], "msa_id").select(
            "target_id", "seed_index", F.lit(True).alias("present"), F.lit("ok").alias("status"), "n_hits", "n_new_hits")
        expanded_msas = grown["full_rows"].select("msa_id", "row_idx", "name", "seq")
    elif expanded_rows is not None:
        expanded_msas = expanded_rows.join(none, ["target_id", "pid"]).select("msa_id", "row_idx", "name", "seq")
        unknown = F.lit(None).cast("long")
        slots = none.join(expanded_msas.select("msa_id").distinct(), "msa_id", "left_semi").select(
            "target_id", "seed_index", F.lit(True).alias("present"), F.lit("ok").alias("status"), unknown.alias("n_hits"), unknown.alias("n_new_hits"))
    else:
        expanded_msas = candidate_rows.limit(0).select(F.lit("").alias("msa_id"), "row_idx", "name", "seq")
        slots = none.limit(0).select("target_id", "seed_index", F.lit(True).alias("present"), F.lit("").alias("status"),
                                     F.lit(0).cast("long").alias("n_hits"), F.lit(0).cast("long").alias("n_new_hits"))
    slots, expanded_msas = cut_lineage(slots), cut_lineage(expanded_msas)

    final = cut_lineage(ledger.still_open(none, book[2:]))
    have = slots.select("target_id", "seed_index").withColumn("_e", F.lit(True))
    wide = F.concat(F.lit("expanded|"), "msa_id")
    runs = final.join(have, ["target_id", "seed_index"], "left").withColumns({
        "run_id": F.col("msa_id"), "seed_msa": F.col("msa_id"), "expanded_msa": F.when(F.col("_e"), wide)})
    rows = candidate_rows.join(final, ["target_id", "pid"]).select("msa_id", "target_id", "row_idx", "name", "seq").unionByName(
        expanded_msas.join(final.select("msa_id", "target_id"), "msa_id").select(wide.alias("msa_id"), "target_id", "row_idx", "name", "seq"))
    ids = rows.select("msa_id", "target_id").distinct().join(usable, "target_id").select(
        "msa_id", F.posexplode(F.array("ensembl_gene_id", "transcript_id")).alias("id_ord", "id"))
    references = runs.join(usable, "target_id").where("uniprot_seq is not null").select("run_id", F.col("uniprot_seq").alias("reference_seq"))
    validated = jobs.validate_job(runs.select("run_id", "seed_msa", "expanded_msa"), rows.drop("target_id"), ids, references)
    validated = cut_lineage(validated.join(runs.select("run_id", "target_id", "pid", "seed_index"), "run_id"))

    sources = [
        targets.select("target_id", F.posexplode("warnings").alias("ord", "warning")),
        species_report.select("target_id", F.posexplode("warnings").alias("ord", "warning")),
        *([unbuilt] if unbuilt is not None else []),
        *([picked["universe"].where("status = 'warn'").select("target_id", F.lit(0).alias("ord"), F.col("issue").alias("warning"))] if "universe" in picked else []),
        picked["warnings"],
        validated.select("target_id", F.col("seed_index").alias("ord"), F.explode("warnings").alias("warning")),
    ]
    warnings = candidates.roll_up_warnings(targets, sources)
    outcome = ledger.outcomes(targets, book)
    results = targets.select("target_id", "input_id", "uniprot_id", "ensembl_gene_id", "transcript_id").join(
        warnings.select("target_id", "warnings"), "target_id", "left").join(outcome, "target_id", "left").withColumn(
        "status", F.when(F.col("failed_stage").isNotNull(), "error").when(F.size("warnings") > 0, "warn").otherwise("ok"))
    results = cut_lineage(results)
    stages = cut_lineage(_stages(targets, results, seeds, slots, validated, expansion is not None or expanded_rows is not None))
    records = _records(targets, results, seeds, slots, validated, stages)
    return {**picked, "targets": targets, "species": species, "expansions": slots, "validations": validated, "results": results,
            "stages": stages, "records": records, **{f"expansion_{name}": df for name, df in grown.items()}}


def _stages(targets: DataFrame, results: DataFrame, seeds: DataFrame, slots: DataFrame, validated: DataFrame, expands: bool) -> DataFrame:
    """``(run, state_path, stage_key, status, identity_hash)``: the stages each target went through, the failed one last."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("target_id").agg(F.count("*").cast("int").alias(name))

    zero, failed = F.lit(0), F.col("failed_stage")
    facts = results.join(counted(seeds, "n_seeds"), "target_id", "left").join(counted(slots, "n_expansions"), "target_id", "left").join(
        counted(validated, "n_validations"), "target_id", "left").select(
        F.col("target_id").alias("run"), F.col("ensembl_gene_id").alias("gene_id"), "transcript_id", F.coalesce(failed != "target", F.lit(True)).alias("has_target"),
        F.col("n_seeds").isNotNull().alias("has_msa"), F.coalesce("n_expansions", zero).alias("n_expansions"),
        F.coalesce("n_validations", zero).alias("n_validations"), "failed_stage")
    keys = catalogue.stage_keys(facts, seeds.select(F.col("target_id").alias("run"), "seed_index", "pid"), include_result=True)
    if not expands:
        keys = keys.where("ord.kind <> 3")
    reached = keys.join(facts.select("run", "failed_stage", "n_expansions", "has_target"), "run")
    at = F.col("ord.kind")
    broken = F.when(failed == "target", at == 0).when(failed == "msa", at == 2).when(failed == "msa_expansion", (at == 3) & (F.col("ord.no") > F.col("n_expansions"))).otherwise(F.lit(False))
    # An order of kinds beyond the failed one was never run.
    last = F.when(failed == "target", 0).when(failed == "msa", 2).when(failed == "msa_expansion", 3).otherwise(5)
    run = reached.where(at <= last).withColumn("status", F.when(broken, "failed").otherwise("done"))
    who = targets.select(F.col("target_id").alias("run"), F.struct(*TARGET_IDENTITY).alias("target"))
    return run.join(who, "run").select(
        "run", F.format_string("%d/%04d", at, F.col("ord.no")).alias("state_path"), "stage_key", "status",
        F.when(F.col("status") == "done", identity_hash(F.struct("stage_key", "target"))).alias("identity_hash"))


def _records(targets: DataFrame, results: DataFrame, seeds: DataFrame, slots: DataFrame, validated: DataFrame, stages: DataFrame) -> DataFrame:
    named = lambda df: df.withColumnRenamed("target_id", "run")
    target = targets.select(F.col("target_id").alias("run"), F.when(F.col("status") == "ok", F.struct(*TARGET_IDENTITY)).alias("target"))
    runs = named(results).join(target, "run").select("run", "input_id", "target", "warnings", "failed_stage", F.col("issue").alias("exception"))
    kept = named(validated).drop("run_id", "seed_msa", "expanded_msa", "msa_id")
    made = catalogue.assemble_results(runs, named(seeds).select("run", "seed_index", "pid", "epli", "n_sequences_msa0"), named(slots), kept, stages)
    return made.join(catalogue.run_identity(runs, stages), "run", "left").withColumnRenamed("run", "target_id")
