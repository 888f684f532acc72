"""The public jobs, each a composition of operators over tables of many targets.

Tables that several later steps read (targets, judged candidates, samples, scores) are cut with a checkpoint, so
each is computed once and plans stay short. The operators themselves stay lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import normalize_primary_input
from ..functions.ordered import cut_lineage
from ..functions.text import ungap
from ..operators import assembly, candidates, catalogue, columns, diversity, expansion, hits, names, resolve, sampling, scoring, validation
from ..sources import json as records
from ..sources import runs as run_files


def resolve_job(inputs: DataFrame, entries: DataFrame, proteins: DataFrame, lookup: DataFrame) -> DataFrame:
    """Raw inputs to targets: primary id, candidates, choice. ``inputs(target_id, id, uniprot_id,
    ensembl_transcript_id, transcript_id, ensembl_gene_id, ensembl_protein_id, species)``."""
    return resolve.resolve_targets(normalize_primary_input(inputs), entries, proteins, lookup)


def assemble_job(
    requests: DataFrame, path_table: DataFrame, exon_rows: DataFrame, s_exon_table: DataFrame,
    symbols: DataFrame | None = None, code_map: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Transcript alignments of ``requests(target_id, gene_id, transcript_id)``.

    Returns ``rows`` (with species), ``codes``, ``code_map``, ``references`` and ``report(target_id, status, issue)``.
    """
    paths = cut_lineage(assembly.transcript_paths(requests, path_table))
    exons = assembly.path_exons(paths.where("status = 'ok'"), ["target_id"])
    wanted = exons.where(F.col("s_exon_id").startswith(assembly.QUERY_ONLY_PREFIX)).join(requests, "target_id").select(
        "target_id", "s_exon_id", "gene_id", "transcript_id").distinct()
    query_only = assembly.query_only_sequences(wanted, s_exon_table)
    segments, segment_issues = assembly.exon_segments(exons, exon_rows, query_only, requests.select("target_id", "gene_id"))
    segments = cut_lineage(segments)
    rows, joined = assembly.assemble(segments)
    rows = cut_lineage(rows)
    asked = requests.select("target_id", F.lit(0).alias("id_ord"), F.col("gene_id").alias("id"))
    references = names.resolve_names(asked, rows, "target_id")
    no_reference = references.where("name is null").select(
        "target_id", F.lit("No row of the assembled alignment is the gene's own.").alias("issue"))
    problems = [paths.where("status <> 'ok'").select("target_id", "issue"), segment_issues,
                joined.where("status <> 'ok'").select("target_id", "issue"), no_reference]
    out = {"rows": assembly.species_of_rows(rows, s_exon_table), "references": references}
    if symbols is not None and code_map is not None:
        used = segments.select("target_id", "exon_ord", "s_exon_id").distinct()
        full_map, map_issues = assembly.complete_code_map(code_map, used)
        full_map = cut_lineage(full_map)
        by_segment = segments.select(F.concat_ws("|", "target_id", F.col("exon_ord").cast("string")).alias("seg_key"),
                                     "target_id", "exon_ord", "s_exon_id", "row_idx", "name", "seq")
        wanted_rows = by_segment.select("seg_key", "target_id").distinct().join(
            requests.select("target_id", "gene_id"), "target_id").select("seg_key", F.lit(0).alias("id_ord"), F.col("gene_id").alias("id"))
        reference_rows = names.resolve_names(wanted_rows, by_segment, "seg_key").where("name is not null").select(
            "seg_key", "row_idx").join(by_segment, ["seg_key", "row_idx"]).select("target_id", "exon_ord", "s_exon_id", "seq")
        codes, code_issues = assembly.project_symbols(reference_rows, symbols, full_map)
        out |= {"codes": codes, "code_map": full_map}
        problems += [map_issues, code_issues.where("status <> 'ok'").select("target_id", "issue")]
    first = None
    for i, part in enumerate(problems):
        tagged = part.select("target_id", F.lit(i).alias("o"), "issue")
        first = tagged if first is None else first.unionByName(tagged)
    worst = first.where("issue is not null").groupBy("target_id").agg(F.min_by("issue", "o").alias("issue"))
    out["report"] = requests.select("target_id").distinct().join(worst, "target_id", "left").select(
        "target_id", F.when(F.col("issue").isNull(), "ok").otherwise("error").alias("status"), "issue")
    return out


def candidates_job(
    targets: DataFrame, candidate_rows: DataFrame, strategy: str = "independent", sample_count: int = 45,
    fraction: float = 0.8, seed: int = 0, score_fn: Callable = scoring.consensus_score,
    normalization: scoring.Normalization = scoring.comparable_positions_normalization,
    input_species: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Validate, sample, score and select candidates.

    ``targets(target_id, ensembl_gene_id, transcript_id, uniprot_id, has_reference, uniprot_seq)``;
    ``candidate_rows(target_id, pid_order, pid, row_idx, name, species, seq)``, aligned. Returns ``summary``,
    ``samples``, ``scores``, ``seeds``, ``warnings`` and, for shared samples, ``universe``. A candidate without its reference row,
    and all candidates of a target whose universe lacks the reference species, are not eligible and say so.
    """
    sampling.validate_sampling(sample_count, fraction, seed, strategy)
    keys = ["target_id", "pid_order"]
    cand_key = F.concat_ws("|", "target_id", F.col("pid_order").cast("string"))
    rows = candidate_rows.withColumn("cand_key", cand_key)
    asked = rows.select("target_id", "pid_order", "pid", "cand_key").distinct().join(targets, "target_id")
    ids = asked.select("cand_key", F.posexplode(F.array("ensembl_gene_id", "transcript_id")).alias("id_ord", "id")).where("id is not null")
    reference = names.resolve_names(ids, rows, "cand_key").select("cand_key", F.col("row_idx").alias("ref_idx"))
    ref_rows = reference.where("ref_idx is not null").join(
        rows.select("cand_key", F.col("row_idx").alias("ref_idx"), F.col("name").alias("query_name"),
                    F.upper(ungap("seq")).alias("query_seq"), F.col("species").alias("ref_species")), ["cand_key", "ref_idx"])
    judged = _excluded(candidates.validate_candidates(asked.join(ref_rows, "cand_key", "left")),
                       F.when(F.col("ref_idx").isNull(), "The alignment has no row of the reference gene or transcript."))
    universe = report = None
    if strategy != "independent" and sample_count:
        if strategy == "input" and input_species is None:
            raise ValueError("strategy input needs a table of species")
        species = sampling.candidate_species(rows, keys)
        universe = sampling.common_universe(species, judged.select(*keys, "eligible")) if strategy == "common" else input_species
        first = judged.where("eligible").groupBy("target_id").agg(F.min_by("ref_species", "pid_order").alias("ref_species"))
        report = sampling.universe_report(universe, first.withColumnRenamed("ref_species", "species"), strategy)
        failed = report.where("status = 'error'").select("target_id", F.col("issue").alias("_universe"))
        judged = _excluded(judged.join(failed, "target_id", "left"), F.col("_universe")).drop("_universe")
    judged = cut_lineage(judged)
    eligible = judged.where("eligible").select(*keys, "ref_idx", "ref_species")
    if sample_count == 0:
        summary = candidates.candidate_summary(
            judged.drop("query_seq", "uniprot_seq"),
            judged.select(*keys).limit(0).withColumns({"epli": F.lit(0.0), "n_samples": F.lit(0).cast("long")}), rows, 0, keys)
        return {"summary": summary, "seeds": candidates.select_seeds(summary, 0), "warnings": candidates.candidate_warnings(summary)}
    if strategy == "independent":
        members = rows.join(eligible, keys).select(*keys, "row_idx", F.col("row_idx").eqNullSafe(F.col("ref_idx")).alias("is_ref"))
        samples = cut_lineage(sampling.draw_samples(members, keys, "row_idx", F.col("is_ref"), sample_count, fraction, seed))
        sampled = samples.join(rows.select(*keys, "row_idx", "name", "species", "seq"), [*keys, "row_idx"])
    else:
        first = eligible.groupBy("target_id").agg(F.min_by("ref_species", "pid_order").alias("ref_species"))
        members = universe.join(first, "target_id").select(
            "target_id", "species", F.col("species").eqNullSafe(F.col("ref_species")).alias("is_ref"))
        shared = cut_lineage(sampling.draw_samples(members, ["target_id"], "species", F.col("is_ref"), sample_count, fraction, seed))
        samples = sampling.link_samples(shared, judged.select(*keys, "eligible"))
        sampled = samples.join(rows.select(*keys, "row_idx", "name", "species", "seq"), [*keys, "species"])
    sample_keys = [*keys, "sample"]
    raw = score_fn(rows.join(eligible.select(*keys), keys, "left_semi"), sampled, keys, sample_keys)
    n_ref = rows.groupBy(*keys).agg(F.count("*").alias("n_sequences_reference"))
    sizes = sampled.groupBy(*sample_keys, "sample_label").agg(F.count("*").alias("n_sequences_sample")).join(n_ref, keys)
    scores = cut_lineage(scoring.sample_scores(sizes, raw, sample_keys, normalization, self_keys=keys))
    summary = cut_lineage(candidates.candidate_summary(
        judged.drop("query_seq", "uniprot_seq"), scoring.epli(scores, keys), rows, sample_count, keys))
    out = {"summary": summary, "samples": samples, "scores": scores, "seeds": candidates.select_seeds(summary, sample_count),
           "warnings": candidates.candidate_warnings(summary)}
    return out | ({"universe": report} if report is not None else {})


def _excluded(judged: DataFrame, problem) -> DataFrame:
    """Candidates that were eligible but have a ``problem`` no longer are; the problem becomes their issue."""
    hit = F.col("eligible") & problem.isNotNull()
    return judged.withColumns({
        "eligible": F.col("eligible") & problem.isNull(), "msa0_status": F.when(hit, "invalid_msa0").otherwise(F.col("msa0_status")),
        "msa0_issue": F.when(hit, problem).otherwise(F.col("msa0_issue"))})


def expand_job(seed_rows: DataFrame, seed_cols: DataFrame, code_map: DataFrame, raw_hits: DataFrame, aligned_rows: DataFrame,
               aligned_cols: DataFrame, centroid_members: DataFrame | None = None, centroid_rows: DataFrame | None = None,
               centroid_cols: DataFrame | None = None, key: str = "msa_id") -> dict[str, DataFrame]:
    """Hits and expanded alignment outputs of many seeds at once.

    ``seed_rows(key, row_idx, name, seq)``, ``seed_cols(key, pid, col_idx, code, rf, aligned)``, ``raw_hits(key, line_no,
    target, tseq)``, ``aligned_rows(key, row_idx, name, seq)``, ``aligned_cols(key, pid, col_idx, rf, aligned)``: the
    alignments with new hits. A seed without new hits keeps its own rows and columns; without a ``seq`` in ``seed_rows`` the caller
    passes them as its aligned ones. ``issues(key, issue)`` are seeds whose new hits were not aligned.

    With ``centroid_members`` hits are expanded to their clusters; ``centroid_rows`` and ``centroid_cols`` are then the alignments with
    the new centroids, and their outputs are named ``centroid_...``.
    """
    seeds = hits.seed_ids(seed_rows, key)
    cleaned = hits.clean_hits(raw_hits)
    centroid_level = hits.all_hits(cleaned, key)
    out: dict[str, DataFrame] = {}
    everything = centroid_level
    if centroid_members is not None:
        centroid_level = cut_lineage(centroid_level)
        out["centroid_hits"] = centroid_level
        out["centroid_new_hits"] = hits.new_hits(centroid_level, seeds, key)
        everything = hits.all_hits(hits.expand_members(centroid_level, centroid_members, key), key)
    everything = cut_lineage(everything)
    out["hits"] = everything
    out["new_hits"] = hits.new_hits(everything, seeds, key)
    out["counts"] = hits.hit_counts(seed_rows, everything, seeds, key)
    priority = seed_rows.select(key, "name", F.col("row_idx").alias("prio"))
    codes = columns.seed_match_codes(seed_cols, [key, "pid"])
    blocks, issues = {}, []

    def outputs(prefix: str, label: str, new: DataFrame, rows: DataFrame, cols: DataFrame) -> None:
        if "seq" in seed_rows.columns:
            rows, cols, lacking = expansion.level_alignment(seed_rows, seed_cols, new, rows, cols, key)
            issues.append(lacking)
        made = expansion.restored_outputs(rows, cols, codes, priority, key)
        out[prefix + "hit_rows"] = hits.hit_rows(rows, seeds, key)
        out.update({prefix + name: df for name, df in made.items()})
        blocks[f"{label}_match"], blocks[f"{label}_full"] = made["match_cols"], made["full_cols"]

    outputs("", "expanded", out["new_hits"], aligned_rows, aligned_cols)
    if centroid_members is not None and centroid_rows is not None and centroid_cols is not None:
        outputs("centroid_", "centroid", out["centroid_new_hits"], centroid_rows, centroid_cols)
    out["blocks"] = columns.block_tables(blocks, code_map, key)
    out["issues"] = reduce(DataFrame.unionByName, issues) if issues else seed_rows.limit(0).select(key, F.lit("").alias("issue"))
    return out


def validate_job(runs: DataFrame, rows: DataFrame, ids: DataFrame, references: DataFrame, cluster_threshold: float = 62.0,
                 neff_threshold: float = 80.0) -> DataFrame:
    """``runs(run_id, seed_msa, expanded_msa)``, ``rows(msa_id, row_idx, name, seq)``, ``ids(msa_id, id_ord, id)``,
    ``references(run_id, reference_seq)``."""
    stats = diversity.alignment_stats(rows, "msa_id", cluster_threshold, neff_threshold)
    named = names.resolve_names(ids, rows, "msa_id", fallback=True)
    queries = named.join(rows.select("msa_id", "row_idx", "seq"), ["msa_id", "row_idx"]).select(
        "msa_id", F.col("name").alias("query_name"), F.upper(ungap("seq")).alias("query_seq"))
    return validation.validation_rows(runs, stats, queries, references)


def stability_job(records_: DataFrame, keys: list[str], aligner: Callable | None = None, reference: str | None = None,
                  sample_count: int = 45, fraction: float = 0.8, seed: int = 0, score_fn: Callable = scoring.consensus_score,
                  normalization: scoring.Normalization = scoring.comparable_positions_normalization) -> tuple[DataFrame, DataFrame]:
    """Stability of sequence sets: sample rows, align each sample, score against the full alignment, take the median.

    ``records_(keys, rec_idx, name, seq)``. Without an ``aligner`` the rows are taken as aligned already.
    """
    sampling.validate_sampling(max(sample_count, 1), fraction, seed)
    if sample_count < 1:
        raise ValueError("sample_count must be positive")
    if reference is None:
        firsts = records_.groupBy(*keys).agg(F.min("rec_idx").alias("_ref"))
    else:
        firsts = records_.where(F.col("name") == reference).groupBy(*keys).agg(F.min("rec_idx").alias("_ref"))
    members = records_.join(firsts, keys).select(*keys, "rec_idx", (F.col("rec_idx") == F.col("_ref")).alias("is_ref"))
    samples = cut_lineage(sampling.draw_samples(members, keys, "rec_idx", F.col("is_ref"), sample_count, fraction, seed, "sequence_subset"))
    sample_keys = [*keys, "sample"]
    if aligner is None:
        full, sampled = records_, samples.join(records_, [*keys, "rec_idx"])
    else:
        bare = records_.withColumn("seq", ungap("seq"))
        full = cut_lineage(scoring.align_samples(bare, keys, aligner))
        drawn = samples.join(bare, [*keys, "rec_idx"]).drop("rec_idx").withColumnRenamed("draw", "rec_idx")
        sampled = scoring.align_samples(drawn, sample_keys, aligner)
    raw = score_fn(full, sampled, keys, sample_keys)
    n_ref = records_.groupBy(*keys).agg(F.count("*").alias("n_sequences_reference"))
    sizes = samples.groupBy(*sample_keys, "sample_label").agg(F.count("*").alias("n_sequences_sample")).join(n_ref, keys)
    own = None
    if normalization is scoring.self_reference_normalization:
        copies = full.withColumn("sample", F.lit(0))
        own = score_fn(full, copies, keys, sample_keys).drop("sample")
    scores = cut_lineage(scoring.sample_scores(sizes, raw, sample_keys, normalization, own, keys))
    return scores, scoring.epli_summary(scores, keys, sample_count, fraction, seed, getattr(score_fn, "__name__", "score"),
                                        getattr(normalization, "__name__", "normalization"))


def load_catalogue(spark: SparkSession, root: str, msa_section: str = "msa") -> dict[str, DataFrame]:
    """Results and manifests of every run under ``root``, with what its target, stats and sequence files say."""
    documents, sequence_names, files = run_files.scan_runs(spark, root)
    return catalogue_from_files(documents, sequence_names, files, msa_section)


def catalogue_from_files(documents: DataFrame, sequence_names: DataFrame, files: DataFrame, msa_section: str = "msa") -> dict[str, DataFrame]:
    """``documents(path, content)``, ``sequence_names(path, name)``, ``files(path)`` of many run folders to catalogue tables."""
    results = cut_lineage(records.parse_results(run_files.documents_named(documents, "result.json", "run"), msa_section))
    target_files = run_files.target_files(documents)
    seeds = catalogue.load_seeds(results)
    paths = cut_lineage(run_files.expansion_paths(results, seeds, catalogue.load_targets(results, target_files)))
    counted = run_files.counted_hits(paths, sequence_names, files)
    stats = cut_lineage(run_files.stats_rows(results, seeds, documents))
    tables = catalogue_tables(results, target_files, stats, counted, paths)
    states = documents.where(F.col("path").endswith("/stage_state.json")).select(F.col("path").alias("state_path"), "content")
    return tables | {"stages": records.manifests(states)}


def catalogue_tables(results: DataFrame, target_files: DataFrame | None = None, stats: DataFrame | None = None,
                     counted: DataFrame | None = None, paths: DataFrame | None = None) -> dict[str, DataFrame]:
    seeds = catalogue.load_seeds(results)
    expansions, expansion_warnings = catalogue.load_expansions(results, seeds, counted, paths)
    validations, validation_warnings = catalogue.load_validations(results, seeds, stats, expansions)
    return {"targets": catalogue.load_targets(results, target_files), "seeds": seeds, "expansions": expansions,
            "validations": validations, "warnings": expansion_warnings.unionByName(validation_warnings)}
