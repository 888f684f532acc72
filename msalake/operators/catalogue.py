"""Run catalogue: stage audit, stage keys, status roll-ups, result loading and assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import differing_fields, identity_hash, resolve_path
from ..functions.text import pid_key, pid_label, status_class
from ..sources.json import EXPANSION_FIELDS, VALIDATION_FIELDS, parse_json
from .validation import comparison_warning


def audit_stages(expected: DataFrame, states: DataFrame, outputs: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Classify each expected stage: ``reusable, stale, unfinished, missing`` or its own recorded status.

    ``expected(keys, identity_hash, dir_exists)``; ``states(keys, status, identity_hash, readable)`` holds the
    manifests found; ``outputs(keys, path)`` the required outputs (NULL paths need nothing); ``files(path)`` what
    exists. Adds ``state, reusable, warning``.
    """
    have = files.select("path").distinct().withColumn("_there", F.lit(True))
    ready = outputs.where("path is not null").join(have, "path", "left").groupBy(*keys).agg(
        F.bool_and(F.col("_there").isNotNull()).alias("_ready"))
    found = states.select(*keys, F.col("status").alias("_status"), F.col("identity_hash").alias("_hash"),
                          "readable", F.lit(True).alias("_found"))
    joined = expected.join(found, keys, "left").join(ready, keys, "left")
    outputs_ready = F.coalesce("_ready", F.lit(True))
    status = F.coalesce("_status", F.lit("stale"))
    absent = F.col("_found").isNull()
    cases = [
        (absent & outputs_ready, F.lit("stale"), F.lit("There are outputs without a manifest, so nothing tells whose they are.")),
        (absent & F.col("dir_exists"), F.lit("unfinished"), F.lit("The stage's folder has neither a manifest nor all its outputs.")),
        (absent, F.lit("missing"), F.lit(None).cast("string")),
        (~F.col("readable"), F.lit("stale"), F.lit("The manifest is unreadable.")),
        (status == "running", F.lit("unfinished"), F.lit("The stage was left while it ran.")),
        (status != "done", status, F.concat(F.lit("The stage was left with status "), status, F.lit("."))),
        (~F.coalesce("_hash", F.lit("")).eqNullSafe(F.col("identity_hash")), F.lit("stale"),
         F.lit("The recorded identity is not the one asked for.")),
        (~outputs_ready, F.lit("unfinished"), F.lit("The manifest says done, but outputs are lacking.")),
    ]
    state, warning = None, None
    for test, name, text in cases:
        state = F.when(test, name) if state is None else state.when(test, name)
        warning = F.when(test, text) if warning is None else warning.when(test, text)
    state = state.otherwise("reusable")
    return joined.select(*keys, state.alias("state"), (state == "reusable").alias("reusable"), warning.alias("warning"))


def stage_keys(runs: DataFrame, seeds: DataFrame, key: str = "run", include_result: bool = False) -> DataFrame:
    """``(run, ord, stage_key)`` of the stages a run should have.

    ``runs(run, gene_id, transcript_id, has_target, has_msa, n_expansions, n_validations, failed_stage)``;
    ``seeds(run, seed_index, pid)``. The stage that failed counts as one more key of its kind.
    """
    def with_failed(count: str, stage: str) -> Column:
        return F.col(count) + F.when(F.col("failed_stage") == stage, 1).otherwise(0)

    def fixed(ord_: int, name: str, test: Column) -> DataFrame:
        return runs.where(test).select(key, F.lit(ord_).cast("long").alias("kind"), F.lit(0).cast("long").alias("no"), F.lit(name).alias("stage_key"))

    started = F.col("has_target") | F.col("has_msa")
    per_seed = seeds.join(runs.where("has_msa"), key)
    pid = pid_key("pid")
    expansions = per_seed.where(F.col("has_target") & (F.col("seed_index") <= with_failed("n_expansions", "msa_expansion"))).select(
        key, F.lit(3).cast("long").alias("kind"), F.col("seed_index").cast("long").alias("no"),
        F.concat_ws(":", F.lit("expansion"), "gene_id", "transcript_id", pid).alias("stage_key"))
    validations = per_seed.where(F.col("seed_index") <= with_failed("n_validations", "validation")).select(
        key, F.lit(4).cast("long").alias("kind"), F.col("seed_index").cast("long").alias("no"),
        F.concat_ws(":", F.lit("validation"), pid).alias("stage_key"))
    parts = fixed(0, "target", F.lit(True)).unionByName(fixed(1, "input", started)).unionByName(fixed(2, "msa", started)).unionByName(
        expansions).unionByName(validations)
    if include_result:
        parts = parts.unionByName(fixed(5, "result", F.lit(True)))
    return parts.groupBy(key, "stage_key").agg(F.min(F.struct("kind", "no")).alias("ord")).select(key, "ord", "stage_key")


def count_statuses(items: DataFrame, key: str, prefix: str, hits: str | None = None) -> DataFrame:
    """Counts per status class; a NULL item (``present`` false) counts as missing."""
    cls = F.when(~F.col("present"), "missing").otherwise(status_class("status"))
    counts = [F.count_if(cls == c).alias(f"{prefix}_{c}") for c in ("ok", "warn", "failed", "unknown", "missing")]
    total = [F.coalesce(F.sum(F.when(F.col("present"), F.col(hits))), F.lit(0)).cast("long").alias(f"{prefix}_hits")] if hits else []
    return items.groupBy(key).agg(F.count("*").alias(f"n_{prefix}"), *counts, *total)


def msa_dimensions(seeds: DataFrame, validations: DataFrame, key: str = "run", side: str = "seed") -> DataFrame:
    """``(run, pid_text)``: selected thresholds, each with the dimensions found by the validation of the same index."""
    joined = seeds.join(validations.select(key, "seed_index", F.col(f"{side}_nseq").alias("_n"), F.col(f"{side}_ncol").alias("_c")),
                        [key, "seed_index"], "left")
    text = F.concat(pid_label("pid"), F.when(F.col("_n").isNotNull() & F.col("_c").isNotNull(), F.concat(
        F.lit(" ("), "_n", F.lit(", "), "_c", F.lit(")"))).otherwise(""))
    return joined.groupBy(key).agg(
        F.count("*").alias("n_seeds"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seed_index", text.alias("t")))), lambda p: p["t"]), ", ").alias("pid_text"))


def status_rollup(runs: DataFrame, seeds: DataFrame, expansions: DataFrame, validations: DataFrame, stages: DataFrame,
                  key: str = "run") -> DataFrame:
    """One row per run. ``runs(run, warnings)``, ``expansions(run, present, status, n_hits)``,
    ``validations(run, seed_index, status, seed_nseq, seed_ncol)``, ``stages(run, status)``."""
    here = F.lit(True).alias("present")
    parts = [
        msa_dimensions(seeds, validations, key),
        count_statuses(expansions, key, "expansions", hits="n_hits"),
        count_statuses(validations.select(key, "status", here), key, "validations"),
        count_statuses(stages.select(key, "status", here), key, "stages"),
    ]
    out = runs.select(key, F.size("warnings").alias("n_warnings"))
    for part in parts:
        out = out.join(part, key, "left")
    return out.fillna(0)


def load_targets(results: DataFrame, target_files: DataFrame | None = None) -> DataFrame:
    """``(run, target, warning, issue)``; a readable target file overrides the record's own target.

    ``target_files(run, target[, file_issue])``. Without any target the run is an error.
    """
    base = results.select("run", F.col("target").alias("_embedded"), F.coalesce("input_id", F.lit("")).alias("_input"))
    none = F.lit(None).cast("string")
    if target_files is None:
        joined = base.withColumns({"_file": F.lit(None).cast(results.schema["target"].dataType), "_problem": none})
    else:
        problem = F.col("file_issue") if "file_issue" in target_files.columns else none
        joined = base.join(target_files.select("run", F.col("target").alias("_file"), problem.alias("_problem")), "run", "left")
    usable = F.col("_file.ensembl_gene_id").isNotNull() & F.col("_file.transcript_id").isNotNull()
    embedded = F.col("_embedded").withField("input_id", F.coalesce("_embedded.input_id", "_input"))
    embedded_ok = F.col("_embedded.ensembl_gene_id").isNotNull() & F.col("_embedded.transcript_id").isNotNull()
    target = F.when(usable, F.col("_file")).when(embedded_ok, embedded)
    told = F.concat_ws(" ", "_problem", F.lit("The target is the result record's own; paths of its sequence files may be lacking."))
    return joined.select(
        "run", target.alias("target"), F.when(~F.coalesce(usable, F.lit(False)) & target.isNotNull(), told).alias("warning"),
        F.when(target.isNull(), "The run has no target.").alias("issue"))


def load_seeds(results: DataFrame) -> DataFrame:
    """``(run, seed_index, <seed fields>)`` with artifact paths resolved against the run folder."""
    rows = results.select("run", F.posexplode("msa.seeds").alias("p", "s"))
    return rows.select(
        "run", (F.col("p") + 1).alias("seed_index"), "s.pid", "s.epli",
        resolve_path("s.stockholm_path", "run").alias("stockholm_path"), resolve_path("s.fasta_path", "run").alias("fasta_path"),
        resolve_path("s.s_exon_blocks_tsv", "run").alias("s_exon_blocks_tsv"),
        resolve_path("s.summary_path", "run").alias("summary_path"),
        F.coalesce("s.used_fallback_dir", F.lit(False)).alias("used_fallback_dir"))


def load_expansions(results: DataFrame, seeds: DataFrame, counted: DataFrame | None = None,
                    paths: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Expansions aligned with seeds, and ``(run, ord, warning)``.

    Slot i belongs to seed i. A missing or malformed slot is kept as a row with ``present`` false; slots past the
    last seed are dropped with a warning. A run that failed in expansion before any summary gets one such row per
    seed; any other run without summaries has none. Hit counts absent from the record come from
    ``counted(run, seed_index, n_hits, n_new_hits)``; ``paths(run, seed_index, <path fields>)`` are where a slot's files lie.
    """
    slots = results.select("run", F.posexplode("expansions").alias("p", "text")).select(
        "run", (F.col("p") + 1).alias("seed_index"), "text")
    totals = results.select("run", F.coalesce(F.size("expansions"), F.lit(0)).alias("_size"), "failed_stage").withColumn(
        "_n", F.greatest("_size", F.lit(0)))
    padded = (F.col("_n") > 0) | (F.col("failed_stage") == "msa_expansion")
    wanted = seeds.select("run", "seed_index").join(totals.where(padded), "run")
    parsed = wanted.join(slots, ["run", "seed_index"], "left").withColumn(
        "e", F.when(F.col("text").startswith("{"), parse_json("text", EXPANSION_FIELDS)))
    present = F.col("e").isNotNull()
    rows = parsed.select(
        "run", "seed_index", present.alias("present"), F.when(present, F.coalesce("e.status", F.lit("ok"))).alias("status"),
        F.col("e.n_hits").alias("n_hits"), F.col("e.n_new_hits").alias("n_new_hits"),
        resolve_path("e.match_stockholm", "run").alias("match_stockholm"),
        resolve_path("e.full_stockholm", "run").alias("full_stockholm"),
        resolve_path("e.hits_fasta", "run").alias("hits_fasta"), F.col("text"), "_n", "failed_stage")
    if counted is not None:
        c = counted.select("run", "seed_index", F.col("n_hits").alias("_h"), F.col("n_new_hits").alias("_nh"))
        rows = rows.join(c, ["run", "seed_index"], "left").withColumns({
            "n_new_hits": F.coalesce("n_new_hits", F.when(F.col("n_hits").isNull(), F.col("_nh"))),
            "n_hits": F.coalesce("n_hits", "_h")}).drop("_h", "_nh")
    if paths is not None:
        fields = [c for c in paths.columns if c not in ("run", "seed_index", "counted", "seed_path")]
        rows = rows.drop(*fields).join(paths.select("run", "seed_index", *fields), ["run", "seed_index"], "left")
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({
        "n_hits": F.when(F.col("present"), F.coalesce("n_hits", zero)),
        "n_new_hits": F.when(F.col("present"), F.coalesce("n_new_hits", zero))})
    slot_text = F.when(F.col("_n") == 0, "The run stopped before any expansion was recorded; each seed keeps an empty slot.").when(
        F.col("text").isNull() | (F.col("text") == "null"), "No expansion is recorded for this seed.").otherwise(
        "What is recorded as this seed's expansion is no object.")
    slot_warnings = rows.where("not present").select("run", F.col("seed_index").cast("long").alias("ord"), slot_text.alias("warning"))
    n_seeds = seeds.groupBy("run").agg(F.count("*").alias("_s"))
    extra = totals.join(n_seeds, "run", "left").where(F.col("_n") > F.coalesce("_s", zero)).select(
        "run", F.lit(1 << 30).cast("long").alias("ord"), F.lit("More expansions are recorded than there are seeds; the rest is left out.").alias("warning"))
    return rows.drop("text", "_n", "failed_stage"), slot_warnings.unionByName(extra)


MISSING_STATS = "No stats file of this validation was found; the values are the result record's own."
UNREADABLE_STATS = "The stats file of this validation cannot be read; the values are the result record's own."


def load_validations(results: DataFrame, seeds: DataFrame, stats: DataFrame | None = None,
                     expansions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Validations aligned with seeds, and ``(run, ord, warning)``; a readable stats row overrides the record's values.

    ``stats(run, seed_index, <stats columns>[, found, readable, stage_warnings])`` re-read from the stats files;
    ``expansions(run, seed_index, present)`` say whether a comparison was that of an expanded alignment.
    """
    slots = results.select("run", F.posexplode("validations").alias("p", "text")).select(
        "run", (F.col("p") + 1).alias("seed_index"), F.when(F.col("text").startswith("{"), parse_json("text", VALIDATION_FIELDS)).alias("v"))
    matched = slots.join(seeds.select("run", "seed_index", "pid"), ["run", "seed_index"], "left")
    usable = F.col("v").isNotNull() & F.col("pid").isNotNull()
    skipped = matched.where(~usable).select(
        "run", F.col("seed_index").cast("long").alias("ord"),
        F.lit("A recorded validation is no object or belongs to no seed; it is left out.").alias("warning"))
    fields = ["query_name", "seed_nseq", "seed_ncol", "seed_clusters62", "seed_neff80", "expanded_nseq", "expanded_ncol",
              "expanded_clusters62", "expanded_neff80", "aln_identical", "aln_mismatches", "aln_insertions", "aln_deletions"]
    rows = matched.where(usable).select(
        "run", "seed_index", "pid", *[F.col(f"v.{f}").alias(f) for f in fields],
        F.coalesce("v.warnings", F.array().cast("array<string>")).alias("warnings"),
        F.coalesce("v.status", F.lit("ok")).alias("status"))
    if stats is None:
        fallback = rows.select("run", "seed_index", F.lit(MISSING_STATS).alias("warning"))
    else:
        # A stats file without a verdict of its own counts as found and readable.
        given = {"found": F.lit(True), "readable": F.lit(True), "stage_warnings": F.lit(None).cast("array<string>")}
        own = stats.select("run", "seed_index", *[(F.col(c) if c in stats.columns else d).alias(f"_{c}") for c, d in given.items()],
                           *[F.col(f).alias(f"_{f}") for f in fields])
        grown = expansions.where("present").select("run", "seed_index", F.lit(True).alias("_grown")) if expansions is not None else None
        joined = rows.join(own, ["run", "seed_index"], "left")
        joined = joined.withColumn("_grown", F.lit(False)) if grown is None else joined.join(grown, ["run", "seed_index"], "left")
        use = F.coalesce(F.col("_found") & F.col("_readable"), F.lit(False))
        fallback = joined.where(~use).select("run", "seed_index", F.when(F.coalesce("_found", F.lit(False)), UNREADABLE_STATS).otherwise(MISSING_STATS).alias("warning"))
        merged = joined.select("run", "seed_index", "pid", *[F.when(use, F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields],
                               "warnings", "status", "_stage_warnings", "_grown", (use & F.col("_stage_warnings").isNotNull()).alias("_renew"))
        # Warnings of a stats file are those of its manifest and what its own figures say.
        renewed = F.array_distinct(F.concat("_stage_warnings", F.array_compact(F.array(comparison_warning(F.coalesce("_grown", F.lit(False)))))))
        rows = merged.withColumn("warnings", F.when(F.col("_renew"), renewed).otherwise(F.col("warnings"))).withColumn(
            "status", F.when(~F.col("_renew"), F.col("status")).when(F.size("warnings") > 0, "warn").otherwise("ok")).drop(
            "_stage_warnings", "_grown", "_renew")
    fallback = fallback.select("run", F.col("seed_index").cast("long").alias("ord"), "warning")
    return rows, skipped.unionByName(fallback)


def pick_seeds(seeds: DataFrame, pid: float | None = None, index: int | None = None) -> DataFrame:
    """One seed per run by threshold or by index, never both; with neither, the run must have a single seed.

    ``(run, seed_index, status, issue)``.
    """
    if pid is not None and index is not None:
        raise ValueError("choose a seed by pid or by index")
    if index is not None:
        test = F.col("seed_index") == index
        issue = F.concat(F.lit(f"seed index {index} is outside 1:"), F.col("n"), F.lit("."))
    elif pid is not None:
        test = F.col("pid") == float(pid)
        issue = F.lit(f"No seed has threshold {pid}.")
    else:
        test = F.lit(True)
        issue = F.lit(None).cast("string")
    picked = seeds.groupBy("run").agg(F.count("*").alias("n"), F.min(F.when(test, F.col("seed_index"))).alias("seed_index"))
    if pid is None and index is None:
        problem = F.when(F.col("n") > 1, F.concat(F.lit("The run has "), "n", F.lit(" seeds, so a pid or an index is needed.")))
    else:
        problem = F.when(F.col("seed_index").isNull(), issue)
    return picked.select("run", F.when(problem.isNull(), F.col("seed_index")).alias("seed_index"),
                         F.when(problem.isNull(), "ok").otherwise("error").alias("status"), problem.alias("issue"))


def _gather(df: DataFrame, key: str, ord_col: str, fields: list[str], name: str) -> DataFrame:
    """Ordered array of structs per run. A run holds a few slots (one per threshold), so the array is short."""
    item = F.struct(F.col(ord_col).alias("o"), F.struct(*fields).alias("v"))
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(item)), lambda p: p["v"]).alias(name))


def assemble_results(runs: DataFrame, seeds: DataFrame, expansions: DataFrame, validations: DataFrame, stages: DataFrame,
                     key: str = "run") -> DataFrame:
    """Nested record per run, failed runs included.

    ``runs(run, input_id, target, warnings, failed_stage, exception)``. A failed run has status ``error`` and keeps
    its partial parts; one that failed in expansion gets a NULL slot for each seed without an expansion.
    """
    index = seeds.select(key, "seed_index")
    failed = runs.where("failed_stage = 'msa_expansion'").select(key)
    missing = index.join(failed, key, "left_semi").join(expansions.select(key, "seed_index"), [key, "seed_index"], "left_anti")
    e_fields = [c for c in expansions.columns if c not in (key, "seed_index", "present")]
    slot = F.when(F.col("present"), F.struct(*e_fields))
    e_rows = expansions.select(key, "seed_index", slot.alias("slot"))
    e_rows = e_rows.unionByName(missing.withColumn("slot", F.lit(None).cast(e_rows.schema["slot"].dataType)))
    e = e_rows.groupBy(key).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("seed_index").alias("o"), F.col("slot").alias("v")))), lambda p: p["v"]).alias("expansions"))
    s_fields = [c for c in seeds.columns if c not in (key, "seed_index")]
    v_fields = [c for c in validations.columns if c not in (key, "seed_index")]
    s = _gather(seeds, key, "seed_index", s_fields, "seeds")
    v = _gather(validations, key, "seed_index", v_fields, "validations")
    st = _gather(stages, key, "state_path", [c for c in stages.columns if c != key], "stages")
    out = runs
    for part in (s, e, v, st):
        out = out.join(part, key, "left")
    status = F.when(F.col("failed_stage").isNotNull(), "error").when(F.size("warnings") > 0, "warn").otherwise("ok")
    return out.withColumn("status", status).withColumn("selected_pids", F.transform("seeds", lambda x: x["pid"]))


def run_identity(runs: DataFrame, stages: DataFrame, key: str = "run") -> DataFrame:
    """``(run, result_identity)``: hash over the input id and the stage hashes in manifest order.

    The result stage itself and stages without a hash do not count.
    """
    used = stages.where("identity_hash is not null and stage_key <> 'result'")
    hashes = used.groupBy(key).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("state_path", "identity_hash"))), lambda p: p["identity_hash"]).alias("stage_hashes"))
    joined = runs.select(key, "input_id").join(hashes, key, "left").withColumn(
        "stage_hashes", F.coalesce("stage_hashes", F.array().cast("array<string>")))
    return joined.select(key, identity_hash(F.struct("input_id", "stage_hashes")).alias("result_identity"))


def reuse_decisions(requested: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """May a recorded run stand for a requested one? ``(keys, decision, differing)`` for every request.

    Both tables are ``(keys, identity)`` with one nested identity type. ``decision`` is ``reuse``, ``run`` (nothing recorded) or
    ``rebuild``, and then ``differing`` names the fields that are not the same, NULLs compared as values.
    """
    kind = requested.schema["identity"].dataType
    if recorded.schema["identity"].dataType.simpleString() != kind.simpleString():
        raise ValueError("both identities must be of one type")
    had = recorded.select(*keys, F.col("identity").alias("_had"), F.lit(True).alias("_there"))
    fields = differing_fields(F.col("identity"), F.col("_had"), kind)
    joined = requested.join(had, keys, "left").withColumn("differing", F.when(F.col("_there"), fields))
    decision = F.when(F.col("_there").isNull(), "run").when(F.size("differing") == 0, "reuse").otherwise("rebuild")
    return joined.select(*keys, decision.alias("decision"), "differing")
