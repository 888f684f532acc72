import json

from pyspark.sql import functions as F

from msalake.operators import catalogue
from msalake.plans import jobs
from msalake.sources import json as records
from msalake.sources import runs as run_files


def test_stage_audit(table, rows):
    names = ["reuse", "nostate", "dir", "gone", "broken", "running", "failed", "changed", "partial"]
    expected = table("run string, stage string, identity_hash string, dir_exists boolean", *[("r", n, "h", n == "dir") for n in names])
    states = table("run string, stage string, status string, identity_hash string, readable boolean",
                   ("r", "reuse", "done", "h", True), ("r", "broken", None, None, False), ("r", "running", "running", "h", True),
                   ("r", "failed", "failed", "h", True), ("r", "changed", "done", "x", True), ("r", "partial", "done", "h", True))
    outputs = table("run string, stage string, path string", *[("r", n, f"/{n}") for n in names], ("r", "reuse", None))
    files = table("path string", ("/reuse",), ("/nostate",), ("/changed",), ("/broken",))
    got = dict(rows(catalogue.audit_stages(expected, states, outputs, files, ["run", "stage"]), "stage", "state"))
    assert got == {"reuse": "reusable", "nostate": "stale", "dir": "unfinished", "gone": "missing", "broken": "stale",
                   "running": "unfinished", "failed": "failed", "changed": "stale", "partial": "unfinished"}


def test_stage_keys(table):
    runs = table("run string, gene_id string, transcript_id string, has_target boolean, has_msa boolean, n_expansions int, n_validations int, failed_stage string",
                 ("a", "G", "T", True, True, 1, 1, None), ("b", "G", "T", True, True, 0, 0, "msa_expansion"), ("c", None, None, False, False, 0, 0, "target"))
    seeds = table("run string, seed_index int, pid double", ("a", 1, 10.0), ("a", 2, 30.0), ("b", 1, 10.0))
    got = {}
    for r in catalogue.stage_keys(runs, seeds, include_result=True).orderBy("run", "ord").collect():
        got.setdefault(r.run, []).append(r.stage_key)
    assert got == {"a": ["target", "input", "msa", "expansion:G:T:pid_10.00", "validation:pid_10.00", "result"],
                   "b": ["target", "input", "msa", "expansion:G:T:pid_10.00", "result"], "c": ["target", "result"]}


TARGET = {"input_kind": "uniprot", "uniprot_id": "P1", "ensembl_gene_id": "G", "transcript_id": "T"}
SEED = {"pid": 10.0, "epli": None, "stockholm_path": "a/s.sto", "fasta_path": None, "summary_path": "c.csv"}


def results(spark, *objects):
    return records.parse_results(spark.createDataFrame([(f"/r{i}", json.dumps(o)) for i, o in enumerate(objects)], "run string, content string"))


def test_catalogue_load(spark, rows):
    res = results(
        spark,
        {"input_id": "P1", "status": "ok", "target": TARGET, "msa": {"seeds": [SEED, {**SEED, "pid": 30.0}, {**SEED, "pid": 60.0}]},
         "expansions": [{"n_hits": 5, "n_new_hits": 2, "match_stockholm": "e/m.sto"}, None, "junk", {"n_hits": 1}],
         "validations": [{"seed_nseq": 4, "status": "warn", "warnings": ["w"]}, 7]},
        {"input_id": "P2", "status": "error", "failed_stage": "msa_expansion", "target": TARGET, "msa": {"seeds": [SEED, SEED]}},
        {"input_id": "P3", "status": "ok", "target": {"uniprot_id": "x"}, "msa": {"seeds": [SEED]}},
    )
    files = res.where("run = '/r2'").select("run", F.struct(*[
        (F.lit("G2") if f.name in ("ensembl_gene_id", "transcript_id") else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in res.schema["target"].dataType.fields]).alias("target"))
    stats = spark.createDataFrame([("/r0", 1, 9)], "run string, seed_index int, seed_nseq long").withColumns(
        {c: F.lit(None) for c in ("query_name", "seed_ncol", "seed_clusters62", "seed_neff80", "expanded_nseq", "expanded_ncol", "expanded_clusters62",
                                  "expanded_neff80", "aln_identical", "aln_mismatches", "aln_insertions", "aln_deletions")})
    out = jobs.catalogue_tables(res, files, stats)
    assert rows(out["expansions"], "run", "seed_index", "present", "n_hits") == [
        ("/r0", 1, True, 5), ("/r0", 2, False, None), ("/r0", 3, False, None), ("/r1", 1, False, None), ("/r1", 2, False, None)]
    assert rows(out["validations"], "run", "seed_index", "seed_nseq", "status") == [("/r0", 1, 9, "warn")]
    assert rows(out["seeds"].where("run = '/r0'"), "seed_index", "pid", "stockholm_path")[0] == (1, 10.0, "/r0/a/s.sto")
    targets = {r.run: r for r in out["targets"].collect()}
    assert targets["/r0"].target.input_id == "P1" and targets["/r0"].warning and targets["/r2"].target.ensembl_gene_id == "G2"
    assert jobs.catalogue_tables(res)["targets"].where("issue is not null").count() == 1
    assert len(out["warnings"].where("run = '/r0'").collect()) == 4
    assert rows(catalogue.pick_seeds(out["seeds"], pid=30.0), "run", "seed_index")[0] == ("/r0", 2)
    assert rows(catalogue.pick_seeds(out["seeds"]), "run", "status") == [("/r0", "error"), ("/r1", "error"), ("/r2", "ok")]
    counted = spark.createDataFrame([("/r0", 1, 99, 98)], "run string, seed_index int, n_hits long, n_new_hits long")
    assert rows(jobs.catalogue_tables(res, counted=counted)["expansions"], "run", "seed_index", "n_hits")[0] == ("/r0", 1, 5)


def test_read_tree(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name / "validation").mkdir(parents=True)
        (tmp_path / name / "result.json").write_text(json.dumps({"input_id": name, "target": TARGET, "msa_part": {"seeds": [SEED]}}, indent=1))
        (tmp_path / name / "validation" / "stage_state.json").write_text(json.dumps({"stage_key": "validation", "status": "done"}))
    out = jobs.load_catalogue(spark, str(tmp_path), msa_section="msa_part")
    assert out["seeds"].count() == 2 and out["stages"].count() == 2


def test_rollup_and_assembly(spark, table, rows):
    runs = table("run string, input_id string, warnings array<string>, failed_stage string, exception string",
                 ("a", "P1", ["w"], None, None), ("b", "P2", [], "msa_expansion", "boom"), ("c", "P3", [], None, None))
    seeds = table("run string, seed_index int, pid double", ("a", 1, 10.0), ("a", 2, 30.0), ("b", 1, 10.0), ("b", 2, 30.0))
    expansions = table("run string, seed_index int, present boolean, status string, n_hits long", ("a", 1, True, "ok", 5), ("a", 2, False, None, None), ("b", 1, True, "DONE", 2))
    validations = table("run string, seed_index int, status string, seed_nseq long, seed_ncol long", ("a", 1, "warn", 4, 6), ("a", 2, "x", None, None))
    stages = table("run string, state_path string, stage_key string, status string, identity_hash string",
                   ("a", "p2", "msa", "done", "h2"), ("a", "p1", "target", "done", "h1"), ("a", "p3", "result", "done", "h3"), ("a", "p4", "x", "failed", None))
    got = {r.run: r for r in catalogue.status_rollup(runs, seeds, expansions, validations, stages).collect()}
    assert (got["a"].pid_text, got["a"].expansions_ok, got["a"].expansions_missing, got["a"].expansions_hits) == ("10.0 (4, 6), 30.0", 1, 1, 5)
    assert (got["a"].validations_warn, got["a"].validations_unknown, got["a"].stages_ok, got["a"].stages_failed, got["a"].n_warnings) == (1, 1, 3, 1, 1)
    assert got["c"].n_expansions == 0
    built = {r.run: r for r in catalogue.assemble_results(runs, seeds, expansions, validations, stages).collect()}
    assert built["a"].selected_pids == [10.0, 30.0] and built["a"].status == "warn" and built["a"].expansions[1] is None
    assert built["b"].status == "error" and [e is None for e in built["b"].expansions] == [False, True]
    assert built["c"].status == "ok" and [s.state_path for s in built["a"].stages] == ["p1", "p2", "p3", "p4"]
    ident = dict(rows(catalogue.run_identity(runs, stages), "run", "result_identity"))
    assert len(set(ident.values())) == 3
    same = dict(rows(catalogue.run_identity(runs, stages.where("stage_key <> 'result'").repartition(3)), "run", "result_identity"))
    assert same == ident


def test_catalogue_prefers_files(spark, tmp_path, rows):
    run = tmp_path / "x"
    stats = {"query_name": "q", "seed_nseq": "9", "seed_ncol": "3", "aln_identical": "false", "aln_insertions": "1"}
    header = sorted(run_files.STATS)
    for folder in ("validation/pid_10.00", "validation/pid_30.00", "elsewhere", "s", "expansion/GF/TF/pid_30.00/expanded_msa"):
        (run / folder).mkdir(parents=True)
    (run / "result.json").write_text(json.dumps({
        "input_id": "P1", "status": "ok", "target": TARGET,
        "msa": {"seeds": [{**SEED, "pid": p, "stockholm_path": f"s/{i}.sto"} for i, p in enumerate((10.0, 30.0, 60.0, 80.0))]},
        "expansions": [{"n_hits": 4, "run_dir": "e"}, {"s_exon_blocks_tsv": None}, {}, None],
        "validations": [{"seed_nseq": 1}, {"seed_nseq": 2, "warnings": ["kept"], "status": "warn"}, {"seed_nseq": 3, "stats_path": "elsewhere/stats.csv"}, {"seed_nseq": 4}]}))
    (run / "target.json").write_text(json.dumps({**TARGET, "input_id": "F", "ensembl_gene_id": "GF", "transcript_id": "TF"}))
    line = ",".join(stats.get(c, "") for c in header)
    (run / "validation/pid_10.00/stats.csv").write_text(",".join(header) + "\n" + line + "\n")
    (run / "validation/pid_30.00/stats.csv").write_text("seed_nseq\n7\n")
    (run / "elsewhere/stats.csv").write_text(",".join(header[::-1]) + "\n" + ",".join(stats.get(c, "") for c in header[::-1]) + "\n")
    (run / "validation/pid_10.00/stage_state.json").write_text(json.dumps({"stage_key": "v", "warnings": ["late"]}))
    (run / "s/1.sto").write_text("# STOCKHOLM 1.0\nold x\nold y\nb AC\n//\n")
    (run / "expansion/GF/TF/pid_30.00/expanded_msa/TF_hits_raw.fasta").write_text(">old 1\nAC\n>new\nAC\n>new\nAC\n")
    out = jobs.load_catalogue(spark, str(tmp_path))
    target = out["targets"].collect()[0]
    assert (target.target.input_id, target.target.ensembl_gene_id, target.warning, target.issue) == ("F", "GF", None, None)
    got = {r.seed_index: r for r in out["validations"].collect()}
    assert (got[1].seed_nseq, got[1].seed_ncol, got[1].query_name, got[1].status) == (9, 3, "q", "warn")
    assert got[1].warnings[0] == "late" and "insertions" in got[1].warnings[1] and got[1].warnings[1].startswith("Expanded")
    assert (got[2].seed_nseq, got[2].warnings, got[2].status) == (2, ["kept"], "warn")
    assert (got[3].seed_nseq, got[3].status) == (9, "warn") and (got[4].seed_nseq, got[4].status) == (4, "ok")
    told = {(r.ord, r.warning) for r in out["warnings"].collect()}
    assert (2, catalogue.UNREADABLE_STATS) in told and (4, catalogue.MISSING_STATS) in told and len(told) == 3
    slots = {r.seed_index: r for r in out["expansions"].collect()}
    assert [(slots[i].n_hits, slots[i].n_new_hits) for i in (1, 2, 3)] == [(4, 0), (3, 2), (0, 0)] and slots[4].n_hits is None
    root = slots[1].run_dir.removesuffix("/e")
    assert slots[1].match_stockholm == f"{root}/e/expanded_msa/TF_matchonly.sto"
    assert slots[2].s_exon_blocks_tsv is None and slots[2].seed_fasta == f"{root}/expansion/GF/TF/pid_30.00/seeds/seed_pid30.0.fasta"
    assert slots[3].s_exon_blocks_tsv.endswith("pid_60.00/expanded_msa/TF_s_exon_blocks.tsv")


def test_a_damaged_target_file_falls_back(spark, tmp_path):
    for name, text in (("a", "{"), ("b", json.dumps({"input_id": "only"}))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "result.json").write_text(json.dumps({"input_id": name, "target": TARGET}))
        (tmp_path / name / "target.json").write_text(text)
    got = jobs.load_catalogue(spark, str(tmp_path))["targets"].collect()
    assert {r.target.input_id for r in got} == {"a", "b"} and all(r.warning.startswith("The target file is unreadable.") for r in got)


def test_differing_fields_of_nested_identities(table):
    kind = "run string, identity struct<target:struct<id:string,species:string>,settings:struct<match_mode:int,ratio:double>>"
    asked = table(kind, ("same", (("a", None), (1, 0.5))), ("mode", (("a", "s"), (1, None))), ("null", (("a", None), (0, 0.5))), ("new", (("a", "s"), (1, 0.5))))
    had = table(kind, ("same", (("a", None), (1, 0.5))), ("mode", (("a", "s"), (2, None))), ("null", (("a", "s"), (0, None))))
    got = {r.run: (r.decision, r.differing) for r in catalogue.reuse_decisions(asked, had, ["run"]).collect()}
    assert got == {"same": ("reuse", []), "mode": ("rebuild", ["settings.match_mode"]), "null": ("rebuild", ["target.species", "settings.ratio"]), "new": ("run", None)}
