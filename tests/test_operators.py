from pyspark.sql import functions as F

from msalake.functions import ordered
from msalake.operators import assembly, candidates, columns, hits, names, resolve, sampling, scoring, speciesfilter, validation


def test_xrefs_and_resolution(spark, table, rows):
    ref = "struct<database:string,id:string,isoformId:string,properties:array<struct<key:string,value:string>>>"
    xrefs = [
        ("PDB", "1ABC", None, None),
        ("Ensembl", "ENST000001.1", "P20963-1", [("GeneId", "ENSG000001"), ("ProteinId", "ENSP000001.5")]),
        ("Ensembl", "ENST000002", None, [("ProteinId", "ENSP000002")]),
        ("Ensembl", "ENST000001.1", None, [("GeneId", "ENSG000001")]),
    ]
    entries = table(f"uniprot_id string, species string, protein_sequence string, xrefs array<{ref}>",
                    ("P20963", "Homo sapiens", "ACDE", xrefs), ("Q99999", None, "AC", []))
    flat = resolve.explode_xrefs(entries)
    tmap = resolve.fill_default_genes(resolve.transcript_map(flat), resolve.default_genes(flat))
    assert rows(tmap, "ord", "transcript_id", "gene_id", "protein_id", "isoform_id") == [
        (1, "ENST000001.1", "ENSG000001", "ENSP000001.5", "P20963-1"), (2, "ENST000002", "ENSG000001", "ENSP000002", None)]
    proteins = table("protein_id string, seq string", ("ENSP000001", "acde"), ("ENSP000002.9", "ACDE"))
    cands = resolve.validate_candidates(tmap, entries, proteins)
    assert cands.count() == 2
    req = table("uniprot_id string, wanted_transcript string", ("P20963", None), ("Q99999", None))
    got = {r.uniprot_id: r for r in resolve.choose_candidates(req, cands).collect()}
    assert got["P20963"].transcript_id == "ENST000001.1" and "first is taken: ENST000001.1." in got["P20963"].warnings[0]
    assert got["Q99999"].status == "error"
    want2 = table("uniprot_id string, wanted_transcript string", ("P20963", "ENST000002.7"))
    assert resolve.choose_candidates(want2, cands).collect()[0].transcript_id == "ENST000002"

    lookup = table("transcript_id string, ensembl_gene_id string, species string, issue string",
                   ("ENST7", "ENSG7", "mus_musculus", None), ("ENST8", None, None, "no parent"))
    inputs = table("target_id string, primary_id string, input_kind string, wanted_transcript string, supplied_uniprot string, "
                   "ensembl_gene_id string, ensembl_protein_id string, species string, status string, issue string",
                   ("a", "P20963", "uniprot", "ENST000002", "P20963", None, None, None, "ok", None),
                   ("b", "ENST7.1", "ensembl_transcript", None, None, None, None, None, "ok", None),
                   ("c", "ENST8", "ensembl_transcript", None, None, None, None, None, "ok", None),
                   ("d", "ENST9", "ensembl_transcript", None, "P1", "G", None, "S", "ok", None),
                   ("e", "junk", None, None, None, None, None, None, "error", "bad id"),
                   ("f", "P11111", "uniprot", None, "P11111", None, None, None, "ok", None))
    out = {r.target_id: r for r in resolve.resolve_targets(inputs, entries, proteins, lookup).collect()}
    assert len(out) == 6
    assert (out["a"].transcript_id, out["a"].ensembl_gene_id, out["a"].species, out["a"].status) == ("ENST000002", "ENSG000001", "Homo sapiens", "ok")
    assert (out["b"].ensembl_gene_id, out["b"].species) == ("ENSG7", "mus_musculus")
    assert out["c"].issue == "no parent" and out["d"].ensembl_gene_id == "G" and out["d"].status == "ok"
    assert out["e"].issue == "bad id" and out["f"].status == "error"


def test_name_resolution(table, rows):
    msa = table("msa_id string, row_idx long, name string", ("m", 1, "1|ENSG1.2"), ("m", 2, "ENSG1"), ("m", 3, "ENSG2.1"), ("n", 1, "x"))
    req = table("msa_id string, id_ord int, id string", ("m", 0, "nothing"), ("m", 1, "ENSG2"), ("m", 2, "ENSG1"), ("n", 0, "y"))
    assert rows(names.resolve_names(req, msa)) == [("m", "ENSG2.1", 3), ("n", None, None)]
    assert rows(names.resolve_names(req, msa, fallback=True))[1] == ("n", "x", 1)
    first = table("msa_id string, id_ord int, id string", ("m", 0, "ENSG1"))
    # Row 1 claims the shared variant before row 2.
    assert rows(names.resolve_names(first, msa)) == [("m", "1|ENSG1.2", 1)]


def test_name_resolution_matches_brute_force(spark, rows):
    ids_ = [f"{p}{g}{v}" for p in ("", "1|", "x|") for g in ("G1", "G2") for v in ("", ".1")]

    def variants(s):
        bare = s.split("|", 1)[1] if "|" in s and s.split("|", 1)[0].isdigit() else s
        return list(dict.fromkeys([s, s.split(".")[0], bare, bare.split(".")[0]]))

    msa, req, want = [], [], []
    for m in range(60):
        got = [ids_[(m * 7 + k * 5) % len(ids_)] for k in range(3)]
        asked = [ids_[(m * 3 + k) % len(ids_)] for k in range(2)]
        msa += [(m, k, n) for k, n in enumerate(got)]
        req += [(m, k, n) for k, n in enumerate(asked)]
        lookup = {}
        for n in got:
            for v in variants(n):
                lookup.setdefault(v, n)
        want.append((m, next((lookup[v] for a in asked for v in variants(a) if v in lookup), None)))
    out = names.resolve_names(spark.createDataFrame(req, "msa_id long, id_ord int, id string"),
                              spark.createDataFrame(msa, "msa_id long, row_idx int, name string"))
    assert sorted((r.msa_id, r.name) for r in out.collect()) == want


def test_orders(table, rows):
    msa = table("msa_id string, row_idx long, name string", ("m", 1, "b"), ("m", 2, "a"), ("m", 3, "c"))
    prio = table("msa_id string, prio long, name string", ("m", 1, "a"), ("m", 2, "missing"))
    assert [r.name for r in names.priority_order(msa, prio).orderBy("order_key").collect()] == ["a", "b", "c"]
    src = table("msa_id string, rec_idx long, name string", ("m", 1, "x"), ("m", 2, "y"), ("n", 1, "x"))
    out = table("msa_id string, name string, seq string", ("m", "y", "AC"), ("m", "x", "A-"), ("n", "z", "A"))
    got = rows(names.reorder_like(out, src), "msa_id", "rec_idx", "seq", "status")
    assert got == [("m", 1, "A-", "ok"), ("m", 2, "AC", "ok"), ("n", 1, None, "error")]


def test_homology_levels(table):
    doc = "array<struct<homologies:array<struct<type:string,target:struct<species:string>>>>>"
    data = [([("ortholog_one2one", ("Mus musculus",)), ("ortholog_one2many", ("danio_rerio",)), ("ortholog_one2one", ("mus_musculus",))],),
            ([("ortholog_many2many", ("x_y",)), ("paralog", ("z_z",)), ("ortholog_one2one", None)],), (None,)]
    for level, n in (("1:1", 1), ("1:n", 2), ("m:n", 3)):
        df = table(f"target_id string, orthology string, data {doc}", ("t", level, data))
        assert [r.species for r in speciesfilter.homology_species(df).orderBy("ord").collect()] == ["mus_musculus", "danio_rerio", "x_y"][:n]


def _targets(table, *rows_):
    return table("target_id string, ensembl_gene_id string, species string, orthology string, has_request boolean, homology_failed boolean", *rows_)


def test_effective_species(table):
    targets = _targets(table, ("a", "G", "Homo sapiens", "1:n", True, False), ("b", "G", "homo_sapiens", "1:n", False, False),
                       ("c", "G", None, "1:n", True, False), ("d", "G", "q_q", "1:n", True, True), ("e", "G", "q_q", "1:n", True, False))
    req = table("target_id string, ord int, species string", ("a", 0, "mus_musculus"), ("a", 1, "canis_lupus"), ("c", 0, "zz"),
                ("d", 0, "x_x"), ("e", 0, "x_x"))
    orth = table("target_id string, ord int, species string", ("a", 0, "mus_musculus"), ("a", 1, "danio_rerio"),
                 ("b", 0, "danio_rerio"), ("b", 1, "homo_sapiens"), ("c", 0, "yy"))
    species, report = speciesfilter.effective_species(targets, req, orth)
    lists = {}
    for r in species.orderBy("target_id", "ord").collect():
        lists.setdefault(r.target_id, []).append(r.species)
    assert lists == {"a": ["homo_sapiens", "mus_musculus"], "b": ["homo_sapiens", "danio_rerio"], "c": ["zz"], "d": ["x_x"]}
    rep = {r.target_id: r for r in report.collect()}
    assert rep["a"].warning == "Species left out for want of orthologs of level 1:n of gene G: canis_lupus."
    assert rep["b"].status == "ok" and rep["c"].status == "warn" and rep["d"].status == "warn" and rep["e"].status == "error"


def test_dataset_filter(table):
    targets = table("target_id string, species string", ("a", "canis_lupus"), ("b", "x_y"))
    req = table("target_id string, ord int, species string", ("a", 0, "homo_sapiens"), ("a", 1, "canis_lupus"), ("a", 2, "mus_musculus"),
                ("a", 3, "canis_lupus_familiaris"), ("b", 0, "mus_musculus"))
    reg = table("dataset string", ("hsapiens_gene_ensembl",))
    species, report = speciesfilter.dataset_filter(targets, req, reg)
    assert [(r.species, r.fate) for r in species.orderBy("ord").collect()] == [
        ("homo_sapiens", "kept"), ("canis_lupus", "query"), ("canis_lupus_familiaris", "unchecked")]
    rep = {r.target_id: r for r in report.collect()}
    assert len(rep["a"].warnings) == 3 and rep["a"].warnings[0].endswith("alias of it: mus_musculus.") and rep["b"].status == "error"


def test_compose_filters(table):
    targets = _targets(table, ("a", "G", "Homo sapiens", "1:n", True, False))
    req = table("target_id string, ord int, species string", ("a", 0, "mus_musculus"), ("a", 1, "canis_lupus"))
    reg = table("dataset string", ("hsapiens_gene_ensembl",), ("mmusculus_gene_ensembl",))
    species, report = speciesfilter.compose_filters(targets, req, req.limit(1), reg)
    assert [r.species for r in species.orderBy("ord").collect()] == ["homo_sapiens", "mus_musculus"]
    assert report.collect()[0].status == "warn"
    same, _ = speciesfilter.compose_filters(targets, req, req, reg, prebuilt_input=True)
    assert same.count() == 2


def test_column_golden(table, rows):
    cols = table("msa_id string, pid double, col_idx long, code string, rf string, aligned string",
                 *[("m", 10.0, i + 1, c, None, None) for i, c in enumerate("00β=")], *[("n", 10.0, i + 1, c, None, None) for i, c in enumerate("..a.aab")])
    cmap = table("msa_id string, code string, s_exon_id string", ("m", "0", "1_0"), ("m", "β", "2_0"), ("m", "=", "3_0"), ("n", "a", "9"))
    want = [("m", "seed", 10.0, "0", "1_0", 1, 2, 2), ("m", "seed", 10.0, "=", "3_0", 4, 4, 1), ("m", "seed", 10.0, "β", "2_0", 3, 3, 1),
            ("n", "seed", 10.0, "a", "9", 3, 3, 1), ("n", "seed", 10.0, "a", "9", 5, 6, 2), ("n", "seed", 10.0, "b", "", 7, 7, 1)]
    for span in (1, 2, 3, 1000):
        assert rows(columns.block_table(cols, cmap, "msa_id", "seed", span=span)) == want


def test_projection_golden(table, rows):
    def cols(codes, mask):
        return table("m string, col_idx long, code string, rf string, aligned string",
                     *[("m", i + 1, c, "x", a) for i, (c, a) in enumerate(zip(codes, mask))])

    def text(df):
        return "".join(r.code for r in df.orderBy("col_idx").collect())

    for span in (2, 1000):
        target = cols("......", "110011")
        seed = columns.seed_match_codes(cols("0β23", "1111"), ["m"], span)
        assert text(columns.project_codes(target, seed, ["m"], span)) == "0β..23"
        masked = columns.seed_match_codes(cols("0123", "1101"), ["m"], span)
        full = columns.project_codes(target, masked, ["m"], span)
        assert text(full) == "01..3."
        assert text(columns.match_columns(full, ["m"])) == "013."
    msa = table("m string, row_idx long, seq string", ("m", 1, "ACdeFG"))
    assert columns.match_only_rows(msa, full, "m").collect()[0].seq == "ACFG"
    rf = table("rf string, aligned string", ("x", None), (".", None), (None, None), (".", "1"))
    assert [r[0] for r in rf.select(columns.match_state(False)).collect()] == [True, False, False, True]
    notes = table("msa_id string, ncol int, codes string, rf string, aligned string", ("a", 2, "ab", None, "10"), ("b", 2, "a", None, None), ("c", 2, None, None, "1x"))
    assert rows(columns.column_issues(notes), "status") == [("error",), ("error",), ("ok",)]


PATHS = "target_id string, TranscriptIDCluster string, Path string"
EXONS = "target_id string, GeneID string, Species string, TranscriptIDCluster string, S_exonID string, S_exon_Sequence string, row_no long"
ROWS = "target_id string, s_exon_id string, row_idx long, name string, seq string"


def _assemble(table, paths, s_exons, exon_rows, symbols, cmap, requests):
    from msalake.plans.jobs import assemble_job

    return assemble_job(
        table("target_id string, gene_id string, transcript_id string", *requests), table(PATHS, *paths), table(ROWS, *exon_rows),
        table(EXONS, *s_exons), table("target_id string, symbols string", *symbols), table("target_id string, code string, s_exon_id string", *cmap))


def test_assembly_golden(table, rows):
    paths = [("t1", "ENST1/ENST2", "start/1_0/2_0/stop"), ("t2", "ENST1", "start/0_0/1_0/stop"), ("t3", "ENST1", "start/1_0/0_1/stop"),
             ("t4", "ENST1", "start/1_0/2_0/stop"), ("t5", "ENST1", "start/1_0/9_0/stop"), ("t6", "ENST1", "a"), ("t6", "ENST1.1", "b")]
    s_exons = [("t1", "ENSG1", "homo_sapiens", "", "", None, 1), ("t1", "ORTHO1", "other", "", "", None, 2), ("t1", "ORTHO1", "mus_musculus", "", "", None, 3),
               ("t2", "ENSG1", "homo_sapiens", "ENST1", "0_0", "MM", 1), ("t2", "ENSG1", "homo_sapiens", "ENST1", "1_0", "AA", 2),
               ("t3", "ENSG1", "homo_sapiens", "ENST1", "1_0", "AA", 1), ("t3", "ENSG1", "homo_sapiens", "ENST1", "0_1", None, 2)]
    exon_rows = [("t1", "1_0", 1, "ENSG1", "A-A."), ("t1", "1_0", 2, "ORTHO1", "ABCD"), ("t1", "2_0", 1, "ENSG1", "CC"), ("t1", "2_0", 2, "ORTHO1", "CD"),
                 ("t2", "1_0", 1, "ENSG1", "AA"), ("t2", "1_0", 2, "ORTHO1", "AB"), ("t3", "1_0", 1, "ENSG1", "AA"), ("t3", "1_0", 2, "ORTHO1", "AB"),
                 ("t4", "1_0", 1, "ENSG1", "AA"), ("t4", "2_0", 1, "OTHER", "AA"), ("t5", "1_0", 1, "ENSG1", "AA")]
    symbols = [("t1", "aa=="), ("t2", "zzaa"), ("t3", "aa")]
    cmap = [("t1", "a", "1_0"), ("t1", "=", "2_0"), ("t2", "a", "1_0"), ("t3", "a", "1_0"), ("t3", "b", "0_1")]
    requests = [(t, "ENSG1.1", "ENST1.1") for t in ("t2", "t3", "t4", "t5", "t6")] + [("t1", "ENSG1.1", "ENST2.1"), ("t7", "G", "ENST9")]
    out = _assemble(table, paths, s_exons, exon_rows, symbols, cmap, requests)
    got = {(r.target_id, r.name): (r.row_idx, r.seq, r.species) for r in out["rows"].collect()}
    assert got[("t1", "ENSG1")] == (1, "A-A-CC", "homo_sapiens") and got[("t1", "ORTHO1")] == (2, "ABCDCD", "mus_musculus")
    assert got[("t2", "ENSG1")] == (1, "MMAA", "homo_sapiens") and got[("t2", "ORTHO1")] == (2, "--AB", "unknown")
    assert got[("t3", "ENSG1")][1] == "AA" and got[("t3", "ORTHO1")][2] == "unknown"
    codes = {}
    for r in out["codes"].where("target_id < 't4'").orderBy("target_id", "col_idx").collect():
        codes[r.target_id] = codes.get(r.target_id, "") + r.code
    assert codes["t1"] == "aaaa==" and codes["t3"] == "aa" and codes["t2"][2:] == "aa"
    new = {r.s_exon_id: r.code for r in out["code_map"].where("target_id = 't2'").collect()}
    assert new["0_0"] == codes["t2"][0] == codes["t2"][1] == assembly.FALLBACK_SYMBOLS[0] == "%"
    report = {r.target_id: (r.status, r.issue) for r in out["report"].collect()}
    assert [report[t][0] for t in ("t1", "t2", "t3")] == ["ok"] * 3
    assert "no row in common" in report["t4"][1] and "9_0" in report["t5"][1]
    assert "more than one" in report["t6"][1] and "has no path" in report["t7"][1]


def test_symbol_projection_errors(table):
    refs = table("target_id string, exon_ord int, s_exon_id string, seq string", *[(t, 0, "1_0", "AA") for t in "abcd"])
    symbols = table("target_id string, symbols string", ("a", "a"), ("b", "aaa"), ("c", "a="), ("d", "zz"))
    cmap = table("target_id string, code string, s_exon_id string", *[(t, c, e) for t in "abcd" for c, e in (("a", "1_0"), ("=", "2_0"))])
    _, report = assembly.project_symbols(refs, symbols, cmap, span=1)
    got = {r.target_id: r.issue for r in report.collect()}
    assert "fewer" in got["a"] and "more" in got["b"] and "another exon" in got["c"] and got["d"] is None


def test_query_only_sequences(table, rows):
    tab = table("GeneID string, TranscriptIDCluster string, S_exonID string, S_exon_Sequence string",
                ("G.1", "T/U", "0_0", "MM*"), ("G", "U", "0_0", "MM"), ("G", "T", "0_1", "A"), ("G", "T", "0_1", "B"))
    wanted = table("target_id string, s_exon_id string, gene_id string, transcript_id string", ("t", "0_0", "G.9", "T.1"), ("t", "0_1", "G", "T"), ("t", "0_2", "G", "T"))
    assert rows(assembly.query_only_sequences(wanted, tab), "s_exon_id", "seq", "status") == [("0_0", "MM", "ok"), ("0_1", None, "error"), ("0_2", None, "error")]


def test_sampling(spark, table, rows):
    members = table("t string, species string", *[("a", f"s{i}") for i in range(4)], ("solo", "s1"), *[("big", f"s{i}") for i in range(301)])
    draw = lambda n: sampling.draw_samples(members, ["t"], "species", F.col("species") == "s1", n, 0.5, 42)
    got = {}
    for r in draw(3).orderBy("t", "sample", "draw").collect():
        got.setdefault((r.t, r["sample"]), []).append(r.species)
        assert r.sample_label == f"subset_{r['sample']:03d}"
    for (t, _), picked in got.items():
        assert picked[0] == "s1" and len(set(picked)) == len(picked)
        # round half to even: 0.5 * 3 = 1.5 -> 2; 0.5 * 300 = 150
        assert len(picked) == {"a": 3, "solo": 1, "big": 151}[t]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    again = rows(draw(3))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert again == rows(draw(3)) and draw(0).count() == 0


def test_universe(table, rows):
    data = table("target_id string, pid_order int, row_idx long, species string",
                 *[("t", 1, i, s) for i, s in enumerate("bacd")], *[("t", 2, i, s) for i, s in enumerate("dabb")], ("t", 3, 0, "z"))
    cand = table("target_id string, pid_order int, eligible boolean", ("t", 1, True), ("t", 2, True), ("t", 3, False))
    uni = sampling.common_universe(sampling.candidate_species(data, ["target_id", "pid_order"]), cand)
    assert [r.species for r in uni.orderBy("ord").collect()] == ["b", "a", "d"]
    refs = table("target_id string, species string", ("t", "a"), ("u", "a"))
    rep = {r.target_id: r for r in sampling.universe_report(uni, refs, "common").collect()}
    assert rep["t"].status == "warn" and rep["t"].n_species == 3 and rep["u"].status == "error"


def test_scores(table, rows):
    codes = table("r string, pos int, code string", ("a", 1, "|"), ("a", 1, " "), ("a", 0, "|"), ("a", 2, "."), ("b", 0, "|"))
    assert rows(scoring.identity_counts(codes, ["r"])) == [("a", 1, 2)]
    samples = table("c string, sample int, sample_label string, n_sequences_reference long, n_sequences_sample long",
                    *[("c", i, f"s{i}", 5, 4) for i in range(1, 4)], ("d", 1, "s1", 5, 4))
    raw = table("c string, sample int, raw_score double, matched_positions long, comparable_positions long",
                ("c", 1, 1.0, 1, 4), ("c", 2, 3.0, 3, 4), ("d", 1, 0.0, 0, 0))
    scores = scoring.sample_scores(samples, raw, ["c", "sample"])
    assert rows(scores, "c", "sample", "normalized_score", "normalization_score") == [("c", 1, 25.0, 4.0), ("c", 2, 75.0, 4.0), ("d", 1, 0.0, 0.0)]
    assert rows(scoring.epli(scores, ["c"])) == [("c", 50.0, 2), ("d", 0.0, 1)]
    own = table("c string, raw_score double", ("c", 20.0), ("d", 0.0))
    ten = raw.withColumn("raw_score", F.lit(10.0))
    selfed = scoring.sample_scores(samples, ten, ["c", "sample"], scoring.self_reference_normalization, own, ["c"])
    assert rows(selfed, "c", "sample", "normalized_score", "status") == [("c", 1, 50.0, "ok"), ("c", 2, 50.0, "ok"), ("d", 1, None, "error")]
    user = scoring.sample_scores(samples, ten, ["c", "sample"], scoring.user_normalization(lambda r, s: r * 2))
    assert {r[0] for r in rows(user, "normalized_score")} == {20.0}
    plain = scoring.sample_scores(samples, raw, ["c", "sample"], scoring.no_normalization)
    assert rows(plain, "normalized_score", "normalization_score")[2] == (3.0, None)


def test_report_scores(table, rows):
    lines = [("a", i, t) for i, t in enumerate("Probab=99\nquery 1 A-C 2\n        | |\nConfidence".split("\n"))] + [("b", 0, "none")]
    df = table("report_id string, line_no long, line string", *lines)
    assert rows(scoring.score_reports(df), "report_id", "raw_score", "matched_positions", "comparable_positions") == [("a", 2.0, 2, 2), ("b", 0.0, 0, 0)]
    assert rows(scoring.score_reports(df, "profile"), "report_id", "status") == [("a", "error"), ("b", "error")]


def test_consensus(table, rows):
    ref = table("c string, name string, seq string", ("c", "1", "AC-D"), ("c", "2", "AC-E"), ("c", "3", "GC-E"))
    sam = table("c string, sample int, name string, seq string", ("c", 1, "1", "AC-D"), ("c", 1, "3", "GC-E"), ("c", 2, "3", "GC-E"))
    got = scoring.consensus_score(ref, sam, ["c"], ["c", "sample"])
    # Ties take the smallest residue: sample 1 column 1 -> A, column 4 -> D.
    assert rows(got) == [("c", 1, 2.0, 2, 3), ("c", 2, 2.0, 2, 3)]


def test_candidate_validation(table):
    df = table("target_id string, pid double, transcript_id string, uniprot_id string, has_reference boolean, uniprot_seq string, query_name string, query_seq string",
               ("ok", 80.0, "T", "P", True, "AACC", "q", "AACC"), ("sub", 80.0, "T", "P", True, "AAAC", "q", "AACC"),
               ("indel", 80.0, "T", "P", True, "AAC", "q", "AACC"), ("nofile", 80.0, "T", "P", True, None, "q", "AACC"),
               ("noref", 80.0, "T", None, False, None, None, None), ("norow", 80.0, "T", "P", True, "AA", None, None))
    got = {r.target_id: r for r in candidates.validate_candidates(df).collect()}
    assert {k: (v.eligible, v.msa0_status) for k, v in got.items()} == {
        "ok": (True, "ok"), "sub": (True, "warning"), "indel": (False, "invalid_msa0"), "nofile": (True, "warning"),
        "noref": (True, "ok"), "norow": (False, "invalid_msa0")}
    assert "insertions=0, deletions=1" in got["indel"].msa0_issue and got["sub"].warning.startswith("PID 80.0 candidate retained")


SUMMARY = "target_id string, row_no int, pid double, pid_order int, eligible string, epli double, n_sequences_msa0 int, stockholm_path string, fasta_path string"


def test_seed_selection(table, rows):
    df = table(SUMMARY, ("a", 1, 30.0, 1, "false", 90.0, 20, "p30.sto", None), ("a", 2, 10.0, 2, "true", 70.0, 10, "p10.sto", None),
               ("a", 3, 80.0, 3, "true", 60.0, 30, "p80.sto", None), ("b", 1, 10.0, 1, "true", 70.0, 10, "p10.sto", None),
               ("b", 2, 80.0, 2, "true", 70.0, 20, "p80.sto", None), ("c", 1, 10.0, 2, "TRUE", 70.0, 20, "p10.sto", None),
               ("c", 2, 80.0, 1, "true", 70.0, 20, "p80.sto", None), ("d", 1, 30.0, 1, "false", 9.0, 1, "x", None),
               ("e", 1, 30.0, 1, "true", float("nan"), 1, "x", None), ("e", 2, 40.0, 2, "true", 1.0, 1, "x", None))
    best = candidates.best_seeds(df)
    assert rows(best, "target_id", "pid") == [("a", 10.0), ("b", 80.0), ("c", 80.0), ("e", 40.0)]
    assert rows(candidates.selection_report(df, best), "target_id", "status")[3] == ("d", "error")
    every = candidates.select_seeds(df, 0).where("target_id = 'c'").orderBy("seed_index")
    assert [(r.pid, r.seed_index) for r in every.collect()] == [(80.0, 1), (10.0, 2)]
    short = df.select("target_id", "row_no", "pid", "epli", "stockholm_path", "fasta_path").where("target_id = 'b'")
    assert candidates.best_seeds(short).collect()[0].pid == 10.0
    marked = candidates.mark_selected(df.withColumns({"selected": F.lit(False), "workdir": F.lit("/w")}),
                                      table("target_id string, pid double, stockholm_path string", ("c", 80.0, "/w/p80.sto")))
    assert rows(marked.where("selected"), "target_id", "row_no") == [("c", 2)]
    back = candidates.selected_seeds(marked.withColumns({"pid_sample_seed": F.lit(None).cast("decimal(20,0)"), "sampling_strategy": F.lit("common")}), 7, "input")
    got = back.collect()[0]
    assert (got.pid, int(got.pid_sample_seed), got.sampling_strategy, got.s_exon_blocks_tsv) == (80.0, 7, "common", "p80_s_exon_blocks.tsv")


def test_summary_matches(table, rows):
    meta = "gene_id string, transcript_id string, pid_thresholds_key string, pid_sample_count int, pid_sample_fraction double, pid_sample_seed long, sampling_strategy string, effective_specieslist string, orthology string, specieslist_filter boolean, biomart_datasets_filter boolean, transcript_query_fingerprint string, selection_mode string"
    m = ("G", "T", "10.0,20.0", 45, 0.8, 7, "common", None, "1:n", True, False, "f", "sampled_selection")
    tail = ", ".join(f"{c} string" for c in ("selected", "msa0_status", "msa0_issue", "sequence_fasta", "species_file", "scores_path", "eligible"))
    summary = table(f"target_id string, pid double, epli double, n_sequences_msa0 int, {meta}, {tail}",
                    *[(t, p, 1.0, 1, *m, *["x"] * 7) for t in ("a", "b", "c") for p in (10.0, 20.0)], ("d", 10.0, 1.0, 1, *m, *["x"] * 7))
    seed8 = (*m[:5], 8, *m[6:])
    expected = table(f"target_id string, requested_seed long, {meta}", ("a", 7, *m), ("b", 8, *seed8), ("c", None, *seed8), ("d", 7, *m), ("e", 7, *m))
    assert rows(candidates.summary_matches(summary, expected)) == [("a", True), ("b", False), ("c", True), ("d", False), ("e", False)]
    assert candidates.summary_matches(summary.drop("epli"), expected).where("reusable").count() == 0


def test_warnings_roll_up(table):
    targets = table("target_id string", ("a",), ("b",))
    one = table("target_id string, ord int, warning string", ("a", 2, "w2"), ("a", 1, "w1"), ("b", 1, None))
    two = table("target_id string, ord int, warning string", ("a", 0, "w1"), ("a", 1, "w3"))
    got = {r.target_id: (r.warnings, r.status) for r in candidates.roll_up_warnings(targets, [one, two]).collect()}
    assert got == {"a": (["w1", "w2", "w3"], "warn"), "b": ([], "ok")}


def test_hits_golden(table, rows):
    from msalake.sources.tables import parse_hits

    text = ["too-short", "query\t\tACDE", "query\thit one\t---", "query\thit one\tACD-", "query\thit one\tACDE", "query\tseed one\tACDF", "query\tnew_hit\tacdg"]
    lines = table("msa_id string, line_no long, line string", *[("m", i, t) for i, t in enumerate(text)])
    cleaned = hits.clean_hits(parse_hits(lines))
    every = hits.all_hits(cleaned)
    assert [(r.name, r.seq) for r in every.orderBy("line_no").collect()] == [("hit", "ACD"), ("seed", "ACDF"), ("new_hit", "ACDG")]
    seeds = hits.seed_ids(table("msa_id string, name string", ("m", "seed x"), ("n", "other")))
    assert [(r.name, r.seq) for r in hits.new_hits(every, seeds).orderBy("line_no").collect()] == [("hit", "ACD"), ("new_hit", "ACDG")]
    assert rows(hits.hit_counts(seeds, every, seeds)) == [("m", 3, 2), ("n", 0, 0)]
    members = table("centroid string, member_ord long, member string, seq string", ("hit", 1, "hit", "A"), ("hit", 2, "seed", "B"), ("zz", 1, "q", "C"))
    grown = hits.all_hits(hits.expand_members(every, members, rows_per_salt=1))
    assert rows(grown, "name", "seq") == [("hit", "A"), ("seed", "B")]
    aligned = table("msa_id string, name string", ("m", "seed x"), ("m", "hit 1"))
    assert rows(hits.hit_rows(aligned, seeds), "name") == [("hit 1",)]


def test_compare_and_validation(table):
    df = table("q string, r string", ("ACDE", "ACDE"), ("acde", "ACDF"), ("ACDE", "ACD"), ("ACD", "ACDE"), (None, "A"))
    got = [r[0] and tuple(r[0]) for r in df.select(validation.compare_pair("q", "r")).collect()]
    assert got == [(True, 0, 0, 0), (False, 1, 0, 0), (False, None, 0, 1), (False, None, 1, 0), None]
    runs = table("run_id string, seed_msa string, expanded_msa string", ("1", "s", None), ("2", "s", "e"), ("3", "s", "e"))
    stats = table("msa_id string, nseq long, ncol long, clusters62 long, neff80 double", ("s", 2, 4, 1, 1.0), ("e", 5, 4, 2, 2.5))
    queries = table("msa_id string, query_name string, query_seq string", ("s", "q", "ACDE"), ("e", "q", "ACD"))
    refs = table("run_id string, reference_seq string", ("1", "ACDF"), ("2", "ACDE"))
    out = {r.run_id: r for r in validation.validation_rows(runs, stats, queries, refs).collect()}
    assert out["1"].warnings == ["Seed query: substitutions against the reference sequence."] and out["1"].expanded_nseq is None
    assert out["2"].warnings == ["Expanded query: insertions or deletions against the reference sequence."] and out["2"].expanded_neff80 == 2.5
    assert (out["3"].status, out["3"].aln_identical, out["3"].query_name) == ("ok", None, None)


def test_assemble_repeats_and_widths(table):
    segments = table("target_id string, exon_ord int, row_idx long, name string, seq string", ("a", 1, 2, "x", "TT"), ("a", 1, 1, "x", "AC"), ("a", 2, 1, "x", "G"),
                     ("b", 1, 1, "x", "AC"), ("b", 1, 2, "y", "TTT"))
    rows_, report = assembly.assemble(segments)
    assert [(r.name, r.seq) for r in rows_.where("target_id = 'a'").collect()] == [("x", "ACG")]
    assert {r.target_id: r.status for r in report.collect()} == {"a": "ok", "b": "error"}


def test_sample_labels_never_collide(table):
    assert [r[0] for r in table("i int", (7,), (999,), (1000,), (10021,)).select(sampling.sample_label("i")).collect()] == [
        "subset_007", "subset_999", "subset_1000", "subset_10021"]


def test_join_of_a_key_hot_on_both_sides(spark):
    left = spark.range(60).select(F.when(F.col("id") < 40, "hot").when(F.col("id") < 50, "big").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), F.lit(1).alias("l"))
    right = spark.range(90).select(F.when(F.col("id") < 50, "hot").when(F.col("id") < 52, "big").otherwise(F.concat(F.lit("k"), (F.col("id") % 60).cast("string"))).alias("k"), (F.col("id") % 3).alias("r"))
    got, want = ordered.salted_join(left, right, ["k"], rows_per_salt=8), left.join(right, "k")
    count = lambda df: sorted(map(tuple, df.groupBy("k", "l", "r").count().collect()))
    assert got.columns == want.columns and count(got) == count(want) and got.where("k = 'hot'").count() == 2000
    assert count(ordered.salted_join(left.where("false"), right, ["k"])) == [] == count(ordered.salted_join(left, right.where("false"), ["k"]))


def test_members_of_a_centroid_that_many_keys_hit(spark):
    found = spark.range(50).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("msa_id"), F.lit(1).cast("long").alias("line_no"), F.lit("c").alias("name"))
    members = spark.range(200).select(F.when(F.col("id") < 70, "c").otherwise("other").alias("centroid"), F.col("id").alias("member_ord"), F.col("id").cast("string").alias("member"), F.lit("A").alias("seq"))
    grown = hits.expand_members(found, members, rows_per_salt=10)
    assert grown.count() == 3500 == grown.select("msa_id", "name").distinct().count()


def test_seeds_shared_by_many_keys_are_not_repeated_for_each(spark, table, rows):
    """Libraries give what seeds repeated for each key give, and counts of members what listing them gives."""
    found = spark.range(400).select((F.col("id") % 7).alias("msa_id"), F.col("id").alias("line_no"), F.concat(F.lit("p"), (F.col("id") * 13 % 60).cast("string")).alias("name"), F.lit("A").alias("seq"))
    libraries = spark.range(6).select(F.col("id").alias("msa_id"), (F.col("id") % 2).alias("library"))
    seeds = hits.seed_ids(spark.range(40).select((F.col("id") % 2).alias("library"), F.concat(F.lit("p"), F.col("id").cast("string"), F.lit(" x")).alias("name")), "library")
    each = libraries.join(seeds, "library").drop("library")
    held, every = hits.with_library(found, libraries), hits.all_hits(found)
    keys = found.select("msa_id").distinct()
    assert rows(hits.new_hits(held, seeds, "library").select(*found.columns)) == rows(hits.new_hits(found, each).select(*found.columns))
    assert rows(hits.hit_counts(keys, held, seeds, by="library")) == rows(hits.hit_counts(keys, found, each))
    assert rows(hits.hit_rows(held, seeds, "library").select(*found.columns)) == rows(hits.hit_rows(found, each).select(*found.columns))
    # p0 to p9 are members of two clusters each.
    placed = spark.range(60).select((F.col("id") % 9).alias("cluster"), F.col("id")).unionByName(spark.range(10).select((F.col("id") % 4 + 20).alias("cluster"), F.col("id"))).select(
        "cluster", F.concat(F.lit("p"), F.col("id").cast("string")).alias("member"))
    members = placed.select("cluster", F.col("member").alias("centroid")).join(placed, "cluster").select("centroid", F.lit(1).cast("long").alias("member_ord"), "member", F.lit("A").alias("seq"))
    grown = hits.all_hits(hits.expand_members(every, members))
    number = F.substring("member", 2, 9).cast("long")
    new = hits.new_hits(grown, each).groupBy("msa_id").agg(F.count("*").alias("n_new"))
    want = grown.withColumn("member", F.col("name")).groupBy("msa_id").agg(F.count("*").alias("n_members"), F.sum(number).alias("member_sum")).join(new, "msa_id", "left").na.fill(0)
    assert rows(hits.member_counts(found, placed.withColumnRenamed("member", "centroid"), placed, libraries, seeds, number)) == rows(want)


def test_seed_rows_of_the_queries_are_not_repeated_for_each_supplier(spark):
    from msalake.queries import selection
    from msalake.queries.common import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    libraries, seeds = selection.seed_libraries(t)
    assert libraries.count() == t.supplier.count() and seeds.count() == t.part.count()


def test_median_gathers_no_key(spark, rows):
    """Medians of odd and even numbers of components, repeated ones and NaN, without an object aggregate."""
    scores = spark.range(3000).select((F.col("id") * 7 % 90).alias("k"), F.when(F.col("id") % 11 > 0, (F.col("id") * F.col("id") % 17) / 4).alias("epli_component"))
    scores = scores.unionByName(spark.sql("select 100L k, explode(array(1D, 2D, double('nan'))) epli_component union all select 101L, explode(array(double('nan'), 3D)) union all select 102L, null"))
    want = scores.where("epli_component is not null").groupBy("k").agg(F.percentile("epli_component", 0.5).alias("epli"), F.count("*").alias("n_samples"))
    got = scoring.epli(scores, ["k"])
    assert [tuple(map(str, r)) for r in rows(got)] == [tuple(map(str, r)) for r in rows(want)] and got.count() == 92
    assert "percentile" not in got._jdf.queryExecution().toString()


def test_exon_codes_and_checks_shuffle_the_cells_of_a_target_once(table, rows):
    """Codes come out dealt by target as the report is, so that joining both moves no cell; an exon with two symbols, one without, empty segments."""
    refs = table("target_id long, exon_ord int, s_exon_id string, seq string", (1, 0, "a", "A-."), (1, 1, "b", ""), (1, 2, "b", "CC"), (2, 0, "a", "A"), (2, 1, "c", "-"), (3, 0, "a", "AC"))
    symbols = table("target_id long, symbols string", (1, "xyz"), (2, "x"), (3, "xy"))
    cmap = table("target_id long, code string, s_exon_id string", (1, "x", "a"), (1, "y", "b"), (1, "z", "b"), (2, "x", "a"), (3, "x", "a"), (3, "y", "b"), (3, "y", "a"))
    codes, report = assembly.project_symbols(refs, symbols, cmap)
    assert rows(codes.where("target_id = 2")) == [(2, 1, "x"), (2, 2, None)]
    assert rows(codes.where("target_id = 1"), "col_idx", "code") == [(1, "x"), (2, "x"), (3, "."), (4, "y"), (4, "z"), (5, "y"), (5, "z")]
    assert {r.target_id: r.issue for r in report.collect()} == {
        1: "There are fewer symbols than residues in the reference row.", 2: "No symbol for c.", 3: "A residue's symbol belongs to another exon than a."}
    plan = codes.hint("merge").join(report.hint("merge"), "target_id")._jdf.queryExecution().executedPlan().toString()
    assert "s_exon_id" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)
