import pytest
from pyspark.sql import functions as F

from msalake.operators import expansion, ledger, names, scoring
from msalake.plans import jobs
from msalake.plans.run import run_job
from msalake.sinks.text import stockholm_lines

REF = "struct<database:string,id:string,isoformId:string,properties:array<struct<key:string,value:string>>>"


def candidate_rows(table):
    data = []
    for t, q in (("a", "ACDEFGHIKL"), ("b", "ACDEFGHIKL")):
        for order, pid in ((1, 10.0), (2, 30.0)):
            for i in range(8):
                seq = q if i == 0 or order == 2 else q[:i] + "W" * (10 - i)
                data.append((t, order, pid, i, f"ENSG_{t}" if i == 0 else f"row{i}", f"species_{i}", seq))
    return table("target_id string, pid_order int, pid double, row_idx long, name string, species string, seq string", *data)


TARGETS = "target_id string, ensembl_gene_id string, transcript_id string, uniprot_id string, has_reference boolean, uniprot_seq string"


@pytest.mark.parametrize("strategy", ["independent", "common"])
def test_candidates_job(table, strategy):
    targets = table(TARGETS, ("a", "ENSG_a.1", "T", "P1", True, "ACDEFGHIKL"), ("b", "ENSG_b", "T", "P2", True, "ACDEFGHIK"))
    out = jobs.candidates_job(targets, candidate_rows(table), strategy, sample_count=5, seed=1)
    summary = {(r.target_id, r.pid_order): r for r in out["summary"].collect()}
    assert len(summary) == 4 and summary[("a", 2)].epli == 100.0 and summary[("a", 1)].epli <= 100.0
    assert summary[("b", 1)].eligible is False and summary[("b", 1)].epli is None and summary[("a", 1)].n_sequences_msa0 == 8
    assert [(r.target_id, r.pid) for r in out["seeds"].collect()] == [("a", 30.0)] or summary[("a", 1)].epli == 100.0
    assert out["warnings"].count() == 2
    per_sample = out["samples"].groupBy("target_id", "pid_order", "sample").count().collect()
    assert {r["count"] for r in per_sample} == {7} and len(per_sample) == 10
    every = jobs.candidates_job(targets, candidate_rows(table), strategy, sample_count=0)
    assert every["seeds"].count() == 2 and {r.selection_mode for r in every["summary"].collect()} == {"all_candidates"}


def test_stability_job_with_aligner(table):
    recs = table("k string, rec_idx long, name string, seq string", *[("x", i, f"n{i}", "AC-DE"[: 5 - i % 2]) for i in range(6)])

    def pad(records):
        width = max(len(s) for _, s in records)
        return [(n, s.ljust(width, "-")) for n, s in reversed(records)]

    scores, summary = jobs.stability_job(recs, ["k"], pad, "n2", sample_count=4, fraction=0.5, seed=3)
    got = summary.collect()[0]
    assert got.n_samples == 4 and 0.0 <= got.epli <= 100.0
    assert {r.n_sequences_sample for r in scores.collect()} == {3}
    _, own = jobs.stability_job(recs, ["k"], pad, "n2", 4, 0.5, 3, normalization=scoring.self_reference_normalization)
    assert own.collect()[0].epli is not None
    aligned = scoring.align_samples(recs.withColumn("seq", F.translate("seq", "-", "")), ["k"], pad)
    checked = names.reorder_like(aligned, recs, "k").orderBy("rec_idx").collect()
    assert [r.name for r in checked] == [f"n{i}" for i in range(6)] and {r.status for r in checked} == {"ok"}


def test_expand_job(table, rows):
    seed_rows = table("msa_id string, row_idx long, name string", ("m", 1, "seed x"))
    seed_cols = table("msa_id string, pid double, col_idx long, code string, rf string, aligned string",
                      *[("m", 10.0, i + 1, c, "x", a) for i, (c, a) in enumerate(zip("0123", "1101"))])
    cmap = table("msa_id string, code string, s_exon_id string", ("m", "0", "1_0"), ("m", "1", "2_0"), ("m", "3", "4_0"))
    hits = table("msa_id string, line_no long, target string, tseq string", ("m", 1, "h1 z", "ac-"), ("m", 2, "h1", "AA"), ("m", 3, "seed", "A"))
    aligned = table("msa_id string, row_idx long, name string, seq string", ("m", 1, "h1", "AC-eFG"), ("m", 2, "seed x", "ACdeFG"))
    cols = table("msa_id string, pid double, col_idx long, rf string, aligned string", *[("m", 10.0, i + 1, "x", a) for i, a in enumerate("110011")])
    members = table("centroid string, member_ord long, member string, seq string", ("h1", 1, "h1", "AC"), ("h1", 2, "h2", "AD"), ("seed", 1, "seed", "A"))
    out = jobs.expand_job(seed_rows, seed_cols, cmap, hits, aligned, cols)
    assert rows(out["counts"]) == [("m", 2, 1)]
    assert rows(out["hit_rows"], "name") == [("h1",)]
    assert [(r.name, r.seq) for r in out["match_rows"].orderBy("order_key").collect()] == [("seed x", "ACFG"), ("h1", "ACFG")]
    assert rows(out["blocks"].where("alignment = 'expanded_full'"), "code", "s_exon_id", "start_col", "end_col") == [
        ("0", "1_0", 1, 1), ("1", "2_0", 2, 2), ("3", "4_0", 5, 5)]
    grown = jobs.expand_job(seed_rows, seed_cols, cmap, hits, aligned, cols, members)
    assert rows(grown["counts"]) == [("m", 3, 2)] and grown["centroid_new_hits"].count() == 1


def test_whole_run(table):
    xrefs = [("Ensembl", "ENST0000001.1", None, [("GeneId", "ENSG_a"), ("ProteinId", "ENSP1.1")])]
    entries = table(f"uniprot_id string, species string, protein_sequence string, xrefs array<{REF}>",
                    ("P20963", "Homo sapiens", "ACDEFGHIKL", xrefs), ("Q12345", "Homo sapiens", "AC", []))
    proteins = table("protein_id string, seq string", ("ENSP1", "acdefghikl"))
    lookup = table("transcript_id string, ensembl_gene_id string, species string, issue string", ("ENST0000009", "ENSG_b", "homo_sapiens", None))
    inputs = table("target_id string, id string, uniprot_id string, ensembl_transcript_id string, transcript_id string, ensembl_gene_id string, ensembl_protein_id string, species string",
                   ("a", "P20963", None, None, None, None, None, None), ("b", "ENST0000009", None, None, None, None, None, None),
                   ("bad", "nope", None, None, None, None, None, None), ("none", "Q12345", None, None, None, None, None, None))
    requested = table("target_id string, ord int, species string", ("a", 0, "mus_musculus"), ("a", 1, "canis_lupus"), ("b", 0, "danio_rerio"))
    orthologs = table("target_id string, ord int, species string", ("a", 0, "mus_musculus"), ("b", 0, "mus_musculus"))
    registry = table("dataset string", ("hsapiens_gene_ensembl",), ("mmusculus_gene_ensembl",))
    expanded = candidate_rows(table).where("pid = 30.0").select("target_id", "pid", "row_idx", "name", "seq")
    out = run_job(inputs, entries, proteins, lookup, requested, orthologs, registry, candidate_rows(table), expanded, sample_count=3)
    got = {r.target_id: r for r in out["results"].collect()}
    assert got["a"].status == "warn" and any("canis_lupus" in w for w in got["a"].warnings)
    assert (got["bad"].status, got["bad"].failed_stage) == ("error", "target") and got["none"].failed_stage == "target"
    assert got["b"].status == "error" and got["b"].failed_stage == "msa"
    v = out["validations"].collect()
    assert len(v) == 1 and v[0].target_id == "a" and v[0].aln_identical is True and v[0].seed_nseq == 8
    assert v[0].expanded_nseq in (8, None)


def _pair(table, *species):
    """One target with two candidates; ``species`` of the second candidate's reference row may differ."""
    data = [("a", order, pid, i, "ENSG_a" if i == 0 and species[order - 1] else f"row{i}", f"species_{i}" if i or species[order - 1] != "odd" else "odd", "ACDEFGHIKL")
            for order, pid in ((1, 10.0), (2, 30.0)) for i in range(8)]
    return table("target_id string, pid_order int, pid double, row_idx long, name string, species string, seq string", *data)


def test_candidate_without_reference_row(table):
    targets = table(TARGETS, ("a", "ENSG_a", "T", None, False, None))
    out = jobs.candidates_job(targets, _pair(table, "yes", None), "independent", sample_count=3, seed=1)
    summary = {r.pid_order: r for r in out["summary"].collect()}
    assert summary[1].eligible and not summary[2].eligible and summary[2].msa0_issue and summary[2].epli is None
    assert [r.pid_order for r in out["seeds"].collect()] == [1]


def test_universe_without_reference_species(table):
    targets = table(TARGETS, ("a", "ENSG_a", "T", None, False, None))
    lacking = table("target_id string, ord long, species string", *[("a", i, f"species_{i}") for i in range(1, 8)])
    for strategy, rows_, universe in (("common", _pair(table, "yes", "odd"), None), ("input", _pair(table, "yes", "yes"), lacking)):
        out = jobs.candidates_job(targets, rows_, strategy, sample_count=3, seed=1, input_species=universe)
        assert out["universe"].collect()[0].status == "error"
        assert not any(r.eligible for r in out["summary"].collect()) and out["seeds"].count() == 0 and out["samples"].count() == 0


def _letters(table, key, *seqs):
    return table("msa_id string, row_idx long, name string, seq string", *[(key, i + 1, n, s) for i, (n, s) in enumerate(seqs)])


def test_centroid_level_and_seeds_without_new_hits(table, rows):
    seed_rows = _letters(table, "m", ("seed x", "ACd-FG")).unionByName(_letters(table, "alone", ("q", "AC"))).unionByName(_letters(table, "lost", ("q", "AC")))
    cells = lambda key, codes, aligned: [(key, 10.0, i + 1, c, "x", a) for i, (c, a) in enumerate(zip(codes, aligned))]
    schema = "msa_id string, pid double, col_idx long, code string, rf string, aligned string"
    seed_cols = table(schema, *cells("m", "01.234", "110111"), *cells("alone", "ab", "11"), *cells("lost", "ab", "11"))
    cmap = table("msa_id string, code string, s_exon_id string", *[("m", c, f"{c}_0") for c in "01234"], ("alone", "a", "1_0"))
    raw = table("msa_id string, line_no long, target string, tseq string", ("m", 1, "c1", "AC"), ("alone", 1, "q", "AC"), ("lost", 1, "new", "AC"))
    members = table("centroid string, member_ord long, member string, seq string", ("c1", 1, "c1", "AC"), ("c1", 2, "c2", "AD"), ("q", 1, "q", "A"), ("new", 1, "new", "A"))
    full = _letters(table, "m", ("c1", "AC-FG"), ("c2", "AD-FG"), ("seed x", "ACDFG"))
    cols = lambda aligned: table(schema, *cells("m", "zzzzzz", aligned)).drop("code")
    out = jobs.expand_job(seed_rows, seed_cols, cmap, raw, full, cols("11111"), members, _letters(table, "m", ("c1", "ACeFG"), ("seed x", "AC-FG")), cols("11011"))
    texts = lambda df: [(r.msa_id, r.name, r.seq) for r in df.orderBy("msa_id", "order_key").collect()]
    assert texts(out["full_rows"]) == [("alone", "q", "AC"), ("m", "seed x", "ACDFG"), ("m", "c1", "AC-FG"), ("m", "c2", "AD-FG")]
    assert texts(out["centroid_match_rows"]) == [("alone", "q", "AC"), ("m", "seed x", "ACFG"), ("m", "c1", "ACFG")]
    codes = lambda df, key: "".join(r.code for r in df.where(f"msa_id = '{key}'").orderBy("col_idx").collect())
    assert (codes(out["full_cols"], "m"), codes(out["centroid_full_cols"], "m"), codes(out["centroid_match_cols"], "m")) == ("01234", "01.23", "0123")
    assert codes(out["full_cols"], "alone") == "ab"
    assert rows(out["issues"].select("msa_id").distinct()) == [("lost",)]
    assert {r.alignment for r in out["blocks"].collect()} == {"expanded_full", "expanded_match", "centroid_full", "centroid_match"}
    lines = [r.line for r in stockholm_lines(expansion.annotated(out["centroid_full_rows"], out["centroid_full_cols"], cmap, "msa_id"), "msa_id").where("msa_id = 'm'").orderBy("section", "ord", "sub_ord").collect()]
    assert lines[1].startswith('#=GF SExonCodeMap "0"=>"0_0"') and lines[2:] == ["#=GC SExonCode 01.23", "seed x\tAC-FG", "c1\tACeFG", "//"]


def test_ledger_keeps_the_first_failure(table, rows):
    targets = table("target_id string", ("a",), ("b",), ("c",))
    report = lambda *r: table("target_id string, status string, issue string", *r)
    book = [ledger.entry("msa", report(("a", "error", "second"), ("b", "ok", None)), 1), ledger.entry("msa", report(("a", "error", "first"), ("b", "error", "x"))),
            ledger.entry("target", report(("b", "error", "earlier")))]
    assert rows(ledger.outcomes(targets, book)) == [("a", "msa", "first"), ("b", "target", "earlier"), ("c", None, None)]
    assert rows(ledger.still_open(targets, book)) == [("c",)]
