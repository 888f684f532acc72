import json
import os

from pyspark.sql import functions as F

from msalake.functions.ordered import shared_folder
from msalake.sinks import shards
from msalake.sinks import text as sinks
from msalake.sources import bundle, reports, stockholm, tables
from msalake.sources import json as records
from msalake.sources import text as scans


def put(tmp_path, name, content):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    return str(path)


def test_read_lines_keeps_order_over_splits(spark, tmp_path, rows):
    path = put(tmp_path, "big.txt", "".join(f"line{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = scans.read_lines(spark, path)
        assert df.rdd.getNumPartitions() >= 1
        assert rows(df, "line_no", "line") == [(i + 1, f"line{i}") for i in range(5000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_read_fasta_split_at_records(spark, tmp_path, rows):
    body = "".join(f">r{i} a > b\nac{'d' * (i % 90)}\n\nEF \n" for i in range(800)) + ">empty\n"
    path = put(tmp_path, "x.fasta", body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = rows(scans.read_fasta(spark, path), "rec_idx", "name", "seq")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [(i + 1, f"r{i} a > b", "AC" + "D" * (i % 90) + "EF") for i in range(800)] + [(801, "empty", None)]
    assert got == want


def test_parse_fasta_and_single_form(table, rows):
    df = table("source string, content string", ("s", "\n>a\nAC\nde\r\n\n>b\n>c\nx>y\n"))
    assert rows(scans.parse_fasta(df), "rec_idx", "name", "seq") == [(1, "a", "ACDE"), (2, "b", None), (3, "c", "X>Y")]
    one = table("t string", (">a\nac\n  de \n>b\nf",), (">only\n",))
    assert [r[0] for r in one.select(scans.fasta_sequence("t")).collect()] == ["ACDEF", None]


def test_pir(table, rows):
    pir = ">P1;ENSG1 ENST1.2/ENST2 a=\naa==\nAACC*\n>P1;ENST3\naa\nA*\n"
    df = table("source string, content string", ("s", pir))
    got = rows(scans.parse_pir(df), "transcript_id", "symbols", "seq", "issue")
    assert got[0] == ("ENSG1", "aa==", "AACC", None)
    assert {g[0] for g in got} == {"ENSG1", "ENST1", "ENST2", "ENST3", "a="}
    assert [g[3] for g in got if g[0] == "ENST3"] == ["An entry has more or fewer symbols than residues."]


STO = """# STOCKHOLM 1.0
# source comment
#=GF ID family1
#=GF DE first description
#=GS seq1 AC accession1
seq1 AC
#=GR seq1 PP 99
#=GC RF xx
#=GF
#=GS seq1
seq1 DE
#=GR seq1 PP **
#=GC RF yy
//
"""


def test_stockholm_normalise_and_write(spark, tmp_path, rows):
    path = put(tmp_path, "f.sto", STO)
    lines = scans.read_lines(spark, path)
    notes = stockholm.normalize_annotations(lines)
    got = {(r.kind, r.seq_name, r.feature): r.value for r in notes.collect()}
    assert got[("seq", "seq1", None)] == "ACDE"
    assert got[("GC", None, "RF")] == "xxyy"
    assert got[("GR", "seq1", "PP")] == "99**"
    assert got[("GF", None, "DE")] == "first description"
    assert got[("comment", None, None)] == "# source comment"
    out = sinks.stockholm_lines(notes).orderBy("section", "ord", "sub_ord")
    assert [r.line for r in out.collect()] == [
        "# STOCKHOLM 1.0", "# source comment", "#=GF ID family1", "#=GF DE first description", "#=GS seq1 AC accession1",
        "#=GC RF xxyy", "seq1\tACDE", "#=GR seq1 PP 99**", "//"]
    target = str(tmp_path / "out")
    sinks.write_stockholm(notes.withColumn("source", F.lit("one")), target)
    assert [r.value for r in spark.read.text(target + "/source=one").collect()][0] == "# STOCKHOLM 1.0"


def test_strip_provenance(table, rows):
    df = table("source string, line_no long, line string", ("a", 1, "#=GC SExonCode 00"), ("a", 2, "s AC"),
               ("b", 1, "# STOCKHOLM 1.0"), ("b", 2, "#=GF SExonCodeMap x"), ("b", 3, "s AC"), ("b", 4, "//"))
    got = rows(stockholm.strip_provenance(df), "source", "line_no", "line")
    assert got == [("a", 0, "# STOCKHOLM 1.0"), ("a", 2, "s AC"), ("a", 3, "//"), ("b", 1, "# STOCKHOLM 1.0"), ("b", 3, "s AC"), ("b", 4, "//")]


def test_format_dispatch(spark, tmp_path):
    put(tmp_path, "m/a.STO", "# STOCKHOLM 1.0\nx AC\nx DE\ny A-\n//\n")
    put(tmp_path, "m/b.fa", ">p\nAC\nDE\n>q\nA-\n")
    put(tmp_path, "m/c.a3m", ">p\nACde\n")
    put(tmp_path, "m/d.txt", "junk\n")
    got = stockholm.read_alignments(spark, str(tmp_path / "m")).collect()
    named = {(os.path.basename(r.msa_id), r.name): r.seq for r in got if r.status == "ok"}
    assert named == {("a.STO", "x"): "ACDE", ("a.STO", "y"): "A-", ("b.fa", "p"): "ACDE", ("b.fa", "q"): "A-", ("c.a3m", "p"): "ACde"}
    assert [os.path.basename(r.msa_id) for r in got if r.status == "error"] == ["d.txt"]


def test_column_annotations(table, rows):
    lines = table("source string, line_no long, line string", ("s", 1, "seed ACdE"), ("s", 2, "#=GC RF xxxx"), ("s", 3, "#=GC SExonCode 01β3"))
    cols = stockholm.column_annotations(stockholm.normalize_annotations(lines))
    assert rows(cols, "col_idx", "code", "rf", "aligned") == [(1, "0", "x", "1"), (2, "1", "x", "1"), (3, "β", "x", "0"), (4, "3", "x", "1")]


def test_tables(spark, tmp_path, table, rows):
    path = put(tmp_path, "s_exon_table.csv", "Species,GeneID\nhomo_sapiens,ENSG1\n")
    got = tables.read_table(spark, path, tables.S_EXON_TABLE).collect()[0]
    assert (got.GeneID, got.Species, got.S_exonID) == ("ENSG1", "homo_sapiens", None)
    summary = put(tmp_path, "c.csv", "pid_thresholds_key,pid,eligible,pid_sample_seed\n10.0,10,TRUE,18446744073709551615\n")
    row = tables.read_table(spark, summary, tables.CANDIDATE_SUMMARY).collect()[0]
    assert (row.pid_thresholds_key, row.pid, row.eligible, int(row.pid_sample_seed)) == ("10.0", 10.0, "TRUE", 2**64 - 1)
    lines = table("source string, line_no long, line string", ("m", 1, "1_0\ta"), ("m", 2, " "), ("m", 3, "2_0"), ("m", 4, "3_0\tbb"))
    assert [r[1] is None for r in rows(tables.parse_code_map(lines), "line_no", "issue")] == [True, False, False]


def test_registry_and_failure_logs(table, rows):
    reg = table("line string", ("TableSet\thsapiens_gene_ensembl\tx",), ("TableSet\t mmusculus_gene_ensembl \t",), ("TableSet\tother",),
                ("Other\thsapiens_gene_ensembl",), ("TableSet\thsapiens_gene_ensembl\ty",))
    assert rows(tables.parse_dataset_registry(reg)) == [("hsapiens_gene_ensembl",), ("mmusculus_gene_ensembl",)]
    errors = table("run string, row_no long, Species string", ("r", 1, "Canis lupus"), ("r", 2, None))
    log = table("run string, line_no long, line string", ("r", 1, "It can not found mus_musculus in biomart"),
                ("r", 2, "Download failed for ENSG1 in Danio_rerio now"), ("r", 3, "Download failed for X in canis_lupus"), ("r", 4, "fine"))
    got = [r.species for r in tables.failed_species(errors, log, "run").orderBy("ord").collect()]
    assert got == ["canis_lupus", "mus_musculus", "danio_rerio"]


def test_json_scans(spark, tmp_path, rows):
    put(tmp_path, "u/a.json", json.dumps({"primaryAccession": "P1", "organism": {"scientificName": "Homo sapiens"}, "sequence": {"value": "acde"},
                                          "uniProtKBCrossReferences": [{"database": "PDB", "id": "1"}]}))
    put(tmp_path, "u/b.json", json.dumps({"primaryAccession": "P2"}))
    got = rows(records.read_uniprot(spark, str(tmp_path / "u")), "uniprot_id", "species", "protein_sequence")
    assert got == [("P1", "Homo sapiens", "ACDE"), ("P2", None, None)]
    put(tmp_path, "l/a.json", json.dumps({"id": "ENST1", "Parent": "ENSG1", "species": "homo_sapiens"}) + "\n" + json.dumps({"id": "ENST2"}))
    look = rows(records.read_transcript_lookup(spark, str(tmp_path / "l")), "transcript_id", "ensembl_gene_id", "issue")
    assert look[0] == ("ENST1", "ENSG1", None) and look[1][2] is not None


def test_manifests(spark, tmp_path, table):
    put(tmp_path, "r/a/stage_state.json", json.dumps({"stage": "target", "stage_key": "target", "status": "done", "outputs": {"x": ["a", "b"]}, "warnings": ["w"]}, indent=1))
    put(tmp_path, "r/b/stage_state.json", "[1]")
    put(tmp_path, "r/c/stage_state.json", "{broken")
    put(tmp_path, "r/d/other.json", "{}")
    got = records.read_manifests(spark, str(tmp_path / "r")).collect()
    assert [(r.stage_key, r.status, r.outputs) for r in got] == [("target", "done", '{"x":["a","b"]}')]
    assert records.read_manifests(spark, str(tmp_path / "r"), table("stage_key string", ("msa",))).count() == 0


def test_bundle(spark, tmp_path):
    import hashlib

    for name in bundle.REQUIRED_FILES:
        put(tmp_path, f"one/{name}", name)
    put(tmp_path, "two/tree.nh", "x")
    put(tmp_path, "two/tsl.csv", "")
    got = {os.path.basename(r.bundle): r for r in bundle.bundle_state(bundle.read_bundle_files(spark, str(tmp_path))).collect()}
    want = "\n".join(f"{n}\n{len(n)}\n{hashlib.sha256(n.encode()).hexdigest()}" for n in sorted(bundle.REQUIRED_FILES))
    assert got["one"].complete and got["one"].fingerprint == hashlib.sha256(want.encode()).hexdigest()
    assert not got["two"].complete and got["two"].fingerprint is None
    assert got["two"].missing == "sequences.fasta, exonstable.tsv, ensembl_version.csv, tsl.csv"


def test_reports(table, rows):
    text = "Probab=99\nquery 1 A-C 2\n        | |\nConfidence\n"
    more = "Probab=98.5 E-value=1.2e-05 Score=33\nProbab=1\n\nQ x 5 AC-D 7\n    |.+|\n      ||\nConfidence\n\nQ x 8 EF 9\n      ||\nConfidence"
    data = [("a", i, line) for i, line in enumerate(text.split("\n"))] + [("b", i, line) for i, line in enumerate(more.split("\n"))]
    df = table("report_id string, line_no long, line string", *data, ("c", 0, "nothing"))
    codes = reports.report_codes(df)
    assert [r[1:3] for r in rows(codes.where("report_id = 'a'"), "report_id", "pos", "code")] == [(0, " "), (1, "|"), (2, "|")]
    heads = {r.report_id: r for r in reports.report_headers(df).collect()}
    assert (heads["b"].probability, heads["b"].e_value, heads["b"].hhalign_score) == (98.5, 1.2e-05, 33.0)
    assert (heads["a"].probability, heads["a"].e_value) == (99.0, None) and heads["c"].probability is None
    wrong = table("report_id string, line_no long, line string", ("w", 0, "Probab=1"), ("w", 1, "q 1 ACD 9"), ("w", 2, "    |||"))
    assert {r.issue for r in reports.report_codes(wrong).collect()} == {"Alignment positions do not agree."}


def test_sinks_round_trip(spark, tmp_path, table, rows):
    long = "acdefghiklmnpqrstvwy" * 7
    df = table("msa_id string, rec_idx long, name string, seq string", ("m", 2, "b", "AC"), ("m", 1, "a", long), ("n", 1, "c", "D"))
    out = str(tmp_path / "fa")
    sinks.write_fasta(df, out)
    text = "\n".join(r.value for r in spark.read.text(out + "/msa_id=m").collect())
    assert text.split("\n")[0] == ">a" and len(text.split("\n")[1]) == 60
    back = scans.read_fasta(spark, out + "/msa_id=m")
    assert rows(back, "rec_idx", "name", "seq") == [(1, "a", long.upper()), (2, "b", "AC")]
    wrapped = table("s string", ("A" * 61,)).select(sinks.wrap_sequence("s")).collect()[0][0]
    assert wrapped == "A" * 60 + "\nA\n"
    sinks.write_table(table("a string, b int", ("x", None)), str(tmp_path / "t"), sep="\t")
    assert {r.value for r in spark.read.text(str(tmp_path / "t")).collect()} == {"a\tb", "x\t"}
    sinks.write_json(table("a string, b int", ("x", None)), str(tmp_path / "j"))
    assert [r.value for r in spark.read.text(str(tmp_path / "j")).collect()] == ['{"a":"x","b":null}']
    sp = table("k string, draw long, species string", ("k", 1, "b"), ("k", 0, "a"))
    sinks.write_species(sp, str(tmp_path / "s"), "k")
    assert [r.value for r in spark.read.text(str(tmp_path / "s" / "k=k")).collect()] == ["a", "b"]
    assert rows(sinks.specieslist_text(sp, "k", "draw")) == [("k", "a,b")]


def test_shared_folder_is_local_only_in_local_mode(spark):
    assert os.path.isdir(shared_folder(spark).replace("file:", ""))


def test_bad_cells_keep_their_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\nx,1\ny,n/a\n")
    got = tables.read_table(spark, str(tmp_path / "a.csv"), "a INT, b STRING, c DOUBLE").collect()
    assert [(r.a, r.b, r.c) for r in got] == [(1, "x", None), (None, "y", None)]


def test_fasta_preamble(table):
    got = scans.parse_fasta(table("k int, content string", (1, "junk\n>r one\nAC\n>s\nG\n"), (2, "junk only")))
    assert sorted((r.k, r.rec_idx, r.name, r.seq) for r in got.collect()) == [(1, 1, "r one", "AC"), (1, 2, "s", "G")]


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    put(tmp_path, "t/a.csv", 'a,b,c\n1,"x, ""y""",2.5\n\n2,,bad\n')
    put(tmp_path, "t/b.csv", 'c, a\r\n7,3\r\n8,4,9\r\n,5\r\n')
    got = {(os.path.basename(r.source), r.line_no): r for r in tables.read_table(spark, str(tmp_path / "t"), "a INT, b STRING, c DOUBLE, d STRING").collect()}
    values = {k: (r.a, r.b, r.c, r.d) for k, r in got.items()}
    assert values == {("a.csv", 2): (1, 'x, "y"', 2.5, None), ("a.csv", 4): (2, None, None, None),
                      ("b.csv", 2): (3, None, 7.0, None), ("b.csv", 3): (4, None, 8.0, None), ("b.csv", 4): (5, None, None, None)}
    issues = {k: r.issue for k, r in got.items() if r.issue}
    assert issues == {("a.csv", 4): "c is no double: bad", ("b.csv", 3): "3 cells under 2 headers"}


def test_tables_with_tabs_long_cells_and_no_rows(table, rows):
    lines = table("source string, line_no long, line string", ("s", 1, "a\tb"), ("s", 2, "x,y\t" + "q" * 200_000), ("s", 3, "\t"), ("e", 1, "a\tb"), ("z", 5, " "))
    got = rows(tables.parse_table(lines, "a STRING, b STRING", "\t"), "source", "a", "b", "issue")
    assert got == [("s", "x,y", "q" * 200_000, None), ("s", None, None, None)]


def test_shards_are_few_and_read_back_by_key(spark, tmp_path, table, rows):
    data = [(f"k{i:03d}", j, f"n{j}", "ACDEFGHIKL" * (1 + (i * j) % 9)) for i in range(120) for j in range(3)]
    data += [("hot", j, f"h{j}", "ß" * 50) for j in range(400)] + [("none", 0, "x", None)]
    df = spark.createDataFrame(data, "msa_id string, rec_idx long, name string, seq string").repartition(7)
    path = str(tmp_path / "fa")
    sinks.write_fasta(df, path, shard_bytes=8000)
    files = [f for _, _, names in os.walk(path + "/data") for f in names if f.endswith(".txt")]
    index = spark.read.parquet(path + "/index").collect()
    assert 5 <= len(files) < 20 and {r.key for r in index} == {d[0] for d in data} and max(r.part for r in index if r.key == "hot") > 0
    lines = {}
    for r in shards.read_shards(spark, path).orderBy("key", "part", "at").collect():
        lines.setdefault(r.key, []).append(r.line)
    want = {}
    for k, _, n, s in sorted(data, key=lambda d: (d[0], d[1])):
        upper = s.replace("ß", "SS") if s else None
        text = None if s is None else f">{n}\n" + "".join(upper[i:i + 60] + "\n" for i in range(0, len(upper), 60))
        want[k] = want.get(k, "") + (text or "") + "\n"
    assert {k: "\n".join(v) + "\n" for k, v in lines.items()} == want
    # The index tells the bytes themselves.
    for r in index:
        if r.key in ("hot", "k007"):
            folder = f"{path}/data/shard={r.shard}"
            raw = open(os.path.join(folder, next(f for f in os.listdir(folder) if f.endswith(".txt"))), "rb").read()
            assert raw[r.offset:r.offset + r.length].decode().startswith(">")
    some = shards.read_shards(spark, path, table("key string", ("k007",), ("absent",)))
    assert {r.key for r in some.collect()} == {"k007"}


def test_empty_export(spark, tmp_path, table):
    df = table("msa_id string, draw long, species string", ("a", 1, "x")).where("false")
    sinks.write_species(df, str(tmp_path / "s"), "msa_id", shard_bytes=100)
    assert spark.read.parquet(str(tmp_path / "s" / "index")).count() == 0


def test_report_counts_equal_counts_by_position(table, rows):
    texts = {
        "plain": "Probab=1\nq 1 ACDEF 5\n    ||.|\nConfidence\nq 6 AC-DE 9\n    | |||\nConfidence",
        "overlap": "Probab=1\nq 3 ACDEF 7\n    ||  |\n    .|||.\nConfidence\nq 5 ACDEF 9\n    |...|\nConfidence\nq 1 A 1\n    |\nConfidence",
        "far": "Probab=1\nq 50 " + "ACDEFGHIKL" * 20 + " 249\n     " + "|. |" * 50 + "\nConfidence\nq 0 ACD 2\n    |||\nConfidence",
        "short": "Probab=1\nq 1 ACDEF 5\n    |\nConfidence", "wrong": "Probab=1\nq 1 ACD 9\n    |||", "gaps": "Probab=1\nq 1 --- 0\n    |||"}
    df = table("report_id string, line_no long, line string", *[(k, i, line) for k, text in texts.items() for i, line in enumerate(text.split("\n"))])
    codes = reports.report_codes(df).where("pos <> 0").groupBy("report_id", "pos").agg(F.bool_or(F.col("code") == "|").alias("m"), F.max("issue").alias("i"))
    want = {r[0]: tuple(r[1:]) for r in codes.groupBy("report_id").agg(F.count_if("m"), F.count("*"), F.max("i")).collect()}
    got = {r[0]: tuple(r[1:]) for r in reports.report_counts(df).collect()}
    assert got == want and got["overlap"][1] == 8 and got["wrong"][2] and "gaps" not in got


def test_metadata_files_over_several_lines(spark, tmp_path):
    entry = lambda n: {"primaryAccession": n, "organism": {"scientificName": "Homo sapiens"}, "sequence": {"value": "acd"}, "uniProtKBCrossReferences": []}
    put(tmp_path, "u/a.json", json.dumps(entry("P1"), indent=2))
    put(tmp_path, "u/b.json", json.dumps([entry("P2"), entry("P3")], indent=1))
    got = {r.uniprot_id: (r.species, r.protein_sequence) for r in records.read_uniprot(spark, str(tmp_path / "u"), whole_files=True).collect()}
    assert got == {n: ("Homo sapiens", "ACD") for n in ("P1", "P2", "P3")}
    put(tmp_path, "l/a.json", json.dumps({"id": "T1", "Parent": "G1", "species": "s"}, indent=2))
    put(tmp_path, "l/b.json", json.dumps({"id": "T2"}, indent=2))
    look = {r.transcript_id: (r.ensembl_gene_id, r.issue is None) for r in records.read_transcript_lookup(spark, str(tmp_path / "l"), whole_files=True).collect()}
    assert look == {"T1": ("G1", True), "T2": (None, False)}


def test_a_report_is_shuffled_once_and_long_ones_are_cut_into_spans(table):
    """Blocks with and without a query row, a header in a block, closings before it; spans of two lines give what one pass gives."""
    text = ("Confidence\n x\nProbab=9\n\n  early\nquery 1 A-CD 3\n      | |\nConfidence\n  | |\n  || |\nProbab=8\n   |\nConfidence\n"
            "query 4 CC 9\nT other\n      ||\nq 7 AA 8\n   .|\nConfidence\nConfidence\n  |\n  ||")
    lines = [(k, i, t) for k in "abc" for i, t in enumerate(text.split("\n")) if k != "b" or i % 5]
    df = table("report_id string, line_no long, line string", *lines)
    whole = sorted(tuple(r) for r in reports.symbol_rows(df).collect())
    assert len(whole) == 7 and whole == sorted(tuple(r) for r in reports.symbol_rows(df, span=2).collect())
    # Whole reports need one shuffle of their lines, and no join of lines with their blocks.
    plan = reports._placed(df.repartition(3), "report_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_lines_of_a_shard_are_dealt_once_and_keep_their_key_over_splits(spark, tmp_path, rows):
    """Files of 20 kB read in splits of 700 bytes: keys that begin in an earlier split, several in one, splits without a beginning."""
    data = [(k, j, f"n{k}.{j}", "ACDEFGHIKL" * (40 if k % 5 == 0 else 1)) for k in range(60) for j in range(8 if k == 7 else 1)]
    df, path = spark.createDataFrame(data, "msa_id long, rec_idx long, name string, seq string"), str(tmp_path / "fa")
    sinks.write_fasta(df, path, shard_bytes=20_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        back = shards.read_shards(spark, path)
        plan = back._jdf.queryExecution().executedPlan().toString()
        lines = {}
        for r in back.orderBy("key", "part", "at").collect():
            lines.setdefault(r.key, []).append(r.line)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {}
    for k, _, n, s in data:
        want.setdefault(k, []).extend([f">{n}", *(s[i:i + 60] for i in range(0, len(s), 60)), ""])
    assert lines == want
    assert "Exchange" not in plan[plan.index("last(entry"):plan.index("Union")]
