from pyspark.sql import functions as F

from msalake.functions import codemap, ids, ordered, paths, species, text


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_id_kind(table):
    df = table("id string", ("P20963",), ("A0A0C4DGY3",), ("A0A0C4DGY3-1",), ("ENST00000362089.10",), ("not-an-id",))
    assert values(df, ids.id_kind("id")) == ["uniprot", "uniprot", "uniprot", "ensembl_transcript", None]


def test_name_variants(table):
    df = table("id string", ("7|ENSG1.2",), ("x|ENSG1",), ("|a",), ("plain",))
    assert values(df, ids.name_variants("id")) == [["7|ENSG1.2", "7|ENSG1", "ENSG1.2", "ENSG1"], ["x|ENSG1"], ["|a", "a"], ["plain"]]


def test_primary_input(table):
    df = table(
        "n int, id string, uniprot_id string, ensembl_transcript_id string, transcript_id string",
        (1, "P20963", None, None, "ENST1"), (2, None, "P20963", None, None), (3, None, None, None, "ENST1"),
        (4, "P20963", "Q12345", None, None), (5, "P20963", None, "ENST1", None), (6, None, None, None, None),
        (7, "ENST1", "P20963", None, "ENST9"), (8, "junk", None, None, None))
    out = {r.n: r for r in ids.normalize_primary_input(df).collect()}
    assert (out[1].primary_id, out[1].wanted_transcript, out[1].supplied_uniprot) == ("P20963", "ENST1", "P20963")
    assert (out[2].primary_id, out[2].supplied_uniprot, out[2].status) == ("P20963", "P20963", "ok")
    assert (out[3].primary_id, out[3].wanted_transcript, out[3].supplied_uniprot) == ("ENST1", None, None)
    assert [out[i].status for i in (4, 5, 6, 8)] == ["error"] * 4
    assert (out[7].input_kind, out[7].wanted_transcript, out[7].supplied_uniprot) == ("ensembl_transcript", None, "P20963")


def test_species(table):
    df = table("s string", (" Mus musculus ",), ("mus_musculus",), ("canis_lupus_familiaris",), ("_x",), (None,), ("\thuman\n",))
    assert values(df, species.normalize_species("s")) == ["mus_musculus", "mus_musculus", "canis_lupus_familiaris", "_x", None, "human"]
    assert values(df, species.gene_dataset_name("s")) == ["mmusculus_gene_ensembl", "mmusculus_gene_ensembl", None, None, None, None]


def test_species_lists(table):
    df = table("s string", (" ases ",), ("all",), ("",), ("a,B b,,a",), (None,))
    modes = values(df, species.specieslist_preset("s"))
    assert [m and m.mode for m in modes] == ["ases", "all", "all", "explicit", None]
    assert modes[0].specieslist.split(",")[0] == "homo_sapiens" and len(modes[0].specieslist.split(",")) == 12
    assert values(df, species.parse_specieslist("s"))[2:] == [None, ["a", "b_b"], None]
    levels = table("o string", ("1:1",), ("1:n",), (" m:n ",), ("2:2",))
    assert [v and len(v) for v in values(levels, species.orthology_relationships("o"))] == [1, 2, 3, None]


def test_text(table):
    df = table("s string", ("hit one",), ("  ",), ("a\tb",))
    assert values(df, text.first_token("s")) == ["hit", None, "a"]
    seqs = table("s string", (" acd- ",), ("---",), ("A.c",))
    assert values(seqs, text.hit_sequence("s")) == ["ACD", None, "A.C"]
    exon = table("s string", (None,), ("",), ("A*",), (" * ",))
    assert values(exon, text.exon_sequence("s")) == ["", "", "A", ""]
    pid = table("p double", (10.0,), (12.34,))
    assert values(pid, text.pid_label("p")) == ["10.0", "12.3"]
    assert values(pid, text.pid_key("p")) == ["pid_10.00", "pid_12.34"]
    assert values(table("p array<double>", ([10.0, 20.0],)), text.pid_thresholds_key("p")) == ["10.0,20.0"]


def test_truthy_and_status(table):
    assert values(table("v string", ("TRUE",), ("1",), (None,)), text.truthy("v", "string")) == [True, False, False]
    assert values(table("v int", (1,), (2,), (None,)), text.truthy("v", "int")) == [True, False, False]
    words = table("s string", ("OK",), ("Completed",), ("warning",), ("failed",), ("running",), (None,))
    assert values(words, text.status_class("s")) == ["ok", "ok", "warn", "failed", "unknown", "unknown"]


def test_paths(table):
    df = table("p string, root string", ("/w/a/b.sto", "/w"), ("/x/b", "/w"), ("rel/b", "/w"), ("/w", "/w/"), (None, "/w"),
               ("/wide/b", "/w"), ("/w/../w/./c", "/w"), ("/a", "/"))
    assert values(df, paths.relative_path("p", "root")) == ["a/b.sto", "/x/b", "rel/b", ".", None, "/wide/b", "c", "a"]
    assert values(df, paths.resolve_path("p", "root"))[:4] == ["/w/a/b.sto", "/x/b", "/w/rel/b", "/w"]


def test_identity_hash_keeps_nulls(table):
    df = table("a string, b string", ("x", None), (None, "x"), ("x", None))
    hashes = values(df, paths.identity_hash(F.struct("a", "b")))
    assert hashes[0] == hashes[2] != hashes[1]


def test_code_map(table):
    raw = '"0"=>"1_0","β"=>"2_0","="=>"3_0"'
    df = table("m int, raw string", (1, raw), (2, '"a"=>"x","a"=>"y"'), (3, '"ab"=>"x"'), (4, '"."=>"x"'), (5, 'a=>b'),
               (6, '"a"=>"x",'), (7, '"\\""=>"q\\\\"'), (8, ""))
    assert [v is None for v in values(df, codemap.code_map_issue("raw"))] == [True, True, False, False, False, False, True, True]
    out = sorted(tuple(r) for r in codemap.explode_code_map(df, "m", "raw").collect())
    assert out == [(1, "0", "1_0"), (1, "=", "3_0"), (1, "β", "2_0"), (2, "a", "y"), (7, '"', "q\\")]
    again = values(df.where("m in (1, 7)"), codemap.format_code_map(codemap.code_map_entries("raw")))
    assert again == [raw, '"\\""=>"q\\\\"']


def test_running_sum_is_exact_across_spans(spark, rows):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    got = rows(ordered.running_sum(df, ["k"], "o", F.col("v"), "s", span=17), "k", "o", "s")
    want, acc = [], {}
    for i in range(1000):
        acc[i % 3] = acc.get(i % 3, 0) + i % 7
        want.append((i % 3, i, acc[i % 3]))
    assert got == sorted(want)


def test_previous_across_spans(spark, rows):
    df = spark.range(200).where("id % 5 <> 0").select(F.lit(1).alias("k"), F.col("id").alias("o"), F.col("id").cast("string").alias("v"))
    got = {o: p for o, p in rows(ordered.with_previous(df, ["k"], "o", "v", "p", span=9), "o", "p")}
    ids_ = [i for i in range(200) if i % 5]
    assert got == {o: (str(ids_[i - 1]) if i else None) for i, o in enumerate(ids_)}


def test_ranked(spark, rows):
    df = spark.range(500).select(F.lit("a").alias("k"), F.md5(F.col("id").cast("string")).alias("h"))
    got = rows(ordered.ranked(df, ["k"], F.substring("h", 1, 1), [F.col("h")], "r"), "h", "r")
    assert [r for _, r in got] == list(range(1, 501))


def test_salted_join_keeps_every_match(spark):
    right = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"))
    left = spark.range(3).select(F.lit(0).alias("k"), F.col("id").alias("l")).union(spark.createDataFrame([(950, 9)], "k long, l long"))
    out = ordered.salted_join(left, right, ["k"], rows_per_salt=50)
    assert out.count() == 3 * 900 + 1 and out.distinct().count() == 2701


def test_last_known_across_spans(spark, rows):
    df = spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.when(F.col("id") % 23 == 5, F.col("id")).alias("v"))
    got = dict(rows(ordered.with_last_known(df, ["k"], "o", "v", "w", span=7), "o", "w"))
    want, seen = {}, None
    for i in range(100):
        seen = i if i % 23 == 5 else seen
        want[i] = seen
    assert got == want
