"""Queries of the composed jobs: suppliers are targets, users' event streams are alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import jobs
from ..plans.run import AssemblyInput, ExpansionInput, run_job
from .alignment import event_columns
from .common import Registry, Tables

QUERIES = Registry()
ORACLES = QUERIES.oracles

QUERY = "ACDEFGHIKL"


def _suppliers(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_suppkey").cast("string").alias("target_id"))


def _gene():
    return F.format_string("ENSG%011d", F.col("k"))


def _rows_of(df: DataFrame, n: int = 8) -> DataFrame:
    """Eight equal rows: the gene's own, then one per species."""
    i = F.col("i")
    return df.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(
        "*", i.cast("long").alias("row_idx"), F.when(i == 0, _gene()).otherwise(F.concat(F.lit("row"), i.cast("string"))).alias("name"),
        F.concat(F.lit("species_"), i.cast("string")).alias("species"), F.lit(QUERY).alias("seq"))


def supplier_targets(t: Tables) -> dict[str, DataFrame]:
    """Keys by last digit: 9 has no id, 8 no metadata."""
    base, d = _suppliers(t), F.col("k") % 10
    text = lambda name: F.lit(None).cast("string").alias(name)
    transcript = F.format_string("ENST%011d", F.col("k"))
    inputs = base.select("target_id", F.when(d == 9, "nope").otherwise(transcript).alias("id"),
                         *[text(c) for c in ("uniprot_id", "ensembl_transcript_id", "transcript_id", "ensembl_gene_id", "ensembl_protein_id", "species")])
    lookup = base.where(d != 8).select(transcript.alias("transcript_id"), _gene().alias("ensembl_gene_id"), F.lit("homo_sapiens").alias("species"), text("issue"))
    entries = t.spark.createDataFrame([], "uniprot_id string, species string, protein_sequence string, xrefs array<struct<database:string,id:string,"
                                          "isoformId:string,properties:array<struct<key:string,value:string>>>>")
    return {"inputs": inputs, "lookup": lookup, "entries": entries, "proteins": t.spark.createDataFrame([], "protein_id string, seq string")}


def supplier_run(t: Tables, assembled: bool) -> dict[str, DataFrame]:
    """Keys by last digit: 9 no id, 8 no metadata, 7 no ortholog of the request, 6 no eligible candidate, 2 hits that were not
    aligned, 1 two new hits; the others have none. Candidate 1 of odd keys lacks the gene's row or cannot be assembled."""
    base, d, given = _suppliers(t), F.col("k") % 10, supplier_targets(t)
    text = lambda name: F.lit(None).cast("string").alias(name)
    transcript = F.format_string("ENST%011d", F.col("k"))
    asked = F.when(d == 7, F.array(F.lit("danio_rerio"))).otherwise(F.array(F.lit("mus_musculus"), F.lit("canis_lupus")))
    requested = base.select("target_id", F.posexplode(asked).alias("ord", "species"))
    orthologs = base.select("target_id", F.lit(0).alias("ord"), F.lit("mus_musculus").alias("species"))
    pairs = base.withColumn("pid_order", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("pid", F.when(F.col("pid_order") == 1, 10.0).otherwise(30.0))
    bad = (d == 6) | ((F.col("k") % 2 == 1) & (F.col("pid_order") == 1))
    # Even keys have two good candidates of equal rows; the first of two equal ones is told apart by leaving two rows out.
    rows = _rows_of(pairs).where((F.col("pid_order") == 2) | (F.col("i") < 6) | (F.col("k") % 2 == 1))
    more: dict = {}
    if assembled:
        halves = rows.withColumn("e", F.explode(F.array(F.lit("1_0"), F.lit("2_0")))).select(
            "target_id", "pid_order", F.col("e").alias("s_exon_id"), F.col("row_idx"),
            F.when(bad & (F.col("e") == "2_0"), F.concat(F.lit("x"), "name")).otherwise(F.col("name")).alias("name"),
            F.when(F.col("e") == "1_0", QUERY[:4]).otherwise(QUERY[4:]).alias("seq"))
        more["assembly"] = AssemblyInput(
            pairs.select("target_id", "pid_order", "pid"),
            pairs.select("target_id", "pid_order", transcript.alias("TranscriptIDCluster"), F.lit("start/1_0/2_0/stop").alias("Path")), halves,
            rows.select("target_id", "pid_order", F.col("name").alias("GeneID"), F.col("species").alias("Species"), F.lit("").alias("TranscriptIDCluster"),
                        F.lit("").alias("S_exonID"), text("S_exon_Sequence"), F.col("row_idx").alias("row_no")))
    else:
        more["candidate_rows"] = rows.where(~bad | (F.col("i") > 0)).select("target_id", "pid_order", "pid", "row_idx", "name", "species", "seq")
    hit_lines = pairs.where(d.isin(1, 2)).select("target_id", "pid", F.posexplode(F.array(F.lit("h1 a"), F.lit("row1"), F.lit("h2"), F.lit("h1"))).alias("line_no", "target"), F.lit("acd-e").alias("tseq"))
    grown = _rows_of(pairs, 10).where(d == 1).select("target_id", "pid", "row_idx", F.when(F.col("i") == 8, "h1").when(F.col("i") == 9, "h2").otherwise(F.col("name")).alias("name"), "seq")
    cols = pairs.withColumn("col_idx", F.explode(F.sequence(F.lit(1), F.lit(len(QUERY))))).select(
        "k", "target_id", "pid", F.col("col_idx").cast("long").alias("col_idx"), F.when(F.col("col_idx") <= 4, "a").otherwise("b").alias("code"), F.lit("x").alias("rf"), text("aligned"))
    more["expansion"] = ExpansionInput(
        cols.drop("k"), pairs.select("target_id", "pid", F.explode(F.map_from_arrays(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("1_0"), F.lit("2_0")))).alias("code", "s_exon_id")),
        hit_lines, grown, cols.where(d == 1).drop("k", "code"))
    return run_job(**given, requested=requested, orthologs=orthologs, registry=None, sample_count=3, seed=7, **more)


_RUN = """WITH k AS (SELECT s_suppkey AS k, s_suppkey % 10 AS d FROM supplier),
f AS (SELECT k, d, CASE WHEN d >= 8 THEN 'target' WHEN d >= 6 THEN 'msa' WHEN d = 2 THEN 'msa_expansion' END AS failed FROM k)"""
_RECORDS = f"""{_RUN} SELECT CAST(k AS VARCHAR) AS target_id, CASE WHEN failed IS NULL THEN 'warn' ELSE 'error' END AS status, failed AS failed_stage,
  CASE WHEN d < 6 THEN '30.0' END AS pids, CASE WHEN d >= 6 THEN NULL WHEN d = 2 THEN 'none' WHEN d = 1 THEN '3/2' ELSE '0/0' END AS slots,
  CASE WHEN failed IS NULL THEN CASE WHEN d = 1 THEN '8>10' ELSE '8>8' END END AS validated,
  CASE WHEN d >= 8 THEN 'target:failed' WHEN d >= 6 THEN 'target:done,input:done,msa:failed' WHEN d = 2 THEN 'target:done,input:done,msa:done,expansion:failed'
    ELSE 'target:done,input:done,msa:done,expansion:done,validation:done,result:done' END AS stages FROM f"""


def _shown(records: DataFrame) -> DataFrame:
    def listed(name, show):
        return F.array_join(F.transform(name, show), ",")

    slot = lambda e: F.when(e.isNull(), "none").otherwise(F.concat(e["n_hits"].cast("string"), F.lit("/"), e["n_new_hits"].cast("string")))
    return records.select(
        "target_id", "status", "failed_stage", F.array_join(F.transform("selected_pids", lambda p: p.cast("string")), ",").alias("pids"),
        listed("expansions", slot).alias("slots"),
        listed("validations", lambda v: F.concat(v["seed_nseq"].cast("string"), F.lit(">"), F.coalesce(v["expanded_nseq"].cast("string"), F.lit("-")))).alias("validated"),
        listed("stages", lambda s: F.concat(F.split(s["stage_key"], ":")[0], F.lit(":"), s["status"])).alias("stages"))


@QUERIES.add(_RECORDS)
def full_run(t: Tables) -> DataFrame:
    """One nested record per target, from given candidates; failed targets keep the parts made before."""
    return _shown(supplier_run(t, assembled=False)["records"])


@QUERIES.add(_RECORDS)
def full_run_assembled(t: Tables) -> DataFrame:
    """The same run with candidates assembled from exon tables; one that cannot be assembled is left out with a warning."""
    return _shown(supplier_run(t, assembled=True)["records"])


def stream_expansion(t: Tables) -> dict[str, DataFrame]:
    """User = seed, events = columns, views = inserts. The level of all hits spans all events, that of the centroids every second one.

    Users 0 mod 4 have no new hit and keep their seed; of the others' hits one is a centroid of its own.
    """
    cols = event_columns(t).withColumn("pid", F.lit(30.0)).withColumnRenamed("user_id", "msa_id")
    users = t.events.select(F.col("user_id").alias("msa_id")).distinct()
    letter = F.when(F.col("rf") == ".", "v").otherwise("A")
    spelled = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_idx", letter.alias("c")))), lambda x: x["c"]), "")
    half = cols.where("col_idx % 2 = 1").withColumn("col_idx", (F.col("col_idx") + 1) / 2).withColumn("col_idx", F.col("col_idx").cast("long"))
    texts = {"all": cols.groupBy("msa_id").agg(spelled.alias("seq")), "half": half.groupBy("msa_id").agg(spelled.alias("seq"))}
    seed_rows = texts["all"].select("msa_id", F.lit(5).cast("long").alias("row_idx"), F.lit("seed").alias("name"), "seq")
    grown = F.col("msa_id") % 4 != 0

    def aligned(text: DataFrame, names: list[str]) -> DataFrame:
        return text.where(grown).select("msa_id", F.posexplode(F.array(*[F.lit(n) for n in names])).alias("row_idx", "name"), "seq").withColumn("row_idx", F.col("row_idx").cast("long"))

    raw = users.where(grown).select("msa_id", F.lit(1).cast("long").alias("line_no"), F.lit("c1").alias("target"), F.lit("AA").alias("tseq"))
    members = t.spark.range(2).select(F.lit("c1").alias("centroid"), F.col("id").alias("member_ord"), F.concat(F.lit("c"), (F.col("id") + 1).cast("string")).alias("member"), F.lit("AA").alias("seq"))
    bare = ["msa_id", "pid", "col_idx", "rf", "aligned"]
    code_map = cols.select("msa_id", "code").distinct().withColumn("s_exon_id", F.col("code"))
    return jobs.expand_job(seed_rows, cols, code_map, raw, aligned(texts["all"], ["c1", "seed", "c2"]), cols.where(grown).select(bare), members,
                           aligned(texts["half"], ["c1", "seed"]), half.where(grown).select(bare))


_STREAM = """WITH c AS (SELECT user_id AS m, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, event_type = 'view' AS ins,
  CASE event_type WHEN 'error' THEN '.' ELSE substr(event_type, 1, 1) END AS code FROM events),
codes AS (SELECT m, row_number() OVER (PARTITION BY m ORDER BY i) AS r, code FROM c WHERE NOT ins),
l AS (SELECT 'expanded' AS level, m, i, ins FROM c UNION ALL SELECT 'centroid', m, CASE WHEN m % 4 = 0 THEN i ELSE (i + 1) // 2 END, ins FROM c WHERE m % 4 = 0 OR i % 2 = 1),
k AS (SELECT *, CASE WHEN NOT ins THEN count(*) FILTER (NOT ins) OVER (PARTITION BY level, m ORDER BY i) END AS r FROM l)"""


@QUERIES.add(f"""{_STREAM}, s AS (SELECT level, m, string_agg(CASE WHEN ins THEN 'v' ELSE 'A' END, '' ORDER BY i) AS f, coalesce(string_agg('A', '') FILTER (NOT ins), '') AS q FROM k GROUP BY ALL),
n AS (SELECT level, m, f, q, unnest(CASE WHEN m % 4 = 0 THEN ['seed'] WHEN level = 'centroid' THEN ['seed', 'c1'] ELSE ['seed', 'c1', 'c2'] END) AS name FROM s)
SELECT m AS user_id, level, 'full' AS kind, name, f AS seq, name = 'seed' AS first FROM n UNION ALL SELECT m, level, 'match', name, q, name = 'seed' FROM n""")
def expansion_rows(t: Tables) -> DataFrame:
    """Full and match-only rows of both levels, the seed's first."""
    made = stream_expansion(t)
    parts = [made[prefix + kind + "_rows"].select(F.col("msa_id").alias("user_id"), F.lit(level).alias("level"), F.lit(kind).alias("kind"), "name", "seq",
                                                  (~F.col("order_key.rest")).alias("first"))
             for prefix, level in (("", "expanded"), ("centroid_", "centroid")) for kind in ("full", "match")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@QUERIES.add(f"""{_STREAM}, b AS (SELECT level || '_full' AS a, k.m, i, CASE WHEN ins THEN '.' ELSE coalesce(code, '.') END AS code FROM k LEFT JOIN codes ON codes.m = k.m AND codes.r = k.r
  UNION ALL SELECT level || '_match', k.m, k.r, code FROM k JOIN codes ON codes.m = k.m AND codes.r = k.r),
g AS (SELECT *, i - row_number() OVER (PARTITION BY a, m, code ORDER BY i) AS grp FROM b)
SELECT m AS user_id, a AS alignment, code, min(i) AS start_col, max(i) AS end_col FROM g WHERE code <> '.' GROUP BY a, m, code, grp""")
def expansion_blocks(t: Tables) -> DataFrame:
    """Exon blocks of full and match-only alignments of both levels, codes restored from the seed."""
    return stream_expansion(t)["blocks"].select(F.col("msa_id").alias("user_id"), "alignment", "code", "start_col", "end_col")


@QUERIES.add("""WITH k AS (SELECT s_suppkey AS k, s_suppkey % 10 AS d FROM supplier)
SELECT CAST(k AS VARCHAR) AS target_id, CASE WHEN d < 8 THEN 'ok' ELSE 'error' END AS status, CASE WHEN d < 8 THEN 'ENSG' || lpad(CAST(k AS VARCHAR), 11, '0') END AS ensembl_gene_id,
  CASE WHEN d < 9 THEN 'ENST' || lpad(CAST(k AS VARCHAR), 11, '0') END AS transcript_id, CASE WHEN d < 8 THEN 'homo_sapiens' END AS species, d >= 8 AS told FROM k""")
def target_resolution_job(t: Tables) -> DataFrame:
    """The whole resolution job; a target without metadata or with a bad id stays, with its issue."""
    made = supplier_targets(t)
    return jobs.resolve_job(made["inputs"], made["entries"], made["proteins"], made["lookup"]).select(
        "target_id", "status", "ensembl_gene_id", "transcript_id", "species", F.col("issue").isNotNull().alias("told"))


@QUERIES.add("""WITH n AS (SELECT s_nationkey AS m, count(*) AS n, min(s_suppkey) AS q FROM supplier GROUP BY s_nationkey)
SELECT m AS run_id, n AS seed_nseq, 10 AS seed_ncol, 1 AS seed_clusters62, CAST(1 AS DOUBLE) AS seed_neff80, CASE WHEN m % 2 = 0 THEN n + 1 END AS expanded_nseq, CASE WHEN m % 2 = 0 THEN 1 END AS expanded_clusters62,
  CASE WHEN m % 3 > 0 THEN 'q' || CAST(q AS VARCHAR) END AS query_name, CASE WHEN m % 3 > 0 THEN m % 3 = 1 END AS aln_identical, CASE WHEN m % 3 > 0 THEN m % 3 - 1 END AS aln_mismatches,
  CASE WHEN m % 3 = 2 THEN 'warn' ELSE 'ok' END AS status FROM n""")
def validation_job(t: Tables) -> DataFrame:
    """The whole validation job: nation = run, suppliers = equal rows; even nations have one more row in their expanded alignment.

    References: none for nations 0 mod 3, the query itself for 1 mod 3, one substitution for 2 mod 3."""
    nation = F.col("s_nationkey")
    seed_id, wide_id = F.concat(F.lit("s"), nation.cast("string")), F.concat(F.lit("e"), nation.cast("string"))
    own = t.supplier.select(nation, F.col("s_suppkey").alias("row_idx"), F.concat(F.lit("q"), F.col("s_suppkey").cast("string")).alias("name"), F.lit(QUERY).alias("seq"))
    more = own.select("s_nationkey").distinct().where("s_nationkey % 2 = 0").select("s_nationkey", F.lit(1 << 40).cast("long").alias("row_idx"), F.lit("hit").alias("name"), F.lit(QUERY).alias("seq"))
    rows = own.withColumn("msa_id", seed_id).unionByName(own.where("s_nationkey % 2 = 0").unionByName(more).withColumn("msa_id", wide_id))
    nations = own.groupBy("s_nationkey").agg(F.min("name").alias("any"), F.min_by("name", "row_idx").alias("q"))
    runs = nations.select(nation.alias("run_id"), seed_id.alias("seed_msa"), F.when(nation % 2 == 0, wide_id).alias("expanded_msa"))
    ids = rows.select("msa_id", "s_nationkey").distinct().join(nations, "s_nationkey").select("msa_id", F.lit(0).alias("id_ord"), F.col("q").alias("id"))
    references = nations.where("s_nationkey % 3 > 0").select(nation.alias("run_id"), F.when(nation % 3 == 1, QUERY).otherwise("W" + QUERY[1:]).alias("reference_seq"))
    return jobs.validate_job(runs, rows.drop("s_nationkey"), ids, references).select(
        "run_id", "seed_nseq", "seed_ncol", "seed_clusters62", "seed_neff80", "expanded_nseq", "expanded_clusters62", "query_name", "aln_identical", "aln_mismatches", "status")
