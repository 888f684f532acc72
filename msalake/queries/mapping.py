"""Cross-reference, target, name and species-filter queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import names, resolve, speciesfilter
from .common import Registry, Tables

QUERIES = Registry()
ORACLES = QUERIES.oracles


def order_entries(t: Tables) -> DataFrame:
    """Order = entry, line = cross-reference, part = transcript, supplier = gene; some properties are absent."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_quantity", "l_discount")

    def prop(name, value):
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    def xref(x):
        gene = F.when(x["l_returnflag"] != "N", prop("GeneId", F.concat(F.lit("G"), x["l_suppkey"])))
        protein = F.when(x["l_linestatus"] != "O", prop("ProteinId", F.concat(F.lit("P"), x["l_partkey"], F.lit("."), x["l_linenumber"])))
        return F.struct(
            F.when(x["l_quantity"] > 45, "PDB").otherwise("Ensembl").alias("database"), F.concat(F.lit("T"), x["l_partkey"]).alias("id"),
            F.when(x["l_discount"] > 0.05, F.concat(F.lit("I"), x["l_suppkey"])).alias("isoformId"),
            F.array_compact(F.array(gene, protein)).alias("properties"))

    return t.lineitem.groupBy(F.col("l_orderkey").alias("uniprot_id")).agg(
        F.transform(F.array_sort(F.collect_list(line)), xref).alias("xrefs"))


_XREFS = """x AS (SELECT l_orderkey AS e, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_linestatus, l_quantity, l_discount) AS o,
  'T' || CAST(l_partkey AS VARCHAR) AS tx, CASE WHEN l_returnflag <> 'N' THEN 'G' || CAST(l_suppkey AS VARCHAR) END AS g,
  CASE WHEN l_linestatus <> 'O' THEN 'P' || CAST(l_partkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) END AS p,
  CASE WHEN l_discount > 0.05 THEN 'I' || CAST(l_suppkey AS VARCHAR) END AS i, l_quantity FROM lineitem),
xr AS (SELECT * FROM x WHERE l_quantity <= 45),
defaults AS (SELECT e, arg_min(g, o) AS dg FROM xr WHERE g IS NOT NULL GROUP BY e),
tmap AS (SELECT e, tx, min(o) AS o, coalesce(max_by(g, o) FILTER (g IS NOT NULL), any_value(dg)) AS gene_id,
  max_by(p, o) FILTER (p IS NOT NULL) AS protein_id, max_by(i, o) FILTER (i IS NOT NULL) AS isoform_id
  FROM xr LEFT JOIN defaults USING (e) GROUP BY e, tx)"""


def _transcripts(t: Tables) -> DataFrame:
    flat = resolve.explode_xrefs(order_entries(t))
    return resolve.fill_default_genes(resolve.transcript_map(flat), resolve.default_genes(flat))


@QUERIES.add(f"WITH {_XREFS} SELECT e AS uniprot_id, tx AS transcript_id, gene_id, protein_id, isoform_id FROM tmap")
def xref_map(t: Tables) -> DataFrame:
    return _transcripts(t).select("uniprot_id", "transcript_id", "gene_id", "protein_id", "isoform_id")


@QUERIES.add(f"""WITH {_XREFS},
req AS (SELECT o_orderkey AS e, CASE o_orderstatus WHEN 'F' THEN 'T' || CAST((SELECT max(l_partkey) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS VARCHAR) || '.9' WHEN 'P' THEN 'none' END AS w FROM orders o),
firsts AS (SELECT e, count(*) AS n, arg_min(tx, o) AS first_tx FROM tmap GROUP BY e),
wanted AS (SELECT r.e, t.tx FROM req r JOIN tmap t ON t.e = r.e AND t.tx = split_part(r.w, '.', 1))
SELECT r.e AS uniprot_id, coalesce(n, 0) AS n_candidates, CASE WHEN r.w IS NULL THEN first_tx ELSE wanted.tx END AS transcript_id,
  CASE WHEN (r.w IS NULL AND first_tx IS NOT NULL) OR wanted.tx IS NOT NULL THEN 'ok' ELSE 'error' END AS status,
  CASE WHEN r.w IS NULL AND n > 1 THEN 'Several transcripts have the entry''s sequence; the first is taken: ' || first_tx || '.' ELSE '' END AS warning
FROM req r LEFT JOIN firsts USING (e) LEFT JOIN wanted USING (e)""")
def candidate_choice(t: Tables) -> DataFrame:
    last_part = t.lineitem.groupBy("l_orderkey").agg(F.max("l_partkey").alias("m"))
    status = F.col("o_orderstatus")
    requests = t.orders.join(last_part, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("uniprot_id"),
        F.when(status == "F", F.concat(F.lit("T"), "m", F.lit(".9"))).when(status == "P", F.lit("none")).alias("wanted_transcript"))
    chosen = resolve.choose_candidates(requests, _transcripts(t).withColumn("ord", F.col("ord").cast("int")))
    return chosen.select("uniprot_id", "n_candidates", "transcript_id", "status", F.array_join("warnings", "").alias("warning"))


@QUERIES.add("""SELECT a.doc_id AS uniprot_id, 'T' || CAST(b.doc_id AS VARCHAR) AS transcript_id, a.lang AS species
FROM documents a JOIN documents b ON b.doc_id IN (a.doc_id, a.doc_id + 1, a.doc_id + 7) WHERE upper(a.text) = upper(b.text)""")
def candidate_validation(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "lang", "text")
    transcripts = docs.select(F.col("doc_id").alias("uniprot_id"), F.explode(F.array(
        F.col("doc_id"), F.col("doc_id") + 1, F.col("doc_id") + 7)).alias("other")).select(
        "uniprot_id", F.col("other").alias("ord"), F.concat(F.lit("T"), "other").alias("transcript_id"), F.lit("G").alias("gene_id"),
        F.concat(F.lit("P"), "other", F.lit(".4")).alias("protein_id"), F.lit(None).cast("string").alias("isoform_id"))
    entries = docs.select(F.col("doc_id").alias("uniprot_id"), F.col("lang").alias("species"), F.col("text").alias("protein_sequence"))
    proteins = docs.select(F.concat(F.lit("P"), "doc_id").alias("protein_id"), F.col("text").alias("seq"))
    return resolve.validate_candidates(transcripts, entries, proteins).select("uniprot_id", "transcript_id", "species")


@QUERIES.add("""WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') ELSE CAST(c_custkey AS VARCHAR) END AS z, c_custkey % 4 AS shape, c_nationkey AS n, c_acctbal AS b, c_mktsegment AS seg FROM customer)
SELECT k AS target_id, CASE shape WHEN 0 THEN 'P' || z || '5' WHEN 3 THEN 'junk' ELSE 'ENST' || CAST(k AS VARCHAR) || '.2' END AS input_id,
  CASE shape WHEN 0 THEN CASE WHEN b > 0 THEN 'G' || CAST(k AS VARCHAR) END WHEN 1 THEN CASE WHEN n <> 3 THEN 'G' || CAST(k AS VARCHAR) END WHEN 2 THEN 'given' END AS ensembl_gene_id,
  CASE shape WHEN 0 THEN CASE WHEN b > 0 THEN 'ENST' || CAST(k AS VARCHAR) || '.1' END WHEN 3 THEN NULL ELSE 'ENST' || CAST(k AS VARCHAR) || '.2' END AS transcript_id,
  CASE shape WHEN 0 THEN CASE WHEN b > 0 THEN seg END WHEN 1 THEN seg WHEN 2 THEN 'given' END AS species,
  CASE shape WHEN 0 THEN CASE WHEN b > 0 THEN 'ok' ELSE 'error' END WHEN 1 THEN CASE WHEN n <> 3 THEN 'ok' ELSE 'error' END WHEN 2 THEN 'ok' ELSE 'error' END AS status
FROM c""")
def resolve_targets(t: Tables) -> DataFrame:
    """Customers as inputs: accession, transcript to look up, complete transcript, junk."""
    k = F.col("c_custkey").cast("string")
    shape = F.col("c_custkey") % 4
    accession = F.concat(F.lit("P"), F.when(F.length(k) < 4, F.lpad(k, 4, "0")).otherwise(k), F.lit("5"))
    none = F.lit(None).cast("string")
    inputs = t.customer.select(
        F.col("c_custkey").alias("target_id"),
        F.when(shape == 0, accession).when(shape == 3, "junk").otherwise(F.concat(F.lit("ENST"), k, F.lit(".2"))).alias("primary_id"),
        F.when(shape == 0, "uniprot").when(shape < 3, "ensembl_transcript").alias("input_kind"), none.alias("wanted_transcript"),
        none.alias("supplied_uniprot"), F.when(shape == 2, "given").alias("ensembl_gene_id"), none.alias("ensembl_protein_id"),
        F.when(shape == 2, "given").alias("species"), F.when(shape == 3, "error").otherwise("ok").alias("status"), none.alias("issue"))
    prop = lambda key, value: F.struct(F.lit(key).alias("key"), value.alias("value"))
    entries = t.customer.where(shape == 0).groupBy(accession.alias("uniprot_id")).agg(
        F.min(F.struct("c_custkey", "c_mktsegment")).alias("m")).select(
        "uniprot_id", F.col("m.c_mktsegment").alias("species"), F.lit("ACDE").alias("protein_sequence"),
        F.array(F.struct(
            F.lit("Ensembl").alias("database"), F.concat(F.lit("ENST"), F.col("m.c_custkey").cast("string"), F.lit(".1")).alias("id"),
            none.alias("isoformId"), F.array(
                prop("GeneId", F.concat(F.lit("G"), F.col("m.c_custkey").cast("string"))),
                prop("ProteinId", F.concat(F.lit("ENSP"), F.col("m.c_custkey").cast("string")))).alias("properties"))).alias("xrefs"))
    proteins = t.customer.select(F.concat(F.lit("ENSP"), k).alias("protein_id"), F.when(F.col("c_acctbal") > 0, "acde").otherwise("AC").alias("seq"))
    lookup = t.customer.select(F.concat(F.lit("ENST"), k).alias("transcript_id"), F.when(F.col("c_nationkey") != 3, F.concat(F.lit("G"), k)).alias("ensembl_gene_id"),
                               F.col("c_mktsegment").alias("species"), F.when(F.col("c_nationkey") == 3, "no parent gene").alias("issue"))
    return resolve.resolve_targets(inputs, entries, proteins, lookup).select(
        "target_id", "input_id", "ensembl_gene_id", "transcript_id", "species", "status")


_NAMES = """rows_ AS (SELECT c_nationkey AS m, c_custkey AS r, CASE c_custkey % 3 WHEN 0 THEN 'G' || CAST(c_custkey % 100 AS VARCHAR) || '.1'
    WHEN 1 THEN '7|G' || CAST(c_custkey % 100 AS VARCHAR) || '.2' ELSE 'G' || CAST(c_custkey AS VARCHAR) END AS name FROM customer),
req AS (SELECT s_nationkey AS m, s_suppkey AS o, CASE WHEN s_suppkey % 4 = 0 THEN 'G' || CAST(s_suppkey % 100 AS VARCHAR) ELSE 'none' || CAST(s_suppkey AS VARCHAR) END AS id FROM supplier),
rv AS (SELECT m, r, name, 0 AS v, name AS variant FROM rows_ UNION ALL SELECT m, r, name, 1, split_part(name, '.', 1) FROM rows_
  UNION ALL SELECT m, r, name, 2, regexp_replace(name, '^[0-9]*[|]', '') FROM rows_ UNION ALL SELECT m, r, name, 3, split_part(regexp_replace(name, '^[0-9]*[|]', ''), '.', 1) FROM rows_),
hit AS (SELECT q.m, name, r, row_number() OVER (PARTITION BY q.m ORDER BY q.o, r, v) AS k FROM req q JOIN rv ON rv.m = q.m AND rv.variant = q.id)"""


@QUERIES.add(f"""WITH {_NAMES}, firsts AS (SELECT m, min(r) AS r FROM rows_ GROUP BY m)
SELECT q.m AS msa_id, coalesce(h.name, f.name) AS name, coalesce(h.r, f.r) AS row_idx FROM (SELECT DISTINCT m FROM req) q
LEFT JOIN hit h ON h.m = q.m AND k = 1 LEFT JOIN (SELECT rows_.* FROM rows_ JOIN firsts USING (m, r)) f ON f.m = q.m""")
def name_resolution(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    rows = t.customer.select(
        F.col("c_nationkey").alias("msa_id"), c.alias("row_idx"),
        F.when(c % 3 == 0, F.concat(F.lit("G"), (c % 100).cast("string"), F.lit(".1")))
        .when(c % 3 == 1, F.concat(F.lit("7|G"), (c % 100).cast("string"), F.lit(".2"))).otherwise(F.concat(F.lit("G"), c.cast("string"))).alias("name"))
    s = F.col("s_suppkey")
    requests = t.supplier.select(F.col("s_nationkey").alias("msa_id"), s.alias("id_ord"), F.when(
        s % 4 == 0, F.concat(F.lit("G"), (s % 100).cast("string"))).otherwise(F.concat(F.lit("none"), s.cast("string"))).alias("id"))
    return names.resolve_names(requests, rows, fallback=True)


@QUERIES.add("""WITH src AS (SELECT o_custkey AS k, o_orderkey AS r, 'O' || CAST(o_orderkey AS VARCHAR) AS name, o_totalprice > 480000 AS lost FROM orders),
bad AS (SELECT k FROM src GROUP BY k HAVING bool_or(lost))
SELECT k AS msa_id, r AS rec_idx, name, CASE WHEN NOT lost THEN reverse(name) END AS seq, CASE WHEN bad.k IS NULL THEN 'ok' ELSE 'error' END AS status FROM src LEFT JOIN bad USING (k)""")
def row_reorder(t: Tables) -> DataFrame:
    name = F.concat(F.lit("O"), F.col("o_orderkey").cast("string"))
    source = t.orders.select(F.col("o_custkey").alias("msa_id"), F.col("o_orderkey").alias("rec_idx"), name.alias("name"))
    aligned = t.orders.where("o_totalprice <= 480000").select(F.col("o_custkey").alias("msa_id"), name.alias("name"), F.reverse(name).alias("seq"))
    return names.reorder_like(aligned, source).drop("issue")


@QUERIES.add("""SELECT o_custkey AS msa_id, o_orderkey AS row_idx, o_orderstatus <> 'F' AS rest,
  CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END AS prio FROM orders""")
def priority_rows(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("msa_id"), F.col("o_orderkey").alias("row_idx"), F.col("o_orderkey").cast("string").alias("name"))
    priority = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("msa_id"), F.col("o_orderkey").cast("string").alias("name"), F.floor("o_totalprice").alias("prio"))
    return names.priority_order(rows, priority).select("msa_id", "row_idx", "order_key.rest", "order_key.prio")


_ORTHOLOGS = """hom AS (SELECT l_orderkey AS e, 'nation_' || CAST(s_nationkey AS VARCHAR) AS s, l_returnflag AS f,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag) AS o
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
lvl AS (SELECT o_orderkey AS e, o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS lv FROM orders),
orth AS (SELECT e, s, min(o) AS o FROM hom JOIN lvl USING (e) WHERE f = 'R' OR (f = 'A' AND lv >= 2) OR (f = 'N' AND lv >= 3) GROUP BY e, s)"""


def _homologies(t: Tables) -> DataFrame:
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "s_nationkey")

    def homology(x):
        kind = F.when(x["l_returnflag"] == "R", "ortholog_one2one").when(x["l_returnflag"] == "A", "ortholog_one2many").otherwise("ortholog_many2many")
        return F.struct(kind.alias("type"), F.struct(F.concat(F.lit("Nation "), x["s_nationkey"]).alias("species")).alias("target"))

    docs = t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).groupBy("l_orderkey").agg(
        F.array(F.struct(F.transform(F.array_sort(F.collect_list(line)), homology).alias("homologies"))).alias("data"))
    level = F.when(F.col("o_orderstatus") == "F", "1:1").when(F.col("o_orderstatus") == "O", "1:n").otherwise("m:n")
    return docs.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("target_id"), level.alias("orthology"), "data")


def _order_orthologs(t: Tables) -> DataFrame:
    found = speciesfilter.homology_species(_homologies(t))
    return found.select("target_id", F.col("ord._j").alias("ord"), "species")


@QUERIES.add(f"WITH {_ORTHOLOGS} SELECT e AS target_id, CAST(o - 1 AS INTEGER) AS ord, s AS species FROM orth")
def homology_species(t: Tables) -> DataFrame:
    return _order_orthologs(t)


def _facts(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("target_id"), F.concat(F.lit("G"), F.col("o_orderkey").cast("string")).alias("ensembl_gene_id"),
        F.concat(F.lit("NATION "), F.col("c_nationkey").cast("string")).alias("species"),
        F.when(status == "F", "1:1").when(status == "O", "1:n").otherwise("m:n").alias("orthology"),
        (F.substring("o_orderpriority", 1, 1) != "5").alias("has_request"), (F.substring("o_orderpriority", 1, 1) == "4").alias("homology_failed"))


def _requested(t: Tables) -> DataFrame:
    """Every nation of the customer's region, in key order, for the orders that carry a request."""
    region = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    # 25 nations: one short list per region.
    lists = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_nationkey")).alias("l"))
    return t.orders.where("substring(o_orderpriority, 1, 1) <> '5'").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        region, "c_nationkey").join(lists, "n_regionkey").select(
        F.col("o_orderkey").alias("target_id"), F.posexplode("l").alias("ord", "n")).select(
        "target_id", "ord", F.concat(F.lit("nation_"), F.col("n").cast("string")).alias("species"))


_EFFECTIVE = f"""{_ORTHOLOGS},
facts AS (SELECT o_orderkey AS e, 'nation_' || CAST(c_nationkey AS VARCHAR) AS q, c_nationkey, substr(o_orderpriority, 1, 1) AS p,
  CASE o_orderstatus WHEN 'F' THEN '1:1' WHEN 'O' THEN '1:n' ELSE 'm:n' END AS lv FROM orders JOIN customer ON c_custkey = o_custkey),
asked AS (SELECT e, n2.n_nationkey AS o, 'nation_' || CAST(n2.n_nationkey AS VARCHAR) AS s FROM facts JOIN nation n1 ON n1.n_nationkey = c_nationkey JOIN nation n2 ON n2.n_regionkey = n1.n_regionkey WHERE p <> '5'),
kept AS (SELECT a.e, a.o, a.s FROM asked a JOIN facts USING (e) LEFT JOIN orth ON orth.e = a.e AND orth.s = a.s WHERE p = '4' OR orth.s IS NOT NULL
  UNION ALL SELECT orth.e, orth.o, orth.s FROM orth JOIN facts USING (e) WHERE p = '5'),
eff0 AS (SELECT e, s, min(o) AS o FROM (SELECT * FROM kept UNION ALL SELECT e, -1, q FROM facts WHERE p <> '4') GROUP BY e, s),
bad AS (SELECT e FROM facts WHERE p <> '4' AND e NOT IN (SELECT e FROM kept)),
eff AS (SELECT * FROM eff0 WHERE e NOT IN (SELECT e FROM bad)),
gone AS (SELECT a.e, string_agg(a.s, ', ' ORDER BY a.o) AS txt FROM asked a JOIN facts USING (e) LEFT JOIN orth ON orth.e = a.e AND orth.s = a.s
  WHERE p <> '4' AND orth.s IS NULL AND a.s <> q AND a.e NOT IN (SELECT e FROM bad) GROUP BY a.e)"""


@QUERIES.add(f"""WITH {_EFFECTIVE}
SELECT f.e AS target_id, l.names, CASE WHEN f.e IN (SELECT e FROM bad) THEN 'error' WHEN p = '4' OR txt IS NOT NULL THEN 'warn' ELSE 'ok' END AS status,
  CASE WHEN p = '4' THEN 'The ortholog lookup gave nothing, so the requested species are taken as they are.'
       WHEN txt IS NOT NULL THEN 'Species left out for want of orthologs of level ' || lv || ' of gene G' || CAST(f.e AS VARCHAR) || ': ' || txt || '.' END AS warning
FROM facts f LEFT JOIN gone USING (e) LEFT JOIN (SELECT e, string_agg(s, ',' ORDER BY o) AS names FROM eff GROUP BY e) l USING (e)""")
def species_effective(t: Tables) -> DataFrame:
    species, report = speciesfilter.effective_species(_facts(t), _requested(t), _order_orthologs(t))
    lists = species.groupBy("target_id").agg(speciesfilter.ordered_join(F.col("species"), F.col("ord"), ",").alias("names"))
    return report.join(lists, "target_id", "left").select("target_id", "names", "status", "warning")


_FATES = """asked AS (SELECT o_orderkey AS e, n2.n_nationkey AS o, CASE WHEN n2.n_nationkey % 10 = 7 THEN 'nation_x_' ELSE 'nation_' END || CAST(n2.n_nationkey AS VARCHAR) AS s,
    n2.n_nationkey AS n, c_nationkey AS q FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation n1 ON n1.n_nationkey = c_nationkey JOIN nation n2 ON n2.n_regionkey = n1.n_regionkey),
fates AS (SELECT *, CASE WHEN n % 10 = 7 THEN 'unchecked' WHEN n % 3 = 0 THEN 'kept' WHEN n = q THEN 'query' ELSE 'removed' END AS fate FROM asked)"""


@QUERIES.add(f"""WITH {_FATES}
SELECT e AS target_id, string_agg(CASE WHEN fate <> 'removed' THEN s END, ',' ORDER BY o) AS names,
  CASE WHEN count(*) FILTER (fate <> 'removed') = 0 THEN 'error' WHEN count(*) FILTER (fate <> 'kept') > 0 THEN 'warn' ELSE 'ok' END AS status,
  CAST(CAST(count(*) FILTER (fate = 'removed') > 0 AS INTEGER) + CAST(count(*) FILTER (fate = 'unchecked') > 0 AS INTEGER) + CAST(count(*) FILTER (fate = 'query') > 0 AS INTEGER) AS INTEGER) AS n_warnings
FROM fates GROUP BY e""")
def dataset_filter(t: Tables) -> DataFrame:
    region = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    lists = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_nationkey")).alias("l"))
    who = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(region, "c_nationkey").join(lists, "n_regionkey")
    name = lambda n: F.concat(F.when(n % 10 == 7, "nation_x_").otherwise("nation_"), n.cast("string"))
    requested = who.select(F.col("o_orderkey").alias("target_id"), F.explode("l").alias("ord")).withColumn("species", name(F.col("ord")))
    targets = who.select(F.col("o_orderkey").alias("target_id"), name(F.col("c_nationkey")).alias("species"))
    registry = t.nation.where("n_nationkey % 3 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit("_gene_ensembl")).alias("dataset"))
    species, report = speciesfilter.dataset_filter(targets, requested, registry)
    lists = species.groupBy("target_id").agg(speciesfilter.ordered_join(F.col("species"), F.col("ord"), ",").alias("names"))
    return report.join(lists, "target_id", "left").select("target_id", "names", "status", F.size("warnings").alias("n_warnings"))


@QUERIES.add(f"""WITH {_EFFECTIVE},
judged AS (SELECT eff.e, eff.o, eff.s, q, CASE WHEN CAST(substr(eff.s, 8) AS INTEGER) % 3 = 0 OR eff.s = q THEN 1 ELSE 0 END AS k FROM eff JOIN facts USING (e))
SELECT f.e AS target_id, names, CASE WHEN f.e IN (SELECT e FROM bad) OR (names IS NULL AND f.e IN (SELECT e FROM judged)) THEN 'error'
  WHEN p = '4' OR txt IS NOT NULL OR f.e IN (SELECT e FROM judged WHERE k = 0) OR f.e IN (SELECT e FROM judged WHERE s = q AND CAST(substr(s, 8) AS INTEGER) % 3 <> 0) THEN 'warn' ELSE 'ok' END AS status
FROM facts f LEFT JOIN gone USING (e) LEFT JOIN (SELECT e, string_agg(s, ',' ORDER BY o) AS names FROM judged WHERE k = 1 GROUP BY e) l USING (e)""")
def species_filter_chain(t: Tables) -> DataFrame:
    registry = t.nation.where("n_nationkey % 3 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit("_gene_ensembl")).alias("dataset"))
    species, report = speciesfilter.compose_filters(_facts(t), _requested(t), _order_orthologs(t), registry)
    lists = species.groupBy("target_id").agg(speciesfilter.ordered_join(F.col("species"), F.col("ord"), ",").alias("names"))
    return report.join(lists, "target_id", "left").select("target_id", "names", "status")
