"""Identifier, species, cleaning, label, path and code-map queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codemap, ids, paths, species, text
from .common import Registry, Tables

QUERIES = Registry()
ORACLES = QUERIES.oracles

_IDS_SQL = """ids AS (SELECT o_orderkey, CASE o_orderkey % 5
  WHEN 0 THEN 'ENST' || lpad(CAST(o_orderkey AS VARCHAR), 11, '0') || '.' || CAST(o_orderkey % 7 AS VARCHAR)
  WHEN 1 THEN 'P' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0')
  WHEN 2 THEN 'A' || CAST(o_orderkey % 10 AS VARCHAR) || 'BC' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || '-2'
  WHEN 3 THEN CAST(o_orderkey % 9 AS VARCHAR) || '|ENSG' || CAST(o_orderkey AS VARCHAR) || '.1'
  ELSE 'x|' || o_orderstatus || CAST(o_orderkey AS VARCHAR) END AS id FROM orders)"""


def order_ids(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    k = key.cast("string")
    shape = (
        F.when(key % 5 == 0, F.concat(F.lit("ENST"), F.lpad(k, 11, "0"), F.lit("."), (key % 7).cast("string")))
        .when(key % 5 == 1, F.concat(F.lit("P"), F.lpad((key % 100000).cast("string"), 5, "0")))
        .when(key % 5 == 2, F.concat(F.lit("A"), (key % 10).cast("string"), F.lit("BC"), F.lpad((key % 100).cast("string"), 2, "0"), F.lit("-2")))
        .when(key % 5 == 3, F.concat((key % 9).cast("string"), F.lit("|ENSG"), k, F.lit(".1")))
        .otherwise(F.concat(F.lit("x|"), "o_orderstatus", k))
    )
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", shape.alias("id"))


@QUERIES.add(f"""WITH {_IDS_SQL}
SELECT o_orderkey, id,
  CASE WHEN regexp_full_match(id, 'ENS[A-Z]*T[0-9]+([.][0-9]+)?') THEN 'ensembl_transcript'
       WHEN regexp_full_match(id, '([OPQ][0-9][A-Z0-9][A-Z0-9][A-Z0-9][0-9]|[A-NR-Z][0-9]([A-Z][A-Z0-9][A-Z0-9][0-9])(([A-Z][A-Z0-9][A-Z0-9][0-9])?))(-[0-9]+)?') THEN 'uniprot' END AS kind,
  split_part(id, '.', 1) AS core,
  CASE WHEN strpos(id, '|') > 0 AND regexp_full_match(split_part(id, '|', 1), '[0-9]*') THEN substr(id, strpos(id, '|') + 1) ELSE id END AS bare
FROM ids""")
def id_kind(t: Tables) -> DataFrame:
    return order_ids(t).select("o_orderkey", "id", ids.id_kind("id").alias("kind"), ids.strip_version("id").alias("core"),
                               ids.strip_numeric_prefix("id").alias("bare"))


@QUERIES.add(f"""WITH {_IDS_SQL},
bare AS (SELECT o_orderkey, id, CASE WHEN strpos(id, '|') > 0 AND regexp_full_match(split_part(id, '|', 1), '[0-9]*') THEN substr(id, strpos(id, '|') + 1) ELSE id END AS b FROM ids),
forms AS (SELECT o_orderkey, 0 AS o, id AS variant FROM bare UNION ALL SELECT o_orderkey, 1, split_part(id, '.', 1) FROM bare
  UNION ALL SELECT o_orderkey, 2, b FROM bare UNION ALL SELECT o_orderkey, 3, split_part(b, '.', 1) FROM bare),
firsts AS (SELECT o_orderkey, variant, min(o) AS o FROM forms GROUP BY ALL)
SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY o) - 1 AS INTEGER) AS variant_ord, variant FROM firsts""")
def name_variants(t: Tables) -> DataFrame:
    return order_ids(t).select("o_orderkey", F.posexplode(ids.name_variants("id")).alias("variant_ord", "variant"))


@QUERIES.add(f"""WITH {_IDS_SQL},
given AS (SELECT i.o_orderkey, CASE WHEN o_custkey % 3 <> 0 THEN id END AS a,
    CASE WHEN o_custkey % 4 = 0 THEN 'P12345' WHEN o_custkey % 4 = 1 THEN id END AS u,
    CASE WHEN o_custkey % 5 = 0 THEN 'ENST0001' END AS e, CASE WHEN o_custkey % 2 = 0 THEN 'ENST0009.2' END AS x
  FROM ids i JOIN orders USING (o_orderkey)),
picked AS (SELECT *, coalesce(a, e, u) AS d, coalesce(a, e, u, x) AS p FROM given),
kinds AS (SELECT *, CASE WHEN regexp_full_match(p, 'ENS[A-Z]*T[0-9]+([.][0-9]+)?') THEN 'ensembl_transcript'
  WHEN regexp_full_match(p, '([OPQ][0-9][A-Z0-9]{{3}}[0-9]|[A-NR-Z][0-9][A-Z][A-Z0-9]{{2}}[0-9])(-[0-9]+)?') THEN 'uniprot' END AS k FROM picked)
SELECT o_orderkey, p AS primary_id, k AS input_kind,
  CASE WHEN d IS NOT NULL AND k = 'uniprot' THEN x END AS wanted_transcript,
  CASE WHEN d IS NULL THEN NULL WHEN k = 'uniprot' THEN p ELSE u END AS supplied_uniprot,
  CASE WHEN p IS NULL OR (a IS NOT NULL AND e IS NOT NULL AND a <> e) OR k IS NULL OR (d IS NOT NULL AND k = 'uniprot' AND u IS NOT NULL AND u <> p)
    THEN 'error' ELSE 'ok' END AS status
FROM kinds""")
def primary_input(t: Tables) -> DataFrame:
    c = F.col("o_custkey")
    given = order_ids(t).select(
        "o_orderkey", F.when(c % 3 != 0, F.col("id")).alias("id"),
        F.when(c % 4 == 0, F.lit("P12345")).when(c % 4 == 1, F.col("id")).alias("uniprot_id"),
        F.when(c % 5 == 0, F.lit("ENST0001")).alias("ensembl_transcript_id"),
        F.when(c % 2 == 0, F.lit("ENST0009.2")).alias("transcript_id"))
    return ids.normalize_primary_input(given).select(
        "o_orderkey", "primary_id", "input_kind", "wanted_transcript", "supplied_uniprot", "status")


@QUERIES.add("""SELECT p_partkey, replace(lower(p_name), ' ', '_') AS species,
  CASE WHEN len(string_split(p_name, ' ')) = 2 THEN substr(p_name, 1, 1) || split_part(p_name, ' ', 2) || '_gene_ensembl' END AS dataset
FROM part""")
def species_names(t: Tables) -> DataFrame:
    raw = F.concat(F.lit(" \t"), F.initcap("p_name"), F.lit("\n"))
    return t.part.select("p_partkey", species.normalize_species(raw).alias("species"), species.gene_dataset_name(raw).alias("dataset"))


@QUERIES.add("""WITH lists AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN ' ases ' WHEN 'MACHINERY' THEN 'all'
    ELSE c_name || ', ' || lower(c_mktsegment) || ',,' || c_mktsegment || ' , nation ' || CAST(c_nationkey AS VARCHAR) END AS raw FROM customer),
items AS (SELECT c_custkey, i, replace(lower(trim(list_extract(string_split(raw, ','), i))), ' ', '_') AS s
  FROM lists, unnest(range(1, len(string_split(raw, ',')) + 1)) AS r(i)),
firsts AS (SELECT c_custkey, s, min(i) AS i FROM items WHERE s <> '' GROUP BY ALL),
joined AS (SELECT c_custkey, string_agg(s, '|' ORDER BY i) AS names FROM firsts GROUP BY ALL)
SELECT l.c_custkey, CASE trim(raw) WHEN 'ases' THEN 'ases' WHEN 'all' THEN 'all' ELSE 'explicit' END AS mode, names
FROM lists l JOIN joined USING (c_custkey)""")
def species_lists(t: Tables) -> DataFrame:
    seg = F.col("c_mktsegment")
    raw = F.when(seg == "BUILDING", " ases ").when(seg == "MACHINERY", "all").otherwise(F.concat(
        "c_name", F.lit(", "), F.lower(seg), F.lit(",,"), seg, F.lit(" , nation "), F.col("c_nationkey").cast("string")))
    return t.customer.select("c_custkey", species.specieslist_preset(raw)["mode"].alias("mode"),
                             F.array_join(species.parse_specieslist(raw), "|").alias("names"))


@QUERIES.add("""SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ortholog_one2one'
  WHEN '2' THEN 'ortholog_one2one,ortholog_one2many' WHEN '3' THEN 'ortholog_one2one,ortholog_one2many,ortholog_many2many' END AS relationships
FROM orders""")
def orthology_levels(t: Tables) -> DataFrame:
    p = F.substring("o_orderpriority", 1, 1)
    level = F.when(p == "1", "1:1").when(p == "2", "1:n").when(p == "3", "m:n").otherwise("n:n")
    return t.orders.select("o_orderkey", F.array_join(species.orthology_relationships(level), ",").alias("relationships"))


@QUERIES.add(r"""WITH d AS (SELECT doc_id, replace(text, 'ß', 's') AS x FROM documents)
SELECT doc_id, md5(replace(replace(x, '-', ''), '.', '')) AS bare,
  regexp_extract(x, '[^ \t\n\r\f]+') AS token,
  CASE WHEN regexp_matches(x, '[A-Za-z]') THEN md5(upper(replace(regexp_replace(regexp_replace(x, '^[ \t\n\r\f]+', ''), '[ \t\n\r\f]+$', ''), '-', ''))) END AS hit,
  md5(replace(x, '*', '')) AS exon
FROM d""")
def sequence_cleaning(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", F.translate("text", "ß", "s").alias("x"))
    return docs.select("doc_id", F.md5(text.ungap("x")).alias("bare"), text.first_token("x").alias("token"),
                       F.md5(text.hit_sequence("x")).alias("hit"), F.md5(text.exon_sequence("x")).alias("exon"))


@QUERIES.add("""SELECT event_id, CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'warn' WHEN 'error' THEN 'failed' ELSE 'unknown' END AS cls,
  event_type = 'purchase' AS by_text, value = 1.0 AS by_number FROM events""")
def status_classes(t: Tables) -> DataFrame:
    e = F.col("event_type")
    word = F.when(e == "view", "Completed").when(e == "click", "WARNING").otherwise(e)
    flag = F.when(e == "purchase", "True").when(e == "click", "1").otherwise("no")
    return t.events.select("event_id", text.status_class(word).alias("cls"), text.truthy(flag, "string").alias("by_text"),
                           text.truthy("value", "double").alias("by_number"))


@QUERIES.add("""SELECT p_partkey, printf('%.1f', p_size / 4.0) AS label, printf('pid_%.2f', p_size / 8.0) AS dir_key,
  CAST(CAST(p_size AS DOUBLE) AS VARCHAR) || ',' || CAST(p_size + 0.5 AS VARCHAR) AS thresholds_key FROM part""")
def pid_labels(t: Tables) -> DataFrame:
    size = F.col("p_size")
    return t.part.select("p_partkey", text.pid_label(size / 4.0).alias("label"), text.pid_key(size / 8.0).alias("dir_key"),
                         text.pid_thresholds_key(F.array(size.cast("double"), size + 0.5)).alias("thresholds_key"))


@QUERIES.add("""WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', CASE WHEN page_id % 3 = 0 THEN '/runs/' WHEN page_id % 3 = 1 THEN '/runs/./x/../' ELSE '' END) AS path FROM pages),
n AS (SELECT page_id, path, CASE WHEN page_id % 3 = 2 THEN path ELSE rtrim(replace(path, '/./x/../', '/'), '/') END AS clean FROM p)
SELECT page_id, CASE WHEN page_id % 3 = 2 THEN path ELSE substr(clean, 7) END AS relative,
  CASE WHEN page_id % 3 = 2 THEN '/runs/' || path ELSE path END AS resolved FROM n""")
def artifact_paths(t: Tables) -> DataFrame:
    prefix = F.when(F.col("page_id") % 3 == 0, "/runs/").when(F.col("page_id") % 3 == 1, "/runs/./x/../").otherwise("")
    path = F.concat(prefix, F.regexp_replace("url", "^https?://", ""))
    root = F.lit("/runs/")
    return t.pages.select("page_id", paths.relative_path(path, root).alias("relative"), paths.resolve_path(path, root).alias("resolved"))


@QUERIES.add("""SELECT c_custkey, sha256(c_name) AS content,
  sha256('{"input_id":"' || c_name || '","species":' || CASE WHEN c_acctbal < 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || ',"nation":' || CAST(c_nationkey AS VARCHAR) || '}') AS identity
FROM customer""")
def identity_hashes(t: Tables) -> DataFrame:
    struct = F.struct(F.col("c_name").alias("input_id"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("species"),
                      F.col("c_nationkey").alias("nation"))
    return t.customer.select("c_custkey", paths.content_sha256("c_name").alias("content"), paths.identity_hash(struct).alias("identity"))


@QUERIES.add("""SELECT c_custkey, c_acctbal >= 0 AS valid,
  CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey % 10 AS VARCHAR) || ':' || c_mktsegment || '|' || chr(65 + c_nationkey) || ':' || c_name END AS entries,
  CASE WHEN c_acctbal >= 0 THEN '"' || CAST(c_custkey % 10 AS VARCHAR) || '"=>"' || c_mktsegment || '","' || chr(65 + c_nationkey) || '"=>"' || c_name || '"' END AS formatted
FROM customer""")
def code_map_parse(t: Tables) -> DataFrame:
    raw = F.concat(F.lit('"'), (F.col("c_custkey") % 10).cast("string"), F.lit('"=>"'), "c_mktsegment", F.lit('","'),
                   F.char(F.lit(65) + F.col("c_nationkey")), F.lit('"=>"'), "c_name",
                   F.when(F.col("c_acctbal") < 0, '",').otherwise('"'))
    maps = t.customer.select("c_custkey", raw.alias("raw"))
    ok = codemap.code_map_issue("raw").isNull()
    entries = codemap.code_map_entries("raw")
    shown = F.array_join(F.transform(entries, lambda e: F.concat(e["code"], F.lit(":"), e["s_exon_id"])), "|")
    return maps.select("c_custkey", ok.alias("valid"), F.when(ok, shown).alias("entries"),
                       F.when(ok, codemap.format_code_map(entries)).alias("formatted"))
