"""Scan and export queries: texts of every source format derived from the driver tables, then parsed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import running_sum, shared_folder
from ..operators import scoring
from ..sinks import shards
from ..sinks import text as sinks
from ..sources import bundle, stockholm, tables
from ..sources import json as records
from ..sources import text as scans
from .common import Registry, Tables

QUERIES = Registry()
ORACLES = QUERIES.oracles

_CLEAN_TEXT = "replace(replace(text, 'ß', 's'), '>', '_')"


def clean_text() -> F.Column:
    return F.translate("text", "ß>", "s_")


def _fasta_texts(t: Tables) -> DataFrame:
    content = F.concat(F.lit(">d"), F.col("doc_id"), F.lit(" "), "lang", F.lit("\n"), clean_text(), F.lit("\n>e"), F.col("doc_id"), F.lit("\n\n"))
    return t.documents.select("doc_id", content.alias("content"))


@QUERIES.add(rf"""WITH d AS (SELECT doc_id, lang, upper(regexp_replace({_CLEAN_TEXT}, '[ \t\n\r\f\v]', '', 'g')) AS s FROM documents)
SELECT doc_id, 1 AS rec_idx, 'd' || CAST(doc_id AS VARCHAR) || ' ' || lang AS name, CASE WHEN s <> '' THEN md5(s) END AS digest, CASE WHEN s <> '' THEN length(s) END AS n FROM d
UNION ALL SELECT doc_id, 2, 'e' || CAST(doc_id AS VARCHAR), NULL, NULL FROM d""")
def fasta_records(t: Tables) -> DataFrame:
    return scans.parse_fasta(_fasta_texts(t)).select("doc_id", "rec_idx", "name", F.md5("seq").alias("digest"), F.length("seq").alias("n"))


@QUERIES.add(rf"""WITH d AS (SELECT doc_id, upper(regexp_replace({_CLEAN_TEXT}, '[ \t\n\r\f\v]', '', 'g')) AS s FROM documents)
SELECT doc_id, md5('>d' || CAST(doc_id AS VARCHAR) || chr(10) || regexp_replace(s, '(.{{1,60}})', '\1' || chr(10), 'g')) AS record FROM d""")
def fasta_export(t: Tables) -> DataFrame:
    seq = F.regexp_replace(clean_text(), r"\s", "")
    return t.documents.select("doc_id", F.md5(sinks.fasta_record(F.concat(F.lit("d"), F.col("doc_id")), seq)).alias("record"))


_LINES = r"""c AS (SELECT conv_id, turn, role, regexp_replace(text, '[^A-Za-z]', '', 'g') AS s FROM conversations)"""


def conversation_lines(t: Tables) -> DataFrame:
    """A fragmented Stockholm file per conversation: five lines per turn, in turn order."""
    s = F.regexp_replace("text", "[^A-Za-z]", "")
    turn = F.col("turn")
    lines = F.array(
        F.concat("role", F.lit("  "), s), F.concat(F.lit("#=GR "), "role", F.lit(" PP "), F.reverse(s)), F.concat(F.lit("#=GC RF "), s),
        F.concat(F.lit("#=GF DE turn "), turn.cast("string"), F.lit(" of "), "role"), F.lit("#=GS short"))
    body = t.conversations.select(F.col("conv_id").cast("string").alias("source"), turn, F.posexplode(lines).alias("p", "line")).select(
        "source", (turn * 5 + F.col("p") + 2).cast("long").alias("line_no"), "line")
    head = t.conversations.select(F.col("conv_id").cast("string").alias("source")).distinct().select(
        "source", F.lit(1).cast("long").alias("line_no"), F.lit("# STOCKHOLM 1.0").alias("line"))
    return body.unionByName(head)


@QUERIES.add(rf"""WITH {_LINES}
SELECT CAST(conv_id AS VARCHAR) AS source, 'seq' AS kind, role AS seq_name, NULL AS feature, string_agg(s, '' ORDER BY turn) AS value FROM c WHERE s <> '' GROUP BY conv_id, role
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'GR', role, 'PP', string_agg(reverse(s), '' ORDER BY turn) FROM c WHERE s <> '' GROUP BY conv_id, role
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'GC', NULL, 'RF', string_agg(s, '' ORDER BY turn) FROM c WHERE s <> '' GROUP BY conv_id
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'GF', NULL, 'DE', 'turn ' || CAST(turn AS VARCHAR) || ' of ' || role FROM c""")
def stockholm_normalise(t: Tables) -> DataFrame:
    return stockholm.normalize_annotations(conversation_lines(t)).drop("ord")


@QUERIES.add(rf"""WITH {_LINES},
seqs AS (SELECT conv_id, role, min(turn) AS o, string_agg(s, '' ORDER BY turn) AS v, string_agg(reverse(s), '' ORDER BY turn) AS r FROM c WHERE s <> '' GROUP BY conv_id, role),
lines AS (SELECT DISTINCT conv_id, 0 AS a, 0 AS b, 0 AS d, '# STOCKHOLM 1.0' AS line FROM c
  UNION ALL SELECT conv_id, 2, 0, turn, '#=GF DE turn ' || CAST(turn AS VARCHAR) || ' of ' || role FROM c
  UNION ALL SELECT conv_id, 4, 0, 0, '#=GC RF ' || string_agg(s, '' ORDER BY turn) FROM c WHERE s <> '' GROUP BY conv_id
  UNION ALL SELECT conv_id, 5, o, 0, role || chr(9) || v FROM seqs UNION ALL SELECT conv_id, 5, o, 1, '#=GR ' || role || ' PP ' || r FROM seqs
  UNION ALL SELECT DISTINCT conv_id, 9, 0, 0, '//' FROM c)
SELECT CAST(conv_id AS VARCHAR) AS source, md5(string_agg(line, chr(10) ORDER BY a, b, d)) AS digest FROM lines GROUP BY conv_id""")
def stockholm_export(t: Tables) -> DataFrame:
    lines = sinks.stockholm_lines(stockholm.normalize_annotations(conversation_lines(t)))
    # One digest per file shows the order of its few lines.
    ordered = F.array_sort(F.collect_list(F.struct("section", "ord", "sub_ord", "line")))
    return lines.groupBy("source").agg(F.md5(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")).alias("digest"))


@QUERIES.add("""WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n, role FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS source, k AS line_no, CASE role WHEN 'user' THEN 'u ' || CAST(turn AS VARCHAR) WHEN 'system' THEN '# STOCKHOLM 1.0' END AS line FROM c WHERE role <> 'assistant'
UNION ALL SELECT CAST(conv_id AS VARCHAR), 0, '# STOCKHOLM 1.0' FROM c WHERE k = 1 AND role <> 'system'
UNION ALL SELECT CAST(conv_id AS VARCHAR), k + 1, '//' FROM c WHERE k = n""")
def stockholm_strip(t: Tables) -> DataFrame:
    role = F.col("role")
    # Rank by counting earlier turns of the (short) conversation.
    turns = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    lines = t.conversations.join(turns, "conv_id").select(
        F.col("conv_id").cast("string").alias("source"), F.array_position("turns", F.col("turn")).alias("line_no"),
        F.when(role == "user", F.concat(F.lit("u "), F.col("turn").cast("string"))).when(role == "system", "# STOCKHOLM 1.0").otherwise(
            "#=GC SExonCode 00").alias("line"))
    return stockholm.strip_provenance(lines)


@QUERIES.add(r"""WITH p AS (SELECT page_id, url || CASE page_id % 5 WHEN 0 THEN '.STO' WHEN 1 THEN '.stockholm' WHEN 2 THEN '.A3m' WHEN 3 THEN '.fa' ELSE '' END AS path FROM pages)
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'stockholm' WHEN 1 THEN 'stockholm' WHEN 2 THEN 'a3m' WHEN 3 THEN 'fasta' END AS format FROM p""")
def alignment_formats(t: Tables) -> DataFrame:
    p = F.col("page_id") % 5
    suffix = F.when(p == 0, ".STO").when(p == 1, ".stockholm").when(p == 2, ".A3m").when(p == 3, ".fa").otherwise("")
    return t.pages.select("page_id", stockholm.alignment_format(F.concat("url", suffix)).alias("format"))


@QUERIES.add(r"""WITH c AS (SELECT conv_id, turn, role, regexp_replace(text, '[^A-Za-z]', '', 'g') AS s FROM conversations),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS row_idx, role || CAST(turn AS VARCHAR) AS name, s FROM c)
SELECT CAST(conv_id AS VARCHAR) || CASE conv_id % 2 WHEN 0 THEN '.fasta' ELSE '.doc' END AS msa_id, CASE conv_id % 2 WHEN 0 THEN row_idx END AS row_idx,
  CASE conv_id % 2 WHEN 0 THEN name END AS name, CASE conv_id % 2 WHEN 0 THEN s END AS seq, CASE conv_id % 2 WHEN 0 THEN 'ok' ELSE 'error' END AS status
FROM r WHERE conv_id % 2 = 0 OR row_idx = 1""")
def alignment_scan(t: Tables) -> DataFrame:
    s = F.regexp_replace("text", "[^A-Za-z]", "")
    name = F.concat(F.col("conv_id").cast("string"), F.when(F.col("conv_id") % 2 == 0, ".fasta").otherwise(".doc"))
    lines = t.conversations.select(name.alias("source"), "turn", F.posexplode(F.array(
        F.concat(F.lit(">"), "role", F.col("turn").cast("string")), s)).alias("p", "line")).select(
        "source", (F.col("turn") * 2 + F.col("p")).alias("line_no"), "line")
    return stockholm.alignments_from_lines(lines).select("msa_id", "row_idx", "name", "seq", "status")


@QUERIES.add(r"""WITH d AS (SELECT doc_id, lang, regexp_replace(text, '[^A-Za-z]', '', 'g') AS s FROM documents)
SELECT doc_id, 'T' || CAST(doc_id AS VARCHAR) || x AS transcript_id, md5(reverse(s) || CASE WHEN doc_id % 3 = 0 THEN '!' ELSE '' END) AS symbols, md5(s) AS seq, doc_id % 3 = 0 AS bad
FROM d, (VALUES (''), ('b')) v(x)""")
def pir_entries(t: Tables) -> DataFrame:
    s = F.regexp_replace("text", "[^A-Za-z]", "")
    k = F.col("doc_id").cast("string")
    extra = F.when(F.col("doc_id") % 3 == 0, "!").otherwise("")
    content = F.concat(F.lit(">P1;T"), k, F.lit(".1/T"), k, F.lit("b \n"), F.reverse(s), extra, F.lit("\n"), F.regexp_replace(s, "(.{60})", "$1\n"), F.lit("*\n"))
    texts = t.documents.select("doc_id", content.alias("content"))
    return scans.parse_pir(texts).select("doc_id", "transcript_id", F.md5("symbols").alias("symbols"), F.md5("seq").alias("seq"), F.col("issue").isNotNull().alias("bad"))


@QUERIES.add("""SELECT p_partkey, CAST(p_partkey AS VARCHAR) || '_0' AS s_exon_id, CASE p_size % 3 WHEN 0 THEN chr(33 + p_size) WHEN 1 THEN p_brand END AS symbol, p_size % 3 <> 0 AS bad
FROM part WHERE p_type <> 'ECONOMY'""")
def exon_symbol_map(t: Tables) -> DataFrame:
    exon = F.concat(F.col("p_partkey").cast("string"), F.lit("_0"))
    size = F.col("p_size") % 3
    line = F.when(F.col("p_type") == "ECONOMY", "  ").when(size == 0, F.concat(exon, F.lit("\t"), F.char(F.lit(33) + F.col("p_size")))).when(
        size == 1, F.concat(exon, F.lit("\t"), "p_brand")).otherwise(exon)
    return tables.parse_code_map(t.part.select("p_partkey", line.alias("line"))).select("p_partkey", "s_exon_id", "symbol", F.col("issue").isNotNull().alias("bad"))


@QUERIES.add("""SELECT DISTINCT lower(p_brand) || '_gene_ensembl' AS dataset FROM part WHERE p_size % 4 = 0 AND p_type <> 'PROMO'""")
def dataset_registry(t: Tables) -> DataFrame:
    tag = F.when(F.col("p_size") % 4 == 0, "TableSet").otherwise("Other")
    name = F.concat(F.lower("p_brand"), F.when(F.col("p_type") == "PROMO", "_other").otherwise("_gene_ensembl"))
    return tables.parse_dataset_registry(t.part.select(F.concat(F.lit(" "), tag, F.lit("\t "), name, F.lit(" \tx")).alias("line")))


@QUERIES.add("""WITH named AS (SELECT user_id, 0 AS part, event_id AS o, 'nation_' || CAST(event_id % 25 AS VARCHAR) AS s FROM events WHERE event_type = 'error'
  UNION ALL SELECT user_id, 1, event_id, 'mart_' || CAST(event_id % 7 AS VARCHAR) FROM events WHERE event_type = 'view'
  UNION ALL SELECT user_id, 1, event_id, 'nation_' || CAST(event_id % 11 AS VARCHAR) FROM events WHERE event_type = 'click'),
firsts AS (SELECT user_id, s, min(part * 1000000000000 + o) AS k FROM named GROUP BY ALL)
SELECT user_id, string_agg(s, ', ' ORDER BY k) AS species FROM firsts GROUP BY user_id""")
def failure_species(t: Tables) -> DataFrame:
    e, k = F.col("event_type"), F.col("event_id")
    errors = t.events.where(e == "error").select("user_id", k.alias("row_no"), F.concat(F.lit("Nation "), (k % 25).cast("string")).alias("Species"))
    line = F.when(e == "view", F.concat(F.lit("x It can not found Mart_"), (k % 7).cast("string"), F.lit(" in biomart"))).when(
        e == "click", F.concat(F.lit("Download failed for G1 in nation_"), (k % 11).cast("string"), F.lit("!"))).otherwise("fine")
    logs = t.events.select("user_id", k.alias("line_no"), line.alias("line"))
    found = tables.failed_species(errors, logs, "user_id")
    # At most 32 distinct names per user.
    listed = F.array_sort(F.collect_list(F.struct("ord", "species")))
    return found.groupBy("user_id").agg(F.array_join(F.transform(listed, lambda x: x["species"]), ", ").alias("species"))


@QUERIES.add("""SELECT c_custkey, 'P' || CAST(c_custkey AS VARCHAR) AS uniprot_id, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS species,
  CASE WHEN c_nationkey % 2 = 0 THEN upper(c_name) END AS protein_sequence, CAST(CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_xrefs FROM customer""")
def uniprot_records(t: Tables) -> DataFrame:
    """JSON texts with wrong-typed and missing parts."""
    k = F.col("c_custkey").cast("string")
    content = F.concat(
        F.lit('{"primaryAccession":"P'), k, F.lit('"'),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(',"organism":{"scientificName":"'), "c_mktsegment", F.lit('","taxonId":1}'))).otherwise(""),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit(',"sequence":{"value":"'), "c_name", F.lit('"}'))).otherwise(',"sequence":7'),
        F.when(F.col("c_nationkey") % 3 == 0, ',"uniProtKBCrossReferences":[{"database":"Ensembl","id":"T"}]').otherwise(""), F.lit("}"))
    parsed = t.customer.select("c_custkey", records.parse_json(content, records.UNIPROT_SCHEMA).alias("r")).select("c_custkey", "r.*")
    entries = records.uniprot_entries(parsed)
    # The scan keeps its columns in one projection, so the key travels through the accession.
    return entries.select(F.substring("uniprot_id", 2, 20).cast("long").alias("c_custkey"), "uniprot_id", "species", "protein_sequence",
                          F.greatest(F.coalesce(F.size("xrefs"), F.lit(0)), F.lit(0)).alias("n_xrefs"))


@QUERIES.add("""SELECT 'ENST' || CAST(o_orderkey AS VARCHAR) AS transcript_id, CASE WHEN o_orderstatus <> 'P' THEN 'G' || CAST(o_custkey AS VARCHAR) END AS ensembl_gene_id,
  o_orderpriority AS species, o_orderstatus = 'P' AS bad FROM orders""")
def transcript_lookup(t: Tables) -> DataFrame:
    content = F.to_json(F.struct(
        F.concat(F.lit("ENST"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("G"), F.col("o_custkey").cast("string"))).alias("Parent"),
        F.col("o_orderpriority").alias("species")))
    parsed = t.orders.select(records.parse_json(content, records.LOOKUP_SCHEMA).alias("r")).select("r.*")
    return records.transcript_lookup(parsed).select("transcript_id", "ensembl_gene_id", "species", F.col("issue").isNotNull().alias("bad"))


@QUERIES.add("""SELECT '/s/' || CAST(event_id AS VARCHAR) AS state_path, event_type AS stage_key, CASE WHEN value > 50 THEN 'done' ELSE 'failed' END AS status,
  '{"path":"' || CAST(user_id AS VARCHAR) || '"}' AS outputs FROM events WHERE event_id % 5 < 3""")
def stage_manifests(t: Tables) -> DataFrame:
    k = F.col("event_id")
    good = F.concat(F.lit('{"stage_key": "'), "event_type", F.lit('", "status": "'), F.when(F.col("value") > 50, "done").otherwise("failed"),
                    F.lit('", "outputs": {"path": "'), F.col("user_id").cast("string"), F.lit('"}}'))
    content = F.when(k % 5 < 3, good).when(k % 5 == 3, "[1, 2]").otherwise(F.concat(F.lit('{"stage_key": '), "event_type"))
    texts = t.events.select(F.concat(F.lit("/s/"), k.cast("string")).alias("state_path"), content.alias("content"))
    return records.manifests(texts).select("state_path", "stage_key", "status", "outputs")


@QUERIES.add("""WITH u AS (SELECT o_custkey, name, min(o_orderkey) AS k FROM (SELECT *, CASE o_orderkey % 6 WHEN 0 THEN 'sequences.fasta' WHEN 1 THEN 'exonstable.tsv' WHEN 2 THEN 'tree.nh' WHEN 3 THEN 'ensembl_version.csv' WHEN 4 THEN 'tsl.csv' ELSE 'notes.txt' END AS name FROM orders) GROUP BY ALL),
good AS (SELECT * FROM u WHERE name <> 'notes.txt' AND k % 11 <> 0),
s AS (SELECT o_custkey, count(*) AS n, sha256(string_agg(name || chr(10) || CAST(k % 11 AS VARCHAR) || chr(10) || sha256(CAST(k AS VARCHAR)), chr(10) ORDER BY name)) AS fp FROM good GROUP BY o_custkey)
SELECT c.o_custkey AS bundle, coalesce(n, 0) = 5 AS complete, CASE WHEN n = 5 THEN fp END AS fingerprint,
  coalesce((SELECT string_agg(r, ', ' ORDER BY i) FROM (VALUES (1, 'sequences.fasta'), (2, 'exonstable.tsv'), (3, 'tree.nh'), (4, 'ensembl_version.csv'), (5, 'tsl.csv')) q(i, r)
    WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.o_custkey = c.o_custkey AND g.name = r)), '') AS missing
FROM (SELECT DISTINCT o_custkey FROM u) c LEFT JOIN s USING (o_custkey)""")
def bundle_fingerprints(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 6
    name = F.when(k == 5, "notes.txt")
    for i, file in enumerate(bundle.REQUIRED_FILES):
        name = name.when(k == i, file)
    files = t.orders.groupBy(F.col("o_custkey").alias("bundle"), name.alias("name")).agg(F.min("o_orderkey").alias("k")).select(
        "bundle", "name", (F.col("k") % 11).alias("size"), F.sha2(F.col("k").cast("string"), 256).alias("sha256"))
    return bundle.bundle_state(files)


_REPORT = r"""s AS (SELECT doc_id, n_chars, translate(regexp_replace(text, '[^A-Za-z]', '', 'g'), 'zqZQ', '----') AS s FROM documents)"""


def report_lines(t: Tables) -> DataFrame:
    """A report per document: its letters in blocks of 60, vowels marked as identical, z and q as gaps."""
    s = F.translate(F.regexp_replace("text", "[^A-Za-z]", ""), "zqZQ", "----")
    docs = t.documents.select(F.col("doc_id").alias("report_id"), "n_chars", s.alias("s"))
    head = docs.select("report_id", F.lit(1).cast("long").alias("line_no"), F.concat(
        F.lit("Probab="), F.col("n_chars").cast("string"), F.when(F.col("report_id") % 2 == 0, F.concat(
            F.lit("  E-value=1.5e-3  Score="), (F.col("n_chars") / 4).cast("string"), F.lit("  Identities=1"))).otherwise("")).alias("line"))
    # 50 blocks make a chunk: residues are summed over the chunks before it, then inside it, all in the document's own row.
    # Outer, as Spark would else cut every text once more to learn whether it has pieces.
    sizes = lambda found: F.transform(found, lambda x: (F.length(F.replace(x, F.lit("-"), F.lit("")))).cast("long"))
    first = lambda many, n: F.aggregate(F.slice(many, F.lit(1), F.col(n)), F.lit(0).cast("long"), lambda x, y: x + y)
    chunks = docs.select("report_id", F.regexp_extract_all("s", F.lit(".{1,3000}"), F.lit(0)).alias("chunks"))
    cut = chunks.select("report_id", sizes(F.col("chunks")).alias("sizes"), F.posexplode_outer("chunks").alias("k", "chunk")).where("chunk is not null").select(
        "report_id", "k", F.regexp_extract_all("chunk", F.lit(".{1,60}"), F.lit(0)).alias("pieces"), first("sizes", "k").alias("base"))
    blocks = cut.select("report_id", "k", "base", sizes(F.col("pieces")).alias("sizes"), F.posexplode_outer("pieces").alias("j", "piece")).select(
        "report_id", (F.col("k") * 50 + F.col("j")).alias("b"), "piece", (F.col("base") + first("sizes", "j")).alias("before"), F.get("sizes", F.col("j")).alias("own"))
    before, stop = F.col("before"), F.col("before") + F.col("own")
    label = F.format_string("> #%-6d %8d ", F.col("b"), before + 1)
    row = F.concat(label, "piece", F.lit("  "), stop.cast("string"), F.lit(" (99)"))
    marks = F.concat(F.repeat(F.lit(" "), F.length(label)), F.regexp_replace(F.regexp_replace("piece", "[aeiouAEIOU]", "|"), "[^|]", "."))
    lines = F.array(F.lit(""), row, marks, F.lit("T other      1 xxx 3"), F.lit("Confidence   999"))
    body = blocks.select("report_id", "b", F.posexplode(lines).alias("p", "line")).select(
        "report_id", (F.col("b") * 5 + F.col("p") + 2).cast("long").alias("line_no"), "line")
    return head.unionByName(body)


@QUERIES.add(rf"""WITH {_REPORT}
SELECT doc_id AS report_id, CAST(length(s) - length(regexp_replace(s, '[aeiouAEIOU]', '', 'g')) AS BIGINT) AS matched_positions,
  CAST(length(replace(s, '-', '')) AS BIGINT) AS comparable_positions, CAST(n_chars AS DOUBLE) AS probability,
  CASE WHEN doc_id % 2 = 0 THEN CAST(0.0015 AS DOUBLE) END AS e_value, CASE WHEN doc_id % 2 = 0 THEN n_chars / 4.0 END AS hhalign_score, 'ok' AS status FROM s""")
def report_scores(t: Tables) -> DataFrame:
    return scoring.score_reports(report_lines(t)).select(
        "report_id", "matched_positions", "comparable_positions", "probability", "e_value", "hhalign_score", "status")


@QUERIES.add("""SELECT doc_id AS report_id, CASE WHEN doc_id % 2 = 0 THEN n_chars / 4.0 END AS raw_score, CASE WHEN doc_id % 2 = 0 THEN 'ok' ELSE 'error' END AS status FROM documents""")
def profile_scores(t: Tables) -> DataFrame:
    return scoring.score_reports(report_lines(t), "profile").select("report_id", "raw_score", "status")


@QUERIES.add("""SELECT o_custkey AS sample, string_agg('N' || CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS specieslist FROM orders GROUP BY o_custkey""")
def species_list_export(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("sample"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("species"))
    return sinks.specieslist_text(rows, "sample")


def _fresh(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _lines_of(lines: DataFrame) -> DataFrame:
    """The text of each key, its lines in order. A key here is one record or one short file."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("part", "at", "line"))), lambda x: x["line"])
    return lines.groupBy("key").agg(F.array_join(ordered, "\n").alias("text"))


@QUERIES.add(rf"""WITH d AS (SELECT doc_id, upper(regexp_replace({_CLEAN_TEXT}, '[ \t\n\r\f\v]', '', 'g')) AS s FROM documents)
SELECT doc_id, md5('>d' || CAST(doc_id AS VARCHAR) || chr(10) || regexp_replace(s, '(.{{1,60}})', '\1' || chr(10), 'g')) AS record FROM d""")
def fasta_shards(t: Tables) -> DataFrame:
    """All documents as FASTA in packed files, each read back through the index."""
    path, seq = _fresh(t, "fasta"), F.regexp_replace(clean_text(), r"\s", "")
    records = t.documents.select("doc_id", F.lit(0).alias("rec_idx"), F.concat(F.lit("d"), F.col("doc_id")).alias("name"), seq.alias("seq"))
    sinks.write_fasta(records, path, "doc_id", shard_bytes=1 << 22)
    return _lines_of(shards.read_shards(t.spark, path)).select(F.col("key").alias("doc_id"), F.md5("text").alias("record"))


@QUERIES.add("""SELECT conv_id, string_agg('>' || role || CAST(turn AS VARCHAR) || chr(10) || regexp_replace(text, '[^A-Za-z]', '', 'g'), chr(10) ORDER BY turn) AS a3m FROM conversations WHERE conv_id % 3 = 0 GROUP BY conv_id""")
def a3m_shards(t: Tables) -> DataFrame:
    """Conversations as A3M alignments in packed files; every third one is asked for by key."""
    path = _fresh(t, "a3m")
    rows = t.conversations.select("conv_id", F.col("turn").alias("row_idx"), F.concat("role", F.col("turn").cast("string")).alias("name"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"))
    sinks.write_a3m(rows, path, "conv_id", shard_bytes=1 << 18)
    wanted = t.conversations.where("conv_id % 3 = 0").select(F.col("conv_id").alias("key"))
    return _lines_of(shards.read_shards(t.spark, path, wanted)).select(F.col("key").alias("conv_id"), F.col("text").alias("a3m"))


@QUERIES.add("""SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, c_mktsegment || ', "q"' AS note, NULL AS issue FROM customer""")
def table_round_trip(t: Tables) -> DataFrame:
    """Customers written as a delimited table and scanned again; NULL comes back as NULL, quotes as quotes."""
    path = _fresh(t, "table")
    sinks.write_table(t.customer.select("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"), F.concat("c_mktsegment", F.lit(', "q"')).alias("note")), path)
    back = tables.read_table(t.spark, path, "note STRING, c_acctbal DOUBLE, c_name STRING, c_custkey BIGINT")
    return back.select("c_custkey", "c_name", "c_acctbal", "note", "issue")


@QUERIES.add("""SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment, CASE WHEN c_acctbal >= 0 THEN 4 ELSE 3 END AS n_values, 4 AS n_keys FROM customer""")
def json_round_trip(t: Tables) -> DataFrame:
    """Customers written as JSON objects; a NULL field is there, so an absent value differs from an absent field."""
    path = _fresh(t, "json")
    sinks.write_json(t.customer.select("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"), F.lit(1).alias("one")), path)
    back = t.spark.read.text(path).select(F.json_object_keys("value").alias("k"), F.from_json("value", "c_custkey BIGINT, c_name STRING, segment STRING, one INT").alias("r"))
    filled = F.size(F.array_compact(F.array(*[F.col(f"r.{c}").cast("string") for c in ("c_custkey", "c_name", "segment", "one")])))
    return back.select("r.c_custkey", "r.c_name", "r.segment", filled.alias("n_values"), F.size("k").alias("n_keys"))


@QUERIES.add("""SELECT o_custkey % 7 AS source, o_orderkey AS line_no, o_orderkey, CASE WHEN o_orderkey % 11 > 0 THEN o_totalprice END AS o_totalprice, o_orderpriority || ', "x"' AS note, NULL AS absent,
  nullif(concat_ws('; ', CASE WHEN o_orderkey % 13 = 0 AND o_custkey % 7 % 2 = 0 THEN '4 cells under 3 headers' END, CASE WHEN o_orderkey % 11 = 0 THEN 'o_totalprice is no double: n/a' END), '') AS issue
FROM orders""")
def table_scan(t: Tables) -> DataFrame:
    """Seven files, those of odd number with another order of columns; some prices are no numbers, some lines have a cell too many."""
    source, odd = F.col("o_custkey") % 7, F.col("o_custkey") % 7 % 2 == 1
    price = F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    note = F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""x"""'))
    key = F.col("o_orderkey").cast("string")
    extra = F.when(F.col("o_orderkey") % 13 == 0, ",more").otherwise("")
    line = F.when(odd, F.concat_ws(",", note, price, key)).otherwise(F.concat(F.concat_ws(",", key, price, note), extra))
    body = t.orders.select(source.alias("source"), F.col("o_orderkey").alias("line_no"), line.alias("line"))
    header = F.when(F.col("source") % 2 == 1, "note,o_totalprice,o_orderkey").otherwise("o_orderkey,o_totalprice,note")
    heads = body.select("source").distinct().select("source", F.lit(-1).cast("long").alias("line_no"), header.alias("line"))
    return tables.parse_table(heads.unionAll(body), "o_orderkey BIGINT, o_totalprice DOUBLE, note STRING, absent STRING")
