"""Assembly, column, sampling and diversity queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import running_sum
from ..operators import assembly, columns, diversity, sampling, scoring
from .common import Registry, Tables

QUERIES = Registry()
ORACLES = QUERIES.oracles


@QUERIES.add("""WITH p AS (SELECT page_id, string_split(url, '/') AS a FROM pages),
u AS (SELECT page_id, i, list_extract(a, i) AS x FROM p, unnest(range(1, len(a) + 1)) AS r(i))
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS exon_ord, x AS s_exon_id FROM u WHERE x NOT IN ('', 'http:', 'https:')""")
def path_exons(t: Tables) -> DataFrame:
    path = F.concat(F.regexp_replace("url", "^https?:", "start"), F.lit("/stop"))
    return assembly.path_exons(t.pages.select("page_id", path.alias("path")), ["page_id"])


@QUERIES.add("""SELECT o_orderkey AS target_id, CASE WHEN o_orderkey % 5 IN (0, 4) OR o_orderkey % 5 = 3 THEN NULL ELSE 'start/' || CAST(o_orderkey AS VARCHAR) || '_0/stop' END AS path,
  CASE o_orderkey % 5 WHEN 0 THEN 'error' WHEN 3 THEN 'error' WHEN 4 THEN 'error' ELSE 'ok' END AS status FROM orders""")
def transcript_paths(t: Tables) -> DataFrame:
    """Keys 0 mod 5 are named twice, 4 mod 5 never, and 3 mod 5 have an empty path."""
    k, shape = F.col("o_orderkey"), F.col("o_orderkey") % 5
    name = F.concat(F.lit("T"), k.cast("string"))
    path = F.when(shape == 3, "start//stop").otherwise(F.concat(F.lit("start/"), k.cast("string"), F.lit("_0/stop")))
    cluster = F.when(shape == 4, "other").when(shape == 1, F.concat(name, F.lit(".2/"), name, F.lit("/z"))).otherwise(F.concat(F.lit("z/"), name))
    table = t.orders.select(cluster.alias("TranscriptIDCluster"), path.alias("Path"))
    twice = t.orders.where(shape == 0).select(F.concat(name, F.lit(".2")).alias("TranscriptIDCluster"), F.lit("start/9/stop").alias("Path"))
    requests = t.orders.select(k.alias("target_id"), F.concat(name, F.lit(".2")).alias("transcript_id"))
    return assembly.transcript_paths(requests, table.unionByName(twice)).select("target_id", "path", "status")


@QUERIES.add("""WITH s AS (SELECT l_orderkey AS k, l_linenumber AS n, min(CASE l_returnflag WHEN 'R' THEN '' ELSE l_returnflag END) AS a, max(CASE l_returnflag WHEN 'R' THEN '' ELSE l_returnflag END) AS b FROM lineitem GROUP BY ALL)
SELECT k AS target_id, '0_' || CAST(n AS VARCHAR) AS s_exon_id, CASE WHEN a = b THEN a END AS seq, CASE WHEN a = b THEN 'ok' ELSE 'error' END AS status FROM s
UNION ALL SELECT o_orderkey, '0_99', NULL, 'error' FROM orders""")
def query_only_exons(t: Tables) -> DataFrame:
    key = F.col("l_orderkey")
    exon = F.concat(F.lit("0_"), F.col("l_linenumber").cast("string"))
    seq = F.when(F.col("l_returnflag") == "R", " * ").otherwise(F.concat("l_returnflag", F.lit("*")))
    table = t.lineitem.select(
        key.alias("target_id"), F.concat(F.lit("G"), key.cast("string"), F.lit(".3")).alias("GeneID"),
        F.concat(F.lit("T"), key.cast("string"), F.lit("/U")).alias("TranscriptIDCluster"), exon.alias("S_exonID"), seq.alias("S_exon_Sequence"))
    asked = t.lineitem.select(key.alias("target_id"), exon.alias("s_exon_id")).unionByName(
        t.orders.select(F.col("o_orderkey").alias("target_id"), F.lit("0_99").alias("s_exon_id"))).distinct()
    wanted = asked.select("*", F.concat(F.lit("G"), F.col("target_id").cast("string")).alias("gene_id"),
                          F.concat(F.lit("T"), F.col("target_id").cast("string"), F.lit(".1")).alias("transcript_id"))
    return assembly.query_only_sequences(wanted, table).drop("issue")


_SEGMENTS = """seg AS (SELECT l_orderkey AS k, l_linenumber AS n, 'S' || CAST(l_suppkey % 3 AS VARCHAR) AS name, min(l_suppkey) AS r,
  min(repeat(l_returnflag, l_linenumber)) AS s FROM lineitem GROUP BY ALL)"""


def order_segments(t: Tables) -> DataFrame:
    """Order = transcript, line = segment, supplier class = row."""
    return t.lineitem.groupBy(
        F.col("l_orderkey").alias("target_id"), F.col("l_linenumber").alias("exon_ord"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 3).cast("string")).alias("name")).agg(
        F.min("l_suppkey").alias("row_idx"), F.min(F.expr("repeat(l_returnflag, l_linenumber)")).alias("seq"))


@QUERIES.add(f"""WITH {_SEGMENTS},
names AS (SELECT k, name, min(n * 1000000000000 + r) AS f, min(n) AS n0 FROM seg GROUP BY ALL),
cells AS (SELECT names.k, names.name, w.n, coalesce(seg.s, repeat('-', w.n)) AS s FROM names JOIN (SELECT DISTINCT k, n FROM seg) w ON w.k = names.k
  LEFT JOIN seg ON seg.k = names.k AND seg.name = names.name AND seg.n = w.n),
built AS (SELECT k, name, string_agg(s, '' ORDER BY n) AS seq FROM cells GROUP BY ALL),
link AS (SELECT seg.k, seg.n, bool_or(n0 < seg.n) AS l FROM seg JOIN names USING (k, name) GROUP BY ALL),
bad AS (SELECT DISTINCT k FROM link WHERE NOT l AND n > (SELECT min(n) FROM seg s2 WHERE s2.k = link.k))
SELECT k AS target_id, row_number() OVER (PARTITION BY k ORDER BY f, name) AS row_idx, name, seq, CASE WHEN k IN (SELECT k FROM bad) THEN 'error' ELSE 'ok' END AS status FROM built JOIN names USING (k, name)""")
def segment_concat(t: Tables) -> DataFrame:
    rows, report = assembly.assemble(order_segments(t))
    return rows.join(report.drop("issue"), "target_id").select("target_id", "row_idx", "name", "seq", "status")


@QUERIES.add("""WITH e AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_linenumber <= 2 THEN '0_' ELSE '1_' END || CAST(min(l_partkey) AS VARCHAR) AS x FROM lineitem GROUP BY l_orderkey, l_linenumber),
alpha AS (SELECT list_filter(list_transform(range(33, 127), lambda c: chr(CAST(c AS INTEGER))), lambda c: NOT list_contains(string_split('\\ * > " , - _ / ; # $ . & ! @ [ ]', ' '), c) AND c <> chr(39)) AS a),
given AS (SELECT k, chr(CAST(34 + n AS INTEGER)) AS code, x FROM e WHERE n >= 3 AND n <> 4),
need AS (SELECT k, x, row_number() OVER (PARTITION BY k ORDER BY min(n)) AS i FROM e WHERE x LIKE '0\\_%' ESCAPE '\\' GROUP BY k, x),
used AS (SELECT k, list(code) AS u FROM given GROUP BY k)
SELECT k AS target_id, code, x AS s_exon_id FROM given
UNION ALL SELECT k, list_extract(list_filter(a, lambda c: NOT coalesce(list_contains(u, c), false)), i), x FROM need CROSS JOIN alpha LEFT JOIN used USING (k)""")
def code_map_complete(t: Tables) -> DataFrame:
    """Lines 1 and 2 are query-only exons; line 4 lacks a symbol, which is an issue for its order."""
    exons = t.lineitem.groupBy(F.col("l_orderkey").alias("target_id"), F.col("l_linenumber").alias("exon_ord")).agg(F.min("l_partkey").alias("p")).select(
        "target_id", "exon_ord", F.concat(F.when(F.col("exon_ord") <= 2, "0_").otherwise("1_"), F.col("p").cast("string")).alias("s_exon_id"))
    given = exons.where("exon_ord >= 3 and exon_ord <> 4").select("target_id", F.char(F.col("exon_ord") + 34).alias("code"), "s_exon_id")
    full, _ = assembly.complete_code_map(given, exons)
    return full


_REFS = """ref AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE min(l_returnflag) WHEN 'A' THEN 'AC-D' WHEN 'N' THEN 'A.-C' ELSE 'AAA' END AS s FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


@QUERIES.add(f"""WITH {_REFS},
cell AS (SELECT k, n, i, substr(s, CAST(i AS INTEGER), 1) AS c FROM ref, unnest(range(1, length(s) + 1)) AS r(i))
SELECT k AS target_id, row_number() OVER (PARTITION BY k ORDER BY n, i) AS col_idx, CASE c WHEN '.' THEN '.' ELSE chr(CAST(96 + n AS INTEGER)) END AS code,
  CASE k % 4 WHEN 0 THEN 'shorter' WHEN 1 THEN 'longer' WHEN 2 THEN 'mismatch' ELSE 'ok' END AS verdict FROM cell""")
def exon_symbols(t: Tables) -> DataFrame:
    """Column codes per order; the transcript symbols are cut, extended or shuffled for three of four orders."""
    flag = F.min("l_returnflag")
    # Seven lines per order at most, so all steps share one shuffle of the lines by order.
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").repartition("l_orderkey")
    refs = lines.groupBy(F.col("l_orderkey").alias("target_id"), F.col("l_linenumber").alias("exon_ord")).agg(
        F.when(flag == "A", "AC-D").when(flag == "N", "A.-C").otherwise("AAA").alias("seq")).select(
        "target_id", "exon_ord", F.concat(F.lit("E"), F.col("exon_ord").cast("string")).alias("s_exon_id"), "seq")
    code = F.char(F.col("exon_ord") + 96)
    piece = F.expr("repeat(char(exon_ord + 96), length(translate(seq, '-.', '')))")
    listed = F.array_sort(F.collect_list(F.struct("exon_ord", piece.alias("s"))))
    whole = refs.groupBy("target_id").agg(F.array_join(F.transform(listed, lambda x: x["s"]), "").alias("s"))
    shape = F.col("target_id") % 4
    symbols = whole.select("target_id", F.when(shape == 0, F.expr("left(s, length(s) - 1)")).when(shape == 1, F.concat("s", F.lit("z"))).when(
        shape == 2, F.concat(F.lit("@"), F.expr("substring(s, 2)"))).otherwise(F.col("s")).alias("symbols"))
    base_map = refs.select("target_id", code.alias("code"), "s_exon_id")
    foreign = whole.where(shape == 2).select("target_id", F.lit("@").alias("code"), F.lit("other").alias("s_exon_id"))
    codes, report = assembly.project_symbols(refs, symbols, base_map.unionByName(foreign))
    issue = F.col("issue")
    verdict = F.when(issue.contains("fewer"), "shorter").when(issue.contains("more"), "longer").when(issue.contains("another exon"), "mismatch").otherwise("ok")
    return codes.join(report.select("target_id", verdict.alias("verdict")), "target_id")


@QUERIES.add("""SELECT l_partkey, max_by('nation_' || CAST(s_nationkey AS VARCHAR), (l_orderkey, l_linenumber, l_suppkey)) AS species
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag <> 'A' GROUP BY l_partkey
UNION ALL SELECT DISTINCT l_partkey, 'unknown' FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag <> 'A')""")
def row_species(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.lit("m").alias("target_id"), F.col("l_partkey").cast("string").alias("name")).distinct()
    table = t.lineitem.where("l_returnflag <> 'A'").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").cast("string").alias("GeneID"), F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("Species"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("row_no"))
    return assembly.species_of_rows(rows, table).select(F.col("name").cast("long").alias("l_partkey"), "species")


def event_columns(t: Tables) -> DataFrame:
    """User = alignment, event order = columns, event type = code (``error`` is ``.``); views are insert columns."""
    e = F.col("event_type")
    cols = running_sum(t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id", F.lit(1), "col_idx")
    return cols.select(
        "user_id", "col_idx", F.when(e == "error", ".").otherwise(F.substring(e, 1, 1)).alias("code"),
        F.when(e == "view", ".").otherwise("x").alias("rf"), F.lit(None).cast("string").alias("aligned"))


_COLS = """c AS (SELECT user_id AS m, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, event_type, CASE event_type WHEN 'error' THEN '.' ELSE substr(event_type, 1, 1) END AS code FROM events)"""


@QUERIES.add(f"""WITH {_COLS}, g AS (SELECT *, i - row_number() OVER (PARTITION BY m, code ORDER BY i) AS grp FROM c)
SELECT m AS user_id, 'seed' AS alignment, CAST(10.0 AS DOUBLE) AS pid, code, CASE code WHEN 's' THEN '' ELSE 'exon_' || code END AS s_exon_id,
  min(i) AS start_col, max(i) AS end_col, count(*) AS n_columns FROM g WHERE code <> '.' GROUP BY m, code, grp""")
def column_blocks(t: Tables) -> DataFrame:
    cols = event_columns(t).withColumn("pid", F.lit(10.0))
    code_map = t.events.where("event_type not in ('error', 'signup')").select(
        "user_id", F.substring("event_type", 1, 1).alias("code")).distinct().withColumn("s_exon_id", F.concat(F.lit("exon_"), "code"))
    return columns.block_table(cols, code_map, "user_id", "seed")


@QUERIES.add(f"""WITH {_COLS}, k AS (SELECT *, event_type <> 'view' AS is_match, CASE WHEN event_type <> 'view' THEN count(*) FILTER (event_type <> 'view') OVER (PARTITION BY m ORDER BY i) END AS r FROM c),
s AS (SELECT m, row_number() OVER (PARTITION BY m ORDER BY i) AS r, code FROM c WHERE event_type <> 'click' AND event_type <> 'signup')
SELECT k.m AS user_id, k.i AS col_idx, k.is_match, coalesce(s.code, '.') AS code FROM k LEFT JOIN s ON s.m = k.m AND s.r = k.r""")
def code_project(t: Tables) -> DataFrame:
    """Seed: the same stream with ``Aligned`` 0 at clicks and signups; target: match columns are all but views."""
    cols = event_columns(t)
    seed = cols.withColumn("aligned", F.when(F.col("code").isin("c", "s"), "0").otherwise("1"))
    codes = columns.seed_match_codes(seed, ["user_id"])
    return columns.project_codes(cols, codes, ["user_id"]).select("user_id", "col_idx", "is_match", "code")


@QUERIES.add(f"""WITH {_COLS}, k AS (SELECT *, count(*) FILTER (event_type <> 'view') OVER (PARTITION BY m ORDER BY i) AS r FROM c),
both_ AS (SELECT 'expanded_full' AS a, m, i, CASE event_type WHEN 'view' THEN '.' ELSE code END AS code FROM k
  UNION ALL SELECT 'expanded_match', m, r, code FROM k WHERE event_type <> 'view'),
g AS (SELECT *, i - row_number() OVER (PARTITION BY a, m, code ORDER BY i) AS grp FROM both_)
SELECT m AS user_id, a AS alignment, code, min(i) AS start_col, max(i) AS end_col FROM g WHERE code <> '.' GROUP BY a, m, code, grp""")
def expanded_blocks(t: Tables) -> DataFrame:
    """Blocks of the full and the match-only alignment of each seed in one table."""
    cols = event_columns(t).withColumn("pid", F.lit(30.0))
    codes = columns.seed_match_codes(cols, ["user_id", "pid"])
    full = columns.project_codes(cols, codes, ["user_id", "pid"])
    parts = {"expanded_match": columns.match_columns(full, ["user_id", "pid"]), "expanded_full": full}
    code_map = cols.select("user_id", "code").distinct().withColumn("s_exon_id", F.col("code"))
    return columns.block_tables(parts, code_map, "user_id").select("user_id", "alignment", "code", "start_col", "end_col")


@QUERIES.add("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value > 50 WHEN event_id % 3 = 1 THEN event_type NOT IN ('view', 'error') ELSE event_type = 'click' END AS is_match,
  CASE WHEN event_type = 'signup' THEN '.' ELSE substr(event_type, 1, 1) END AS code FROM events""")
def match_states(t: Tables) -> DataFrame:
    e, k = F.col("event_type"), F.col("event_id") % 3
    cols = t.events.select(
        "event_id", F.when(k == 0, F.when(F.col("value") > 50, "1").otherwise("0")).alias("aligned"),
        F.when(k == 1, F.when(e == "view", ".").when(e == "error", "-").otherwise("x")).alias("rf"),
        F.when(e != "signup", F.substring(e, 1, 1)).alias("code"), e.alias("e"))
    picked = columns.exon_codes(cols)
    default = F.when(F.col("e") == "click", columns.match_state(True)).otherwise(columns.match_state(False))
    return picked.select("event_id", default.alias("is_match"), "code")


@QUERIES.add("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'codes' WHEN doc_id % 4 = 1 THEN 'rf' WHEN doc_id % 4 = 2 THEN 'aligned' ELSE 'ok' END AS verdict FROM documents""")
def annotation_checks(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 4
    ones = F.expr("repeat('1', char_length(text))")
    notes = t.documents.select(
        "doc_id", F.length("text").alias("ncol"), F.when(k == 0, F.concat("text", F.lit("x"))).when(k == 1, F.col("text")).alias("codes"),
        F.when(k == 1, F.concat("text", F.lit("."))).otherwise(F.col("text")).alias("rf"),
        F.when(k == 2, F.concat(F.lit("2"), F.expr("substring(repeat('1', char_length(text)), 2)"))).when(k == 3, ones).alias("aligned"))
    report = columns.column_issues(notes, "doc_id")
    issue = F.col("issue")
    return report.select("doc_id", F.when(issue.startswith("SExonCode"), "codes").when(issue.startswith("RF"), "rf").when(
        issue.startswith("Aligned"), "aligned").otherwise("ok").alias("verdict"))


def order_species(t: Tables) -> DataFrame:
    """Segment = target, month = candidate, nation = species, order = row."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat("c_mktsegment", F.year("o_orderdate").cast("string")).alias("target_id"), F.month("o_orderdate").alias("pid_order"),
        F.col("o_orderkey").alias("row_idx"), F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("species"))


@QUERIES.add("""WITH r AS (SELECT c_mktsegment || CAST(year(o_orderdate) AS VARCHAR) AS t, month(o_orderdate) AS m, 'nation_' || CAST(c_nationkey AS VARCHAR) AS s, o_orderkey AS k FROM orders JOIN customer ON c_custkey = o_custkey WHERE month(o_orderdate) % 4 = 1),
n AS (SELECT t, count(DISTINCT m) AS n, min(m) AS f FROM r GROUP BY t)
SELECT r.t AS target_id, r.s AS species, min(k) FILTER (r.m = f) AS ord FROM r JOIN n USING (t) GROUP BY r.t, r.s, n.n HAVING count(DISTINCT r.m) = n.n""")
def common_universe(t: Tables) -> DataFrame:
    rows = order_species(t)
    candidates = rows.select("target_id", "pid_order", (F.col("pid_order") % 4 == 1).alias("eligible")).distinct()
    species = sampling.candidate_species(rows, ["target_id", "pid_order"])
    return sampling.common_universe(species, candidates).select("target_id", "species", "ord")


@QUERIES.add("""SELECT c_mktsegment AS target_id, count(DISTINCT c_nationkey) AS n_species, CASE WHEN count(*) FILTER (c_nationkey = 7) = 0 THEN 'error' WHEN count(DISTINCT c_nationkey) <= 6 THEN 'warn' ELSE 'ok' END AS status FROM customer GROUP BY c_mktsegment""")
def universe_report(t: Tables) -> DataFrame:
    universe = t.customer.select(F.col("c_mktsegment").alias("target_id"), F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("species")).distinct()
    references = t.customer.select(F.col("c_mktsegment").alias("target_id")).distinct().withColumn("species", F.lit("nation_7"))
    return sampling.universe_report(universe, references, "common").select("target_id", "n_species", "status")


_DRAWS = """ref AS (SELECT c_nationkey AS n, min(c_custkey) AS r, count(*) - 1 AS others FROM customer GROUP BY c_nationkey),
ranked AS (SELECT c_nationkey AS n, s AS i, c_custkey AS c, row_number() OVER (PARTITION BY c_nationkey, s ORDER BY md5('7|' || CAST(s AS VARCHAR) || '|' || CAST(c_custkey AS VARCHAR)), c_custkey) AS d
  FROM customer JOIN ref ON n = c_nationkey AND c_custkey <> r, range(1, 11) AS g(s)),
draws AS (SELECT n, i, d, c FROM ranked JOIN ref USING (n) WHERE d <= greatest(1, least(others, CAST(round_even(0.8 * others, 0) AS BIGINT)))
  UNION ALL SELECT n, s, 0, r FROM ref, range(1, 11) AS g(s))"""


def nation_samples(t: Tables) -> DataFrame:
    first = t.customer.groupBy("c_nationkey").agg(F.min("c_custkey").alias("r"))
    members = t.customer.join(first, "c_nationkey").select("c_nationkey", "c_custkey", (F.col("c_custkey") == F.col("r")).alias("is_ref"))
    return sampling.draw_samples(members, ["c_nationkey"], "c_custkey", F.col("is_ref"), 10, 0.8, 7)


@QUERIES.add(f"""WITH {_DRAWS} SELECT n AS c_nationkey, CAST(i AS INTEGER) AS sample, 'subset_' || CASE WHEN i < 1000 THEN lpad(CAST(i AS VARCHAR), 3, '0') ELSE CAST(i AS VARCHAR) END AS sample_label, d AS draw, c AS c_custkey FROM draws""")
def subsample(t: Tables) -> DataFrame:
    return nation_samples(t)


@QUERIES.add(f"""WITH {_DRAWS}, cand AS (SELECT c_nationkey AS n, c_mktsegment AS g FROM customer GROUP BY ALL HAVING c_mktsegment <> 'BUILDING')
SELECT draws.n AS c_nationkey, g AS segment, CAST(i AS INTEGER) AS sample, count(*) AS n_rows, sum(length(replace(c_name, '-', ''))) AS n_residues
FROM draws JOIN cand USING (n) JOIN customer ON c_custkey = c GROUP BY ALL""")
def shared_sample_rows(t: Tables) -> DataFrame:
    """One draw per nation, linked to every eligible segment and filled with ungapped sequences."""
    candidates = t.customer.select("c_nationkey", F.col("c_mktsegment").alias("segment"), (F.col("c_mktsegment") != "BUILDING").alias("eligible")).distinct()
    linked = sampling.link_samples(nation_samples(t), candidates, "c_nationkey", "segment")
    rows = t.customer.select("c_nationkey", "c_custkey", F.col("c_name").alias("name"), F.col("c_name").alias("seq"))
    filled = sampling.materialise_samples(linked, rows, ["c_nationkey"], "c_custkey")
    return filled.groupBy("c_nationkey", "segment", "sample").agg(F.count("*").alias("n_rows"), F.sum(F.length("seq")).alias("n_residues"))


def sign_rows(t: Tables) -> DataFrame:
    """Label = alignment, vector = row, sign letter = residue; small components are gaps."""
    letter = lambda x: F.when(F.abs(x) < 0.01, "-").when(x > 0, "A").otherwise("C")
    return t.embeddings.select(F.col("label").alias("msa_id"), F.col("vec_id").alias("row_idx"), F.array_join(F.transform("embedding", letter), "").alias("seq"))


_SIGNS = """s AS (SELECT label AS m, vec_id AS r, array_to_string(list_transform(embedding, lambda x: CASE WHEN abs(x) < CAST(0.01 AS FLOAT) THEN '-' WHEN x > 0 THEN 'A' ELSE 'C' END), '') AS q FROM embeddings)"""
_PAIRS = f"""{_SIGNS}, u AS (SELECT m, r, i, substr(q, CAST(i AS INTEGER), 1) AS c FROM s, range(1, 65) AS g(i)),
pairs AS (SELECT a.m, a.r AS ra, b.r AS rb, 100.0 * count(*) FILTER (a.c = b.c AND a.c <> '-') / nullif(count(*) FILTER (a.c <> '-' OR b.c <> '-'), 0) AS pid
  FROM u a JOIN u b ON a.m = b.m AND a.i = b.i AND a.r <> b.r GROUP BY a.m, a.r, b.r)"""


@QUERIES.add(f"WITH {_SIGNS} SELECT m AS msa_id, count(*) AS nseq, max(length(q)) AS ncol, 'ok' AS status FROM s GROUP BY m")
def msa_size(t: Tables) -> DataFrame:
    return diversity.msa_size(sign_rows(t)).drop("issue")


@QUERIES.add(f"""WITH {_PAIRS}, d AS (SELECT m, ra, count(*) AS n FROM pairs WHERE pid >= 55 GROUP BY m, ra)
SELECT s.m AS msa_id, round(sum(1.0 / (1 + coalesce(n, 0))), 6) AS neff FROM s LEFT JOIN d ON d.m = s.m AND d.ra = s.r GROUP BY s.m""")
def neff(t: Tables) -> DataFrame:
    return diversity.effective_count(sign_rows(t), threshold=55.0).select("msa_id", F.round("neff", 6).alias("neff"))


@QUERIES.add(f"""WITH RECURSIVE {_PAIRS},
ix AS (SELECT s.m, s.r, row_number() OVER (PARTITION BY s.m ORDER BY s.r) AS i FROM s),
nb AS (SELECT ix.m, ix.i, coalesce(list(rb) FILTER (pid >= 50 AND rb < ra), []) AS l, any_value(ix.r) AS r FROM ix JOIN pairs ON pairs.m = ix.m AND ra = ix.r GROUP BY ix.m, ix.i),
lead AS (SELECT m, i, [r] AS heads FROM nb WHERE i = 1
  UNION ALL SELECT nb.m, nb.i, CASE WHEN len(list_intersect(nb.l, lead.heads)) = 0 THEN list_append(lead.heads, nb.r) ELSE lead.heads END FROM lead JOIN nb ON nb.m = lead.m AND nb.i = lead.i + 1)
SELECT m AS msa_id, CAST(max(len(heads)) AS BIGINT) AS n_clusters FROM lead GROUP BY m""")
def hobohm_clusters(t: Tables) -> DataFrame:
    return diversity.hobohm_clusters(sign_rows(t), threshold=50.0)


@QUERIES.add(f"""WITH {_SIGNS},
ref AS (SELECT m, min(r) AS f, count(*) - 1 AS others FROM s GROUP BY m),
ranked AS (SELECT s.m, g.i, s.r, row_number() OVER (PARTITION BY s.m, g.i ORDER BY md5('3|' || CAST(g.i AS VARCHAR) || '|' || CAST(s.r AS VARCHAR)), s.r) AS d FROM s JOIN ref ON ref.m = s.m AND s.r <> f, range(1, 6) AS g(i)),
draws AS (SELECT m, i, r FROM ranked JOIN ref USING (m) WHERE d <= greatest(1, least(others, CAST(round_even(0.5 * others, 0) AS BIGINT))) UNION ALL SELECT m, g.i, f FROM ref, range(1, 6) AS g(i)),
u AS (SELECT m, r, p, substr(q, CAST(p AS INTEGER), 1) AS c FROM s, range(1, 65) AS h(p)),
fc AS (SELECT m, p, c, row_number() OVER (PARTITION BY m, p ORDER BY count(*) DESC, c) AS k FROM u WHERE c <> '-' GROUP BY m, p, c),
sc AS (SELECT d.m, d.i, p, c, row_number() OVER (PARTITION BY d.m, d.i, p ORDER BY count(*) DESC, c) AS k FROM draws d JOIN u ON u.m = d.m AND u.r = d.r WHERE c <> '-' GROUP BY d.m, d.i, p, c),
cmp AS (SELECT sc.m, sc.i, count(*) FILTER (sc.c = fc.c) AS matched FROM sc JOIN fc ON fc.m = sc.m AND fc.p = sc.p AND fc.k = 1 WHERE sc.k = 1 GROUP BY ALL),
n AS (SELECT m, count(*) AS comparable FROM fc WHERE k = 1 GROUP BY m)
SELECT m AS msa_id, CAST(i AS INTEGER) AS sample, matched AS matched_positions, comparable AS comparable_positions FROM cmp JOIN n USING (m)""")
def consensus_scores(t: Tables) -> DataFrame:
    rows = sign_rows(t)
    first = rows.groupBy("msa_id").agg(F.min("row_idx").alias("f"))
    members = rows.join(first, "msa_id").select("msa_id", "row_idx", (F.col("row_idx") == F.col("f")).alias("is_ref"))
    samples = sampling.draw_samples(members, ["msa_id"], "row_idx", F.col("is_ref"), 5, 0.5, 3)
    raw = scoring.consensus_score(rows, samples.join(rows, ["msa_id", "row_idx"]), ["msa_id"], ["msa_id", "sample"])
    return raw.select("msa_id", "sample", "matched_positions", "comparable_positions")


@QUERIES.add(f"""WITH {_SIGNS}, f AS (SELECT m, arg_min(q, r) AS f FROM s GROUP BY m)
SELECT m AS msa_id, r AS row_idx, array_to_string(list_filter(list_transform(range(1, 65), lambda i: CASE WHEN substr(f, CAST(i AS INTEGER), 1) <> '-' THEN substr(q, CAST(i AS INTEGER), 1) END), lambda c: c IS NOT NULL), '') AS seq
FROM s JOIN f USING (m)""")
def match_only_rows(t: Tables) -> DataFrame:
    """Rows of each alignment reduced to the columns where its first row has a residue."""
    rows = sign_rows(t)
    first = rows.groupBy("msa_id").agg(F.min_by("seq", "row_idx").alias("f"))
    cols = first.select("msa_id", F.posexplode(F.split("f", "")).alias("p", "c")).select(
        "msa_id", (F.col("p") + 1).cast("long").alias("col_idx"), (F.col("c") != "-").alias("is_match"))
    return columns.match_only_rows(rows, cols)
