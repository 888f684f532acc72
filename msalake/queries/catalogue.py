"""Run catalogue queries: audit, stage keys, roll-ups, loading and assembly of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import catalogue
from ..plans import jobs
from ..sources import json as records
from ..sources import runs as run_files
from .alignment import _SIGNS, sign_rows
from .common import Registry, Tables

QUERIES = Registry()
ORACLES = QUERIES.oracles


@QUERIES.add("""WITH last AS (SELECT user_id, event_type, arg_max(value, event_id) AS v, max(event_id) AS k FROM events GROUP BY ALL),
kinds AS (SELECT DISTINCT event_type AS e FROM events), x AS (SELECT u.user_id, e, v, k FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN kinds LEFT JOIN last l ON l.user_id = u.user_id AND event_type = e),
s AS (SELECT *, k IS NOT NULL AND k % 7 <> 6 AS has, user_id % 2 = 0 OR e <> 'click' AS there FROM x)
SELECT user_id, e AS stage, CASE WHEN NOT has AND there THEN 'stale' WHEN NOT has AND user_id % 3 = 0 THEN 'unfinished' WHEN NOT has THEN 'missing'
  WHEN k % 7 = 0 THEN 'stale' WHEN k % 7 = 1 THEN 'unfinished' WHEN k % 7 = 2 THEN 'failed' WHEN v < 20 THEN 'stale' WHEN NOT there THEN 'unfinished' ELSE 'reusable' END AS state FROM s""")
def stage_audit(t: Tables) -> DataFrame:
    """Latest event per user and type as a manifest; clicks of odd users have lost their output."""
    # The stages are the event types there are, a short vocabulary that becomes a literal.
    kinds = sorted(r[0] for r in t.events.where("event_type is not null").select("event_type").distinct().collect())
    expected = t.events.select("user_id").distinct().select("user_id", F.explode(F.array(*map(F.lit, kinds)).cast("array<string>")).alias("stage")).select(
        "user_id", "stage", F.lit("h").alias("identity_hash"), (F.col("user_id") % 3 == 0).alias("dir_exists"))
    latest = t.events.groupBy("user_id", F.col("event_type").alias("stage")).agg(F.max("event_id").alias("k"), F.max_by("value", "event_id").alias("v"))
    k = F.col("k") % 7
    states = latest.where(k != 6).select(
        "user_id", "stage", F.when(k == 1, "running").when(k == 2, "failed").otherwise("done").alias("status"),
        F.when(F.col("v") < 20, "other").otherwise("h").alias("identity_hash"), (k != 0).alias("readable"))
    path = F.concat(F.lit("/"), F.col("user_id").cast("string"), F.lit("/"), "stage")
    outputs = expected.select("user_id", "stage", path.alias("path"))
    files = expected.where("user_id % 2 = 0 or stage <> 'click'").select(path.alias("path"))
    return catalogue.audit_stages(expected, states, outputs, files, ["user_id", "stage"]).select("user_id", "stage", "state")


def order_runs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Order = run, line number = seed."""
    status = F.col("o_orderstatus")
    runs = t.orders.select(
        F.col("o_orderkey").alias("run"), F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("gene_id"), F.lit("T").alias("transcript_id"),
        (status != "P").alias("has_target"), (status == "F").alias("has_msa"), F.lit(2).alias("n_expansions"), F.lit(1).alias("n_validations"),
        F.when(F.col("o_orderpriority") == "5-LOW", "msa_expansion").when(F.col("o_orderpriority") == "1-URGENT", "validation").alias("failed_stage"))
    seeds = t.lineitem.groupBy(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("seed_index")).agg(
        F.max("l_quantity").alias("pid"), F.count("*").alias("n"), F.max("l_returnflag").alias("flag"))
    return runs, seeds


@QUERIES.add("""WITH s AS (SELECT l_orderkey AS run, l_linenumber AS i, 'pid_' || printf('%.2f', max(l_quantity)) AS p FROM lineitem GROUP BY ALL),
r AS (SELECT o_orderkey AS run, 'G' || CAST(o_custkey AS VARCHAR) AS g, o_orderstatus AS st, CASE o_orderpriority WHEN '5-LOW' THEN 3 ELSE 2 END AS ne, CASE o_orderpriority WHEN '1-URGENT' THEN 2 ELSE 1 END AS nv FROM orders)
SELECT run, 'target' AS stage_key FROM r UNION SELECT run, unnest(['input', 'msa']) FROM r WHERE st <> 'P' UNION SELECT run, 'result' FROM r
UNION SELECT run, 'expansion:' || g || ':T:' || p FROM r JOIN s USING (run) WHERE st = 'F' AND i <= ne UNION SELECT run, 'validation:' || p FROM r JOIN s USING (run) WHERE st = 'F' AND i <= nv""")
def stage_keys(t: Tables) -> DataFrame:
    runs, seeds = order_runs(t)
    return catalogue.stage_keys(runs, seeds, include_result=True).select("run", "stage_key")


@QUERIES.add("""WITH s AS (SELECT l_orderkey AS run, l_linenumber AS i, max(l_quantity) AS pid, count(*) AS n, max(l_returnflag) AS f FROM lineitem GROUP BY ALL),
a AS (SELECT run, count(*) AS n_seeds, string_agg(printf('%.1f', pid) || CASE WHEN i % 2 = 1 THEN ' (' || CAST(n AS VARCHAR) || ', 9)' ELSE '' END, ', ' ORDER BY i) AS pid_text,
  count(*) FILTER (f = 'A') AS eo, count(*) FILTER (f = 'N') AS ew, count(*) FILTER (f = 'R') AS em, sum(CASE WHEN f <> 'R' THEN n ELSE 0 END) AS hits,
  count(*) FILTER (i % 2 = 1) AS nv, count(*) FILTER (i % 2 = 1 AND f = 'A') AS vo, count(*) FILTER (i % 2 = 1 AND f <> 'A') AS vu FROM s GROUP BY run)
SELECT o_orderkey AS run, coalesce(n_seeds, 0) AS n_seeds, pid_text, coalesce(eo, 0) AS expansions_ok, coalesce(ew, 0) AS expansions_warn, coalesce(em, 0) AS expansions_missing, coalesce(CAST(hits AS BIGINT), 0) AS expansions_hits,
  coalesce(nv, 0) AS n_validations, coalesce(vo, 0) AS validations_ok, coalesce(vu, 0) AS validations_unknown, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS stages_failed, CASE o_orderpriority WHEN '5-LOW' THEN 1 ELSE 0 END AS n_warnings
FROM orders LEFT JOIN a ON run = o_orderkey""")
def status_rollup(t: Tables) -> DataFrame:
    _, seeds = order_runs(t)
    flag = F.col("flag")
    runs = t.orders.select(F.col("o_orderkey").alias("run"), F.when(F.col("o_orderpriority") == "5-LOW", F.array(F.lit("late"))).otherwise(
        F.array().cast("array<string>")).alias("warnings"))
    expansions = seeds.select("run", (flag != "R").alias("present"), F.when(flag == "A", "DONE").when(flag == "N", "warnings").alias("status"), F.col("n").alias("n_hits"))
    validations = seeds.where("seed_index % 2 = 1").select("run", "seed_index", F.when(flag == "A", "ok").otherwise("odd").alias("status"),
                                                          F.col("n").alias("seed_nseq"), F.lit(9).cast("long").alias("seed_ncol"))
    stages = t.orders.select(F.col("o_orderkey").alias("run"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("done").alias("status"))
    return catalogue.status_rollup(runs, seeds.select("run", "seed_index", "pid"), expansions, validations, stages).select(
        "run", "n_seeds", "pid_text", "expansions_ok", "expansions_warn", "expansions_missing", "expansions_hits", "n_validations", "validations_ok",
        "validations_unknown", "stages_failed", "n_warnings")


def conversation_records(t: Tables, uncounted: bool = False) -> DataFrame:
    """Conversation = run: user turns are seeds, other turns are expansion slots, some of them damaged; with ``uncounted``
    some slots name a hits file in place of counts."""
    seed = F.when(F.col("role") == "user", F.struct("turn", F.to_json(F.struct(
        (F.col("turn") * 10).cast("double").alias("pid"), F.concat(F.lit("s/"), F.col("turn").cast("string"), F.lit(".sto")).alias("stockholm_path"))).alias("j")))
    n = F.length("text")
    counted = F.concat(F.lit('{"n_hits":'), n.cast("string"), F.lit(',"status":"ok","match_stockholm":"/abs/m.sto"}'))
    listed = F.concat(F.lit('{"status":"ok","seed_fasta":null,"hits_fasta":"h/'), F.col("turn").cast("string"), F.lit('.fasta"}'))
    slot_text = F.when(n % 5 == 0, "null").when(n % 5 == 1, "[1]").otherwise(F.when((n % 5 == 3) & F.lit(uncounted), listed).otherwise(counted))
    slot = F.when(F.col("role") != "user", F.struct("turn", slot_text.alias("j")))
    check = F.when(F.col("role") == "assistant", F.struct("turn", F.concat(F.lit('{"seed_nseq":'), n.cast("string"), F.lit('}')).alias("j")))

    def texts(item):
        return F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["j"]), ",")

    # A conversation holds a handful of turns.
    runs = t.conversations.groupBy(F.col("conv_id").alias("c")).agg(texts(seed).alias("s"), texts(slot).alias("e"), texts(check).alias("v"))
    status = F.when(F.col("c") % 3 == 0, ',"status":"error","failed_stage":"msa_expansion"').otherwise(',"status":"ok"')
    target = F.when(F.col("c") % 4 != 0, ',"target":{"ensembl_gene_id":"G","transcript_id":"T"}').otherwise("")
    content = F.concat(F.lit('{"input_id":"c'), F.col("c").cast("string"), F.lit('"'), status, target, F.lit(',"msa":{"seeds":['), "s", F.lit(']},"expansions":['),
                       F.when(F.col("c") % 3 == 0, "").otherwise(F.col("e")), F.lit('],"validations":['), "v", F.lit("]}"))
    return runs.select(F.concat(F.lit("/r/"), F.col("c").cast("string")).alias("run"), content.alias("content"))


def conversation_results(t: Tables) -> DataFrame:
    return records.parse_results(conversation_records(t))


def conversation_files(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same runs as folders: result records, some target and stats files (some of them damaged), manifests, sequence files."""
    c, turn = F.col("conv_id"), F.col("turn").cast("string")
    run = F.concat(F.lit("file:///r/"), c.cast("string"))
    result = conversation_records(t, True).select(F.concat(F.lit("file://"), "run", F.lit("/result.json")).alias("path"), "content")
    targets = t.conversations.where("conv_id % 5 < 2").select(F.concat(run, F.lit("/target.json")).alias("path"), F.when(
        c % 5 == 0, '{"input_id":"f","input_kind":"k","ensembl_gene_id":"GF","transcript_id":"TF"}').otherwise('{"input_id":').alias("content")).distinct()
    header = list(run_files.STATS)
    cell = {"seed_nseq": F.when(c % 3 == 0, "bad").otherwise((F.length("text") + 1000).cast("string")), "aln_identical": F.lit("false"), "query_name": F.lit('"q, 1"')}
    lines = [F.concat(F.lit(",".join(names) + "\n"), F.concat_ws(",", *[cell.get(n, F.lit("")) for n in names])) for names in (header, header[::-1])]
    users = t.conversations.where("role = 'user'")
    folder = F.concat(run, F.format_string("/validation/pid_%.2f", (F.col("turn") * 10).cast("double")))
    stats = users.where("turn % 4 = 0").select(F.concat(folder, F.lit("/stats.csv")).alias("path"), F.when(c % 2 == 0, lines[0]).otherwise(lines[1]).alias("content"))
    states = users.where("conv_id % 4 = 0").select(F.concat(folder, F.lit("/stage_state.json")).alias("path"), F.lit('{"stage_key":"v","warnings":["late"]}').alias("content"))
    place = F.when(F.col("role") == "user", F.concat(run, F.lit("/s/"), turn, F.lit(".sto"))).otherwise(F.concat(run, F.lit("/h/"), turn, F.lit(".fasta")))
    held = t.conversations.where("role = 'user' or turn % 4 <> 3")
    names = held.select(place.alias("path"), F.explode(F.split("text", " ")).alias("name"))
    return result.unionAll(targets).unionAll(stats).unionAll(states), names, held.select(place.alias("path"))


_CONV = """seeds AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, CAST(turn * 10 AS DOUBLE) AS pid, turn FROM conversations WHERE role = 'user'),
slots AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, length(text) AS n FROM conversations WHERE role <> 'user' AND conv_id % 3 <> 0),
checks AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, length(text) AS n FROM conversations WHERE role = 'assistant')"""


@QUERIES.add(f"""WITH {_CONV}
SELECT '/r/' || CAST(c AS VARCHAR) AS run, CAST(i AS INTEGER) AS seed_index, coalesce(n % 5 >= 2, false) AS present, CASE WHEN n % 5 >= 2 THEN n END AS n_hits, CASE WHEN n % 5 >= 2 THEN '/abs/m.sto' END AS match_stockholm
FROM seeds LEFT JOIN slots USING (c, i) WHERE c % 3 = 0 OR c IN (SELECT c FROM slots)""")
def catalogue_expansions(t: Tables) -> DataFrame:
    return jobs.catalogue_tables(conversation_results(t))["expansions"].select("run", "seed_index", "present", "n_hits", "match_stockholm")


@QUERIES.add(f"""WITH {_CONV} SELECT '/r/' || CAST(c AS VARCHAR) AS run, CAST(i AS INTEGER) AS seed_index, pid, n AS seed_nseq FROM checks JOIN seeds USING (c, i)""")
def catalogue_validations(t: Tables) -> DataFrame:
    return jobs.catalogue_tables(conversation_results(t))["validations"].select("run", "seed_index", "pid", "seed_nseq")


@QUERIES.add(f"""WITH {_CONV}, e AS (SELECT seeds.c, seeds.i, slots.n, slots.i AS j FROM seeds LEFT JOIN slots USING (c, i) WHERE c % 3 = 0 OR c IN (SELECT c FROM slots)),
w AS (SELECT c, 'slot' AS k FROM e WHERE NOT coalesce(n % 5 >= 2, false)
  UNION ALL SELECT c, 'extra' FROM (SELECT c, max(i) AS m FROM slots GROUP BY c) LEFT JOIN (SELECT c, max(i) AS s FROM seeds GROUP BY c) USING (c) WHERE m > coalesce(s, 0)
  UNION ALL SELECT checks.c, CASE WHEN seeds.c IS NULL THEN 'skipped' ELSE 'stats' END FROM checks LEFT JOIN seeds USING (c, i))
SELECT '/r/' || CAST(c AS VARCHAR) AS run, k AS kind, count(*) AS n FROM w GROUP BY ALL""")
def catalogue_warnings(t: Tables) -> DataFrame:
    w = F.col("warning")
    kind = F.when(w.startswith("More expansions"), "extra").when(w.startswith("A recorded validation"), "skipped").when(w.startswith("No stats file"), "stats").otherwise("slot")
    return jobs.catalogue_tables(conversation_results(t))["warnings"].groupBy("run", kind.alias("kind")).agg(F.count("*").alias("n"))


@QUERIES.add("""SELECT DISTINCT '/r/' || CAST(conv_id AS VARCHAR) AS run, CASE WHEN conv_id % 4 <> 0 THEN 'c' || CAST(conv_id AS VARCHAR) END AS input_id, conv_id % 4 = 0 AS bad FROM conversations""")
def catalogue_targets(t: Tables) -> DataFrame:
    return jobs.catalogue_tables(conversation_results(t))["targets"].select("run", "target.input_id", F.col("issue").isNotNull().alias("bad"))


@QUERIES.add("""SELECT DISTINCT 'file:///r/' || CAST(conv_id AS VARCHAR) AS run, CASE WHEN conv_id % 5 = 0 THEN 'f' WHEN conv_id % 4 <> 0 THEN 'c' || CAST(conv_id AS VARCHAR) END AS input_id,
  CASE WHEN conv_id % 5 = 0 THEN 'GF' WHEN conv_id % 4 <> 0 THEN 'G' END AS gene, conv_id % 5 <> 0 AND conv_id % 4 = 0 AS bad,
  conv_id % 5 = 1 AND conv_id % 4 <> 0 AS told FROM conversations""")
def catalogue_file_targets(t: Tables) -> DataFrame:
    """A readable target file takes the place of the record's target; a damaged one is told."""
    return jobs.catalogue_from_files(*conversation_files(t))["targets"].select(
        "run", "target.input_id", F.col("target.ensembl_gene_id").alias("gene"), F.col("issue").isNotNull().alias("bad"),
        F.coalesce(F.col("warning").startswith("The target file is unreadable."), F.lit(False)).alias("told"))


@QUERIES.add(f"""WITH {_CONV}, u AS (SELECT conv_id AS c, turn, length(text) AS l FROM conversations WHERE role = 'user'),
f AS (SELECT c, i, pid, turn, checks.n, turn % 4 = 0 AS found, turn % 4 = 0 AND c % 3 <> 0 AS ok, u.l FROM checks JOIN seeds USING (c, i) JOIN u USING (c, turn)),
g AS (SELECT c, i FROM slots WHERE n % 5 >= 2)
SELECT 'file:///r/' || CAST(c AS VARCHAR) AS run, CAST(i AS INTEGER) AS seed_index, pid, CASE WHEN ok THEN l + 1000 ELSE n END AS seed_nseq, CASE WHEN ok THEN 'q, 1' END AS query_name,
  CASE WHEN ok THEN 'warn' ELSE 'ok' END AS status, CASE WHEN ok THEN CASE WHEN c % 4 = 0 THEN 'late|' ELSE '' END || CASE WHEN g.i IS NOT NULL THEN 'Expanded' ELSE 'Seed' END ELSE '' END AS told
FROM f LEFT JOIN g USING (c, i)""")
def catalogue_file_validations(t: Tables) -> DataFrame:
    """A readable stats file, whatever the order of its columns, takes the place of the record's figures and renews the warnings."""
    short = F.transform("warnings", lambda w: F.split(w, " ")[0])
    return jobs.catalogue_from_files(*conversation_files(t))["validations"].select(
        "run", "seed_index", "pid", "seed_nseq", "query_name", "status", F.array_join(short, "|").alias("told"))


@QUERIES.add(f"""WITH {_CONV}, w AS (SELECT conv_id AS c, turn, role, unnest(string_split(text, ' ')) AS name FROM conversations),
x AS (SELECT conv_id AS c, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, length(text) AS n FROM conversations WHERE role <> 'user' AND conv_id % 3 <> 0),
s AS (SELECT c, i, x.turn AS h, seeds.turn AS u, n FROM x JOIN seeds USING (c, i) WHERE n % 5 >= 2),
old AS (SELECT DISTINCT c, turn AS u, name FROM w WHERE role = 'user'),
k AS (SELECT s.c, s.i, count(*) AS n_hits, count(*) FILTER (old.name IS NULL) AS n_new_hits FROM s JOIN w ON w.c = s.c AND w.turn = s.h LEFT JOIN old ON old.c = s.c AND old.u = s.u AND old.name = w.name
  WHERE s.n % 5 = 3 AND s.h % 4 <> 3 GROUP BY ALL)
SELECT 'file:///r/' || CAST(c AS VARCHAR) AS run, CAST(i AS INTEGER) AS seed_index, CASE WHEN n % 5 <> 3 THEN n ELSE coalesce(n_hits, 0) END AS n_hits, CASE WHEN n % 5 <> 3 THEN 0 ELSE coalesce(n_new_hits, 0) END AS n_new_hits,
  CASE WHEN n % 5 <> 3 THEN '/abs/m.sto' WHEN g <> '' THEN 'file:///r/' || c || '/expansion/' || g || '/pid_' || printf('%.2f', u * 10.0) || '/expanded_msa/' || t || '_matchonly.sto' END AS match_stockholm,
  CASE WHEN n % 5 <> 3 THEN '/seeds/seed_pid' || printf('%.1f', u * 10.0) || '.fasta' END AS seed_fasta
FROM s LEFT JOIN k USING (c, i), (SELECT DISTINCT conv_id AS c, CASE WHEN conv_id % 5 = 0 THEN 'GF/TF' WHEN conv_id % 4 <> 0 THEN 'G/T' ELSE '' END AS g,
  CASE WHEN conv_id % 5 = 0 THEN 'TF' WHEN conv_id % 4 <> 0 THEN 'T' END AS t FROM conversations) r WHERE r.c = s.c""")
def catalogue_file_expansions(t: Tables) -> DataFrame:
    """Counts a record lacks come from its sequence files; paths it lacks are the usual ones, of the target that holds."""
    found = jobs.catalogue_from_files(*conversation_files(t))["expansions"].where("present")
    return found.select("run", "seed_index", "n_hits", "n_new_hits", "match_stockholm", "seed_fasta")


@QUERIES.add(f"""WITH {_CONV} SELECT '/r/' || CAST(c AS VARCHAR) AS run, CAST(min(i) FILTER (pid = 30) AS INTEGER) AS by_pid, CASE WHEN max(i) >= 2 THEN 2 END AS by_index, CASE WHEN count(*) = 1 THEN 1 END AS only_one FROM seeds GROUP BY c""")
def seed_pick(t: Tables) -> DataFrame:
    seeds = catalogue.load_seeds(conversation_results(t))
    by_pid = catalogue.pick_seeds(seeds, pid=30.0).select("run", F.col("seed_index").alias("by_pid"))
    by_index = catalogue.pick_seeds(seeds, index=2).select("run", F.col("seed_index").alias("by_index"))
    only = catalogue.pick_seeds(seeds).select("run", F.col("seed_index").alias("only_one"))
    return by_pid.join(by_index, "run").join(only, "run")


@QUERIES.add("""WITH s AS (SELECT l_orderkey AS run, l_linenumber AS i, max(l_quantity) AS pid, count(*) AS n, max(l_returnflag) AS f FROM lineitem GROUP BY ALL),
x AS (SELECT s.*, o_orderpriority AS p, CASE WHEN f = 'A' THEN CAST(n AS VARCHAR) WHEN f = 'N' OR o_orderpriority = '5-LOW' THEN 'none' END AS slot FROM s JOIN orders ON o_orderkey = run),
a AS (SELECT run, string_agg(CAST(pid AS VARCHAR), ',' ORDER BY i) AS pids, string_agg(slot, ',' ORDER BY i) AS slots, count(*) FILTER (f <> 'R') AS nv FROM x GROUP BY run)
SELECT o_orderkey AS run, CASE o_orderpriority WHEN '5-LOW' THEN 'error' WHEN '1-URGENT' THEN 'warn' ELSE 'ok' END AS status, pids, slots, coalesce(nv, 0) AS n_validations
FROM orders LEFT JOIN a ON run = o_orderkey""")
def result_assembly(t: Tables) -> DataFrame:
    """Line flag R lacks an expansion, N has an empty slot; low-priority runs failed in expansion and are padded."""
    _, seeds = order_runs(t)
    none = F.array().cast("array<string>")
    runs = t.orders.select(
        F.col("o_orderkey").alias("run"), F.lit("x").alias("input_id"), F.lit(None).cast("string").alias("target"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("w"))).otherwise(none).alias("warnings"),
        F.when(F.col("o_orderpriority") == "5-LOW", "msa_expansion").alias("failed_stage"), F.lit(None).cast("string").alias("exception"))
    expansions = seeds.where("flag <> 'R'").select("run", "seed_index", (F.col("flag") == "A").alias("present"), F.lit("ok").alias("status"), F.col("n").alias("n_hits"))
    validations = seeds.where("flag <> 'R'").select("run", "seed_index", F.lit("ok").alias("status"))
    stages = t.orders.select(F.col("o_orderkey").alias("run"), F.lit("p").alias("state_path"), F.lit("done").alias("status"))
    built = catalogue.assemble_results(runs, seeds.select("run", "seed_index", "pid"), expansions, validations, stages)
    slots = F.transform("expansions", lambda e: F.coalesce(e["n_hits"].cast("string"), F.lit("none")))
    return built.select("run", "status", F.array_join(F.transform("selected_pids", lambda p: p.cast("string")), ",").alias("pids"),
                        F.array_join(slots, ",").alias("slots"), F.greatest(F.coalesce(F.size("validations"), F.lit(0)), F.lit(0)).alias("n_validations"))


@QUERIES.add("""WITH h AS (SELECT l_orderkey AS run, string_agg('"' || l_returnflag || CAST(n AS VARCHAR) || '"', ',' ORDER BY l_linenumber) AS hs
  FROM (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) WHERE l_returnflag <> 'N' AND l_linenumber <> 7 GROUP BY l_orderkey)
SELECT o_orderkey AS run, sha256('{"input_id":"' || o_orderpriority || '","stage_hashes":[' || coalesce(hs, '') || ']}') AS result_identity FROM orders LEFT JOIN h ON run = o_orderkey""")
def run_identity(t: Tables) -> DataFrame:
    _, seeds = order_runs(t)
    stages = seeds.select("run", F.col("seed_index").cast("string").alias("state_path"), F.when(F.col("seed_index") == 7, "result").otherwise("x").alias("stage_key"),
                          F.when(F.col("flag") != "N", F.concat("flag", F.col("n").cast("string"))).alias("identity_hash"))
    runs = t.orders.select(F.col("o_orderkey").alias("run"), F.col("o_orderpriority").alias("input_id"))
    return catalogue.run_identity(runs, stages)


@QUERIES.add("""SELECT o_orderkey AS run, CASE WHEN o_orderstatus = 'P' THEN 'run' WHEN o_orderkey % 3 > 0 AND o_custkey % 5 > 0 AND o_orderpriority <> '5-LOW' THEN 'reuse' ELSE 'rebuild' END AS decision,
  CASE WHEN o_orderstatus <> 'P' THEN concat_ws(',', CASE WHEN o_custkey % 5 = 0 THEN 'target.species' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'seed.fasta_sha256' END,
    CASE WHEN o_orderkey % 3 = 0 THEN 'expansion.match_mode' END) END AS differing FROM orders""")
def identity_difference(t: Tables) -> DataFrame:
    """Requested against recorded expansions: species, seed file (NULL on one side) or match mode may differ; orders in state P have no record."""
    runs = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority", F.col("o_orderkey").cast("string").alias("input_id"),
                           F.lit("uniprot").alias("input_kind"), F.lit(None).cast("string").alias("uniprot_id"), F.col("o_orderstatus").alias("ensembl_gene_id"),
                           F.lit("T").alias("transcript_id"), F.lit(None).cast("string").alias("ensembl_protein_id"), F.lit("s").alias("species"),
                           F.col("o_totalprice").alias("pid"), F.sha2("o_orderstatus", 256).alias("stockholm_sha256"), F.lit("f").alias("fasta_sha256"),
                           F.lit("db").alias("database"), F.lit(1).alias("match_mode"), F.lit(None).cast("double").alias("match_ratio"),
                           F.lit(0.5).alias("symfrac"), F.lit(True).alias("centroids"))
    changed = runs.where("o_orderstatus <> 'P'").withColumns({
        "species": F.when(F.col("o_custkey") % 5 == 0, "other").otherwise(F.col("species")),
        "fasta_sha256": F.when(F.col("o_orderpriority") != "5-LOW", F.col("fasta_sha256")),
        "match_mode": F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("match_mode"))})
    requested, recorded = (df.select(F.col("o_orderkey").alias("run"), paths.expansion_identity().alias("identity")) for df in (runs, changed))
    return catalogue.reuse_decisions(requested, recorded, ["run"]).select("run", "decision", F.array_join("differing", ",").alias("differing"))


def _stability(seed: int, count: int, ref: str) -> str:
    """CTEs up to ``e(m, epli, n_samples)``: per sign alignment the median consensus score of its samples; ``ref`` picks each reference row."""
    return f"""{_SIGNS}, ref AS (SELECT m, {ref} AS f, count(*) - 1 AS others FROM s GROUP BY m HAVING f IS NOT NULL),
ranked AS (SELECT s.m, g.i, s.r, row_number() OVER (PARTITION BY s.m, g.i ORDER BY md5('{seed}|' || CAST(g.i AS VARCHAR) || '|' || CAST(s.r AS VARCHAR)), s.r) AS d FROM s JOIN ref ON ref.m = s.m AND s.r <> f, range(1, {count + 1}) AS g(i)),
draws AS (SELECT m, i, r FROM ranked JOIN ref USING (m) WHERE d <= greatest(1, least(others, CAST(round_even(0.8 * others, 0) AS BIGINT))) UNION ALL SELECT m, g.i, f FROM ref, range(1, {count + 1}) AS g(i)),
u AS (SELECT m, r, p, substr(q, CAST(p AS INTEGER), 1) AS c FROM s, range(1, 65) AS h(p)),
fc AS (SELECT m, p, c, row_number() OVER (PARTITION BY m, p ORDER BY count(*) DESC, c) AS k FROM u WHERE c <> '-' GROUP BY m, p, c),
sc AS (SELECT d.m, d.i, p, c, row_number() OVER (PARTITION BY d.m, d.i, p ORDER BY count(*) DESC, c) AS k FROM draws d JOIN u ON u.m = d.m AND u.r = d.r WHERE c <> '-' GROUP BY d.m, d.i, p, c),
cmp AS (SELECT sc.m, sc.i, count(*) FILTER (sc.c = fc.c) AS matched FROM sc JOIN fc ON fc.m = sc.m AND fc.p = sc.p AND fc.k = 1 WHERE sc.k = 1 GROUP BY ALL),
n AS (SELECT m, count(*) AS comparable FROM fc WHERE k = 1 GROUP BY m),
e AS (SELECT m, median(100.0 * matched / comparable) AS epli, count(*) AS n_samples FROM cmp JOIN n USING (m) GROUP BY m)"""


@QUERIES.add(f"WITH {_stability(11, 45, 'min(r)')} SELECT m AS msa_id, round(epli, 6) AS epli, n_samples FROM e")
def alignment_stability(t: Tables) -> DataFrame:
    """The whole stability job on the sign alignments: 45 samples per alignment, median of their scores."""
    rows = sign_rows(t).select("msa_id", F.col("row_idx").alias("rec_idx"), F.col("row_idx").cast("string").alias("name"), "seq")
    _, summary = jobs.stability_job(rows, ["msa_id"], seed=11)
    return summary.select("msa_id", F.round("epli", 6).alias("epli"), "n_samples")


@QUERIES.add(f"""WITH {_stability(5, 10, "coalesce(min(r) FILTER (r % 20 = 3), min(r) FILTER (r % 20 = 5))")}, z AS (SELECT m, count(*) AS size FROM s GROUP BY m),
b AS (SELECT m % 2 AS t, m, epli, size, row_number() OVER (PARTITION BY m % 2 ORDER BY epli DESC, size DESC, m) AS k FROM e JOIN z USING (m))
SELECT t AS target_id, m AS pid_order, round(epli, 6) AS epli, size AS n_sequences_msa0 FROM b WHERE k = 1""")
def candidate_selection(t: Tables) -> DataFrame:
    """The whole selection job: label class = target, label = candidate, shared samples, best seed per target."""
    rows = sign_rows(t).select(
        (F.col("msa_id") % 2).alias("target_id"), F.col("msa_id").alias("pid_order"), F.col("msa_id").cast("double").alias("pid"), "row_idx",
        F.concat(F.lit("v"), (F.col("row_idx") % 20).cast("string"), F.lit("."), F.col("row_idx").cast("string")).alias("name"),
        F.concat(F.lit("sp"), (F.col("row_idx") % 20).cast("string")).alias("species"), "seq")
    targets = rows.select("target_id").distinct().select(
        "target_id", F.lit("v3").alias("ensembl_gene_id"), F.lit("v5").alias("transcript_id"), F.lit(None).cast("string").alias("uniprot_id"),
        F.lit(False).alias("has_reference"), F.lit(None).cast("string").alias("uniprot_seq"))
    out = jobs.candidates_job(targets, rows, "independent", 10, 0.8, 5)
    return out["seeds"].select("target_id", "pid_order", F.round("epli", 6).alias("epli"), "n_sequences_msa0")
