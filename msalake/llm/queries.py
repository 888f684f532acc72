"""One query for each operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collision, decontaminate, html, jaccard, lemp, lines, merkle, mixing, pii, quality, substring, toxicity
from .store import settled

ORACLES: dict[str, str] = {}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substring.remove_repeats(_read(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, i AS pos, array_to_string(words[i:i + 19], ' ') AS seq FROM w, unnest(range(1, len(words) - 18)) AS t(i)),
n AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY seq ORDER BY doc_id, pos) AS occurrence FROM s),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS i FROM n WHERE occurrence > 1),
e AS (SELECT doc_id, words[i] AS word, i FROM w, unnest(range(1, len(words) + 1)) AS t(i)),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept FROM e ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)"""


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(_read(spark, folder, "documents"))
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{kind}") for k, kind in enumerate(pii.PATTERNS)],
        F.sha2(pii.written("base"), 256).alias("base_sha256"), pii.written("spans").alias("spans"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(_read(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(_read(spark, folder, "documents"), _read(spark, folder, "benchmark")).drop("similarity")


ORACLES["op4_benchmark_decontamination"] = r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM benchmark),
ig AS (SELECT item_id, len(words) AS n, k AS off, array_to_string(words[k + 1:k + 5], ' ') AS gram FROM i, unnest(range(0, len(words) - 4)) AS t(k)),
dg AS (SELECT doc_id, len(words) AS n_words, k AS pos, array_to_string(words[k + 1:k + 5], ' ') AS gram FROM w, unnest(range(0, len(words) - 4)) AS t(k)),
wt AS (SELECT gram, ln(1 + (SELECT count(*) FROM i) / count(DISTINCT item_id)) AS weight FROM ig GROUP BY gram),
win AS (SELECT DISTINCT doc_id, greatest(0, least(pos - off, n_words - n)) AS s, n FROM dg JOIN (SELECT DISTINCT gram, n, off FROM ig) USING (gram)),
wf AS (SELECT DISTINCT doc_id, s, n, gram, coalesce(weight, ln(1 + (SELECT count(*) FROM i))) AS weight FROM win JOIN dg USING (doc_id) LEFT JOIN wt USING (gram)
  WHERE pos >= s AND pos <= s + n - 5),
itf AS (SELECT DISTINCT item_id, n, gram, weight FROM ig JOIN wt USING (gram)),
tw AS (SELECT doc_id, s, n, sum(weight) AS tw FROM wf GROUP BY ALL), ti AS (SELECT item_id, sum(weight) AS ti FROM itf GROUP BY ALL),
c AS (SELECT doc_id, s, n, item_id, sum(wf.weight) AS c FROM wf JOIN itf USING (n, gram) GROUP BY ALL),
j AS (SELECT doc_id, item_id, s, n, round(c / (tw + ti - c), 9) AS sim FROM c JOIN tw USING (doc_id, s, n) JOIN ti USING (item_id) WHERE c / (tw + ti - c) >= 0.8 - 1e-9),
b AS (SELECT doc_id, item_id, s, n, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY sim DESC, s) AS r FROM j)
SELECT doc_id, item_id, CAST(s AS BIGINT) AS start_word, CAST(s + n AS BIGINT) AS end_word FROM b WHERE r = 1"""


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    models = toxicity.fit(docs, _read(spark, folder, "labels"))
    scored = toxicity.score(docs, models)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    ok = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", ok), (-7, 1, "assistant", ok)], "conv_id long, turn long, role string, text string")
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    messages = settled(chat.from_turns(rows))
    out = chat.format_paths(messages, chat.paths(messages))
    turns = F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = out.withColumn("turns", turns).withColumn("loss_text", chat.under_loss(F.col("formatted"), F.col("loss")))
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(F.concat_ws("", "turns"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLES["op6_chat_formatting"] = r"""WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(role, '([\\<\[])', '\1\\', 'g')) + (length(role) - length(replace(role, chr(10), ''))) AS role_chars,
  length(regexp_replace(text, '([\\<\[])', '\1\\', 'g')) AS text_chars, CASE WHEN role = 'assistant' THEN 4 ELSE 7 END AS end_chars FROM r),
a AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS body,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  CAST(sum(6 + role_chars + 1 + text_chars + end_chars) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(body) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM a"""


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link(_read(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLES["op7_ngram_jaccard_join"] = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 4], ' ') END AS gram
  FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) USING (doc_id)"""


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.clean(_read(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op8_line_dedup"] = r"""WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
t AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS body FROM l),
b AS (SELECT body FROM t WHERE body <> '' GROUP BY body HAVING count(DISTINCT coalesce('=' || source, 'none')) >= 10),
k AS (SELECT t.*, t.body IN (SELECT body FROM b) AS gone FROM t),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id)"""


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return mixing.mix(docs, _read(spark, folder, "labels")).drop("text")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_read(spark, folder, "documents"), _read(spark, folder, "labels")).drop("failed_rules")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return lemp.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0, longest=None)


ORACLES["op11_hard_negatives"] = r"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda c: floor(256 * c)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) a JOIN v r ON len(a.x) = len(r.x)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS slot
  FROM s WHERE same AND vec_id <> anchor_id),
n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id, slot ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE slot <= 5 AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return collision.search(_read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op12_nearest_neighbours"] = r"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, r.vec_id, list_cosine_similarity(q.x, r.x) AS score FROM (SELECT DISTINCT vec_id, x FROM v WHERE vec_id % 50 = 0) q
  JOIN v r ON r.vec_id <> q.vec_id AND len(r.x) = len(q.x)),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM n WHERE rank <= 5"""


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    made = lambda text: merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    rows = docs.select("doc_id", "lang", made(F.col("text")).alias("leaf"),
                       F.when(hit, made(F.translate("text", upper, upper.lower()))).alias("tampered"))
    proven = merkle.manifest(rows, id="doc_id", group="lang", carry=("tampered",))
    out = proven.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLES["op13_merkle_manifest"] = r"""WITH RECURSIVE d AS (SELECT doc_id, lang, coalesce('=' || lang, '') AS g, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text FROM documents),
h AS (SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered FROM d),
bits AS (SELECT unnest(range(256)) AS b, unnest(range(256)) AS c0),
crcs AS (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM bits),
crct AS (SELECT list(c ORDER BY b) AS t FROM crcs),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n,
  coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda c, byte: xor(c >> 8, t[CAST(xor(c, byte) & 255 AS INTEGER) + 1])), 4294967295) % 3 = 0, false) AS hit FROM h, crct),
lo AS (SELECT g, 0 AS lvl, pos, n, leaf AS digest FROM o
  UNION ALL SELECT g, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM lo WHERE n > 1 GROUP BY g, lvl, pos // 8, n),
sub AS (SELECT g, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM lo WHERE n = 1),
hi AS (SELECT 0 AS lvl, pos, n, digest FROM sub
  UNION ALL SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM hi WHERE n > 1 GROUP BY lvl, pos // 8, n),
st AS (SELECT a.g, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM lo a JOIN lo b ON a.g = b.g AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL),
su AS (SELECT a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM hi a JOIN hi b ON a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL),
f AS (SELECT doc_id, leaf, g, 0 AS lvl, pos, n, CASE WHEN hit THEN lowered ELSE leaf END AS acc, '' AS seen FROM o
  UNION ALL SELECT f.doc_id, f.leaf, f.g, f.lvl + 1, f.pos // 8, (f.n + 7) // 8, sha256(st.l || f.acc || st.r), f.seen || st.l || st.r
  FROM f JOIN st ON st.g = f.g AND st.lvl = f.lvl AND st.pos = f.pos),
u AS (SELECT f.doc_id, f.leaf, sub.digest AS subroot, 0 AS lvl, sub.pos, sub.n, f.acc, f.seen FROM f JOIN sub ON sub.g = f.g WHERE f.n = 1
  UNION ALL SELECT u.doc_id, u.leaf, u.subroot, u.lvl + 1, u.pos // 8, (u.n + 7) // 8, sha256(su.l || u.acc || su.r), u.seen || su.l || su.r
  FROM u JOIN su ON su.lvl = u.lvl AND su.pos = u.pos)
SELECT doc_id, leaf, subroot, root, sha256(seen) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM u, (SELECT digest AS root FROM hi WHERE n = 1) WHERE n = 1"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
    return dict(sorted(found.items(), key=lambda item: int(item[0][2:].split("_")[0])))


def oracles() -> dict[str, str]:
    return ORACLES
