"""Quality rules with risk-controlled thresholds. DataFrame functions only.

Base rules are fixed. The other rules compare one figure of a document with a cutoff chosen per stratum from labelled
documents: among the good ones (label 1), a cutoff may reject at most a share ``alpha``. For each cutoff of a grid fixed
beforehand, the exact binomial tail ``P(Bin(n, alpha) <= rejected)`` is the p-value of "it rejects more than alpha"; the
level ``delta`` is divided by the number of all tests (strata x rules x cutoffs). The tightest cutoff that passes is used;
where none passes, as in a stratum with few labels, the rule rejects nothing.

Defined results: NULL text counts as an empty one; NULL stratum is a stratum of its own; repeated rows are judged each on
their own; several labels of one document count as the least; an empty label table leaves the base rules only. Columns of the
input other than the id, text and stratum columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import WORD, settled

#: Cutoffs tried for each rule; a document is rejected when its figure lies above the cutoff.
GRID = {
    "symbol_share": [0.005, 0.01, 0.02, 0.05, 0.1, 0.2],
    "dup_line_share": [0.05, 0.1, 0.2, 0.3, 0.5],
    "repeat_share": [0.02, 0.05, 0.1, 0.2, 0.3],
    "upper_share": [0.1, 0.2, 0.3, 0.5, 0.7],
    "mean_word_chars": [8.0, 9.0, 10.0, 12.0, 15.0, 20.0],
}
WINDOW = 8


def figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts of the base rules beside the columns of ``docs``."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = docs.withColumn("_words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
    at = lambda i, k: F.get(F.col("_words"), i + k)
    starts = F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(0), F.size("_words") - WINDOW)).otherwise(F.array().cast("array<int>"))
    hashed = words.withColumn("_hashes", F.transform(starts, lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        hashed.withColumn("_lines", lines)
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")).cast("long"))
        .withColumn("n_symbols", (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]+", ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), _covered("_hashes")).otherwise(F.lit(0)).cast("long"))
        .withColumn("_n_lines", F.size("_lines"))
        .withColumn("_upper", F.length(body) - F.length(F.regexp_replace(body, r"[A-Z]+", "")))
        .drop("_words", "_hashes", "_lines")
    )


def _covered(hashes: str) -> Column:
    """Words inside windows whose hash occurs twice or more."""
    ordered = F.array_sort(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    before = F.concat(nothing, ordered)
    after = F.concat(F.slice(ordered, F.lit(2), F.greatest(F.size(hashes), F.lit(1))), nothing)
    pairs = F.zip_with(F.zip_with(ordered, before, lambda x, b: F.struct(x.alias("x"), b.alias("b"))), after,
                       lambda p, a: F.when((p["x"]["h"] == p["b"]["h"]) | (p["x"]["h"] == a["h"]), p["x"]["i"]))
    starts = F.array_sort(F.filter(pairs, lambda i: i.isNotNull()))
    step = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
    )
    return step["n"]


def shares() -> dict[str, Column]:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "symbol_share": per("n_symbols", "word_chars"), "dup_line_share": per("n_dup_lines", "_n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"), "upper_share": per("_upper", "word_chars"),
        "mean_word_chars": per("word_chars", "n_words"),
    }


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """``P(Bin(n, p) <= k)`` exactly, by the ratio of neighbouring terms; 1 where ``k`` is beyond the mean."""
    odds = F.lit(p / (1 - p))
    first = F.struct((n * F.log(F.lit(1 - p))).alias("t"), F.exp(n * F.log(F.lit(1 - p))).alias("s"))

    def step(acc, j):
        t = acc["t"] + F.log((n - j + 1) / j * odds)
        return F.struct(t.alias("t"), (acc["s"] + F.exp(t)).alias("s"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.aggregate(terms, first, step, lambda acc: acc["s"]))


def cutoffs(counted: DataFrame, labels: DataFrame, *, key: str = "doc_id", stratum: str = "_stratum", good: str = "quality",
            alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``(stratum, rule, cutoff, n_good, n_rejected, p_value)`` of the tightest cutoff that passes, per stratum and rule."""
    marks = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(good).alias("_good")).where("_good = 1")
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), value.alias("value"), F.array(*map(F.lit, GRID[name])).alias("grid"))
                      for name, value in shares().items()])
    holdout = counted.join(marks, key, "left_semi").select(stratum, F.explode(rules).alias("r"))
    tried = holdout.select(stratum, "r.rule", "r.value", F.explode("r.grid").alias("cutoff"))
    risks = tried.groupBy(stratum, "rule", "cutoff").agg(
        F.count("*").alias("n_good"), F.sum((F.col("value") > F.col("cutoff")).cast("long")).alias("n_rejected"))
    tests = sum(map(len, GRID.values()))
    risks = settled(risks)
    strata = max(1, risks.select(stratum).distinct().count())
    judged = risks.withColumn("p_value", binomial_tail(F.col("n_good"), F.col("n_rejected"), alpha))
    passed = judged.where(F.col("p_value") <= delta / (tests * strata))
    return passed.groupBy(stratum, "rule").agg(
        F.min("cutoff").alias("cutoff"), F.min_by("n_good", "cutoff").alias("n_good"),
        F.min_by("n_rejected", "cutoff").alias("n_rejected"), F.min_by("p_value", "cutoff").alias("p_value"))


def judge(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang",
          alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Per document: the base counts, ``base_failed``, ``kept`` and ``failed_rules``."""
    named = docs.select(key, text, F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("none")).alias("_stratum"))
    counted = settled(figures(named, text).drop(text))
    chosen = cutoffs(counted, labels, key=key, alpha=alpha, delta=delta)
    table = settled(chosen.groupBy("_stratum").agg(*[
        F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"_cut_{name}") for name in GRID]))
    # One row of a few numbers for each stratum: broadcast only when the table was counted and is small.
    small = table.limit(10_001).count() <= 10_000
    scored = counted.join(F.broadcast(table) if small else table, "_stratum", "left")
    failed = F.filter(F.array(*[F.when(value > F.col(f"_cut_{name}"), F.lit(name)) for name, value in shares().items()]), lambda x: x.isNotNull())
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & (F.size(failed) == 0)).alias("kept"), failed.alias("failed_rules"))
