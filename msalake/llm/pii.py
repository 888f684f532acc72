"""Personal data by patterns, and terms that give it away by information theory. DataFrame functions only.

Base spans: e-mail addresses, IPv4 addresses, payment cards and telephone numbers, by fixed patterns, with offsets in code
points. Each value found is a protected entity. The corpus then says how much a term reveals an entity: from the number of
different contexts of the entity (``REACH`` terms on both sides) that hold the term, and the documents that hold the term at
all, comes the pointwise mutual information of both. Where it reaches the share ``alpha`` of the entity's own information,
``log2(documents / contexts)``, the term discloses the entity, and is generalised in every document with that entity.
Equal contexts, as in copies of a document, count once; a term needs ``support`` of them.

Patterns are written so that no text makes them slow: each starts at a run's first character only, and never backtracks into
one. Counts are combining aggregates over all documents; a frequent entity or term is never gathered.

Defined results: NULL text is an empty one; NULL ids count as one id after all others; rows that repeat an id each have their
own base spans, and share the terms of their id; a term inside a base span is left to that span. All other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import LAST_ID, settled

_LOCAL = "[A-Za-z0-9._%+-]"
#: The patterns of the base kinds, in their order. A match starts where its run of characters does, or after the last match.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
TERM = r"\p{L}[\p{L}\p{N}'-]{2,}+"
SPAN = "struct<start:int,kind:int,end:int>"
REACH = 8
SUPPORT = 3
ALPHA = 0.9


def _luhn(digits: Column) -> Column:
    def worth(i):
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + worth(i)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return match.rlike(rf"\A{part}(?:\.{part}){{3}}\z")
    if kind == "card":
        digits = F.regexp_replace(match, r"[\x20-]+", "")
        return F.length(digits).between(14, 19) & _luhn(F.substr(digits, F.lit(1), F.lit(19)))
    if kind == "phone":
        return F.length(F.regexp_replace(match, r"[^0-9]+", "")).between(10, 15)
    return F.lit(True)


def _located(body: Column, pattern: str, kind: int, valid) -> Column:
    """Spans of all matches that are valid: offsets add up the text between matches and the matches."""
    matches = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(F.split(body, pattern, -1), F.lit(1), F.size(matches)), matches, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(acc, p):
        start = acc["at"] + F.length(p["gap"])
        end = start + F.length(p["m"])
        new = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(valid(p["m"]), F.concat(acc["spans"], new)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(pairs, zero, step)["spans"]


def base_spans(body: Column) -> Column:
    """``array<struct<start, kind, end>>`` of the base kinds, by start, then kind."""
    none = F.array().cast(f"array<{SPAN}>")
    digits = body.rlike("[0-9]")
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        sign = {"email": F.contains(body, F.lit("@")), "phone": digits & F.contains(body, F.lit("+"))}.get(kind, digits)
        found.append(F.when(sign, _located(body, pattern, k, lambda m, kind=kind: _valid(kind, m))).otherwise(none))
    return F.array_sort(F.concat(*found))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def disclosing_terms(docs: DataFrame, *, support: int = SUPPORT, alpha: float = ALPHA, reach: int = REACH) -> DataFrame:
    """``(id, term)`` of the terms that disclose an entity of the document; ``docs`` has ``id``, ``body``."""
    marked = docs.withColumn("spans", base_spans(F.col("body"))).where(F.size("spans") > 0)
    each = marked.select("id", "body", F.explode("spans").alias("s"))
    wide = reach * 16
    cut = lambda at, n: F.substr("body", at + 1, n)
    left = F.slice(F.reverse(_terms(cut(F.greatest(F.lit(0), F.col("s.start") - wide), F.least(F.lit(wide), F.col("s.start"))))), 1, reach)
    right = F.slice(_terms(cut(F.col("s.end"), F.lit(wide))), 1, reach)
    value = F.lower(cut(F.col("s.start"), F.col("s.end") - F.col("s.start")))
    entity = F.xxhash64("s.kind", F.when(F.col("s.kind") >= 2, F.regexp_replace(value, "[^0-9]+", "")).otherwise(value))
    contexts = settled(each.select("id", entity.alias("entity"), F.array_distinct(F.concat(left, right)).alias("terms")))
    different = contexts.select("entity", "terms", F.xxhash64(F.array_sort("terms")).alias("context")).dropDuplicates(["entity", "context"])
    size = different.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support)
    together = different.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= support)
    spread = docs.select(F.explode_outer(F.array_distinct(_terms(F.col("body")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    total = docs.count()
    known = together.join(size, "entity").join(spread.where("term is not null"), "term")
    shared = F.log2(F.lit(float(max(total, 1))) * F.least("n_both", "n_term") / (F.col("n_term") * F.col("n_entity")))
    own = F.log2(F.lit(float(max(total, 1))) / F.col("n_entity"))
    telling = settled(known.where((own > 0) & (shared >= alpha * own)).select("entity", "term"))
    return contexts.select("id", "entity").distinct().join(telling, "entity").select("id", "term").distinct()


def find(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: key, ``body``, ``base`` and ``spans``, arrays of ``struct<start, kind, end>`` with kinds numbered as in ``KINDS``."""
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    # The terms of one id: a few for each entity of the document.
    terms = disclosing_terms(rows, **options).groupBy("id").agg(F.collect_set("term").alias("telling"))
    joined = rows.join(terms.hint("merge"), "id", "left").withColumn("base", base_spans(F.col("body")))
    located = _located(F.col("body"), TERM, len(PATTERNS), lambda m: F.lit(True))
    word = lambda s: F.lower(F.substr("body", s["start"] + 1, s["end"] - s["start"]))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    extra = F.filter(located, lambda s: F.array_contains("telling", word(s)) & free(s))
    return joined.select(
        F.col("id").alias(key), "body", "base", F.when(F.col("telling").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", extra))).alias("spans"))


def sanitised(body: str = "body", spans: str = "spans") -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        gap = F.substr(body, acc["at"] + 1, s["start"] - acc["at"])
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["parts"], F.array(gap, F.get(kinds, s["kind"])))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    return F.aggregate(spans, zero, step, lambda acc: F.concat(F.concat_ws("", acc["parts"]), F.substr(body, acc["at"] + 1, F.length(body))))


def written(spans: str) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))
