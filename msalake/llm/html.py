"""Main text of web pages by a site style tree.

The pages of one host are merged into a style tree: a node is the path of elements, with their classes, that leads to it. Each
node has the entropy of its presentations (the tags that stand in it) and of its contents over the host's pages. Menus,
notices and footers look and read alike on many pages and score low; the text of articles scores high. Branches below
``least`` importance are removed, as are branches that name themselves as menus, adverts, forms, comments and the like.
The tree judges every page. Where a page marks its article (``article``, ``main``), what lies outside goes too, and inside a branch is
judged as a box: headings, paragraphs and other lines of text count with the element that holds them, so that a heading that all
articles share is not taken for a notice. A host with fewer than ``pages`` different pages has no say; equal pages count once, so that
copies of an article do not make it a notice. What is left comes out block by block.

A page is parsed once, in one pass over its tags; the tree is a combining aggregate over (host, node, presentation, content). Only the
removed nodes of a host are gathered; texts are not shuffled unless these lists are too long for a broadcast.

Defined results: NULL or empty html gives an empty text; NULL ids and urls are kept, a NULL host counts as a host; repeated
rows each come out; unclosed tags end with their parent, unclosed comments, scripts and styles with the page. ``br`` and table
cells are white space. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import settled

PAGES = 8
LEAST = 0.5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|object|select|button|math|video|audio|canvas)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:>.*?(?:</\1\b[^>]*(?:>|\Z)|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"[\s​]+")
_NAME = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

# Elements that start a block, that have no content, and names of what is not an article.
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr "
            "html legend li main menu nav ol optgroup p pre section summary table tbody tfoot thead tr ul caption".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NOISE_TAGS = set("nav aside footer form head menu dialog label".split())
NOISE_ROLES = set("navigation banner contentinfo search complementary dialog alertdialog alert form menu menubar toolbar".split())
NOISE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside "
    "footer masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login social share "
    "sharing related recommended recommendations comment comments commentlist disqus respond replies widget widgets toolbar pagination pager search skip".split())
HEADER_NAMES = set("header head".split())
LINES = set("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre blockquote figcaption caption legend summary address center hr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(text)} if text and not text.isspace() else {}


def _noisy(tag: str, given: dict[str, str], inside: bool) -> bool:
    if tag in NOISE_TAGS or tag == "header" and not inside:
        return True
    if not given or tag in ("html", "body"):
        return False
    if given.get("role", "").lower() in NOISE_ROLES or "hidden" in given or given.get("aria-hidden") == "true":
        return True
    if "display:none" in given.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("article", "main"):
        names = set(_NAME.findall(given.get("class", ""))) & {"comment", "comments", "ad", "related"}
        return bool(names)
    words = {w.lower() for w in _NAME.findall(f"{given.get('class', '')} {given.get('id', '')}")}
    return bool(words & NOISE_NAMES) or not inside and bool(words & HEADER_NAMES)


def parse(page: str) -> tuple[list[str] | None, list[tuple[int, str]], dict[int, tuple[list[str], list[str]]]]:
    """``(article blocks or None, other blocks with their node, nodes with the tags and texts in them)``."""
    article, other, nodes = read(page)
    return None if article is None else [text for _, text in article], other, nodes


def read(page: str) -> tuple[list[tuple[int, str]] | None, list[tuple[int, str]], dict[int, tuple[list[str], list[str]]]]:
    """As ``parse``, article blocks with the box that holds them; boxes are among the nodes."""
    stack: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, 1)]  # tag, node, noise, inside an article, box
    article, other, nodes, parts, marked = [], [], {}, [], False
    at = 0

    def flush():
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            _, node, noise, inside, box = stack[-1]
            nodes.setdefault(node, ([], []))[1].append(text)
            if inside:
                nodes.setdefault(box, ([], []))[1].append(text)
            if not noise:
                (article if inside else other).append((box if inside else node, text))

    def close_to(depth: int):
        if any(entry[0] in BLOCK for entry in stack[depth:]):
            flush()
        del stack[depth:]

    for m in _TAG.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = m[3] and m[3].lower()
        if not tag:
            continue
        if m[2]:
            if tag == "p" and all(entry[0] != "p" for entry in stack):
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close_to(depth)
                    break
            continue
        if tag in BLOCK:
            flush()
            for depth in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph with all that is open in it
                if stack[depth][0] == "p":
                    del stack[depth:]
                    break
                if stack[depth][0] in BLOCK:
                    break
        elif tag in ("br", "td", "th", "img"):
            parts.append(" ")
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in CLOSES.get(tag, ()):
                close_to(depth)
            elif stack[depth][0] in ("table", "ul", "ol", "dl", "article", "body") or tag not in CLOSES:
                break
        if tag in VOID:
            continue
        given = _attributes(m[4])
        _, node, noise, inside, box = stack[-1]
        noise = noise or _noisy(tag, given, inside)
        if tag in ("article", "main") or given.get("role") == "main":
            inside = inside or not noise
            marked = marked or inside
        if tag in BLOCK:
            nodes.setdefault(node, ([], []))[0].append(tag)
            node = _hash(f"{node}/{tag}.{given.get('class', '')}#{given.get('id', '')}")
            if inside:
                nodes.setdefault(box, ([], []))[0].append(tag)
            if tag not in LINES:
                box = _hash(f"box {node}")
        stack.append((tag, node, noise, inside, box))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return (article if marked else None), other, nodes


def _parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.list_(pa.struct([("node", pa.int64()), ("text", pa.string())]))
    stat = pa.list_(pa.struct([("node", pa.int64()), ("look", pa.int64()), ("content", pa.int64())]))
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            copies, blocks, stats = [], [], []
            for page in part.column("html").to_pylist():
                article, other, nodes = read(page or "")
                copies.append(_hash(page or ""))
                blocks.append([{"node": n, "text": t} for n, t in (other if article is None else article)])
                stats.append([{"node": n, "look": _hash(" ".join(tags)), "content": _hash("\n".join(found))} for n, (tags, found) in nodes.items()])
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(copies, pa.int64()), pa.array(blocks, block), pa.array(stats, stat)],
                ["page_id", "url", "copy", "blocks", "nodes"])


def style_tree(parsed: DataFrame) -> DataFrame:
    """``(host, node, pages, importance)``: the higher of the entropies of presentation and content over different pages, as shares of the highest possible."""
    seen = parsed.select("host", "copy", F.explode("nodes").alias("n")).select("host", "copy", "n.*").distinct()

    def entropy(kind: str) -> DataFrame:
        values = seen.groupBy("host", "node", kind).agg(F.count("*").alias("c"))
        return values.groupBy("host", "node").agg(F.sum("c").alias("pages"), (F.log(F.sum("c")) - F.sum(F.col("c") * F.log("c")) / F.sum("c")).alias(kind))

    both = entropy("look").join(entropy("content").drop("pages"), ["host", "node"])
    top = F.when(F.col("pages") > 1, F.log("pages")).otherwise(F.lit(1.0))
    return both.select("host", "node", "pages", (F.greatest("look", "content") / top).alias("importance"))


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", least: float = LEAST, few: int = PAGES) -> DataFrame:
    """Per page: key, url, ``text``."""
    given = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    kind = given.schema["page_id"].dataType.simpleString()
    parsed = given.mapInArrow(
        _parse_pages, f"page_id {kind}, url string, copy bigint, blocks array<struct<node:bigint,text:string>>, nodes array<struct<node:bigint,look:bigint,content:bigint>>")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    parsed = settled(parsed.withColumn("host", host))
    low = style_tree(parsed).where((F.col("pages") >= few) & (F.col("importance") < least))
    removed = settled(low.groupBy("host").agg(F.collect_list("node").alias("removed")))
    held = F.filter("blocks", lambda b: F.col("removed").isNull() | ~F.array_contains("removed", b["node"]))
    text = F.array_join(F.transform(held, lambda b: b["text"]), "\n\n")
    return parsed.select("page_id", "url", "host", "blocks").join(removed, "host", "left").select(F.col("page_id").alias(key), F.col("url").alias(url), text.alias("text"))
