"""Operator 1: main text of web pages, from templates deduced by equivalence classes.

Tokens of a page are its elements, named by their path of structural tags with
class and id, and its texts, each with its path. Over all pages of a host a token
has an occurrence vector: how often it is on each page. Tokens with the same
vector are a class; a class is valid if enough pages have it and its members
occur once on each. A vector is kept as one number that tasks combine (the sum of
a hash of page and count, by 2^64, so that repeated pages do not cancel), so that
a host of any size is one aggregation and no task gathers it.

Valid classes are nested by their paths into the host's template, and what lies
between their members are slots. The main slot of a class is the deepest member
element that holds all of the class's text but for texts of the template and for
menus, headers, footers, sidebars, notices, adverts, forms and comment lists (told
by tag, role, class and id). A slot within an ``article`` or ``main`` element is
that whole element, whose headline and lead may stand outside the slot. A page's
text is what is in the main slot of its most widespread class, without such
parts, and, outside articles, without texts of the template. Pages that share no
class (hosts with fewer than ``MIN_PAGES`` pages) use their own ``article`` or
``main`` element, or else the whole body, by the same rule; where a page has such
an element and the classes point elsewhere, the element stands. So on pages with
articles the classes decide which of several articles is the main one, and on all
others they decide everything.

Character references are decoded, white space in a block becomes one space,
blocks are joined by line feeds in page order.

Rows: null and empty pages have an empty text; a null url is a host of its own;
repeated pages count as pages; every row gives one row and carries its columns
in ``row``. A very long page is taken apart by one task, as any other; of slots
of one depth the last by name is taken. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import released, written

#: Pages that must share a class, and the share of a host's pages.
MIN_PAGES, MIN_SHARE = 3, 0.05

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style template noscript iframe object svg math canvas textarea title select button head".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Blocks that hold text and no part of a page: they are no step of a path.
LEAVES = frozenset("address blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 hr li p pre summary tbody td tfoot th thead tr".split())
#: Elements that a start tag of the same group ends.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "p": ("p",)}
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BOILER_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe social share sharing sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs comment comments disqus reply replies related recommended masthead footer toolbar "
    "pagination pager widget login signup search skip".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPLIT = re.compile(r"[^a-zA-Z]+")
_CONTENT = re.compile(r"(?:^|/)(?:article|main)\b")


def _element(name: str, attributes: str, inside: bool) -> tuple[str, bool]:
    """How an element is named in a path, and whether it begins something that is no content."""
    if not attributes or attributes.isspace():
        return name, name in BOILER_TAGS or (name == "header" and not inside)
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    names = " ".join(filter(None, (found.get("class"), found.get("id"))))
    words = {w.lower() for w in _SPLIT.split(names)}
    boiler = (name in BOILER_TAGS or (name == "header" and not inside) or not words.isdisjoint(BOILER_WORDS)
              or ("header" in words and not inside) or found.get("role", "").lower() in BOILER_ROLES
              or found.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) is not None
              or "display:none" in found.get("style", "").replace(" ", "").lower())
    return name + "".join("." + w for w in names.split()), boiler and name not in ("html", "body", "article", "main")


def blocks(html: str) -> Iterator[tuple[str, bool, str]]:
    """The text blocks of a page in order: path, whether it is boilerplate, text."""
    stack: list[tuple[str, str, bool]] = []
    pieces: list[str] = []
    at, end = 0, len(html)

    def flush() -> Iterator[tuple[str, bool, str]]:
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            yield (stack[-1][1], stack[-1][2], text) if stack else ("", False, text)

    while at < end:
        found = _TOKEN.search(html, at)
        if not found:
            break
        if found.start() > at:
            pieces.append(html[at:found.start()])
        at = found.end()
        closing, name, rest = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
        if name is None:
            continue
        name = name.lower()
        if name in RAW:
            if not closing and not rest.endswith("/"):
                stop = re.compile(f"</{name}(?:[\\s/][^>]*)?>", re.I).search(html, at)
                at = stop.end() if stop else (end if name != "head" else at)
            continue
        if name == "br":
            pieces.append(" ")
        if name not in BLOCKS:
            continue
        yield from flush()
        if closing:
            for i in reversed(range(len(stack))):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        while stack and stack[-1][0] == "p" and name != "p":
            stack.pop()
        if stack and stack[-1][0] in ENDS.get(name, ()):
            stack.pop()
        if name in VOID:
            continue
        path, boiler = (stack[-1][1], stack[-1][2]) if stack else ("", False)
        step, own = _element(name, rest, _CONTENT.search(path) is not None)
        if name not in LEAVES or own:
            path = f"{path}/{step}" if path else step
        stack.append((name, path, boiler or own))
    if at < end:
        pieces.append(html[at:].split("<")[0] if _unfinished(html[at:]) else html[at:])
    yield from flush()


def _unfinished(rest: str) -> bool:
    """Whether a page ends within a tag."""
    return re.search(r"</?[a-zA-Z][^>]*\Z", rest) is not None


def _hash(*parts) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(map(str, parts))) - 2**63


def _tokens(html: str) -> dict[tuple[str, str], tuple[int, int]]:
    """Per token (path, text or ''): how often it is on the page, and the characters of content in it.

    An element's count is the number of separate runs of blocks below its path.
    """
    counts: dict[tuple[str, str], list[int]] = {("", ""): [1, 0]}
    open_: tuple[str, ...] = ()
    for path, boiler, text in blocks(html):
        steps = path.split("/") if path else []
        paths = tuple("/".join(steps[:i + 1]) for i in range(len(steps)))
        for i, p in enumerate(paths):
            entry = counts.setdefault((p, ""), [0, 0])
            if i >= len(open_) or open_[i] != p:
                entry[0] += 1
            if not boiler:
                entry[1] += len(text)
        open_ = paths
        own = counts.setdefault((path, text), [0, 0])
        own[0] += 1
        if not boiler:
            counts["", ""][1] += len(text)
            own[1] += len(text)
    return {k: (a, b) for k, (a, b) in counts.items()}


def _occurrences(pages: DataFrame) -> DataFrame:
    """Per host and token: its vector, the pages that have it, how often, and the content in it."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[str, str, str], list[int]] = {}
            for host, key, html in zip(*(batch[n].to_pylist() for n in ("host", "key", "html"))):
                for (path, text), (n, chars) in _tokens(html or "").items():
                    entry = held.setdefault((host, path, text), [0, 0, 0, 0])
                    entry[0] = (entry[0] + _hash(key, n) + 2**63) % 2**64 - 2**63
                    entry[1] += 1
                    entry[2] += n
                    entry[3] += chars
            keys, values = list(held), list(held.values())
            yield pa.record_batch({
                "host": pa.array([k[0] for k in keys], pa.string()), "path": pa.array([k[1] for k in keys], pa.string()),
                "text": pa.array([_hash(k[2]) if k[2] else None for k in keys], pa.int64()),
                **{n: pa.array([v[i] for v in values], pa.int64()) for i, n in enumerate(("vector", "pages", "uses", "chars"))}})

    rows = pages.select("host", F.xxhash64("url", "page_id", "html").alias("key"), "html").mapInArrow(
        counted, "host string, path string, text bigint, vector bigint, pages bigint, uses bigint, chars bigint")
    # Tasks have reduced by 2^64 already, so the sum of their sums has to be.
    vector = F.pmod(F.sum(F.col("vector").cast("decimal(38,0)")), F.lit(Decimal(2**64)))
    return rows.groupBy("host", "path", "text").agg(vector.alias("vector"), *[F.sum(n).alias(n) for n in ("pages", "uses", "chars")])


def deduce_templates(pages: DataFrame) -> DataFrame:
    """Per host: ``mains``, the main slots of its valid classes, most widespread first, and ``fixed``,
    the texts of its template (hashes of their path and text)."""
    tokens = written(_occurrences(pages), "tokens")
    known = tokens.filter("path = '' AND text IS NULL").select("host", F.col("pages").alias("all"))
    valid = (tokens.filter((F.col("uses") == F.col("pages")) & (F.col("pages") >= MIN_PAGES)).join(known, "host")
                   .filter(F.col("pages") >= F.col("all") * MIN_SHARE))
    texts = valid.filter(F.col("text").isNotNull() & (F.col("pages") * 2 >= F.col("all")))
    # What an element holds beside the template's own texts.
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    stated = texts.filter("chars > 0 AND path <> ''").select("host", F.explode(above).alias("path"), "chars") \
        .groupBy("host", "path").agg(F.sum("chars").alias("stated"))
    held = (valid.filter("text IS NULL AND path <> ''").join(stated, ["host", "path"], "left")
                 .withColumn("chars", F.col("chars") - F.coalesce("stated", F.lit(0))))
    most = held.groupBy("host", "vector").agg(F.max("chars").alias("most"), F.count("*").alias("size"))
    mains = (held.join(most.filter("size >= 2 AND most > 0"), ["host", "vector"]).filter("chars >= most")
                 .groupBy("host", "vector").agg(
                     F.max(F.struct(F.size(F.split("path", "/")).alias("depth"), "path", "pages")).alias("main"))
                 .groupBy("host").agg(F.transform(
                     F.sort_array(F.collect_list(F.struct("main.pages", "main.path")), asc=False),
                     lambda x: x["path"]).alias("mains")))
    fixed = texts.groupBy("host").agg(F.collect_set(F.struct("path", "text")).alias("fixed"))
    return known.select("host").join(mains, "host", "left").join(fixed, "host", "left")


def _within(path: str, main: str) -> bool:
    return path == main or path.startswith(main + "/")


def _whole(main: str) -> str:
    """The article or main element that ``main`` lies in, or ``main`` itself."""
    steps = main.split("/")
    own = next((i for i, step in enumerate(steps) if _CONTENT.search(step)), len(steps))
    return "/".join(steps[:own + 1])


def main_text(html: str, mains: list[str], fixed: set[tuple[str, int]]) -> str:
    """The text of a page's main slot."""
    found = list(blocks(html))
    content = [(p, t) for p, boiler, t in found if not boiler]
    main = next((m for m in map(_whole, mains) if any(_within(p, m) for p, _ in content)), None)
    if main is None or not _CONTENT.search(main):
        # Semantic elements of the page itself are more exact than a plain container.
        own = [p for p, _ in content if _CONTENT.search(p)]
        if own:
            return "\n".join(t for p, t in content if _CONTENT.search(p))
    if main is not None:
        content = [(p, t) for p, t in content if _within(p, main)]
    return "\n".join(t for p, t in content if _CONTENT.search(p) or (p, _hash(t)) not in fixed)


def extract(pages: DataFrame) -> DataFrame:
    """``row`` (all columns of ``pages``: page_id, url, html), and the main ``text``."""
    host = F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))
    keyed = pages.select(F.struct("*").alias("row"), F.lower(host).alias("host"), "url", "page_id", "html")
    templates = written(deduce_templates(keyed), "templates")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html or "", mains or [], {(x["path"], x["text"]) for x in fixed or []})
                     for html, mains, fixed in zip(*(batch[n].to_pylist() for n in ("html", "mains", "fixed")))]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(texts, pa.string())], names=["row", "text"])

    return (keyed.select("row", "host", "html").join(templates, "host").select("row", "html", "mains", "fixed")
                 .mapInArrow(released(extracted), StructType([keyed.schema["row"], StructField("text", StringType())])))
