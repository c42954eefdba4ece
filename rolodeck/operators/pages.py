"""Text, links, contacts and technology of stored pages.

Only the extraction of readable text needs a parser; it is the standard library's, inside Arrow batches. All else are column functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import row_slices
from ..functions import text as X
from .matching import containing


@dataclass(frozen=True)
class Block:
    """Elements whose text is read: by selectors (``tag``, ``class*=x``, ``class~=x``, ``id*=x``, ``id=x``, ``role=x``), in this order, so many of each.

    Texts up to ``over`` characters are left out. ``only``: of the first selector that hits, only the first element.
    """

    selectors: tuple[str, ...]
    most: int
    over: int
    joint: str = " "
    only: bool = False


@dataclass(frozen=True)
class TextRules:
    skip: tuple[str, ...]
    blocks: tuple[Block, ...]
    longest: int
    body_below: int = 0  # with less text than this the whole body is read, if that is more


#: What is read of a site's page, and of a section's.
SITE_RULES = TextRules(
    ("script", "style", "noscript", "iframe"),
    (
        Block(("h1", "class*=hero", "class*=headline", "class*=banner", "class*=intro"), 3, 10, ""),
        Block(("class*=about", "id*=about", "class*=who-we-are", "class*=company"), 2, 30),
        Block(("class*=service", "class*=product", "class*=solution", "class*=offer"), 3, 20),
        Block(("main", "role=main", "class*=content"), 1, 50, only=True),
    ),
    2000,
    100,
)
SECTION_RULES = TextRules(
    ("script", "style", "noscript", "iframe", "nav", "header", "footer"),
    (Block(("h1", "h2", "h3", "class*=hero", "class*=headline", "class*=banner", "class*=about", "id*=about", "class*=service", "class*=solution", "main", "role=main", "article", "class~=content", "id=content", "class*=content"), 5, 20),),
    3000,
)
#: Bytes of pages that are answered at once.
SLICE = 4 << 20
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@lru_cache
def _selectors(rules: TextRules) -> tuple[dict[str, list[str]], dict[str, list[tuple[str, str, str]]], dict[str, int]]:
    """The rules' selectors by tag, and by attribute as (sign, value, selector); how many elements each takes."""
    limits = {s: b.most for b in rules.blocks for s in b.selectors} | {"body": 1}
    tags: dict[str, list[str]] = {}
    attributes: dict[str, list[tuple[str, str, str]]] = {}
    for s in limits:
        m = re.fullmatch(r"(\w+)([*~]?=)(.+)", s)
        if m:
            attributes.setdefault(m[1], []).append((m[2], m[3], s))
        else:
            tags.setdefault(s, []).append(s)
    return tags, attributes, limits


def _hit(sign: str, value: str, has: str) -> bool:
    return value in has if sign == "*=" else value in has.split() if sign == "~=" else has == value


class _Reader(HTMLParser):
    """Collects the text nodes of the elements that selectors hit, in document order."""

    def __init__(self, rules: TextRules):
        super().__init__(convert_charrefs=True)
        self.skip = set(rules.skip)
        self.tags, self.attributes, self.limits = _selectors(rules)
        self.found: dict[str, list[list[str]]] = {s: [] for s in self.limits}
        self.stack: list[tuple[str, bool, list[list[str]]]] = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        hidden = tag in self.skip or bool(self.stack) and self.stack[-1][1]
        opened = []
        if not hidden:
            hits = [*self.tags.get(tag, ())]
            for name, has in dict(attrs).items():
                hits += [s for sign, value, s in self.attributes.get(name, ()) if _hit(sign, value, has or "")]
            for selector in hits:
                if len(self.found[selector]) < self.limits[selector]:
                    self.found[selector].append([])
                    opened.append(self.found[selector][-1])
        self.stack.append((tag, hidden, opened))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        text = data.strip()
        if text and not (self.stack and self.stack[-1][1]):
            for _, _, opened in self.stack:
                for nodes in opened:
                    nodes.append(text)


def page_text(html: str | None, rules: TextRules) -> str:
    """The readable text of a page by the rules; blanks squeezed. A null or empty page has none."""
    if not html:
        return ""
    reader = _Reader(rules)
    reader.feed(html)
    reader.close()
    out = []
    for block in rules.blocks:
        for selector in block.selectors:
            texts = [block.joint.join(nodes) for nodes in reader.found[selector]]
            out += [t for t in texts if len(t) > block.over]
            if block.only and texts:
                break
    text = " ".join(out)
    if len(text) < rules.body_below and reader.found["body"]:
        body = " ".join(" ".join(reader.found["body"][0]).split())
        text = max(text, body, key=len)
    return " ".join(text.split())[: rules.longest]


def with_text(pages: DataFrame, rules: TextRules = SITE_RULES, html: str = "html", into: str = "content") -> DataFrame:
    """pages without html, and its readable text. Narrow; a page is parsed on its own, and only its text is kept as Python's beside a batch as Arrow's. A column that is named as ``into`` already is an error."""
    kept = [c for c in pages.columns if c != html]
    if into.lower() in {c.lower() for c in kept}:
        raise ValueError(f"a column {into} exists already; choose another with into=")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, html, SLICE):
            texts = pa.array([page_text(h.as_py(), rules) for h in batch.column(html)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], names=[*kept, into])
            del batch, texts  # the next batch is read before these names are taken again

    return pages.mapInArrow(run, pages.drop(html).withColumn(into, F.lit("")).schema)


def page_status(content: Column, http_code: Column) -> Column:
    """success, no_content (under 50 characters), or the class of the HTTP code."""
    return F.when(http_code >= 400, F.concat(F.lit("http_"), http_code.cast("string"))).when(F.length(X.blank_if_null(content)) < 50, "no_content").otherwise("success")


def site_rollup(pages: DataFrame, site: str, section: Column, text: str, order: str, per_page: int = 3000, whole: int = 10_000) -> DataFrame:
    """(site, content): the first page of each section, in order, each cut, until the whole is full. A page without a section is left out.

    Sections are few, so a site is a few short texts after the first aggregation, whatever its number of pages.
    """
    rows = pages.select(F.col(site).alias("site"), section.alias("section"), F.col(order).alias("o"), F.substring(X.blank_if_null(F.col(text)), 1, per_page).alias("t")).filter("section is not null")
    first = rows.groupBy("site", "section").agg(F.min(F.struct("o", "t")).alias("x"))
    before = F.coalesce(F.sum(F.length("x.t")).over(Window.partitionBy("site").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = first.withColumn("left", F.lit(whole) - before).filter("left > 0").withColumn("t", F.substr(F.col("x.t"), F.lit(1), F.col("left").cast("int")))
    return cut.groupBy("site").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "t"))), lambda x: x["t"]), "\n").alias("content"))


def contact_links(pages: DataFrame, patterns: DataFrame, url: str = "url", html: str = "html", key: str = "page_id", most: int = 5) -> DataFrame:
    """(key, rank, link): up to five links of a page, by first appearance, that hold a pattern and lead to the same host."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""href=["']([^"'#?]+)"""), F.lit(1))
    host = F.try_parse_url(F.col(url), F.lit("HOST"))
    links = pages.select(key, host.alias("host"), F.posexplode(hrefs).alias("pos", "href"))
    full = F.when(F.col("href").startswith("/") & ~F.col("href").startswith("//"), F.concat(F.lit("https://"), "host", "href")).when(F.col("href").rlike("^https?://"), F.col("href"))
    same = links.withColumn("link", full).filter(F.try_parse_url("link", F.lit("HOST")) == F.col("host"))
    hit = containing(same, F.lower("href"), patterns.select("pattern").distinct(), "pattern")
    first = hit.groupBy(key, "link").agg(F.min("pos").alias("pos"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("pos")).cast("long")).filter(F.col("rank") <= most).select(key, "rank", "link")


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
SOCIAL = ("facebook", "instagram", "linkedin", "twitter", "youtube", "tiktok")


def contacts(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """(key, emails, phones, and a link for each social network) found in a page."""
    h = F.col(html)
    every = lambda p, g=0: F.array_distinct(F.regexp_extract_all(h, F.lit(p), F.lit(g)))
    host = r"https?://(?:www\.)?"
    links = F.regexp_extract_all(h, F.lit(rf"""href=["']({host}(?:{'|'.join(SOCIAL)})\.com/[^"']+)"""), F.lit(1))  # of all networks in one pass
    of = lambda s: F.coalesce(F.get(F.filter("_links", lambda x: x.rlike(rf"^{host}{s}\.com/")), F.lit(0)), F.lit(""))
    found = pages.select(key, every(EMAIL).alias("emails"), every(r"""tel:([+0-9() -]{6,20})""", 1).alias("phones"), links.alias("_links"))
    return found.select(key, "emails", "phones", *[of(s).alias(s) for s in SOCIAL])


def bundle(pages: DataFrame, site: str, main: Column, text: str, order: str, longest: int = 50_000, most: int = 6) -> DataFrame:
    """(site, bundle): the main page, then the first others, under headings, cut at the end."""
    rows = pages.select(F.col(site).alias("site"), F.when(main, 0).otherwise(1).alias("kind"), F.col(order).alias("o"), F.substring(X.blank_if_null(F.col(text)), 1, longest).alias("t"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("site").orderBy("kind", "o"))).filter(F.col("r") <= most)
    heading = F.when(F.col("kind") == 0, "== main ==\n").otherwise("== page ==\n")
    lists = ranked.groupBy("site").agg(F.array_sort(F.collect_list(F.struct("r", F.concat(heading, "t").alias("t")))).alias("ts"))
    return lists.select("site", F.substring(F.array_join(F.transform("ts", lambda x: x["t"]), "\n"), 1, longest).alias("bundle"))


#: Marks of content systems and frameworks, in order; their case does not matter.
CMS = [
    ("WordPress", r"/wp-content/|/wp-includes/|wp-json"),
    ("WordPress", r"""<meta\s+name=["']generator["']\s+content=["']WordPress"""),
    ("Shopify", r"cdn\.shopify\.com|Shopify\.theme"),
    ("Squarespace", r"squarespace\.com|data-squarespace"),
    ("Wix", r"static\.wixstatic\.com|X-Wix-"),
    ("Weebly", r"weebly\.com|weebly-footer"),
    ("Google Sites", r"sites\.google\.com|googleusercontent\.com/site"),
    ("Webflow", r"webflow\.com|data-wf-"),
    ("Ghost", r"ghost\.org|ghost-api"),
    ("Joomla", r"joomla|/administrator/"),
    ("Drupal", r"drupal\.org|Drupal\.settings"),
]
FRAMEWORKS = [
    ("Next.js", r"__NEXT_DATA__|_next/static"),
    ("Nuxt.js", r"__NUXT__|_nuxt/"),
    ("React", r"data-reactroot|react-dom"),
    ("Angular", r"ng-version|angular\.js"),
    ("Vue.js", r"data-v-[a-f0-9]|Vue\.config"),
    ("Svelte", r"svelte-|__svelte"),
]


def first_match(c: Column, patterns: list[tuple[str, str]]) -> Column:
    out = F.lit(None).cast("string")
    for name, p in reversed(patterns):
        out = F.when(c.rlike(f"(?i){p}"), F.lit(name)).otherwise(out)
    return out


def technology(pages: DataFrame, html: str = "html", headers: str | None = None, key: str = "page_id", cms: list[tuple[str, str]] = CMS, frameworks: list[tuple[str, str]] = FRAMEWORKS) -> DataFrame:
    """(key, cms, framework, server), empty where nothing is found. headers: a column with the answer's headers (map), which are searched for content systems too."""
    text = X.blank_if_null(F.col(html))
    if headers is None:
        return pages.select(key, X.blank_if_null(first_match(text, cms)).alias("cms"), X.blank_if_null(first_match(text, frameworks)).alias("framework"), F.lit("").alias("server"))
    h = F.col(headers)
    either = lambda a, b: X.first_present(F.try_element_at(h, F.lit(a)), F.try_element_at(h, F.lit(b)))
    lines = F.array_join(F.transform(F.map_entries(h), lambda e: F.concat(e["key"], F.lit(": "), X.blank_if_null(e["value"]))), " ")
    combined = F.concat_ws(" ", text, either("x-powered-by", "X-Powered-By"), lines)
    return pages.select(key, X.blank_if_null(first_match(combined, cms)).alias("cms"), X.blank_if_null(first_match(text, frameworks)).alias("framework"), either("server", "Server").alias("server"))


def is_ssl(url: Column) -> Column:
    return X.with_scheme(X.blank_if_null(url)).startswith("https")
