"""Main text of web pages by a site style tree.

The element trees of all pages of a host are merged by style path (tags and
class names from the root). A merged node has two importances in 0 to 1: that
of its presentation, the entropy of the child sequences seen under it, and
that of its content, which is low where the same content stands on many pages.
Whole trees are merged, menus and footers too. Branches of low importance go;
as a second signal, so do elements whose tag, role or class says that they are
no article text (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, reader comments), on sites with too few pages the only one. Neither
importance nor a class name nor a form drops ``html``, ``body`` or a branch that holds most of its page's text. Where
a page marks its article (``article`` or ``main``) and most of the text that
stays is in it, text outside it goes too; running text inside it always stays.
Importance counts pages with equal blocks once, and inside articles equal
articles: copies of an article on one host don't make it boilerplate.

Pages are parsed twice; what is merged are counts of different pages per host,
path and content. Equal features of copies fall together before they are
shuffled, and the page is part of the key, so a host with a third of all pages
is no hot key.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_batches, materialize

#: Pages that must share a path before entropy says anything about it.
MIN_PAGES = 5
LOW_IMPORTANCE = 0.25
#: Share of presentation in a node's importance.
PRESENTATION = 0.1

# Element kinds of HTML and words in class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr label""".split())
RAW = frozenset("script style textarea title noscript template xmp iframe".split())
NEVER = frozenset("""head script style noscript template iframe object embed svg canvas nav footer aside
button select option input textarea fieldset menu audio video""".split())
OUTSIDE_NEVER = frozenset("header math label dialog map".split())
ARTICLE = frozenset(("article", "main"))
RUNNING = frozenset("""p h1 h2 h3 h4 h5 h6 blockquote pre article main body html br b i em strong a span td th tr table
tbody figcaption figure dl dt dd""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
SIGNS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar
navigation menu breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices popup modal
newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments
disqus replies reply widget widgets toolbar pagination pager skip alert form search""".split())
OUTSIDE_SIGNS = frozenset("header head top topbar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)|([^<]+|<)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[^a-z]+")
_CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3
h4 h5 h6 header hr main menu nav ol p pre section table ul""".split())
_SAME = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
         "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}


class _Node:
    __slots__ = ("tag", "path", "gone", "named", "article", "up", "size", "children", "text", "mute")

    def __init__(self, tag: str, path: str, gone: bool, named: bool, article: bool, up: "_Node | None"):
        self.tag, self.path, self.gone, self.named, self.article, self.up = tag, path, gone, named, article, up
        self.mute = tag == "head" or (up is not None and up.mute)
        self.size = 0
        self.children: list[str] = []
        self.text: list[str] = []


def _says_no(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """Whether the kind, role or state of an element says that it is no article text."""
    if tag in NEVER or (tag in OUTSIDE_NEVER and not in_article):
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    return attrs.get("role", "").lower() in ROLES


def _named(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """Whether it is a form, or a part of its class or id says so."""
    if tag == "form":
        return True
    if not attrs or tag in ("html", "body", *ARTICLE):
        return False
    parts = {p for k in ("class", "id") if k in attrs for p in _PART.split(attrs[k].lower())}
    return not parts.isdisjoint(SIGNS) or (not in_article and not parts.isdisjoint(OUTSIDE_SIGNS))


def parse(html: str):
    """Blocks of text in page order, ``(text, chain of nodes, in article)``, all nodes and the size of the text.

    ``text`` of a node are all blocks under it, those included that its kind
    or name says are no article text; scripts, styles and the head have none.
    """
    stack = [_Node("", "", False, False, False, None)]
    nodes: list[_Node] = []
    blocks: list[tuple[str, tuple[_Node, ...], bool]] = []
    buffer: list[str] = []

    def flush():
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                chain = tuple(n for n in stack if n.path)
                for n in chain:
                    n.text.append(text)
                if stack[-1].gone:
                    return
                blocks.append((text, chain, stack[-1].article))
                for n in chain:
                    n.size += len(text)

    def close(k: int):
        flush()
        del stack[k:]

    at, end = 0, len(html)
    find = _TOKEN.match
    while at < end:
        m = find(html, at)
        if m is None:  # a tag that never ends
            break
        at = m.end()
        text = m[4]
        if text is not None:
            if not stack[-1].mute:
                buffer.append(entities.unescape(text) if "&" in text else text)
            continue
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in INLINE or tag in VOID:
                if tag == "br":
                    buffer.append(" ")
                elif len(stack) > 1 and stack[-1].tag == tag:  # an inline element kept on the stack for its class
                    close(len(stack) - 1)
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
            else:
                flush()
            continue
        if tag == "br" or tag == "hr":
            buffer.append(" ")
            continue
        if tag in VOID:
            continue
        raw = m[3]
        attrs = {}
        if raw and "=" in raw or raw and "hidden" in raw:
            attrs = {k.lower(): (a or b or c or "") for k, a, b, c in _ATTR.findall(raw)}
        if tag in INLINE:
            if not (_says_no(tag, attrs, stack[-1].article) or _named(tag, attrs, stack[-1].article)):
                continue
        else:
            flush()
            if tag in _CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        close(k)
                        break
                    if stack[k].tag not in INLINE:
                        break
            elif tag in _SAME:
                same, stop = _SAME[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in stop:
                        break
                    if stack[k].tag in same.split():
                        close(k)
                        break
        top = stack[-1]
        article = top.article or tag in ARTICLE
        style = tag + ("." + ".".join(sorted(attrs["class"].split())) if attrs.get("class") else "")
        top.children.append(style)
        node = _Node(tag, f"{top.path}/{style}", top.gone or _says_no(tag, attrs, top.article), _named(tag, attrs, top.article), article, top)
        nodes.append(node)
        if raw and raw.endswith("/") and tag not in RAW and tag in ("svg", "path", "circle", "use", "rect"):
            continue
        if tag in RAW:  # their content is no markup
            stop = re.compile(rf"</{tag}\s*>?", re.I).search(html, at)
            inner = html[at:stop.start() if stop else end]
            at = stop.end() if stop else end
            if not node.gone and inner:
                buffer.append(entities.unescape(inner))
                stack.append(node)
                close(len(stack) - 1)
            continue
        stack.append(node)
    flush()
    total = sum(len(text) for text, _, _ in blocks)
    for n in nodes:  # parents come first
        n.gone = n.gone or n.up.gone or (n.named and 2 * n.size <= total)
    blocks = [b for b in blocks if not (b[1] and b[1][-1].gone)]
    return blocks, [n for n in nodes if not n.mute and n.tag not in INLINE and n.tag not in RAW], total


def node_features(html: str | None) -> list[tuple[str, int, int, int]]:
    """For each merged-tree node of a page its presence (0), content (1) and presentation (2), each once, with a hash of
    the blocks whose copies count once: those of the page, inside an article those of the article."""
    if not html:
        return []
    out = set()
    blocks, nodes, _ = parse(html)
    copy = [xxhash.xxh3_64_intdigest("\n".join(text for text, _, article in blocks if article >= inside)) >> 1 for inside in (False, True)]
    for n in nodes:
        out.add((n.path, 0, 0, copy[n.article]))
        out.add((n.path, 2, xxhash.xxh3_64_intdigest(" ".join(n.children)) >> 1, copy[n.article]))
        if n.text:
            out.add((n.path, 1, xxhash.xxh3_64_intdigest(" ".join(n.text)) >> 1, copy[n.article]))
    return list(out)


def main_text(html: str | None, low: frozenset[str]) -> str:
    """Text of the page's article; ``low`` are the host's paths of low importance."""
    if not html:
        return ""
    blocks, _, total = parse(html)

    def stays(n: _Node, article: bool) -> bool:
        return n.path not in low or n.tag in ("html", "body") or 2 * n.size > total or (article and n.tag in RUNNING)
    kept = [(text, article) for text, chain, article in blocks if not low or all(stays(n, article) for n in chain)]
    marked = 2 * sum(len(text) for text, article in kept if article) >= sum(len(text) for text, _ in kept)
    return " ".join(text for text, article in kept if article or not marked)


def host_column(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def style_importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, path, pages, importance`` of every node of the merged trees; copies of a page or article count once."""
    @F.pandas_udf("array<struct<path:string,kind:int,value:long,copy:long>>")
    def features(htmls: pd.Series) -> pd.Series:
        return pd.Series([node_features(h) for h in htmls], dtype=object)

    seen = (pages.select(host_column(F.col(url_col)).alias("host"), F.explode(features(F.col(html_col))).alias("f"))
            .select("host", "f.*").distinct()
            .groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n")))
    n = F.col("n").cast("double")
    per = seen.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 1, F.log(n))).alias("content_logs"),
        F.sum(F.when(F.col("kind") == 1, 1)).alias("contents"),
        F.sum(F.when(F.col("kind") == 2, n * F.log(n))).alias("style_logs"))
    m = F.log(F.col("pages").cast("double"))
    content = F.when(F.col("contents") > 0, 1 - F.col("content_logs") / F.col("contents") / m).otherwise(F.lit(1.0))
    presentation = 1 - F.col("style_logs") / F.col("pages") / m
    value = F.when(F.col("pages") < 2, F.lit(1.0)).otherwise(PRESENTATION * presentation + (1 - PRESENTATION) * content)
    return per.select("host", "path", "pages", value.alias("importance"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      min_pages: int = MIN_PAGES, low_importance: float = LOW_IMPORTANCE) -> DataFrame:
    """``page_id, url, text`` of every page; null or empty HTML gives an empty text.

    Pages without a host, or whose url is null, are merged as one site.
    """
    bounded_batches(pages.sparkSession)
    low = (style_importance(pages, url_col, html_col)
           .filter((F.col("pages") >= min_pages) & (F.col("importance") < low_importance)))
    low = materialize(low.groupBy("host").agg(F.collect_list("path").alias("low")), "site-styles")
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                       host_column(F.col(url_col)).alias("host"))

    @F.pandas_udf("string")
    def text(htmls: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, frozenset(p) if p is not None else frozenset()) for h, p in zip(htmls, paths, strict=True)], dtype=object)

    return own.join(low, "host", "left").select("page_id", "url", text("html", "low").alias("text"))
