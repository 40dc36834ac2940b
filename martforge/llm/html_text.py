"""Main text of web pages by tree scoring.

A page is read into a tree of block elements.  Every paragraph earns points
(one, one for each comma, up to three for length) and passes them to its
parent, half of them to its grandparent and ever less further up; an element's
points are discounted by its link density.  The element with the most points
is the article; siblings that read like part of it are kept with it, and so
are those between them that are not mostly links.  Inside the article nothing
more is left out, unless it is the whole body: there, lists and boxes of links
without a name are taken for menus.  What can
never be article text (menus, forms, scripts, ...) is cut while reading; so is
what is named for something else (adverts, comments, ...), unless the page
would then be empty.  A head ends at the first element or text that cannot
stand in it, a nav or header that is never closed at an article; a form, nav or
header that holds nearly all text of the page is read like any other element if
there is prose in it.

The work per page is a small function; Spark deals out the pages and nothing
is shuffled.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm.common import read

# fixed values: element names of HTML, by their role here
BLOCK = frozenset(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre form fieldset header footer nav aside figure figcaption address hr details summary center dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUT = frozenset(
    "head title nav footer aside form button select option textarea label noscript template iframe object svg math canvas "
    "audio video dialog menu".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
HEAD = frozenset("html head base link meta title style script noscript template".split())  # what leaves an open head open
SPARED = ("form", "nav", "header")  # read if they hold nearly all text
#: a start tag closes an open element of the same family
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
#: a closing search stops at these
FENCE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
         "thead": ("table",), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}
#: fixed values: words in a class or id that name something beside the article
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notices?|alert|popup|modal|sidebar|side|widget|menu|nav\w*|"
    r"breadcrumbs?|header|masthead|footer|foot|comments?|disqus|respond|reply|replies|share|sharing|social|related|recommend\w*|newsletter|"
    r"subscribe|signup|login|pagination|pager|toolbar|skip|search|copyright|legal|contentinfo|complementary|disclaimer|tags?|byline|meta)(?:$|[\s_-])", re.I)
#: fixed values: whole names that mark the article, whatever stands beside them
CONTENT = frozenset(
    "article content main post entry story post-content entry-content article-body article-content main-content post-body "
    "story-body page-content".split())
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

PARAGRAPH_POINTS = 1.0
LENGTH_PER_POINT, LENGTH_POINTS = 100, 3
SIBLING_SHARE = 0.2
LINK_BOX = 0.6  # link density beyond which an element is a box of links
HOLDS = 0.8  # share of the text, for a spared element
PROSE_CHARS, PROSE_LINKS = 80, 0.25  # the least of a prose block, and its most link density
ARTICLE_BONUS = {"article": 10.0, "main": 5.0}


class Node:
    __slots__ = ("tag", "parent", "kids", "cut", "points", "chars", "links")

    def __init__(self, tag: str, parent: Node | None, cut: str):
        self.tag, self.parent, self.cut = tag, parent, cut  # cut: the tag that cut it, "several", or empty
        self.kids: list[Node | str] = []  # elements and finished text blocks, in page order
        self.points = 0.0
        self.chars = self.links = 0


def _beside(tag: str, attributes: str, inside_article: bool, by_name: bool, spared: frozenset[str]) -> bool:
    if (tag in CUT or (tag == "header" and not inside_article)) and tag not in spared:
        return True
    if not by_name or not attributes or tag in ("html", "body", "article", "main"):
        return False
    names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes)).lower()
    return bool(names) and bool(BESIDE.search(names)) and CONTENT.isdisjoint(names.split())


class Closed:
    """Whether the elements of one tag that are open at a place are closed behind it."""

    def __init__(self, page: str, tag: str):
        self.steps = [(m.end(), -1 if m[0][1] == "/" else 1) for m in re.finditer(rf"</?{tag}(?=[\s/>])", page, re.I)]
        self.places = [at for at, _ in self.steps]
        self.behind = [0]  # tags that close less those that open, from each step on
        for _, step in reversed(self.steps):
            self.behind.append(self.behind[-1] - step)
        self.behind.reverse()

    def all(self, at: int, depth: int) -> bool:
        return self.behind[bisect_left(self.places, at)] >= depth


def parse(page: str, by_name: bool = True, spared: frozenset[str] = frozenset(), lost: dict[str, int] | None = None) -> Node:
    """Tree of block elements; a finished text block is a string among its element's kids.

    spared: tags that do not cut; lost: gets the characters that each tag cut alone."""
    root = node = Node("#root", None, "")
    lost = {} if lost is None else lost
    closed: dict[str, Closed] = {}
    text: list[str] = []
    linked = 0  # characters of the open block that stand in links
    in_link = False
    article = 0

    def flush() -> None:
        nonlocal linked
        block = " ".join(html.unescape("".join(text)).split()) if text else ""
        text.clear()
        if block and not node.cut:
            node.kids.append(block)
            node.chars += len(block)
            node.links += min(linked, len(block))
        linked = 0

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        if m is None:  # a tag that never ends is text
            text.append(page[at])
            at += 1
            continue
        at = m.end()
        closing, name, attributes, chunk = m.groups()
        if chunk is not None:
            if node.tag == "head" and chunk.strip():
                node = _above(node, "head")
            if not node.cut:
                text.append(chunk)
                if in_link:
                    linked += len(chunk.strip())
            else:
                lost[node.cut] = lost.get(node.cut, 0) + len(chunk.strip())
            continue
        if name is None:
            continue
        tag = name.lower()
        if closing:
            if tag == "a":
                in_link = False
            elif tag in BLOCK or tag in CUT:
                open_ = node
                while open_.parent is not None and open_.tag != tag:
                    open_ = open_.parent
                flush()
                if open_.parent is not None:
                    article -= _articles(node, open_)
                    node, in_link = open_.parent, False
            continue
        if node.tag == "head" and tag not in HEAD:
            node = _above(node, "head")
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag == "a":
            in_link = True
        elif tag == "br":
            text.append(" ")
        if tag not in BLOCK and not (tag in CUT and tag not in VOID):
            continue
        flush()
        if tag in VOID:
            continue
        in_link = False
        if tag in BLOCK and node.tag == "p":
            node = node.parent
        for family in CLOSES.get(tag, ()):
            open_ = node
            while open_.parent is not None and open_.tag != family and open_.tag not in FENCE[tag]:
                open_ = open_.parent
            if open_.tag == family:
                article -= _articles(node, open_)
                node = open_.parent
        if tag in ARTICLE_BONUS and node.cut:
            for menu in ("nav", "header"):
                depth = _depth(node, menu)
                if depth and not (closed.get(menu) or closed.setdefault(menu, Closed(page, menu))).all(at, depth):
                    while _depth(node, menu):
                        node = node.parent
            article = _articles(node, root)
        beside = _beside(tag, attributes, article > 0, by_name, spared)
        child = Node(tag, node, node.cut if not beside or node.cut == tag else "several" if node.cut else tag)
        node.kids.append(child)
        node = child
        article += tag in ARTICLE_BONUS
    flush()
    return root


def _above(node: Node, tag: str) -> Node:
    while node.tag == tag:
        node = node.parent
    return node


def _depth(node: Node | None, tag: str) -> int:
    """Open elements of the tag that are cut."""
    n = 0
    while node is not None:
        n += node.tag == tag and bool(node.cut)
        node = node.parent
    return n


def _articles(node: Node, upto: Node) -> int:
    n = 0
    while node is not upto.parent and node is not None:
        n += node.tag in ARTICLE_BONUS
        node = node.parent
    return n


def _nodes(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(k for k in node.kids if isinstance(k, Node) and not k.cut)
    return out


def _points(block: str) -> float:
    commas = block.count(",") + block.count("、") + block.count("，")
    return PARAGRAPH_POINTS + commas + min(len(block) / LENGTH_PER_POINT, LENGTH_POINTS)


def best(root: Node) -> Node | None:
    """The element with the most points, or None if no paragraph earned any."""
    nodes = _nodes(root)
    for node in nodes:
        node.points += ARTICLE_BONUS.get(node.tag, 0.0)
    for node in nodes:
        for block in node.kids:
            if isinstance(block, Node):
                continue
            up, share = (node.parent if node.tag in ("p", "pre", "blockquote", "li", "td") else node), 1.0
            points, level = _points(block), 0
            while up is not None and share > 0.05:
                up.points += points * share
                level += 1
                share = 0.5 if level == 1 else 1.0 / (3 * level)
                up = up.parent
    for node in reversed(nodes):  # children before parents
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.links += node.links
    chosen = max(nodes, key=lambda n: (n.points * (1 - _density(n)) if n.chars else -1.0, -len(n.kids)), default=None)
    return chosen if chosen is not None and chosen.chars else None


def _density(node: Node) -> float:
    return node.links / node.chars if node.chars else 0.0


def _blocks(node: Node, out: list[str]) -> None:
    whole = node.tag in ("#root", "html", "body")
    stack: list[Node | str] = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
        elif not item.cut and not (whole and item.tag in ("ul", "ol", "div", "table") and _density(item) > LINK_BOX):
            stack.extend(reversed(item.kids))


def extract(page: str) -> str:
    """Main text of one page: its blocks, joined by an empty line; empty if there is none."""
    lost: dict[str, int] = {}
    root = parse(page, lost=lost)
    top = best(root)
    spared = frozenset(t for t in SPARED if lost.get(t, 0) >= HOLDS * (lost.get(t, 0) + root.chars) and t in lost)
    if spared:
        inner = best(parse(page, spared=spared)) or best(parse(page, by_name=False, spared=spared))
        top = inner if inner is not None and _prose(inner) else top
    if top is None and (top := best(parse(page, by_name=False))) is None:
        return ""
    kept: list[Node | str] = [top]
    if top.parent is not None and top.tag not in ARTICLE_BONUS:
        least = max(10.0, top.points * (1 - _density(top)) * SIBLING_SHARE)
        kids = top.parent.kids
        joins = [i for i, k in enumerate(kids) if k is top or _joins(k, least)]
        inside = range(joins[0], joins[-1])
        joins = set(joins)
        kept = [k for i, k in enumerate(kids) if i in joins or i in inside and (
            isinstance(k, str) or not k.cut and k.chars and _density(k) <= LINK_BOX)]
    out: list[str] = []
    for item in kept:
        if isinstance(item, str):
            out.append(item)
        else:
            _blocks(item, out)
    return "\n\n".join(out)


def _prose(node: Node) -> bool:
    """Whether a block of prose stands in the element."""
    return any(isinstance(k, str) and len(k) > PROSE_CHARS and n.links < PROSE_LINKS * max(1, n.chars) for n in _nodes(node) for k in n.kids)


def _joins(sibling: Node | str, least: float) -> bool:
    """Whether a sibling of the article belongs to it: enough points, or a heading, or a paragraph of prose."""
    if isinstance(sibling, str):
        return len(sibling) > 80
    if sibling.cut or not sibling.chars:
        return False
    if sibling.points * (1 - _density(sibling)) >= least or sibling.tag in ("h1", "h2", "h3"):
        return True
    return sibling.tag in ("p", "blockquote", "pre") and _density(sibling) < 0.25


def extract_text(pages: DataFrame) -> DataFrame:
    """Per page row: (page_id, url, text, n_chars).

    A null, empty or text-less page gives the empty text; markup that is never
    closed ends with the page; repeated rows are extracted each for itself."""

    @F.pandas_udf("string")
    def main_text(column: pd.Series) -> pd.Series:
        return column.map(extract)

    text = main_text(F.coalesce("html", F.lit("")))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op8_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))
