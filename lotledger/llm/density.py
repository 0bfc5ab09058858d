"""Main text of web pages by composite text density.

Every node of the page's tree has a link-adjusted number of characters per tag; the density sum of
a node is that of its children and of its own text taken together. The node with the largest sum,
or the container that it is a paragraph of, anchors the content. The threshold is the smallest
density on the path from there to the body. The anchor grows to its parent while most of the text
beside it reaches the threshold; beside the path, subtrees that reach it and headings are content.
No element name marks an article. Elements that are none by their markup (menus, forms, scripts)
are never read; names of classes only weigh: a subtree whose name says advert, comments or the like
competes with ``NAMED`` of its sum, adds none to what holds it, and is left out unless it holds the anchor or most of its text.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and words of class and id names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp svg math object".split())
OUTSIDE = frozenset(
    "nav form script style noscript iframe template svg math object head title "
    "button select textarea input label fieldset dialog menu canvas audio video map".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul caption option".split())
CLOSES = {  # an open tag ends these open elements, up to the fence
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
    "body": ({"head"}, set())}
ENDS_P = BLOCKS - {"body", "html", "li", "dt", "dd", "tr", "td", "th", "tbody", "tfoot", "thead", "caption", "option"}
FENCES = frozenset("table td th caption button object html body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("body html div section article main td center details".split())
# Names count on elements that hold others, not on a paragraph, heading or item.
NAMEABLE = CONTAINERS - {"body", "html"} | frozenset("span ul ol dl table header footer aside figure a".split())
BESIDE = frozenset("footer aside".split())
# A class or id says something where all its words are of these two lists, and one of the first.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored sponsors promo "
    "promos promotion promotions nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer "
    "foot masthead topbar cookie cookies consent gdpr notice notices newsletter newsletters subscribe subscription "
    "popup modal overlay comment comments disqus replies respond related recommended share sharing social widget "
    "widgets toolbar pagination pager login signup search copyright skiplink tagcloud".split())
FILLERS = frozenset(
    "the site page main top bottom left right side box bar list wrapper wrap container section area block inner "
    "outer content links link header head form policy text thread buttons icons items item unit slot".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"']|$)", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[^\W\d_]+")
NAMED = 0.02  # weight of the density sum in a subtree that a name marks


class Node:
    __slots__ = ("tag", "parent", "kids", "out", "named", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, out: bool = False, named: bool = False):
        self.tag, self.parent, self.kids, self.out, self.named = tag, parent, [], out, named
        self.chars = self.link_chars = 0
        self.tags = self.link_tags = 0


def _says(value: str) -> bool:
    """Whether a class or id names something that is no article."""
    for name in value.lower().split():
        words = _WORDS.findall(name.replace("_", " "))
        if words and HINTS.intersection(words) and all(w in HINTS or w in FILLERS for w in words):
            return True
    return False


def _marks(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is no part of an article by its markup, and whether its name says so."""
    if tag in OUTSIDE:
        return True, False
    named = tag in BESIDE
    if not attributes or tag in ("html", "body"):
        return False, named
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in ROLES:
            return True, False
        named |= name in ("class", "id") and tag in NAMEABLE and _says(value)
    return False, named


def tree(page: str) -> Node:
    """The page's elements and texts; unclosed and stray tags are resolved as browsers do."""
    root = at = Node("html", None)
    pos, n = 0, len(page)
    while pos < n:
        m = _TOKEN.search(page, pos)
        text = page[pos:m.start() if m else n]
        if text:
            at.kids.append(text)
        if not m:
            break
        pos = m.end()
        slash, tag, rest = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            top = at
            while top is not root and top.tag != tag and not (tag not in BLOCKS and top.tag in BLOCKS):
                top = top.parent
            if top is not root and top.tag == tag:
                at = top.parent
            continue
        if tag == "html":
            continue
        if tag in CLOSES or tag in ENDS_P:
            ends, fence = CLOSES.get(tag, (frozenset(), frozenset()))
            stop, up = None, at
            while up is not root and up.tag not in fence and not (tag in ENDS_P and up.tag in FENCES):
                if up.tag in ends or up.tag == "p":
                    stop = up
                elif up.tag in BLOCKS and not ends:
                    break
                up = up.parent
            if stop is not None:
                at = stop.parent
        node = Node(tag, at, *_marks(tag, rest))
        at.kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>?", re.I).search(page, pos)
            pos = end.end() if end else n
            node.out = True
        elif tag not in VOID and not rest.rstrip().endswith("/") or tag in BLOCKS:
            at = node
    return root


def _nodes(root: Node) -> list[Node]:
    """Nodes of the tree that may hold content, parents first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(k for k in reversed(node.kids) if type(k) is Node and not k.out)
    return order


def _measure(order: list[Node], body: Node) -> None:
    for node in reversed(order):
        for kid in node.kids:
            if type(kid) is str:
                node.chars += len(kid.strip())
            elif not kid.out:
                node.chars += kid.chars
                node.link_chars += kid.chars if kid.tag == "a" else kid.link_chars
                node.tags += 1 + kid.tags
                node.link_tags += (kid.tag == "a") + kid.link_tags
    share = body.link_chars / max(1, body.chars)
    for node in order:
        c, lc = node.chars, node.link_chars if node.tag != "a" else node.chars
        tags, lt = max(1, node.tags), max(1, node.link_tags)
        plain = max(1, c - lc)
        base = math.log(c / plain * lc + share * c + math.e)
        node.density = c / tags * math.log(c / max(1, lc) * tags / lt + 1) / math.log(base + 1) if c else 0.0
    for node in order:
        own = sum(len(k.strip()) for k in node.kids if type(k) is str)
        alone = own * math.log(own + 1) / math.log(math.log(share * own + math.e) + 1)
        node.total = alone + sum(k.density for k in _kids(node) if not k.named)


def _path(node: Node, body: Node) -> list[Node]:
    """A node and what it lies in, up to the body."""
    path = [node]
    while path[-1] is not body:
        path.append(path[-1].parent)
    return path


def _kids(node: Node) -> Iterator[Node]:
    return (k for k in node.kids if type(k) is Node and not k.out)


def _anchor(order: list[Node], body: Node) -> Node:
    """The node of the largest density sum, or the container that it is a paragraph of."""
    inside: dict[int, bool] = {}
    for node in order:  # parents come first
        inside[id(node)] = node.named or node.tag == "header" or inside.get(id(node.parent), False)
    best = max(order, key=lambda x: x.total * (NAMED if inside[id(x)] else 1.0))
    return next(x for x in _path(best, body) if x is body or x.tag in CONTAINERS)


def _linked(node: Node) -> bool:
    """Whether a subtree is mostly a list of links."""
    return node.link_tags > 1 and node.link_chars > 0.66 * node.chars


def _grown(anchor: Node, body: Node, threshold: float) -> Node:
    """The anchor, or what it lies in where most of the text beside it reaches the threshold."""
    while anchor is not body and anchor.parent is not body:
        beside = [k for k in _kids(anchor.parent) if k is not anchor and not k.named]
        dense = sum(k.chars for k in beside if k.density >= threshold and not _linked(k))
        if 2 * dense < sum(k.chars for k in beside if k.tag not in HEADINGS):
            break
        anchor = anchor.parent
    return anchor


def _blocks(node: Node, take: set[int], skip: set[int]) -> list[str]:
    """Block texts in page order; ``take``: ids of the subtrees to read, ``skip``: to leave out."""
    out, parts = [], []

    def end() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append(text)
        parts.clear()

    todo: list[tuple[Node | str | None, bool]] = [(node, False)]
    while todo:
        item, on = todo.pop()
        if item is None:
            end()
        elif type(item) is str:
            if on:
                parts.append(item)
        elif item.tag == "br":
            parts.append(" ")
        elif not item.out and id(item) not in skip:
            on = on or id(item) in take
            block = item.tag in BLOCKS
            if block:
                end()
                todo.append((None, on))
            todo.extend((k, on) for k in reversed(item.kids))
    end()
    return out


def main_text(page: str | None) -> str:
    """Blocks of the article, white space in a block as one space, joined by two line ends."""
    if not page:
        return ""
    root = tree(page)
    body = next((x for x in _nodes(root) if x.tag == "body"), root)
    order = _nodes(body)
    _measure(order, body)
    anchor = _anchor(order, body)
    threshold = min(x.density for x in _path(anchor, body))
    anchor = _grown(anchor, body, threshold)
    path = _path(anchor, body)
    held = {id(x) for x in path}
    take, skip = {id(anchor)}, set()
    for node in path[1:]:
        before = True
        for kid in _kids(node):
            if id(kid) in held:
                before = False
            elif kid.tag == "header":  # of the article, unless it is the page's
                if node is not body and before:
                    take.add(id(kid))
            elif not kid.named and kid.chars and (
                    before and kid.tag in HEADINGS or kid.density >= threshold and 2 * kid.link_chars < kid.chars):
                take.add(id(kid))
    for x in order:
        if id(x) not in held and (x.named and 2 * x.chars < anchor.chars or x.tag in BLOCKS and _linked(x) and x.density < threshold
                                  or x.tag == "header" and x.parent is body):
            skip.add(id(x))
    return "\n\n".join(_blocks(body, take, skip))


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars (code points).

    Null html counts as empty; whole pages are read whatever their length; repeated rows give
    repeated results; other columns are not read; an empty table gives an empty result.
    """

    @F.pandas_udf("string")
    def text(page: pd.Series) -> pd.Series:
        return page.map(main_text)

    return pages.select("page_id", "url", text("html").alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
