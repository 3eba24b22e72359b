"""Main text of web pages by composite text density.

A page becomes a tree of block elements. Elements that are by definition no text of an article (nav, form, aside, hidden
ones, what calls itself comments or adverts) are left out. Every node has a density, its characters per tag, adjusted for
the share that links hold of its characters and tags and of the body's (Sun, Song and Liao, 2011). The node whose
children's densities have the greatest sum is the middle of the main text; the least density on the path from it to the
body is the threshold at which nodes beside that path belong to the text as well.

Names like related, share or notice are hints only: a block that bears one counts a quarter in the choice of the middle,
and is kept, if it isn't made of links, where it is half as dense as the middle's blocks on average, or beside the path
four times as dense as the threshold. Other blocks of the middle stay, but for lists of links outside an article or main
element. Beside the path, but within an article or main element, and for headings, only what is made of links must meet
the threshold.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm.common import table

_TAG = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|/[^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg".split())
BLOCK = frozenset("html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: An element that ends an open one of the kinds named.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"}}
_BOUND = frozenset("table ul ol dl div article section main aside body html blockquote form".split())
OUT = frozenset("nav footer aside form button select dialog menu head object audio video canvas map".split()) | RAW
#: Names, in class or id, of what is left out at any density, and names that are hints.
NO_TEXT = frozenset("ad ads advert adverts advertisement advertising adsense sponsored comment comments disqus respond reply replies".split())
HINTS = frozenset("sponsor promo promotion banner nav navbar navigation menu menus sidebar sidebars aside breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended footer masthead skip pagination pager toolbar widget login".split())
#: What a hinted block's density counts in the choice of the middle and beside the path.
PRIOR = 0.25
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "hint", "chars", "links", "tags", "link_tags", "density", "total")

    def __init__(self, tag, parent, hint=False):
        self.tag, self.parent, self.parts, self.hint = tag, parent, [], hint
        self.chars = self.links = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def _kind(tag: str, attributes: str, inside: bool) -> int:
    """2 for an element that is left out, 1 for one whose name is a hint, else 0."""
    if tag in OUT or tag == "header" and not inside:
        return 2
    if not attributes.strip() or tag in ("article", "main", "body", "html"):
        return 0
    kind = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            parts = re.split(r"[\s_-]+", value)
            if not NO_TEXT.isdisjoint(parts):
                return 2
            kind = max(kind, not HINTS.isdisjoint(parts))
        if name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return 2
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 2
    return int(kind)


def tree(page: str) -> Node:
    """The block elements of a page with their texts; inline elements are counted, not kept."""
    root = Node("body", None)
    #: (tag, node or None for an inline element, whether it is a link) of open elements
    stack: list[tuple[str, Node | None, bool]] = []
    node, at, links, n, inside = root, 0, 0, len(page), 0

    def text(piece: str) -> None:
        if piece:
            node.parts.append((html.unescape(piece) if "&" in piece else piece, links > 0))

    def close(k: int) -> None:
        nonlocal node, links, inside
        for tag, own, link in reversed(stack[k:]):
            links -= link
            if own is not None:
                node = own.parent
                inside -= tag in ("article", "main")
        del stack[k:]

    def leave(tag: str, start: int) -> int:
        """Where the left-out element that begins before start ends."""
        if tag in RAW:
            m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, start)
            return m.end() if m else n
        depth, open_ = 1, [tag]
        pos = start
        while depth:
            m = _TAG.search(page, pos)
            if not m:
                return n
            pos = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                if name == tag:
                    depth -= 1
                elif name in ("body", "html", "article", "main") and name not in open_:
                    return m.start()
                elif name in open_:
                    open_.remove(name)
            elif name == tag and name not in VOID:
                depth += 1
            elif name in RAW:
                pos = leave(name, pos)
            elif name in ("article", "main", "body"):
                open_.append(name)
        return pos

    while True:
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCK:
            # a block ends an open paragraph, unless something that may hold both stands between
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or stack[k][0] in CLOSES.get(tag, ()):
                    close(k)
                    if stack[k - 1 :] and stack[k - 1][0] in CLOSES.get(tag, ()):
                        continue
                    break
                if stack[k][0] in _BOUND:
                    break
        kind = _kind(tag, attributes or "", inside > 0)
        if kind == 2:
            if tag not in VOID:
                at = leave(tag, at)
            if tag in BLOCK:
                node.parts.append(("\n", None))
            continue
        if tag in VOID:
            if tag == "br":
                node.parts.append((" ", False))
            elif tag == "hr":
                node.parts.append(("\n", None))
            continue
        if tag in BLOCK:
            child = Node(tag, node, kind == 1)
            node.parts.append(child)
            stack.append((tag, child, False))
            node = child
            inside += tag in ("article", "main")
        else:
            link = tag == "a"
            if link:
                links += 1
                node.link_tags += 1
            stack.append((tag, None, link))
    return root


def _order(root: Node) -> list[Node]:
    """All nodes, parents first; without recursion, since pages may nest deeply."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo += [p for p in x.parts if isinstance(p, Node)]
    return out


def weigh(root: Node) -> list[Node]:
    """The nodes, parents first, with their counts, densities and sums of densities."""
    nodes = _order(root)
    for x in reversed(nodes):
        for p in x.parts:
            if isinstance(p, Node):
                x.chars, x.links, x.tags, x.link_tags = x.chars + p.chars, x.links + p.links, x.tags + p.tags + 1, x.link_tags + p.link_tags
            elif p[1] is not None:
                size = len(_SPACE.sub("", p[0]))
                x.chars += size
                x.links += size * p[1]
    body = root.links / max(1, root.chars)
    for x in nodes:
        if x.chars:
            c, lc, t, lt = x.chars, max(1, x.links), max(1, x.tags), max(1, x.link_tags)
            base = math.log(c / max(1, c - x.links) * x.links + body * c + math.e)
            x.density = c / t * math.log(c / lc * max(1.0, t / lt) + 1e-9) / math.log(base) if base > 1.0 + 1e-9 else c / t * math.log(c / lc * max(1.0, t / lt) + math.e)
    for x in nodes:
        x.hint = x.hint or x.parent is not None and x.parent.hint
        x.total = sum(p.density * (PRIOR if p.hint else 1.0) for p in x.parts if isinstance(p, Node))
    return nodes


def main_text(page: str) -> str:
    """The blocks of the main text, in page order, one to a line."""
    root = tree(page)
    nodes = weigh(root)
    if not root.chars:
        return ""
    best = max(nodes, key=lambda x: x.total)
    if best.total <= 0:
        best = root
    path, x = [], best
    while x is not None:
        path.append(x)
        x = x.parent
    limit = min(x.density for x in path)
    usual = max(limit, best.total / max(1, sum(isinstance(p, Node) for p in best.parts)))
    on_path, article = {id(x) for x in path}, False

    def stays(x: Node) -> bool:
        """Whether the node x, within best or beside the path, is text."""
        dense, linked = x.density >= limit, 3 * x.links >= x.chars
        if x.hint:
            return not linked and (2 * x.density >= usual if within else PRIOR * x.density >= limit)
        if within:  # a menu without a name is many links and little else
            return article or dense or x.link_tags < 3 or 3 * x.links < 2 * x.chars
        return dense or not linked and (article or x.tag in HEADINGS and x.parent is not root)

    keep, bare, todo = set(), set(), [(root, False, False)]
    while todo:
        x, within, article = todo.pop()
        beside = not within and id(x) not in on_path
        if x.chars and (beside or within and not (x.hint and x.parent.hint)) and not stays(x):
            continue
        within, article = within or beside or x is best, article or x.tag in ("article", "main")
        keep.add(id(x))
        if not within and not article and sum(len(_SPACE.sub("", p[0])) for p in x.parts if not isinstance(p, Node) and p[1] is False) < limit:
            bare.add(id(x))  # what stands right in a node of the path is a block of one tag
        todo += [(p, within, article) for p in x.parts if isinstance(p, Node)]
    return _blocks(root, keep, bare)


def _blocks(root: Node, keep: set[int], bare: set[int]) -> str:
    """The texts of the nodes in keep, without what stands right in those in bare."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        s = _SPACE.sub(" ", "".join(line)).strip(" ")
        if s:
            out.append(s)
        line.clear()

    todo: list = [(root, True)]
    while todo:
        x, own = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, Node):
            flush()
            if id(x) in keep:
                todo.append((None, True))
                todo += [(p, id(x) not in bare) for p in reversed(x.parts)]
        elif x[1] is None:
            flush()
        elif own:
            line.append(x[0])
    flush()
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages (page_id, url, html).

    A null or empty page, and one without text outside what is left out, gives an empty text. Broken markup is read as
    far as it goes: unclosed elements end with what holds them, unknown character references stay as written. Repeated
    rows are read each; other columns aren't looked at.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [main_text(x) if isinstance(x, str) else "" for x in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": texts, "n_chars": [len(x) for x in texts]})

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInPandas(run, "page_id long, url string, text string, n_chars long")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
