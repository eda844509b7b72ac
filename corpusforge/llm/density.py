"""Main text of HTML pages by composite text density.

A page becomes a DOM (implied end tags, raw-text elements, comments and broken nesting handled), parts that
are never an article (scripts, menus, forms ...) are cut off, and so are parts whose class or id speaks of
adverts, comments and the like, unless they hold the page's article or most of its text.  Every remaining node
gets a density: characters per tag, raised or lowered by how much of it are links.  The node whose children's
densities have the largest sum is the article's subtree; the smallest density on its path to the body is the
threshold, and other subtrees at least that dense add their own largest-sum node.

Each page is one small independent computation in an Arrow batch; nothing is shuffled.

Defined cases: a null or empty page gives an empty text; a page without tags is its text; repeated rows give
repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from html import unescape
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Element names of HTML by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg object annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder semantics".split()
)
NEVER = frozenset("script style noscript template iframe svg object annotation annotation-xml head nav aside footer button select textarea input".split())
#: Elements that mark a part like a word of ``MARKS``: a form or dialog may hold the whole page.
MARKED_NAMES = frozenset("form dialog menu".split())
#: Words in a class or id that mark a part as no article, if it is not the part that holds it.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner popup modal overlay cookie cookies "
    "consent gdpr notice notices alert newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "aside widget related recommended share sharing social comment comments disqus replies respond footer header masthead toolbar "
    "pagination pager skip tags copyright legal".split()
)
#: Words before a mark that make it a property of something else: has-sidebar, no-ads.
OWNING = frozenset("has have no not non with without".split())
#: Roles that say the same.
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# Which open elements a start tag ends, and where the search for them stops.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
PHRASE = INLINE | VOID | RAW

_TEXT = re.compile(r"[^<]+")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_VALUE_FOLLOWS = re.compile(r"=\s*\Z")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_DISPLAYED = re.compile(r"display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("name", "children", "parent", "chars", "tags", "link_chars", "link_tags", "density", "total", "marked", "article")

    def __init__(self, name: str, parent: "Node | None", marked: bool = False):
        self.name, self.parent, self.children, self.marked = name, parent, [], marked


def attributes_of(written: str) -> dict[str, str]:
    """Attributes by their lower-cased names; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(written):
        found.setdefault(name.lower(), "".join(values))
    return found


def is_furniture(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in NEVER or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _NOT_DISPLAYED.search(attributes.get("style", "")):
        return True
    return attributes.get("role", "").lower() in ROLES


def is_marked(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether the element, or a word of its class or id, marks a part; inside an article a header is the article's own."""
    if name in MARKED_NAMES:
        return True
    for written in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = ["", *(part.lower() for part in _PART.findall(written))]
        if any(part in MARKS and before not in OWNING and not (in_article and part == "header") for before, part in zip(parts, parts[1:])):
            return True
    return False


class Scanner:
    """Tags and texts of a page, each sign looked at a bounded number of times, however broken the page is."""

    def __init__(self, html: str) -> None:
        self.html, self.at = html, 0
        self.lost: set[str] = set()  # signs that close nothing any more up to the page's end

    def text(self) -> str | None:
        """The text from here on up to the next tag; null if there is none."""
        found = _TEXT.match(self.html, self.at)
        if found:
            self.at = found.end()
            return found[0]
        after = self.html[self.at + 1 : self.at + 2]
        if after in ("!", "?", "/") or (after.isascii() and after.isalpha()):
            return None
        self.at += 1
        return "<"

    def tag(self) -> tuple[str, bool, str] | None:
        """Name, whether it is an end tag, and attributes as written; null for comments and the like."""
        html, begin = self.html, self.at
        found = _TAG.match(html, begin)
        if found is None:
            mark = "-->" if html.startswith("<!--", begin) else ">"
            end = html.find(mark, begin + 2)
            self.at = end + len(mark) if end >= 0 else len(html)
            return None
        stop, self.at = self._tag_end(found.end())
        return found[2].lower(), found[1] == "/", html[found.end() : stop]

    def _tag_end(self, begin: int) -> tuple[int, int]:
        """Where a tag's attributes end, and what follows.  Quotes count where a value begins.

        A tag that does not end, because a quote stays open or the page is cut, ends before the next tag.
        """
        html, at = self.html, begin
        while ">" not in self.lost:
            at = _UNQUOTED.match(html, at).end()
            sign = html[at : at + 1]
            if sign == ">":
                return at, at + 1
            if not sign:
                self.lost.add(">")
                break
            if not _VALUE_FOLLOWS.search(html, max(begin, at - 20), at):
                at += 1
                continue
            close = -1 if sign in self.lost else html.find(sign, at + 1)
            if close < 0:
                self.lost.add(sign)
                break
            at = close + 1
        following = html.find("<", begin)
        following = len(html) if following < 0 else following
        end = html.find(">", begin, following)
        return (end, end + 1) if end >= 0 else (following, following)


class Path:
    """The open elements, and where those of each name are among them."""

    def __init__(self, root: Node) -> None:
        self.nodes, self.places = [root], {root.name: [0]}

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.nodes))
        self.nodes.append(node)

    def last(self, names) -> int:
        """Place of the innermost open element of one of the names; -1 if none is open."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=-1)

    def is_open(self, name: str) -> bool:
        return bool(self.places.get(name))

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all inside it; the root stays open."""
        while len(self.nodes) > max(place, 1):
            self.places[self.nodes.pop().name].pop()

    def close(self, name: str) -> None:
        if self.is_open(name):
            self.cut(self.places[name][-1])

    def end_open(self, names, stops) -> None:
        """What a start tag ends: the innermost element of ``names``, unless one of ``stops`` is further inside."""
        place = self.last(names)
        if place > self.last(stops):
            self.cut(place)


def parse(html: str) -> Node:
    """The DOM without furniture, marked parts included; text is kept as strings among the children."""
    root = Node("#root", None)
    path, scanner = Path(root), Scanner(html)
    skip: str | None = None  # the furniture element that is open, and how many of its name
    depth = 0
    while scanner.at < len(html):
        text = scanner.text()
        if text is not None:
            if not skip:
                path.top.children.append(unescape(text))
            continue
        tag = scanner.tag()
        if tag is None:
            continue
        name, closing, written = tag
        if not closing and name in RAW and not written.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, scanner.at)
            scanner.at = end.end() if end else len(html)
            continue
        if skip:
            if name == skip:
                depth += -1 if closing else 1
                skip = skip if depth else None
            elif closing and name in ("body", "html", "article", "main") and path.is_open(name):
                skip, depth = None, 0  # an unclosed piece of furniture ends with what holds it
                path.close(name)
            continue
        if closing:
            path.close(name)
            continue
        if name not in PHRASE:  # a block ends an open paragraph
            path.end_open(("p",), ("#root", "td", "th", "table", "button"))
        if name in ENDS:
            path.end_open(ENDS[name], STOPS[name] | {"#root"})
        in_article = path.is_open("article")
        attributes = attributes_of(written) if written else {}
        if is_furniture(name, attributes, in_article):
            if name not in VOID and not written.endswith("/"):
                skip, depth = name, 1
            continue
        node = Node(name, path.top, is_marked(name, attributes, in_article))
        path.top.children.append(node)
        if name not in VOID and not (written.endswith("/") and name not in INLINE):
            path.push(node)
    return root


def walk(root: Node) -> list[Node]:
    """All element nodes, parents before children."""
    order = [root]
    for node in order:
        order.extend(child for child in node.children if isinstance(child, Node))
    return order


def count(order: list[Node]) -> None:
    """Characters and tags of every node, and those of them that are links.

    Inline formatting is part of its block's text: only blocks and links count as tags.
    """
    for node in reversed(order):
        chars = tags = link_chars = link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                chars += len(child) - child.count(" ") - child.count("\n")
            else:
                chars += child.chars
                tags += child.tags + (child.name == "a" or child.name not in INLINE)
                link_chars += child.link_chars
                link_tags += child.link_tags + (child.name == "a")
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, chars if node.name == "a" else link_chars, link_tags


def weigh(order: list[Node]) -> None:
    """Counts, densities and sums of child densities of every node; only blocks, and text beside blocks, count as children."""
    count(order)
    share = order[0].link_chars / max(1, order[0].chars)
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, share)
    for node in order:
        inner = [c.density for c in node.children if isinstance(c, Node) and c.name not in PHRASE]
        loose = [density(len(c.strip()), 0, 0, 0, share) for c in node.children if isinstance(c, str)] if inner else []
        node.total = sum(inner) + sum(loose)


def prune(root: Node) -> None:
    """Cut off the marked parts that are not what the page is about.

    A marked part stays, for the densities to judge, if it holds an article that is no small one beside the page's largest,
    or most of the page's characters, few of them links, with little of an article outside it.
    """
    order = walk(root)
    if not any(node.marked for node in order):
        return
    count(order)
    largest = None
    for node in reversed(order):
        node.article = max((c.article for c in node.children if isinstance(c, Node)), default=0)
        if not node.marked and (node.name == "article" or (node.name == "main" and not node.article)):
            node.article = node.chars
            if largest is None or node.chars > largest.chars:
                largest = node
    open_nodes = [(root, False)]
    while open_nodes:
        node, within = open_nodes.pop()
        within = within or node is largest

        def stays(child) -> bool:
            if isinstance(child, str) or not child.marked or child.name in ("html", "body", "article", "main"):
                return True
            if child.article and 4 * child.article >= largest.chars:
                return True
            rest = 0 if largest is None else largest.chars - within * child.chars
            return 2 * child.chars > root.chars and 2 * child.link_chars <= child.chars and 10 * rest < child.chars

        node.children = [child for child in node.children if stays(child)]
        open_nodes.extend((c, within) for c in node.children if isinstance(c, Node))


def density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag times a logarithm whose base grows with the links."""
    if not chars:
        return 0.0
    tags = max(1, tags)
    base = 1 + math.log(chars / max(1, chars - link_chars) * link_chars + share * chars + math.e)
    return chars / tags * math.log(1 + chars / max(1, link_chars) * tags / max(1, link_tags)) / math.log(base)


def content_nodes(root: Node) -> set[Node]:
    order = walk(root)
    weigh(order)
    best = max(order, key=lambda node: node.total)
    threshold, here = best.density, best
    while here is not None:
        if here.name in ("body", "#root"):
            break
        threshold, here = min(threshold, here.density), here.parent
    threshold = min(threshold, here.density) if here is not None and here.name == "body" else threshold
    # Largest-sum node of every subtree, from the leaves up.
    top: dict[Node, Node] = {}
    for node in reversed(order):
        top[node] = max([node, *(top[c] for c in node.children if isinstance(c, Node))], key=lambda n: n.total)
    found, open_nodes = {best}, [root]
    while open_nodes:
        node = open_nodes.pop()
        if node in found:
            continue
        if node.density >= threshold and node.name not in ("#root", "html", "body"):
            found.add(top[node])
        open_nodes.extend(c for c in node.children if isinstance(c, Node))
    return found


def blocks(root: Node, found: set[Node]) -> Iterator[str]:
    """Text of the found subtrees in page order, block by block."""
    held: list[str] = []
    stack: list[tuple[object, bool, bool]] = [(root, root in found, False)]
    while stack:
        item, inside, leaving = stack.pop()
        if isinstance(item, str):
            if inside:
                held.append(item)
            continue
        block = item.name not in INLINE
        if block and held:
            yield " ".join("".join(held).split())
            held = []
        if leaving:
            continue
        if block:
            stack.append((item, inside, True))
        stack.extend((child, inside or child in found, False) for child in reversed(item.children))
    if held:
        yield " ".join("".join(held).split())


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    prune(root)
    return " ".join(block for block in blocks(root, content_nodes(root)) if block)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [main_text(html) for html in batch.pop("html")]
            yield batch.assign(text=found, n_chars=[len(text) for text in found])

    return pages.select("page_id", "url", F.col("html")).mapInPandas(
        texts, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    )
