"""Main text of web pages by composite text density.

Every node of the page gets the characters per tag below it, adjusted for the characters and tags of links. The node
whose children have the largest sum of densities is the core of the article, and the smallest density on the path from
the root down to it is the threshold. Beside the path a branch stays if it comes near the threshold; inside the core a
branch goes if it is marked or made of links and stays below. Marks (class, id, role, a place outside article and main)
only lower densities, so a page whose whole text is marked keeps it. All steps are linear in the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of the HTML standard, by their role here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg math object xmp".split())
NEVER = RAW | set("head nav footer aside form button select menu dialog label fieldset input option video audio canvas".split())
BLOCK = set("html body address article blockquote center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
# An open element that a start tag closes by itself.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_PARAGRAPH = BLOCK | set("nav footer aside form menu dialog".split())
# Words in class, id and role that mark menus, notices, adverts and comments of readers.
NOISE = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay"
    " sidebar side nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc footer masthead toolbar topbar"
    " comment comments commentlist disqus reply replies discussion share sharing social follow related recommended recommendations newsletter subscribe subscription signup login search widget"
    " complementary contentinfo skip hidden".split()
)

# Words for places that may stand beside those in one name (site-footer, nav-left), but mark nothing alone.
PLACES = set("site page main global top bottom left right primary secondary area block box container wrap wrapper list section slot unit links".split())
READERS = set("comment comments commentlist disqus reply replies discussion related recommended recommendations".split())
FOREIGN = ("svg", "math", "object")

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>|<[!?/][^<>]*>", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


TEXT_BLOCKS = BLOCK - set("html body address article div header main section".split())
# What a mark leaves of the density and the counts of an element. Texts of readers count only where nothing else does.
WEIGHTS = {"": 1.0, "layout": 0.1, "readers": 0.0}
NEAR = 0.1  # share of the threshold that an unmarked branch beside the path must reach


class Node:
    __slots__ = ("chars", "children", "density", "link_chars", "link_tags", "most", "name", "noise", "parent", "soft", "tags", "total", "weight")

    def __init__(self, name: str, parent: Node | None, noise: bool = False, soft: str = ""):
        self.name, self.parent, self.noise, self.soft = name, parent, noise, soft
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = self.density = self.total = 0.0
        self.weight = self.most = 1.0  # what marks leave of the node itself, and of the least marked node below

    def inner(self) -> Iterator[Node]:
        return (c for c in self.children if isinstance(c, Node) and not c.noise)


class Stack:
    """The open elements of a page, with the places of every name, so that no look-up walks the whole depth."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], defaultdict(list)

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.places[node.name].append(len(self.nodes))
        self.nodes.append(node)

    def innermost(self, names: Iterable[str]) -> int:
        """Place of the innermost open element of these names, 0 without one (the root stays open)."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def close(self, place: int) -> None:
        while len(self.nodes) > place:
            self.places[self.nodes.pop().name].pop()


@lru_cache(4096)
def _hidden(attributes: str) -> bool:
    for key, *values in _NAMED.findall(attributes):
        if key.lower() == "hidden" or (key.lower() == "aria-hidden" and "true" in values):
            return True
    return False


@lru_cache(4096)
def _soft(attributes: str) -> str:
    """"layout" or "readers" if a whole name in class, id or role is made of words of NOISE and PLACES, else ""."""
    found = ""
    for key, *values in _NAMED.findall(attributes):
        if key.lower() not in ("class", "id", "role"):
            continue
        for token in next((v for v in values if v), "").split():
            words = set(re.split(r"[-_]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", token).lower().strip("-_")))
            if words & NOISE and words <= NOISE | PLACES:
                found = "readers" if words & READERS else found or "layout"
    return found


def _foreign_ends(name: str, page: str) -> dict[int, int]:
    """End of every balanced element of this name, by where its start tag ends. One pass over the page."""
    ends, started = {}, []
    for tag in re.finditer(f"<(/?){name}(?=[\\s/>])[^<>]*>", page, re.I):
        if not tag[1]:
            if not tag[0].endswith("/>"):
                started.append(tag.end())
        elif started:
            ends[started.pop()] = tag.end()
    return ends


def parse(page: str) -> Node:
    """The page as a tree. Unclosed and stray tags are mended the way browsers do it for paragraphs, lists and tables."""
    stack, at = Stack(Node("html", None)), 0
    foreign: dict[str, dict[int, int]] = {}
    while match := _TAG.search(page, at):
        if match.start() > at:
            stack.top.children.append(page[at : match.start()])
        at = match.end()
        name = (match[2] or match[5] or "").lower()
        if not name or name in ("html", "body"):
            continue
        if match[1] or match[4]:
            if place := stack.innermost((name,)):
                stack.close(place)
            continue
        attributes = match[3] or match[6] or ""
        if name in ENDS_PARAGRAPH and (place := stack.innermost(("p", "article", "div", "section", "td"))) and stack.nodes[place].name == "p":
            stack.close(place)
        if name in HEADINGS and stack.top.name in HEADINGS:
            stack.close(len(stack.nodes) - 1)
        if name in CLOSED_BY:
            while (place := stack.innermost((*CLOSED_BY[name], "ul", "ol", "dl", "table"))) and stack.nodes[place].name in CLOSED_BY[name]:
                stack.close(place)
        if stack.top.name == "head" and name in ENDS_PARAGRAPH:
            stack.close(len(stack.nodes) - 1)
        noise = name in NEVER or (name == "header" and not stack.innermost(("article", "main"))) or (bool(attributes) and _hidden(attributes))
        node = Node(name, stack.top, noise, _soft(attributes) if attributes and name != "main" else "")
        stack.top.children.append(node)
        if name in FOREIGN:  # without a balanced end tag they end at once
            if name not in foreign:
                foreign[name] = _foreign_ends(name, page)
            at = foreign[name].get(at, at)
        elif name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not attributes.endswith("/"):
            stack.push(node)
    if at < len(page):
        stack.top.children.append(page[at:])
    return stack.nodes[0]


def composite_density(node: Node, root: Node) -> float:
    """Characters per tag, times a logarithm whose base punishes text in links; 0 for text that is all links.

    Counts are taken as if the largest weight at or below the node were 1, the result is lowered by it.
    """
    if not node.chars:
        return 0.0
    chars, link_chars = node.chars / node.most, node.link_chars / node.most
    tags, links, plain = max(node.tags / node.most, 1.0), max(link_chars, 1.0), max(chars - link_chars, 1.0)
    base = chars / plain * link_chars + root.link_chars / max(root.chars, 1.0) * chars + math.e
    ratio = chars / links * tags / max(node.link_tags / node.most, 1.0)
    return node.most * chars / tags * math.log(max(ratio, 1.0)) / math.log(math.log(base) + math.e - 1)


def measure(root: Node) -> list[Node]:
    """Set counts, density and the sum of the children's densities of all nodes; returns them, children first."""
    order, todo = [], [root]
    while todo:
        order.append(node := todo.pop())
        todo += node.inner()
    outside = WEIGHTS["layout"] if any(n.name in ("article", "main") for n in order) else 1.0
    of = {}  # what the elements around a node leave of it
    for node in order:
        above = of[id(node.parent)] if node.parent else outside
        of[id(node)] = above = above / outside if outside < 1.0 and node.name in ("article", "main") and above == outside else above
        node.weight = of[id(node)] = above * WEIGHTS[node.soft]
    order.reverse()
    for node in order:
        inner = list(node.inner())
        node.most = max([node.weight, *[c.most for c in inner]])
        node.chars = sum(len(c.strip()) for c in node.children if isinstance(c, str)) * node.weight + sum(c.chars for c in inner)
        node.tags = sum(c.tags + c.weight for c in inner)
        node.link_chars = node.chars if node.name == "a" else sum(c.link_chars for c in inner)
        node.link_tags = sum(c.link_tags + (c.weight if c.name == "a" else 0.0) for c in inner)
    for node in order:
        node.density = composite_density(node, root)
        node.total = sum(c.density for c in node.inner())
    return order


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by an empty line; "" for a null or empty page or one without text."""
    if not page:
        return ""
    root = parse(page)
    order = measure(root)
    if not root.chars:  # all text is of readers
        for node in order:
            node.soft = ""
        order = measure(root)
    best = max(order, key=lambda n: (n.total, n.chars))
    path = [best]
    while path[-1] is not root:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    on_path = {id(n) for n in path}
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(line))).strip(" ")
        if text:
            blocks.append(text)
        line.clear()

    def stays(node: Node, inside: bool) -> bool:
        links = 2 * node.link_chars > node.chars
        if node.weight < node.parent.weight or links:
            return node.density >= threshold and node.weight > 0.0 and not (links and not inside)
        # A paragraph without a mark is judged with its parent, so short ones stay.
        return inside or node.name in TEXT_BLOCKS or node.density >= NEAR * threshold

    todo: list[tuple[Node | str | None, bool, bool]] = [(root, False, False)]
    while todo:
        node, inside, mute = todo.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            if not mute:
                line.append(node)
        elif node.name == "br":
            line.append(" ")
        elif not node.noise:
            block = node.name in BLOCK
            if id(node) not in on_path and (block or node.soft) and not stays(node, inside):
                continue
            # Of an article's own header only the headings are text.
            mute = node.name == "header" or (mute and node.name not in HEADINGS)
            if block:
                flush()
                todo.append((None, True, False))
            below = inside or node is best or id(node) not in on_path
            todo += [(c, below, mute) for c in reversed(node.children)]
    flush()
    return "\n\n".join(blocks)


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add text (string) and n_chars (long, code points) to every row of ``pages``; see ``main_text``.

    A null or empty page gives "" and 0. Rows are independent: repeats give equal texts. Columns named text or n_chars
    are replaced, others pass unchanged.
    """
    pages = pages.drop("text", "n_chars")
    names = pages.columns
    schema = pages.selectExpr("*", "'' as text", "0L as n_chars").schema

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(html_col).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    return pages.mapInArrow(extract, schema)
