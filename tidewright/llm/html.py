"""HTML extraction by tree scoring.

A page becomes a tree of blocks. Each paragraph earns points for its length and its
commas, passed to its ancestors with falling weight; a container's points are
discounted by the share of its text inside links. An article or main element around
the best container is kept whole; without one, the container that all prose has in
common, with its siblings, but for those that are mostly links. Menus, headers, footers,
sidebars, notices, adverts, forms, comments of readers and code are dropped on the way,
by element or by name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship, slices, text_bytes, with_fields, without

# Fixed values of HTML: elements without content, whose content is raw text, that end a
# paragraph, and that end an open element of their kind
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
                  "section summary table tbody td tfoot th thead title tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
# Deeper elements become siblings, as browsers do it
DEEPEST = 500
# Elements that never hold the article's text
DROPPED = frozenset("head script style noscript template iframe svg math object embed canvas audio video map nav footer aside "
                    "button select option input textarea legend menu".split())
# Elements that rarely do: they go unless they hold the article (some pages wrap all of it in a form)
DOUBTED = frozenset("form fieldset label dialog".split())
# Names of what is not the article: in a class or id all parts must be such names or say
# only where or how; WEAK ones do not count within an article
NAMED = frozenset("ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion "
                  "popup modal overlay cookie cookies consent gdpr newsletter subscribe subscription signup share sharing social related "
                  "recommend recommended recommendations sidebar aside menu menus nav navi navbar navigation breadcrumb breadcrumbs "
                  "pagination pager footer masthead topbar toolbar comment comments disqus replies respond tagcloud hidden".split())
WEAK = frozenset("banner notice notices alert alerts login widget widgets foot tags copyright legal disclaimer".split())
NAMED_WHOLE = frozenset("side-bar site-header page-header print-only sr-only visually-hidden visuallyhidden screen-reader-text".split())
AROUND = frozenset("site page main top bottom left right primary secondary sub global mobile desktop list box bar area container wrapper wrap "
                   "inner outer block links link posts post articles stories icons icon buttons button section form content items item "
                   "header head title body text unit slot policy message us more media js".split())
PART_OF_NAME = re.compile(r"[-_]+")
KEPT = re.compile(r"(^|[\s_-])(article|content|entry|post|story|main|body|text)($|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert".split())
TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|--!>|\Z)|<[!?][^>]*+>|</(?P<end>[a-zA-Z][^\s/<>]*+)[^>]*+>|"
    r"<(?P<start>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
LOOSE = re.compile(r"<[a-zA-Z/!?][^<>]*>?")
# The same without quoted signs, which never looks beyond the next tag
SIMPLE = re.compile(r"</(?P<end>[a-zA-Z][^\s/<>]*)[^<>]*>|<(?P<start>[a-zA-Z][^\s/<>]*)(?P<attrs>[^<>]*)>")
# Tags without an end may make a match run on to the end of the page: so often it may be tried
TRIES = 50
ATTR = re.compile(r"([^\s=/\"'<>]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "depth", "dropped", "score", "chars", "link_chars")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.depth: int = parent.depth + 1 if parent is not None else 0
        self.dropped = parent is not None and (parent.dropped or unwanted(tag, attrs, parent))
        self.score, self.chars, self.link_chars = 0.0, 0, 0


def unwanted(tag: str, attrs: dict[str, str], parent: Node) -> bool:
    """Whether an element is not part of the article, by what it is."""
    if tag in DROPPED or "hidden" in attrs:
        return True
    if attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if tag == "header" and not any(a.tag in ("article", "main") for a in ancestors(parent)):
        return True
    return False


def named(node: Node) -> bool:
    """Whether an element's kind, role or one of its names says that it is not part of the
    article."""
    if node.tag in ("html", "body", "article", "main"):
        return False
    if node.tag in DOUBTED or node.attrs.get("role", "").lower() in ROLES:
        return True
    names = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower().split()
    if not names:
        return False
    inside = any(a.tag in ("article", "main") for a in ancestors(node.parent))
    return any(said(name, inside) for name in names)


@lru_cache(1 << 14)
def said(name: str, inside: bool) -> bool:
    """Whether a name stands for something else than the article."""
    if name in NAMED_WHOLE:
        return True
    parts = [part.rstrip("0123456789") for part in PART_OF_NAME.split(name)]
    parts = [part for part in parts if part]
    chrome = [part in NAMED or (part in WEAK and not inside) for part in parts]
    return any(chrome) and all(c or part in AROUND for c, part in zip(chrome, parts))


def drop_named(order: list[Node]) -> bool:
    """Drops elements by name, the outer ones first, but none that holds the article: a
    main element, a quarter of the text in article elements, or half of all text."""
    def of_comment(node: Node) -> bool:
        return any(part.startswith("comment") for name in f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower().split()
                   for part in PART_OF_NAME.split(name))

    wanted = [node for node in order if named(node)]
    if not wanted:
        return False
    words = {id(node): 0 for node in order}
    main = set()
    for node in reversed(order):
        held = sum(words.get(id(c), 0) for c in node.children if isinstance(c, Node))
        words[id(node)] = node.chars - node.link_chars if node.tag in ("article", "main") and not of_comment(node) else held
        if node.tag == "main" or any(id(c) in main for c in node.children if isinstance(c, Node)):
            main.add(id(node))
    top = order[0]
    found = False
    for node in wanted:
        if id(node) in main:
            continue
        if words[id(top)]:
            holds = 4 * words[id(node)] >= words[id(top)]
        else:
            holds = 2 * (node.chars - node.link_chars) > top.chars - top.link_chars
        if not holds:
            node.dropped = found = True
            node.chars = node.link_chars = 0
    return found


def ancestors(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def parse(page: str) -> Node:
    """A tree of the page, whatever its faults: open paragraphs end where a block begins,
    end tags without a start are dropped, open elements end with their parent."""
    root = node = Node("#root", {}, None)
    at, n, tries = 0, len(page), TRIES
    unclosed: set[str] = set()  # raw elements whose end comes no more
    while at < n:
        tag_at = page.find("<", at)
        if tag_at < 0:
            node.children.append(page[at:])
            break
        if tag_at > at:
            node.children.append(page[at:tag_at])
        found = (TOKEN if tries or page.startswith("<!--", tag_at) else SIMPLE).match(page, tag_at)
        if not found:
            found = LOOSE.match(page, tag_at)
            tries -= bool(found and tries)
        if not found:
            node.children.append("<")
            at = tag_at + 1
            continue
        at = found.end()
        groups = found.groupdict() if found.re is not LOOSE else {}
        if groups.get("start"):
            tag = groups["start"].lower()
            if tag in BLOCK:
                node = _end(node, {"p"}, {"button", "table", "td", "th", "article", "li", "div", "section"})
            if tag in CLOSES:
                node = _end(node, CLOSES[tag], SCOPE[tag])
            said = groups["attrs"] or ""
            attrs = {}
            for key, value in ATTR.findall(said):
                attrs.setdefault(key.lower(), html.unescape(value.strip("\"'")))
            child = Node(tag, attrs, node)
            node.children.append(child)
            if tag in RAW:
                close = None if tag in unclosed else re.compile(
                    rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|</{re.escape(tag)}\Z", re.I).search(page, at)
                if close is None:
                    unclosed.add(tag)
                    at = n if tag not in ("svg", "math", "noscript", "iframe", "template") else at
                else:
                    at = close.end()
            elif tag not in VOID and child.depth < DEEPEST:
                node = child
        elif groups.get("end"):
            tag = groups["end"].lower()
            for a in ancestors(node):
                if a.tag == tag:
                    node = a.parent or root
                    break
                if a.tag in ("td", "th", "table") and tag not in BLOCK:
                    break
    return root


def _end(node: Node, tags: set[str], scope: set[str]) -> Node:
    """The parent of the nearest open element of `tags`, unless `scope` comes first."""
    for a in ancestors(node):
        if a.tag in tags:
            return a.parent
        if a.tag in scope:
            return node
    return node


def blocks(node: Node) -> Iterator[tuple[str, Node]]:
    """Texts of the blocks below a node, in page order, each with its block's element.
    White space inside is one space, character references are decoded."""
    held: list[str] = []
    # an explicit stack: pages may nest deeper than Python may call
    stack: list[tuple[Node, int]] = [(node, 0)]
    owner = [node]

    def flush() -> Iterator[tuple[str, Node]]:
        text = SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            yield text, owner[-1]

    while stack:
        current, k = stack.pop()
        if k == len(current.children):
            if current.tag in BLOCK and len(owner) > 1 and owner[-1] is current:
                yield from flush()
                owner.pop()
            continue
        stack.append((current, k + 1))
        child = current.children[k]
        if isinstance(child, str):
            held.append(html.unescape(child) if "&" in child else child)
        elif child.tag == "br":
            held.append(" ")
        elif child.dropped or child.tag in RAW:
            if child.tag in BLOCK:
                yield from flush()
        else:
            if child.tag in BLOCK:
                yield from flush()
                owner.append(child)
            stack.append((child, 0))
    yield from flush()


def link_share(node: Node) -> float:
    return node.link_chars / node.chars if node.chars else 0.0


def count(root: Node) -> list[Node]:
    """Characters of text, and of them inside links, below every node; nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped and c.tag not in RAW)
    for node in reversed(order):
        node.chars = sum(len(c.strip()) if isinstance(c, str) else c.chars for c in node.children)
        node.link_chars = node.chars if node.tag == "a" else sum(c.link_chars for c in node.children if isinstance(c, Node))
    return order


def points(text: str) -> float:
    """A paragraph's points: one, one per comma of any script, one per 100 characters up to three."""
    return 1 + sum(text.count(c) for c in ",，、،") + min(len(text) // 100, 3)


BONUS = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 2.0, "blockquote": 2.0, "td": 2.0, "pre": 2.0, "body": 0.0,
         "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "table": -1.0, "th": -5.0}


def main_text(page: str) -> str:
    """The article's blocks, one line each; empty if the page has none."""
    root = parse(page)
    order = count(root)
    if drop_named(order):
        order = count(root)
    scored: dict[int, Node] = {}

    def give(node: Node, value: float) -> None:
        if id(node) not in scored:
            scored[id(node)] = node
            node.score = BONUS.get(node.tag, 0.0) + (5.0 if KEPT.search(f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}") else 0.0)
        node.score += value

    prose: list[tuple[float, Node]] = []
    for text, owner in blocks(root):
        value = points(text) * (1 - link_share(owner))
        inner = owner if owner.tag in ("div", "section", "article", "main", "body", "td", "blockquote", "#root") else owner.parent
        if link_share(owner) < 0.5:
            prose.append((points(text), inner))
        for level, a in enumerate(ancestors(inner)):
            if a.tag == "html" or level > 4:
                break
            give(a, value / (1, 2, 6, 9, 12)[level])
    if not scored:
        return ""

    def worth(node: Node) -> float:
        return node.score * (1 - link_share(node))

    place = {id(node): k for k, node in enumerate(order)}
    best = max(scored.values(), key=lambda node: (worth(node), -place.get(id(node), 0)))
    whole = [a for a in ancestors(best) if a.tag in ("article", "main")]
    if not whole:  # an article of links scores nothing, and is the article all the same
        whole = [node for node in reversed(order) if node.tag in ("article", "main") and 2 * node.chars > root.chars][-1:]
    if whole:
        top = whole[-1]
        keep = [top]
        if top.tag == "article":
            keep = [s for s in top.parent.children
                    if isinstance(s, Node) and (s is top or s.tag == "article" and not s.dropped and link_share(s) < 0.5)]
    else:
        core = shared([inner for value, inner in prose if value >= 2] or [inner for _, inner in prose] or [best])
        top = core if core.tag in ("body", "html", "#root") else core.parent
        for s in margins(core, prose) if top is core else (s for s in top.children if s is not core):
            if isinstance(s, Node) and s.tag in BLOCK and link_share(s) >= 0.5:
                s.dropped = True
        keep = [top]
    lines = []
    for node in keep:
        lines += [text for text, _ in blocks(node)]
    return "\n".join(lines)


def margins(core: Node, prose: list[tuple[float, Node]]) -> list[Node]:
    """Children of the page's body before the first and after the last that holds prose, but
    for paragraphs: lists of links there are menus, among the prose they are its own."""
    held = {id(a) for _, inner in prose for a in ancestors(inner)}
    children = [c for c in core.children if isinstance(c, Node) and c.tag in BLOCK]
    own = [k for k, c in enumerate(children) if id(c) in held or c.tag == "p" and link_share(c) < 0.5]
    if not own:
        return []
    return [c for k, c in enumerate(children) if not own[0] < k < own[-1] and c.tag != "p"]


def shared(nodes: list[Node]) -> Node:
    """The lowest element that holds all of them."""
    found = nodes[0]
    for node in nodes[1:]:
        while found is not node:
            if found.depth >= node.depth:
                found = found.parent
            else:
                node = node.parent
    return found


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars",
            chunk_bytes: int = 4 << 20) -> DataFrame:
    """`pages` without its markup, with the main text and its length in characters.

    Each page on its own, wherever it lies; nothing is shuffled. Nulls: a null page is
    empty, and so is its text; other columns do not matter. Pages without markup are one
    block. Repeated rows: equal pages, equal texts. Empty table: no rows. Columns of
    `pages` called like the new ones are replaced.
    """
    ship(pages)
    keep = without(pages, html_col, text_col, chars_col)
    names = keep.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col, chunk_bytes):
            texts = [main_text(t.decode("utf-8", "replace")) for t in text_bytes(batch.column(html_col))]
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], names=[*names, text_col, chars_col])

    return pages.mapInArrow(run, with_fields(keep, f"`{text_col}` string, `{chars_col}` bigint"))
