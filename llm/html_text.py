"""HTML extraction by tag-path ratios (operator 8).

A page is read into blocks of text, each with its tag path from the root. Per path,
text length and punctuation are summed over the path's nodes and divided by their
number. The two ratios are fused and smoothed over neighbouring nodes in page order,
links count against a path, and what the paths weigh is summed up the tree. The
content is all of an article or main that holds most of that weight. Where none is
named, it is what lies under the smallest container of the paths above the threshold,
with the headings before it, without paths that are mostly links; dense paths beside
it are kept, too.

Menus, headers, footers, sidebars, notices, adverts, forms and comments that say by
element, class, id or role what they are never take part.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm.common import as_bytes, map_batches, table

_NAME = r"[a-zA-Z][^\s/>]*"
# Nothing here is tried twice over a long stretch, whatever is left open in a page.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|"
    rf"<(?P<close>/?)(?P<name>{_NAME})"
    r"(?P<attributes>(?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*+>|[^>]*>)|"
    r"<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.DOTALL,
)
_BEGIN = re.compile("<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|["']""")
_RAW = frozenset("script style template iframe textarea title".split())
# Set apart only where an end tag follows: left open, they would take the rest of the page.
_APART_CLOSED = frozenset("svg select noscript annotation annotation-xml".split())
# In these, "/>" ends any element, and none begins a block.
_FOREIGN = ("svg", "math")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
    "object s samp small span strike strong sub sup time tt u var wbr".split()
)
# Leaves that hold sentences, never a whole article.
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption td th caption".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAMED = frozenset(("article", "main"))
_APART = frozenset("head nav footer aside button dialog menu".split())
_APART_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())
# Set apart as a class or id does it: some pages stand in a form as a whole.
_FORMS = frozenset("form fieldset".split())
_APART_WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo banner nav navbar navigation menu "
    "breadcrumb breadcrumbs footer header masthead sidebar aside widget comment comments reply replies "
    "respond disqus cookie cookies notice notices consent gdpr alert popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended pagination pager skip toolbar form".split()
)
# What readers wrote; with them may stand how it is shown.
_COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus".split())
_COMMENT_PARTS = frozenset(
    "body content text author meta thread threads user users reader readers visitor visitors date avatar count odd "
    "even depth byuser parent children holder entry post view wrapper title inner item tree feed fb".split()
)
# A class or id of several words tells what an element is if these are all it says besides.
_PLACES = frozenset(
    "site main top bottom left right global primary secondary area box container wrapper wrap list bar block section "
    "link links button buttons posts articles stories inner outer item items".split()
)
# Marks by class or id never count on these.
_UNMARKED = frozenset("html body article main p h1 h2 h3 h4 h5 h6".split())
_CLOSED_BY_SAME = {
    "li": {"ul", "ol", "menu"},
    "dt": {"dl"},
    "dd": {"dl"},
    "tr": {"table", "tbody", "thead", "tfoot"},
    "td": {"tr", "table"},
    "th": {"tr", "table"},
    "option": {"select", "datalist"},
}
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？;»«]")


@dataclass(frozen=True)
class Ratios:
    """How paths are judged.

    ``share``: a container must hold this share of its parent's weight to be entered.
    ``threshold``: paths and their nodes need this part of the mean fused ratio to
    count as content on their own.
    ``rest``: a container is left for a child only if content of less than this share
    lies outside the child.
    ``links``: paths in a container without a telling name may be so much of links.
    ``spread``: standard deviation, in nodes, of the smoothing.
    """

    share: float = 0.6
    threshold: float = 0.5
    rest: float = 0.02
    links: float = 0.5
    spread: float = 1.0


@dataclass
class Node:
    """A block of text and the element it stands in."""

    element: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    marks: tuple[int, ...] = ()  # the elements around it that a name sets apart, outer ones first

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass
class Tree:
    """The page's block elements, numbered from the root 0, parents before children.

    ``path`` numbers the tag paths: elements of one kind and class under one path
    share theirs.
    """

    parent: list[int] = field(default_factory=lambda: [0])
    kind: list[str] = field(default_factory=lambda: [""])
    path: list[int] = field(default_factory=lambda: [0])
    nodes: list[Node] = field(default_factory=list)
    paths: dict[tuple[int, str, str], int] = field(default_factory=dict)
    marked: dict[int, str] = field(default_factory=dict)  # what names say of elements: form, comment or apart

    def add(self, parent: int, name: str, label: str) -> int:
        self.parent.append(parent)
        self.kind.append(name)
        known = self.paths
        self.path.append(known.setdefault((self.path[parent], name, label), len(known) + 1))
        return len(self.parent) - 1


@dataclass
class Open:
    """An element that is not closed yet."""

    name: str
    apart: bool
    block: int  # the innermost block element, itself included
    marked: bool = False


def tells(token: str) -> str:
    """What a whole class or id names: ``comment``, ``apart`` such as ``site-footer``, or nothing."""
    words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
    telling = _APART_WORDS | _PLACES
    if any(word in _COMMENT_WORDS for word in words) and all(word in telling or word in _COMMENT_WORDS or word in _COMMENT_PARTS for word in words):
        return "comment"
    return "apart" if any(word in _APART_WORDS for word in words) and all(word in telling for word in words) else ""


def marks_of(attributes: str) -> tuple[str, bool, str]:
    """A label made of the classes; whether hidden or role set an element apart; what a
    class or id says of it."""
    label, apart, marked = "", False, ""
    for match in _ATTRIBUTE.finditer(attributes):
        name = (match[1] or "").lower()
        value = html.unescape(match[2] or match[3] or match[4] or "")
        if name == "hidden":
            apart = True
        elif name == "role":
            role = value.strip().lower()
            apart |= role in _APART_ROLES
            marked = marked or "form" * (role == "form")
        elif name in ("class", "id"):
            told = {tells(token) for token in value.split()}
            marked = "comment" if "comment" in told else marked or "apart" * ("apart" in told)
            if name == "class":
                label = ".".join(sorted(value.lower().split()))
    return label, apart, marked


class Reader:
    """Open elements, and how many of them are of a name or set apart."""

    def __init__(self) -> None:
        self.tree = Tree()
        self.stack: list[Open] = []
        self.held: dict[str, int] = defaultdict(int)
        self.apart = 0
        self.marks: tuple[int, ...] = ()

    @property
    def foreign(self) -> bool:
        return any(self.held[name] for name in _FOREIGN)

    def push(self, name: str, attributes: str, ends: bool = True) -> None:
        label, apart, marked = marks_of(attributes)
        inside = self.held["article"] or self.held["main"]
        apart = apart or name in _APART or name == "header" and not inside or name in _APART_CLOSED and ends
        block = self.stack[-1].block if self.stack else 0
        if name not in _INLINE and name not in _FOREIGN and not self.foreign:
            block = self.tree.add(block, name, label)
            if name in _FORMS:
                marked = marked or "form"
            if name in _UNMARKED and not (name == "article" and marked == "comment"):
                marked = ""
            if marked:
                self.marks += (block,)
                self.tree.marked[block] = marked
        else:
            apart, marked = apart or bool(marked), ""
        # The page itself cannot be set apart.
        opened = Open(name, apart and name not in ("html", "body", "article", "main"), block, bool(marked))
        self.stack.append(opened)
        self.held[name] += 1
        self.apart += opened.apart

    def pop_to(self, at: int) -> None:
        for closed in self.stack[at:]:
            self.held[closed.name] -= 1
            self.apart -= closed.apart
            if closed.marked:
                self.marks = self.marks[:-1]
        del self.stack[at:]

    def close(self, name: str) -> None:
        if not self.held[name]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].name == name:
                self.pop_to(at)
                return
            # An inline end tag does not close the block it stands in.
            if name in _INLINE and self.stack[at].name not in _INLINE:
                return

    def close_before(self, name: str) -> None:
        """Close what the start of ``name`` ends by itself: paragraphs, items, cells."""
        for at in range(len(self.stack) - 1, -1, -1):
            open_ = self.stack[at].name
            same = open_ == name and name in _CLOSED_BY_SAME
            if open_ == "p" or same or {open_, name} in ({"dt", "dd"}, {"td", "th"}):
                self.pop_to(at)
                return
            if open_ not in _INLINE and (open_ not in _CLOSED_BY_SAME or name not in _CLOSED_BY_SAME):
                return


def blocks_of(page: str) -> Tree:
    """The page's blocks in order, without those set apart; blank ones are left out."""
    reader = Reader()
    nodes = reader.tree.nodes
    current: Node | None = None
    raw: str | None = None
    # What begins behind the last end of a tag is no whole tag, and the page ends there.
    unfinished = _BEGIN.search(page, page.rfind(">") + 1)
    page = page[: unfinished.start()] if unfinished else page
    last_end = {name: max((m.start() for m in re.finditer(rf"</{name}(?=[\s/>])", page, re.I)), default=-1) for name in _APART_CLOSED}
    at, size = 0, len(page)
    while at < size:
        if raw:
            found = re.compile(rf"</{raw}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at, raw = (found.end() if found else size), None
            continue
        match = _TOKEN.match(page, at)
        at = match.end()
        text = match["text"] or match["data"]
        if text is not None:
            if reader.apart:
                continue
            if match["text"]:
                text = html.unescape(text)
            if current is None:
                current = Node(reader.stack[-1].block if reader.stack else 0, marks=reader.marks)
                nodes.append(current)
            current.parts.append(text)
            current.linked += len(text.strip()) if reader.held["a"] else 0
            continue
        if not match["name"]:
            continue
        name = match["name"].lower()
        inline = name in _INLINE or name in _FOREIGN or reader.foreign
        if not inline:
            current = None
        elif name == "br" and current is not None:
            current.parts.append(" ")
        if match["close"]:
            reader.close(name)
            continue
        if not inline:
            reader.close_before(name)
        complete = match["attributes"].endswith("/>") and inline
        if name in _RAW:
            raw = None if complete else name
        elif name not in _VOID and not complete:
            reader.push(name, match["attributes"], last_end.get(name, size) >= at)
    reader.tree.nodes = unmarked(reader.tree, [node for node in nodes if node.text])
    return reader.tree


def unmarked(tree: Tree, nodes: list[Node], share: float = 0.1, least: int = 80) -> list[Node]:
    """The nodes outside marked elements, as far as names leave an article.

    Where hardly any text outside links is left, less than ``share``, the outermost marked
    element with the most text loses its mark, if it holds ``least`` characters: a form or
    a wrapper around the whole page. Comments lose theirs only if no sentence is left. All
    marks hold as soon as something is left in an article or main.
    """
    named = [False]
    for element in range(1, len(tree.parent)):
        own = tree.kind[element] in _NAMED and element not in tree.marked
        named.append(named[tree.parent[element]] or own)
    sizes = [max(len(node.text) - node.linked, 0) for node in nodes]
    total = sum(sizes)
    outer = [0] * len(nodes)  # how many of a node's marks are lost
    lost: set[int] = set()
    while True:
        held: dict[int, int] = defaultdict(int)
        clean = sentences = 0
        for at, node in enumerate(nodes):
            while outer[at] < len(node.marks) and node.marks[outer[at]] in lost:
                outer[at] += 1
            if outer[at] < len(node.marks):
                held[node.marks[outer[at]]] += sizes[at]
                continue
            if named[node.element] and sizes[at]:
                clean = total
            clean += sizes[at]
            sentences += sizes[at] >= 25 and 2 * node.linked <= len(node.text) and bool(_PUNCTUATION.search(node.text))
        heaviest = max(held, key=lambda element: (held[element], -element), default=None)
        if heaviest is None or held[heaviest] < least or clean >= share * total:
            break
        if tree.marked[heaviest] == "comment" and sentences:
            break
        lost.add(heaviest)
    return [node for at, node in enumerate(nodes) if outer[at] == len(node.marks)]


def path_ratios(tree: Tree, ratios: Ratios) -> dict[int, float]:
    """Fused ratio of each path: characters and punctuation per node, smoothed."""
    nodes = tree.nodes
    length = np.array([max(len(n.text) - n.linked, 0) for n in nodes], float)
    marks = np.array([len(_PUNCTUATION.findall(n.text)) if 2 * n.linked <= len(n.text) else 0 for n in nodes], float)
    members: dict[int, list[int]] = defaultdict(list)
    for at, node in enumerate(nodes):
        members[tree.path[node.element]].append(at)
    fused = np.empty(len(nodes))
    for own in members.values():
        fused[own] = np.sqrt(length[own].mean() * (1 + marks[own].mean()))
    offsets = np.arange(-3, 4)
    kernel = np.exp(-0.5 * (offsets / ratios.spread) ** 2)
    near = np.pad(fused, 3, mode="edge")
    smooth = np.convolve(near, kernel / kernel.sum(), mode="valid")
    return {path: float(smooth[own].mean()) for path, own in members.items()}


def content(tree: Tree, ratios: Ratios = Ratios()) -> list[Node]:
    """The nodes of the main text."""
    nodes = tree.nodes
    if not nodes:
        return []
    ratio = path_ratios(tree, ratios)
    path = [tree.path[node.element] for node in nodes]
    # Weight of every element: its text outside links, times what its path is worth.
    weight = [0.0] * len(tree.parent)
    links: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for node, own in zip(nodes, path):
        weight[node.element] += max(len(node.text) - node.linked, 0) * (1 + ratio[own])
        links[own][0] += node.linked
        links[own][1] += len(node.text)
    children: dict[int, list[int]] = defaultdict(list)
    for element in range(len(weight) - 1, 0, -1):
        weight[tree.parent[element]] += weight[element]
        children[tree.parent[element]].append(element)
    prose = [(ratio[own], len(n.text)) for n, own in zip(nodes, path) if links[own][0] <= ratios.links * links[own][1]]
    dense = sum(r * n for r, n in prose) / sum(n for _, n in prose) if prose else 0.0
    # What is content wherever it stands, links inside its sentences included.
    sure = [
        links[own][0] <= ratios.links * links[own][1] and min(ratio[own], len(node.text)) >= ratios.threshold * dense
        for node, own in zip(nodes, path)
    ]
    firm = [0.0] * len(tree.parent)
    for node, own in zip(nodes, sure):
        firm[node.element] += len(node.text) * own
    for element in range(len(firm) - 1, 0, -1):
        firm[tree.parent[element]] += firm[element]
    # An element that is, or holds, an article or main.
    has_name = [kind in _NAMED for kind in tree.kind]
    for element in range(len(has_name) - 1, 0, -1):
        has_name[tree.parent[element]] |= has_name[element]
    inner = 0
    while children[inner] and tree.kind[inner] not in _NAMED:
        heavy = max(children[inner], key=lambda e: (weight[e], -e))
        if tree.kind[heavy] in _LEAVES or not weight[heavy] or weight[heavy] < ratios.share * weight[inner]:
            break
        # Content beside an element without a telling name belongs to the same text.
        if not has_name[heavy] and firm[inner] - firm[heavy] > ratios.rest * firm[inner]:
            break
        inner = heavy
    within = [False] * len(weight)
    within[inner] = True
    for element in range(inner + 1, len(weight)):
        within[element] = within[tree.parent[element]]
    named = tree.kind[inner] in _NAMED
    above = {inner}
    while inner:
        inner = tree.parent[inner]
        above.add(inner)
    first = next((at for at, node in enumerate(nodes) if within[node.element]), 0)
    kept = []
    for at, (node, own) in enumerate(zip(nodes, path)):
        mostly_links = links[own][0] > ratios.links * links[own][1]
        kind, outer = tree.kind[node.element], tree.parent[node.element]
        if within[node.element]:
            if named or not mostly_links:
                kept.append(node)
        # Text as dense as the article's own, and the headings that stand before it.
        elif kind in _LEAVES and sure[at] or kind in _HEADINGS and at < first and outer in above and not mostly_links:
            kept.append(node)
    return kept


def main_text(page: str, ratios: Ratios = Ratios()) -> str:
    return "\n".join(node.text for node in content(blocks_of(page), ratios))


def extract(
    pages: DataFrame, ratios: Ratios = Ratios(), id_col: str = "page_id", html_col: str = "html"
) -> DataFrame:
    """``pages``' id and url with ``text`` and ``n_chars``.

    A null or empty page, and one without text, has an empty text. Pages are read one
    by one, so repeated rows, null ids and an empty table need nothing; other columns
    are not read. Long pages are read whole.
    """
    keys = [id_col] + [c for c in ("url",) if c in pages.columns]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(page.decode("utf-8", "replace"), ratios) for page in batch.columns[-1].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            names=[*keys, "text", "n_chars"],
        )

    kinds = ", ".join(f"`{name}` {pages.schema[name].dataType.simpleString()}" for name in keys)
    rows = pages.select(*keys, as_bytes(html_col).alias("html_bytes"))
    return map_batches(rows, run, f"{kinds}, text string, n_chars long")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
