"""Main text of web pages by composite text density.

A page becomes a tree of elements. Each node's density is its characters per tag, adjusted for the
share that links hold: with C characters, T tags, LC characters and LT tags of links,
C/T * log base ln(C/nonlink*LC + LCb/Cb*C + e) of (C/LC * T/LT); the base is at least LEAST_BASE, which
matters for short texts on pages with few links. A node's sum adds its children's
densities. The body's density sets the threshold: among the nodes on the path from the body to the densest node,
those at least as dense as the least dense one of that path may hold the main text; of them the one
with the largest sum is taken, or the article element that it is in, or the outermost element around it that
holds more text as dense as the threshold, and what is no text of the article is left out below it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pieces import bytes_of, per_text, small_batches

# Fixed: names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: Elements that never hold text of the article.
NEVER = frozenset(
    "head script style noscript template iframe object embed svg canvas video audio nav footer aside form button "
    "select textarea input option datalist menu dialog title noembed noframes xmp".split()
)
#: Words in a class, id or role of what stands beside the article.
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|banner|breadcrumbs?|comments?|cookies?|consent|footer|foot|gdpr|masthead|"
    r"menu|modal|nav|navbar|navigation|newsletter|notice|pagination|pager|popup|promo\w*|related|reply|replies|respond|"
    r"share|sharing|sidebar|side|signup|social|sponsor\w*|subscribe|teaser|toolbar|widget|complementary|contentinfo|"
    r"search|login|disqus)(?=$|[\s_-]|\d)",
    re.I,
)
#: Words in a class, id or role of what holds the article.
GOOD = re.compile(r"(?:^|[\s_-])(?:article|post|entry|content|story|main)(?=$|[\s_-]|body|text)", re.I)
#: Elements that can be the main text as a whole; paragraphs and smaller ones can't.
CONTAINERS = frozenset(
    "article blockquote body center details div dl fieldset figure main ol section table tbody td ul".split()
)
#: Starting one of these ends an open element of the second set, up to one of the third.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table", "tbody", "thead", "tfoot"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
#: A tag that isn't closed runs to the end, as the standard has it; one with an odd quote to the next '>'.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ENDS_RAW = {tag: re.compile(rf"</{tag}[\s/>]", re.I) for tag in RAW}
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


#: The least base of the logarithm: at 1 it would have none.
LEAST_BASE = 2.0


@dataclass
class Node:
    """An element: its children are nodes and texts in page order."""

    tag: str
    beside: bool = False
    good: bool = False
    parts: list = field(default_factory=list)
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    total: float = 0.0


def _judged(node: Node, attributes: str, path: list[Node]) -> None:
    """Mark an element that stands beside the article, or holds it, by its name and attributes."""
    if node.tag in ("body", "html"):
        return
    names = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)) if attributes else ""
    node.good = node.tag in ("article", "main") or bool(names and GOOD.search(names))
    if node.tag in NEVER or (attributes and _HIDDEN.search(attributes)):
        node.beside = True
    elif node.tag == "header":  # of the page, not of the article
        node.beside = not any(n.good for n in path)
    elif node.tag not in ("article", "main"):
        node.beside = bool(names and BESIDE.search(names))
    elif names:
        node.beside = bool(re.search(r"(?:^|[\s_-])(?:comments?|reply|replies)(?=$|[\s_-]|\d)", names, re.I))
    if node.tag in ("h1", "main") and not node.beside:
        # What holds the headline is no sidebar, whatever it is called.
        for n in reversed(path):
            if n.tag in NEVER or n.tag == "header":
                break
            n.beside = False


class _Path:
    """The open elements, and how many of each tag."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.open: Counter[str] = Counter()

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.open[node.tag] += 1

    def cut(self, depth: int) -> None:
        for node in self.nodes[depth:]:
            self.open[node.tag] -= 1
        del self.nodes[depth:]

    def last(self, tags: frozenset[str], stops: frozenset[str] = frozenset()) -> int:
        """Depth of the innermost open element of `tags` that none of `stops` is within; 0 if there is none."""
        if not any(self.open[t] for t in tags):
            return 0
        for i in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[i].tag in stops:
                return 0
            if self.nodes[i].tag in tags:
                return i
        return 0


_P = frozenset({"p"})
_SCOPES = frozenset({"table", "td", "th", "caption", "button", "object"})


def _end(path: _Path, tag: str) -> None:
    depth = path.last(frozenset({tag}))
    if not depth:
        return
    # An end tag within a line doesn't close the blocks that have begun since.
    if tag in BLOCKS or not any(n.tag in BLOCKS for n in path.nodes[depth + 1 :]):
        path.cut(depth)
    else:
        path.open[tag] -= 1
        path.nodes[depth].tag = ""
        path.open[""] += 1


def tree(page: str) -> Node:
    """The elements of a page, however it is broken: unknown end tags are passed over, open ones closed."""
    root = Node("html")
    path = _Path(root)
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            path.nodes[-1].parts.append(html.unescape(text))
        if not m:
            return root
        at = m.end()
        if m[1] is not None:
            path.nodes[-1].parts.append(m[1])
        name = m[3] or m[6]
        if not name:
            continue
        tag, attributes = name.lower(), m[4] if m[3] else m[7]
        if m[2] or m[5]:
            _end(path, tag)
            continue
        if tag == "html" and len(path.nodes) == 1:
            continue
        if tag in BLOCKS and (depth := path.last(_P, _SCOPES)):
            path.cut(depth)  # a block ends an open paragraph, with what is open in it
        if tag in ENDS and (depth := path.last(*ENDS[tag])):
            path.cut(depth)
        node = Node(tag)
        _judged(node, attributes, path.nodes)
        path.nodes[-1].parts.append(node)
        if tag in RAW:
            end = _ENDS_RAW[tag].search(page, at)
            close = page.find(">", end.start()) if end else -1
            at = len(page) if close < 0 else close + 1
        elif tag not in VOID and not attributes.endswith("/"):
            path.push(node)


def _sizes(root: Node) -> list[Node]:
    """Count characters and tags from the leaves up; the nodes in page order. Elements of NEVER count nothing."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append(node)
        node.link_tags = int(node.tag == "a")
        for part in node.parts:
            if isinstance(part, Node):
                if not part.beside:
                    stack.append((part, linked or node.tag == "a"))
            else:
                n = len(part) - part.count(" ") - part.count("\n")
                node.chars += n
                if linked or node.tag == "a":
                    node.link_chars += n
    for node in reversed(order):
        for part in node.parts:
            if isinstance(part, Node) and not part.beside:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
    return order


def density(c: int, t: int, lc: int, lt: int, ratio: float, plain: int, linked: int) -> float:
    """Composite text density of c characters and t tags, of which lc and lt (1 at least) of links; `ratio` is the body's share of links."""
    base = max(math.log(c / max(plain, 1) * linked + ratio * c + math.e), LEAST_BASE)
    return c / t * max(math.log(c / lc * t / lt), 0.0) / math.log(base)


def main_node(root: Node) -> Node:
    """The subtree with the main text."""
    order = _sizes(root)
    body = next((n for n in order if n.tag == "body"), root)
    ratio = body.link_chars / max(body.chars, 1)
    for n in order:
        c, t, lc, lt = n.chars, max(n.tags, 1), max(n.link_chars, 1), max(n.link_tags, 1)
        if not n.chars:
            continue
        n.density = density(c, t, lc, lt, ratio, n.chars - n.link_chars, n.link_chars)
    parents: dict[int, Node] = {}
    for n in order:
        for part in n.parts:
            if isinstance(part, Node) and not part.beside:
                parents[id(part)] = n
                n.total += part.density
    inside = [n for n in order if n is body or (id(n) in parents and n.tag in CONTAINERS)]
    densest = max(inside, key=lambda n: n.total)
    path = [densest]
    while path[-1] is not body and id(path[-1]) in parents:
        path.append(parents[id(path[-1])])
    least = min((n.density for n in path), default=0.0)
    able = [n for n in inside if n.density >= least]
    found = chosen = max(able, key=lambda n: n.total, default=body)
    while id(found) in parents:  # the whole article, if it is in one
        found = parents[id(found)]
        if found.tag in ("article", "main"):
            chosen = found
    return chosen if chosen.tag in ("article", "main") else _widened(chosen, body, parents, least)


def _widened(chosen: Node, body: Node, parents: dict[int, Node], least: float) -> Node:
    """The outermost element where as dense text stands next to what is chosen; its other children don't count from then on.

    Such text is at least a tenth of what is chosen, or stands in an element whose name says that it holds the article.
    """
    at, thin, passed = chosen, [], []
    while at is not body and id(at) in parents:
        up = parents[id(at)]
        nodes = [n for n in up.parts if isinstance(n, Node) and not n.beside]
        others = [n for n in nodes if n is not at and n.chars]
        dense = [n for n in others if n.density >= least and 2 * n.link_chars < n.chars]
        # Headlines and short paragraphs stay.
        passed += [n for n in others if 2 * n.link_chars >= n.chars or (n.tag in CONTAINERS and n.density < least)]
        more = sum(n.chars - n.link_chars for n in dense) + up.chars - sum(n.chars for n in nodes)
        if more and (up.good or 10 * more >= chosen.chars - chosen.link_chars):
            chosen, thin = up, list(passed)
        at = up
    for n in thin:
        # Links between the words of a line belong to it.
        n.beside = n.beside or n.tag in BLOCKS
    return chosen


def blocks(node: Node) -> list[str]:
    """The texts of the blocks below a node in page order, white space made single spaces."""
    out: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append(text)
        held.clear()

    stack: list = [node]
    while stack:
        part = stack.pop()
        if part is None:
            close()
        elif isinstance(part, str):
            held.append(part)
        elif part.beside:
            held.append(" ")
        else:
            if part.tag in ("br", "img", "wbr"):
                held.append("" if part.tag == "wbr" else " ")
            block = part.tag in BLOCKS
            if block:
                close()
                stack.append(None)
            stack.extend(reversed(part.parts))
    close()
    return out


def main_text(page: str) -> str:
    """The article's blocks, joined by line ends; empty for a page without text."""
    return "\n".join(blocks(article(main_node(tree(page)))))


def article(node: Node) -> Node:
    """The node itself, or the article that it wraps: a single `article` or `main` element below it."""
    stack, found = [node], []
    while stack:
        n = stack.pop()
        if n.tag in ("article", "main") and n.chars:
            found.append(n)
            continue
        stack.extend(p for p in n.parts if isinstance(p, Node) and not p.beside)
    return found[0] if len(found) == 1 else node


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, text, n_chars.

    Null and empty pages, and pages without text, give the empty text. Repeated rows come back repeated;
    other columns are not read.
    """
    id_kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(b.decode()) for b in bytes_of(batch, "_html")]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=[id_col, url_col, "text", "n_chars"]
        )

    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    return small_batches(source).mapInArrow(
        per_text("_html", work), f"`{id_col}` {id_kind}, `{url_col}` {url_kind}, text string, n_chars long"
    )


def op2_page_text(spark, sf_dir: str) -> DataFrame:
    return page_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
