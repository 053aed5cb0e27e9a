"""Main text of web pages by composite text density.

Each page becomes a tree of elements.  Parts that HTML itself names as
furniture (navigation, headers, footers, sidebars, forms, scripts) and hidden parts
are cut at once, headers inside an article with the title they hold included.  What
only a class, id or role names is cut if it does not hold the node of the highest
density sum and its own sum is low or its share of the text small; what is named as
readers' comments is cut wherever it stands, as long as other text is left.
Captions stay.  For every remaining node

    density = C / T * log_base(C / LC' * T / LT'),
    base    = ln(C / NLC' * LC + LCB / CB' * C + e),

with C characters, T tags, LC and LT characters and tags inside links, NLC the
others, and LCB, CB those of the body (primed: at least 1).  The node whose
children's densities sum highest below the body holds the article; the lowest
density on its path to the body is the threshold.  The article is the highest node
above it, below the body, whose text lies mostly in subtrees at or above the
threshold or in headings, whatever the node is called.  Inside it only lists of
links below the threshold are left out.

Reading a page takes time in proportion to its length: the open elements are kept
by name, so no tag searches the elements that enclose it.

Defined cases: null and empty html, and pages without text, give an empty text;
unclosed, misnested and cut-off markup is read as far as it goes; nesting of any
depth is handled without recursion.  Every row gives one row; repeated or null
ids and further columns play no part.  No shuffle.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
DROPPED = set(
    "nav header footer aside form script style noscript template iframe object button select textarea input dialog menu "
    "svg canvas audio video head title".split()
)
RAW = set("script style textarea title noscript iframe template".split())
CLOSES_P = set(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split()
)
SAME_CLOSES = {"li": {"ul", "ol", "menu"}, "option": {"select"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "dt": {"dl"}, "dd": {"dl"}}

# Words that name furniture in a class, id or role, and those for readers' comments.
_WORDS = (
    r"ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar|footer|header|masthead|"
    r"share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|cookies?|consent|gdpr|notice|alert|"
    r"popup|modal|overlay|widget|pagination|pager|login|search|toolbar|complementary|contentinfo|navigation|disclaimer|"
    r"copyright|skip|hidden"
)
_COMMENT_WORDS = r"comments?|replies|reply|respond|disqus"
_PLACES = r"(?:[_-](?:list|box|bar|area|links?|buttons?|items?|block|form|menu|section|container|wrapper|inner|body|text|thread))?"


def _tokens(words: str) -> re.Pattern[str]:
    """Whole tokens of ``words``, with one word before (but no denial of it) or a place behind."""
    return re.compile(rf"(?:^|\s)(?:(?!(?:no|not|with|without|has|show|hide|is)[_-])[a-z0-9]+[_-])?(?:{words}){_PLACES}(?=$|\s)", re.I)


_FURNITURE, _COMMENTS = _tokens(f"{_WORDS}|{_COMMENT_WORDS}"), _tokens(_COMMENT_WORDS)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_KEPT = {"html", "body", "article", "main"} | _HEADINGS
_LISTS = {"ul", "ol", "dl", "menu", "table"}
#: Share of the page's text from which an element is no furniture for its name alone.
SHARE = 0.5
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    __slots__ = ("tag", "parent", "depth", "block", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "named", "comment")

    def __init__(self, tag: str, parent: "Node | None") -> None:
        self.tag, self.parent = tag, parent
        self.depth: int = parent.depth + 1 if parent else 0
        #: the element itself, or the innermost around it, that is not inline
        self.block: Node = parent.block if parent and tag in INLINE else self
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.named = self.comment = False  # furniture by class, id or role; readers' comments


def _furniture(tag: str, attributes: str) -> bool:
    """Whether the element itself, or that it is hidden, makes it furniture."""
    if tag in DROPPED:
        return True
    if not attributes or tag in _KEPT:
        return False
    for m in _ATTR.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _named(tag: str, attributes: str, names: re.Pattern[str]) -> bool:
    """Whether a class, id or role holds one of ``names``."""
    if not attributes or tag in _KEPT:
        return False
    return any(m[1].lower() in ("class", "id", "role") and names.search(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attributes))


class _Builder:
    """The tree of a page as it is read; ``opened`` holds the open elements of each name."""

    def __init__(self) -> None:
        self.root = self.here = Node("html", None)
        self.opened: dict[str, list[Node]] = {"html": [self.root]}
        self.cut: Node | None = None  # outermost furniture that is open

    def text(self, piece: str) -> None:
        if piece and self.cut is None:
            self.here.children.append(html.unescape(piece))

    def open(self, tag: str, keep: bool = True) -> Node:
        node = Node(tag, self.here)
        if keep:
            self.here.children.append(node)
        self.opened.setdefault(tag, []).append(node)
        self.here = node
        return node

    def close(self, node: Node) -> None:
        """Close ``node`` and what is open inside it."""
        while True:
            last = self.here
            self.opened[last.tag].pop()
            if last is self.cut:
                self.cut = None
            self.here = last.parent
            if last is node:
                return

    def innermost(self, tag: str) -> Node | None:
        stack = self.opened.get(tag)
        return stack[-1] if stack else None

    def close_implied(self, tag: str) -> None:
        """Close an open item before the next one, or an open paragraph before a block."""
        stops = SAME_CLOSES.get(tag)
        if stops is not None:
            item = self.innermost(tag)
            fence = max((n.depth for n in map(self.innermost, stops) if n is not None), default=0)
            if item is not None and item.depth > fence:
                self.close(item)
        if tag in CLOSES_P and self.here.block.tag == "p":
            self.close(self.here.block)


def parse(page: str) -> Node:
    """The tree of a page, without furniture elements and hidden parts."""
    tree = _Builder()
    at, size, last_end = 0, len(page), page.rfind(">")
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            tree.text(page[at:])
            break
        m = _TOKEN.match(page, lt)
        if m is None:  # a lone "<", or a tag that the page's end cuts inside a quoted value
            broken = lt > last_end and re.match(r"</?[a-zA-Z]", page[lt : lt + 3])
            tree.text(page[at:lt] if broken else page[at : lt + 1])
            at = size if broken else lt + 1
            continue
        tree.text(page[at:lt])
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                tree.text(m[0][9:].removesuffix("]]>"))
            continue
        if not m[4]:
            break
        if m[1]:
            node = tree.innermost(tag)
            if node is not None and node is not tree.root:
                tree.close(node)
            continue
        if tag in ("html", "body"):
            if tag == "body" and tree.here is tree.root:
                tree.open("body")
            continue
        if tag in CLOSES_P or tag in SAME_CLOSES:
            tree.close_implied(tag)
        if tag in VOID or m[3].endswith("/") and tag not in RAW:
            tree.here.children.append(Node(tag, tree.here))
            continue
        furniture = tree.cut is None and _furniture(tag, m[3])
        node = tree.open(tag, keep=not furniture)
        if furniture:
            tree.cut = node
        if tree.cut is None:
            node.named = _named(tag, m[3], _FURNITURE)
            node.comment = node.named and _named(tag, m[3], _COMMENTS)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else size
            tree.close(node)
    return tree.root


def _measure(root: Node) -> list[Node]:
    """Fill in the counts and densities of all nodes; returns them parents first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = 0.0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len("".join(c.split()))
            else:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags + (c.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    body = max(root.chars, 1)
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + root.link_chars / body * c + math.e)
            ratio = c / max(lc, 1) * t / lt
            node.density = c / t * (math.log(ratio) / math.log(base) if base > 1 and ratio > 0 else math.log(max(ratio, 1)))
    for node in order:
        node.total = sum(c.density for c in node.children if isinstance(c, Node))
    return order


def _densest(root: Node, order: list[Node]) -> Node:
    best = max(order, key=lambda n: n.total)
    return best if best.total > 0 else root


def _threshold(node: Node | None) -> float:
    """The lowest density on the path from a node to the root."""
    least = node.density
    while node is not None:
        least = min(least, node.density)
        node = node.parent
    return least


def _cut(nodes: set[Node]) -> None:
    for parent in {n.parent for n in nodes}:
        parent.children = [c for c in parent.children if c not in nodes]


def _cut_named(root: Node, order: list[Node]) -> None:
    """Cut named furniture unless it holds the densest node, or much of the text at a high density sum."""
    best = _densest(root, order)
    threshold, path, node = _threshold(best), set(), best
    while node is not None:
        path.add(node)
        node = node.parent
    _cut({n for n in order if n.named and n not in path and (n.total < threshold or n.chars < SHARE * root.chars)})


def _article(best: Node) -> tuple[Node, float]:
    """The highest node above the densest one whose text is mostly content, and its threshold."""
    threshold = _threshold(best)
    node, found = best, best
    while node.parent is not None and node.parent.parent is not None and node.tag != "body" and node.parent.tag != "body":
        node = node.parent
        content = sum(len("".join(c.split())) if isinstance(c, str) else c.chars * (c.density >= threshold or c.tag in _HEADINGS or c.tag in INLINE) for c in node.children)
        if 2 * content >= node.chars:
            found = node
    return found, threshold


def _main(root: Node) -> tuple[Node, float]:
    """The node that holds the article, and the density threshold of its path."""
    order = _measure(root)
    comments = {n for n in order if n.comment}
    if comments and root.chars > sum(n.chars for n in comments if not _inside(n, comments)):
        _cut(comments)
        order = _measure(root)
    if any(n.named for n in order):
        _cut_named(root, order)
        order = _measure(root)
    return _article(_densest(root, order))


def _inside(node: Node, others: set[Node]) -> bool:
    node = node.parent
    while node is not None:
        if node in others:
            return True
        node = node.parent
    return False


def _link_list(node: Node, threshold: float) -> bool:
    """A list below the threshold whose text is mostly links is a menu."""
    return node.tag in _LISTS and node.density < threshold and node.link_tags > 1 and 2 * node.link_chars > node.chars


def main_text(page: str | None) -> str:
    """The page's main text: blocks in order, joined by single spaces."""
    if not page:
        return ""
    best, threshold = _main(parse(page))
    out: list[str] = []
    stack: list[Node | str] = [best]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        if item is not best and _link_list(item, threshold):
            continue
        block = item.tag not in INLINE
        if block:
            out.append(" ")
            stack.append(" ")
        stack += reversed(item.children)
    return " ".join("".join(out).split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
