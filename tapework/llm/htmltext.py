"""Main-text extraction from web pages by composite text density.

For every node of a page: characters per tag, adjusted for the characters inside links. A node's score is the sum of
its children's densities. The main subtree starts at the node with the highest score and widens to the ancestor that holds
its sibling parts: nodes whose own density reaches the threshold, the least density on the path from body to that node.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tapework.llm.common import made_from

#: Elements that never hold article text, that break a block, that have no end tag, and closing rules.
SKIPPED = frozenset("script style noscript template head title nav header footer aside button select option textarea iframe svg canvas object embed dialog menu".split())
BLOCKS = frozenset("address article blockquote body br dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul caption center".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
P_STOPS = BLOCKS - {"p"}
CLOSES_P = BLOCKS - {"br", "body", "html"}
#: Kinds of elements that close one another, and what they are not looked for beyond: paragraphs, then items of lists and tables.
_LISTS = frozenset("ul ol dl table select".split())
KINDS = ((frozenset(["p"]), P_STOPS), *((frozenset(kind.split()), _LISTS) for kind in ("li", "dd dt", "tr", "td th", "option")))
ITEMS = {name: k for k, (kind, _) in enumerate(KINDS) if k for name in kind}
SCOPED = frozenset().union(*(kind | stops for kind, stops in KINDS))
#: Elements that text is told in; a line that stands bare in a container beside them is none of an article's.
TOLD = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption caption".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
#: Words in a class, id or role that mark menus, notices, adverts and reader comments. They and forms count only where size and density agree.
NOISE = re.compile(r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|banner|sponsor(?:ed)?|promo|nav(?:igation|bar)?|menu|breadcrumbs?|sidebar|footer|masthead|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|sharing|social|comments?|comment-list|respond|replies|related|recommended|widget|toolbar|pagination|complementary|contentinfo|search)(?:$|[-_ ])", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
CLASS = re.compile(r"\bclass\s*=\s*([\"'][^\"']+|[^\s>\"']+)", re.I)
COMMENTS = re.compile(r"(?:^|[-_ ])(?:comments?|comment-list|respond|replies)(?:$|[-_ ])", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
SPACE = re.compile(r"\s+")
#: Shares of a page's text outside links: a marked node with MOST is kept, one with SOME if it is as dense as the page, reader comments only with NEARLY_ALL
#: or as a wrapper of main or h1; siblings widen the result if they hold WIDENS of its text. A line of less than A_LINE characters stays what it is marked.
MOST, SOME, NEARLY_ALL, WIDENS, A_LINE = 0.5, 0.2, 0.9, 0.1, 200


class Node:
    __slots__ = ("name", "parent", "children", "chars", "tags", "link_chars", "link_tags", "noise", "pieces", "doubt", "marks", "kind", "scope", "told", "headed")

    def __init__(self, name: str, parent: Node | None, noise: bool = False, doubt: bool = False, marks: str = "", kind: str = ""):
        self.name, self.parent, self.noise, self.doubt, self.marks, self.kind = name, parent, noise, doubt, marks, kind
        self.children: list[Node] = []
        self.pieces: list[str | Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = self.told = self.headed = 0
        # The open element of each kind that a new one of the kind would close, so that none is searched for.
        above = parent.scope if parent else (None,) * len(KINDS)
        self.scope = tuple(self if name in kind else None if name in stops else up for up, (kind, stops) in zip(above, KINDS, strict=True)) if name in SCOPED else above


def parse(html: str) -> Node:
    """The page as a tree, forgiving: unclosed elements end with their parents, stray end tags are ignored."""
    root = node = Node("#root", None)
    at, end = 0, len(html)
    open_ = Counter()  # elements between root and node, so that no search goes up for one that is not there

    def up_to(outer: Node) -> Node:
        inner = node
        while inner is not outer:
            open_[inner.name] -= 1
            inner = inner.parent
        return outer

    while at < end:
        m = TOKEN.search(html, at)
        if text := html[at : m.start() if m else end]:
            node.pieces.append(unescape(text) if "&" in text else text)
        if not m:
            break
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if open_[name]:
                up = node
                while up.name != name:
                    up = up.parent
                node = up_to(up.parent)
            continue
        if (name in CLOSES_P or name == "p") and node.scope[0]:
            node = up_to(node.scope[0].parent)
        if name in ITEMS and (item := node.scope[ITEMS[name]]):
            node = up_to(item.parent)
        marked = MARKED.findall(m[3]) if m[3] else []
        marks = " ".join(filter(None, (y for x in marked for y in x)))
        doubt = name == "form" or name not in ("body", "html", "main") and any(NOISE.search(" ".join(filter(None, x))) for x in marked)
        child = Node(name, node, name in SKIPPED or bool(m[3]) and bool(HIDDEN.search(m[3])), doubt, marks, f"{name} {c[1]}" if (c := CLASS.search(m[3] or "")) else "")
        node.children.append(child)
        node.pieces.append(child)
        if name in VOID or m[0].endswith("/>"):
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        node = child
        open_[name] += 1
    return root


def _in_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        if not n.noise:
            stack.extend(n.children)
    return order


def _count(order: list[Node]) -> None:
    for n in reversed(order):
        if n.noise:
            n.chars = n.tags = n.link_chars = n.link_tags = n.told = n.headed = 0
            continue
        n.chars = sum(len(p.strip()) for p in n.pieces if isinstance(p, str)) + sum(c.chars for c in n.children)
        n.tags = sum(1 + c.tags for c in n.children if not c.noise)
        n.link_chars = n.chars if n.name == "a" else sum(c.link_chars for c in n.children)
        n.link_tags = sum((c.name == "a") + c.link_tags for c in n.children if not c.noise)
        n.told = n.chars - n.link_chars if n.name in TOLD else sum(c.told for c in n.children)
        n.headed = int(n.name in ("h1", "h2", "h3") and n.chars > 0 or any(c.headed for c in n.children))


def _holds(a: Node, b: Node | None) -> bool:
    while b is not None and b is not a:
        b = b.parent
    return b is a


def _settle(root: Node) -> None:
    """Marked nodes and forms become noise, unless they hold so much of the counted page that the mark cannot be meant for all of it."""
    page, order = max(root.chars - root.link_chars, 1), _in_order(root)
    named = [x for x in order if x.name in ("article", "main") and x.chars]
    for n in order:
        if not n.doubt:
            continue
        free, linked = n.chars - n.link_chars, 2 * n.link_chars > n.chars
        share = free / page
        if free < A_LINE or named and not any(_holds(x, n) or _holds(n, x) for x in named):
            kept = False  # a page that names its article elsewhere agrees with the mark
        elif COMMENTS.search(n.marks):
            kept = share >= NEARLY_ALL or share >= MOST and any(x.name in ("main", "h1") for x in _in_order(n))
        else:
            kept = share >= MOST or share >= SOME and not linked and n.chars * max(root.tags, 1) >= root.chars * max(n.tags, 1)
        n.noise = not kept


def main_node(root: Node) -> Node | None:
    """The subtree with the largest density sum; None for a page without text."""
    _count(_in_order(root))
    _settle(root)
    order = _in_order(root)
    _count(order)
    body = next((n for n in order if n.name == "body" and not n.noise), root)
    if not body.chars:
        return None
    page = body.link_chars / body.chars

    def density(n: Node) -> float:
        if n.noise or not n.chars:
            return 0.0
        tags, links = max(n.tags, 1), max(n.link_tags, 1)
        free = max(n.chars - n.link_chars, 1)
        base = math.log(n.chars * n.link_chars / free + page * n.chars + math.e)
        ratio = (n.chars / max(n.link_chars, 1)) * (tags / links)
        return n.chars / tags * math.log(max(ratio, 1.0) + 1) / math.log(base + 1)

    inside, found = [], [body]
    while found:
        n = found.pop()
        inside.append(n)
        found.extend(c for c in n.children if not c.noise)
    dense = {id(n): density(n) for n in inside}
    total = {id(n): sum(dense.get(id(c), 0.0) for c in n.children) for n in inside}
    top, path = max(inside, key=lambda n: total[id(n)]), []
    n: Node | None = top
    while n is not None:
        path.append(dense[id(n)])
        n = None if n is body else n.parent
    threshold, best = min(path), top
    # Inline markup and single paragraphs are parts of the article, not the article.
    while best is not body and (best.name not in BLOCKS or best.name in ("p", "li", "td", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6")):
        best = best.parent
    best = _narrowed(best)
    return _widened(best, body, dense, threshold)


def _narrowed(best: Node) -> Node:
    """The lowest container that holds nearly all that is told in paragraphs, headings and items: bare lines and links beside it are no article.

    These must hold half of the free text, unless they are a heading and more in one container.
    """
    def whole(n: Node) -> bool:
        return n.headed and sum(c.told > 0 for c in n.children) > 1

    inner: Node | None = best
    while inner is not None:
        best, free = inner, inner.chars - inner.link_chars
        inner = next((c for c in best.children if not c.noise and c.name in BLOCKS and c.name not in TOLD and c.told and c.told >= NEARLY_ALL * best.told and (2 * c.told >= free or whole(c))), None)
    return best


def _widened(best: Node, body: Node, dense: dict[int, float], threshold: float) -> Node:
    """The highest ancestor whose other children are parts of the same text. Lists of links beside the way to it become noise.

    Composite density grows with a node's size, so a small part may also reach the threshold in characters per tag.
    """
    plain = lambda n: n.chars / max(n.tags, 1)
    way, least = best, plain(best)
    while way is not body and way.parent is not None:
        way = way.parent
        least = min(least, plain(way))
    way, result = best, best
    while way is not body and way.parent is not None:
        on, way = way, way.parent
        parts = [c for c in way.children if c is not on and not c.noise and c.name in BLOCKS and c.chars and 2 * c.link_chars <= c.chars and (c.told or not best.told) and (dense[id(c)] >= threshold or plain(c) >= least)]
        if sum(c.chars for c in parts) >= WIDENS * on.chars or any(c.kind and c.kind == on.kind for c in parts):
            result = way
    way = best
    while way is not result:
        on, way = way, way.parent
        for c in way.children:
            c.noise = c.noise or c is not on and c.name in BLOCKS and 2 * c.link_chars > c.chars
    return result


def blocks_of(node: Node) -> list[str]:
    """The texts of a subtree's blocks in page order, white space made one space, noise left out."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if text := SPACE.sub(" ", "".join(run)).strip():
            blocks.append(text)
        run.clear()

    stack: list[str | Node | None] = [*reversed(node.pieces)]
    while stack:
        piece = stack.pop()
        if piece is None:
            flush()
        elif isinstance(piece, str):
            run.append(piece)
        elif not piece.noise:
            if piece.name in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(piece.pieces))
    flush()
    return blocks


def main_text(html: str | None) -> str:
    node = main_node(parse(html or ""))
    return "\n\n".join(blocks_of(node)) if node else ""


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row. Null, empty and text-free pages have an empty text; repeated rows stay; other columns are ignored."""

    def make(html: list[str | None]) -> dict[str, pa.Array]:
        text = [main_text(x) for x in html]
        return {"text": pa.array(text, pa.string()), "n_chars": pa.array([len(x) for x in text], pa.int64())}

    return made_from(pages.select(pages["page_id"].cast("long"), "url", "html"), "html", make, "text string, n_chars long", keep=["page_id", "url"])
