"""Main text of web pages by composite text density."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from stratamart.llm.common import ddl, map_batches, quoted

# Names of the HTML standard and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = frozenset("script style noscript iframe template svg canvas object button select textarea input nav header footer "
                    "aside menu dialog title head noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu "
                      "sidebar aside footer header masthead breadcrumb breadcrumbs cookie cookies consent notice disclaimer comments "
                      "comment commentlist respond reply replies disqus share sharing social related recommended newsletter subscribe popup modal "
                      "pagination pager toolbar skip widget".split())
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus".split())
# What follows a word of furniture in the name of a part of it.
PARTS = frozenset("section list area container box wrapper wrap block slot unit buttons button bar links posts post articles items item "
                  "signup form right left holder panel thread feed body top bottom inner outer module zone".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert".split())
# What an open element of the first name is closed by.
CLOSES = {"p": frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                         "pre section table ul".split()),
          "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
          "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
          "option": frozenset(["option", "optgroup"])}
# The elements that the start of an element of the first name closes.
CLOSED_BY = {name: [e for e, closers in CLOSES.items() if name in closers] for name in frozenset().union(*CLOSES.values())}
# Elements through which an end tag or an implied end does not reach.
SCOPE = frozenset("article section div td th table body html main ul ol blockquote".split())

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>", re.S)
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
# A tag in which a quote is never closed ends at the next bracket, as do all tags after it.
_BROKEN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"(?<![^\s=\"'/>])([^\s=\"'/>]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_WORD = re.compile(r"[a-z]+")
MARKED = ("article", "main")


class Node:
    """An element: its content in order (texts and nodes) and, once measured, what lies under it."""

    __slots__ = ("name", "parent", "content", "furniture", "named", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None, furniture: bool = False, named: int = 0) -> None:
        self.name, self.parent, self.furniture, self.named = name, parent, furniture, named
        self.content: list[str | Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _is_furniture(name: str, attributes: str) -> bool:
    return name in DROPPED or name not in ("html", "body", *MARKED) and bool(re.search(r"(?:^|\s)hidden(?:[\s/=]|$)", attributes))


#: What a name says of an element: nothing, that it is furniture, or that it is part of some.
PLAIN, NAMED, HINTED = 0, 1, 2


def _named(name: str, attributes: str) -> int:
    """Whether an element is a form, is hidden, has a role of furniture or a class or id that names furniture or a part of it.

    A class names furniture if all its words do, and a part of it if its first word does and the others say what part
    (`related-posts`). Of articles only those of comments count.
    """
    if name in ("html", "body", "main"):
        return PLAIN
    if name == "form":
        return NAMED
    found = PLAIN
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        key = key.lower()
        if key in ("class", "id"):
            for words in map(_WORD.findall, value.split()):
                if not words or name == "article" and words[0] not in COMMENTS:
                    continue
                if FURNITURE.issuperset(words) or words[0] in COMMENTS and PARTS.issuperset(words[1:]):
                    return NAMED
                if words[0] in FURNITURE and PARTS.issuperset(words[1:]):
                    found = HINTED
        elif name != "article" and (key == "role" and value in ROLES or key == "style" and _HIDDEN.search(value) or key == "aria-hidden" and value == "true"):
            return NAMED
    return found


class _Open:
    """The open elements, by scope: how many of each name, so that a tag with nothing to close costs nothing."""

    def __init__(self, root: Node) -> None:
        self.node = root
        self.scopes: list[tuple[Node, dict[str, int]]] = [(root, {})]
        self.held: dict[str, int] = {}

    def enter(self, node: Node) -> None:
        self.node = node
        if node.name in SCOPE:
            self.scopes.append((node, {}))
            self.held[node.name] = self.held.get(node.name, 0) + 1
        else:
            counts = self.scopes[-1][1]
            counts[node.name] = counts.get(node.name, 0) + 1

    def leave(self, last: Node) -> None:
        """End every open element up to `last`, itself included."""
        while True:
            node = self.node
            if node.name in SCOPE:
                self.scopes.pop()
                self.held[node.name] -= 1
            else:
                self.scopes[-1][1][node.name] -= 1
            self.node = node.parent
            if node is last:
                return

    def end(self, name: str) -> bool:
        """Act on an end tag; false if it ends nothing."""
        if not (self.held if name in SCOPE else self.scopes[-1][1]).get(name):
            return False
        up = self.node
        while up.name != name:
            up = up.parent
        self.leave(up)
        return True

    def imply(self, name: str) -> None:
        """End what the start of an element of this name closes: within the scope, then the scope itself."""
        closed = CLOSED_BY.get(name)
        if not closed:
            return
        scope, counts = self.scopes[-1]
        left = sum(counts.get(c, 0) for c in closed)
        if left:
            up = self.node
            while True:
                left -= up.name in closed
                if not left:
                    break
                up = up.parent
            self.leave(up)
        if scope.parent is not None and scope.name in closed:
            self.leave(scope)


def parse(page: str) -> Node:
    """The elements of a page, in time that grows with its length; forgiving: stray end tags are ignored, elements left
    open end with their parent, a tag that the page ends in is left out."""
    root = Node("#root", None)
    opened, at, broken = _Open(root), 0, False
    last = page.rfind(">")
    while True:
        start = page.find("<", at)
        if start < 0 or start >= len(page) - 1:
            opened.node.content.append(page[at:])
            return root
        if start > at:
            opened.node.content.append(page[at:start])
        follows = page[start + 1]
        if follows in "!?":
            token = _COMMENT.match(page, start) if start < last or page.startswith(("<!--", "<![CDATA["), start) else None
            if token is None:
                return root  # the page ends in a declaration
            if token[0].startswith("<![CDATA["):
                opened.node.content.append(token[0][9:-3] if token[0].endswith("]]>") else token[0][9:])
            at = token.end()
            continue
        if not (follows.isascii() and follows.isalpha() or follows == "/" and page[start + 2:start + 3].isascii() and page[start + 2:start + 3].isalpha()):
            opened.node.content.append("<")
            at = start + 1
            continue
        if start > last:
            return root  # the page ends in a tag
        token = None if broken else _TAG.match(page, start)
        if token is None:
            broken, token = True, _BROKEN_TAG.match(page, start)
        at = token.end()
        name = token[2].lower()
        if token[1]:
            if not opened.end(name) and name in ("p", "br"):
                opened.node.content.append(Node(name, opened.node))
            continue
        opened.imply(name)
        child = Node(name, opened.node, _is_furniture(name, token[3]), _named(name, token[3]))
        opened.node.content.append(child)
        if name in VOID or token[3].endswith("/") and name not in RAW and name in ("svg", "path", "use", "rect", "circle"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            child.content.append(page[at:end.start() if end else len(page)])
            at = end.end() if end else len(page)
            continue
        opened.enter(child)


def _measure(root: Node) -> None:
    """Characters, tags, characters and tags of links under every node, furniture left out."""
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, done = stack.pop()
        children = [c for c in node.content if isinstance(c, Node) and not c.furniture]
        if not done:
            stack.append((node, True))
            stack.extend((c, False) for c in children)
            continue
        node.chars = sum(len("".join(entities.unescape(c).split())) for c in node.content if isinstance(c, str)) + sum(c.chars for c in children)
        node.tags = sum(c.tags + 1 for c in children)
        node.link_tags = sum(c.link_tags + (c.name == "a") for c in children)
        node.link_chars = node.chars if node.name == "a" else sum(c.link_chars for c in children)


def _cut_named(root: Node) -> bool:
    """Make furniture of the elements so named; needs measures. One that holds an article, a main part or a first heading stays,
    and so does one that holds most of the page's text outside links, unless an article or main part lies elsewhere. One
    that is only named part of furniture also stays if it holds most of the text of the article it lies in."""
    order, stack = [], [(root, root)]
    while stack:
        node, within = stack.pop()
        order.append((node, within))
        inner = node if node.name in MARKED and not node.named else within
        stack.extend((c, inner) for c in node.content if isinstance(c, Node) and not c.furniture)
    holding: set[Node] = set()
    marked = False
    for node, _ in order:
        if node.chars and not node.named and node.name in (*MARKED, "h1"):
            marked = marked or node.name in MARKED
            while node is not None and node not in holding:
                holding.add(node)
                node = node.parent
    most = (root.chars - root.link_chars) / 2
    cut = False
    for node, within in order:
        if node.named and node not in holding and (marked or node.chars - node.link_chars <= most):
            if node.named == NAMED or 2 * (node.chars - node.link_chars) <= within.chars - within.link_chars:
                node.furniture = cut = True
    return cut


def _densities(root: Node) -> None:
    """Composite text density of every node: characters per tag, with a logarithm whose base grows with the share of
    link text. A node's total is the sum of its children's densities."""
    stack = [root]
    order = []
    all_chars, all_links = max(1, root.chars), root.link_chars
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.content if isinstance(c, Node) and not c.furniture)
    for node in order:
        chars, tags = node.chars, max(1, node.tags)
        if not chars:
            continue
        links, link_tags = max(1, node.link_chars), max(1, node.link_tags)
        plain = max(1, chars - node.link_chars)
        base = math.log(chars / plain * node.link_chars + all_links / all_chars * chars + math.e)
        inside = chars / links * tags / link_tags
        node.density = chars / tags * (math.log(max(inside, 1.0)) / math.log(base) if base > 1 else math.log(max(inside, 1.0)))
        if chars == node.link_chars:
            node.density = 0.0
    for node in order:
        node.total = sum(c.density for c in node.content if isinstance(c, Node) and not c.furniture)


def _texts(items: list[str | Node]) -> list[str]:
    """The blocks' texts in page order, without furniture: inline elements join, all others part."""
    blocks: list[list[str]] = [[]]
    stack: list[str | Node | None] = list(reversed(items))
    while stack:
        item = stack.pop()
        if item is None:
            blocks.append([])
        elif isinstance(item, str):
            blocks[-1].append(entities.unescape(item))
        elif not item.furniture:
            parts = item.name not in INLINE
            if parts:
                blocks.append([])
                stack.append(None)
            stack.extend(reversed(item.content))
    return [text for text in (" ".join("".join(b).split()) for b in blocks) if text]


def main_text(page: str | None) -> str:
    """The article's text of one page; empty if there is none.

    The subtree with the largest sum of child densities is found and taken whole, up to the article or main part that it lies in
    or, if it is inline, up to its block. The least density on the path from the body to it is the threshold: subtrees
    beside that path which reach it and hold running text (in a marked page: those with articles, which may reach it in
    total too) are joined, with all between.
    """
    if not page:
        return ""
    root = parse(page)
    _measure(root)
    if not root.chars:
        return ""
    if _cut_named(root):
        _measure(root)
    _densities(root)
    body = _first(root, ("body",)) or root
    best, stack = body, [body]
    while stack:
        node = stack.pop()
        if node.total > best.total:
            best = node
        stack.extend(c for c in node.content if isinstance(c, Node) and not c.furniture)
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path if n.chars)
    marked = [n for n in path if n.name in MARKED]
    while (marked and best is not marked[0]) or (best.name in INLINE and best is not path[-1]):
        best = best.parent
    chosen: list[str | Node] = [best]
    top = best
    for up in path[path.index(best) + 1:]:
        at = next(i for i, c in enumerate(up.content) if c is top)
        others = [(i, c) for i, c in enumerate(up.content) if isinstance(c, Node) and not c.furniture and c is not top]
        if marked:
            beside = [i for i, c in others if max(c.density, c.total) >= threshold > 0 and _first(c, MARKED) is not None]
        else:
            beside = [i for i, c in others if c.density >= threshold > 0 and 2 * c.link_chars < c.chars]
        if beside:
            chosen = up.content[min(*beside, at):at] + chosen + up.content[at + 1:max(*beside, at) + 1]
        top = up
    return " ".join(_texts(chosen))


def _first(node: Node, names: tuple[str, ...]) -> Node | None:
    stack = [node]
    while stack:
        node = stack.pop()
        if node.name in names:
            return node
        stack.extend(c for c in reversed(node.content) if isinstance(c, Node) and not c.furniture)
    return None


def extract(pages: DataFrame) -> DataFrame:
    """Add `text`, the main text of the whole `html`, to the other columns of `pages` (a column `text` is replaced).

    A null or empty html and a page without text give an empty text; nulls in other columns, repeated rows and very
    long or broken pages are kept as they are; an empty table gives an empty result.
    """
    kept = [f for f in pages.schema.fields if f.name not in ("html", "text")]
    source = pages.select(*quoted([f.name for f in kept]), pages["html"].cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(texts, pa.string())],
                                             [*(f.name for f in kept), "text"])

    schema = ddl(kept)
    return map_batches(source, run, f"{schema}, text string" if kept else "text string")
