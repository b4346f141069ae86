"""The main text of a web page, by points that paragraphs pass up the tree of elements."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup up to their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Never part of a text.
DROPPED = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video head title nav footer aside form "
    "button select option textarea input label fieldset dialog menu noembed noframes xmp".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
CONTAINERS = frozenset("article main section div td body blockquote ul ol dl table tbody tr".split())
#: An open element of the first is closed by the start of one of the second.
CLOSED_BY = {
    "p": BLOCKS,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody"]),
    "th": frozenset(["td", "th", "tr", "tbody"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Elements that end where one of these began.
SCOPES = frozenset("article aside body div footer form header html main nav section table td th ul ol dl".split())
#: Words of a class, id or role that mark what surrounds a text.
AROUND = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promotion recommended related remark replies reply share sharing sidebar signup skip social sponsor sponsored "
    "subscribe tags toolbar widget advertisements alert complementary contentinfo search".split()
)
#: Beside one of the first words, the second ones do not mark surroundings: the header of an entry is a part of it.
MAIN = frozenset("article content entry post story".split())
OF_MAIN = frozenset("header tags".split())
#: Wrappers of whole pages have these, too, as many a page stands in one form.
WEAK = frozenset("search widget modal popup toolbar tags".split())

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
#: An attribute from its name on; a quote opens a value only right after the equals sign.
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_REST = re.compile(r"[\s/]*")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    """An element: its children are nodes and strings."""

    __slots__ = ("name", "parent", "children", "around", "kind", "depth", "block", "scope", "score", "length", "linked")

    def __init__(self, name: str, parent: Node | None, around: bool | None = False, kind: str = ""):
        self.name, self.parent, self.around, self.kind = name, parent, around, kind
        self.children: list[Node | str] = []
        self.depth = parent.depth + 1 if parent else 0
        #: The nearest block and the nearest scope, itself included.
        self.block: Node = self if parent is None or name in BLOCKS else parent.block
        self.scope: Node = self if parent is None or name in SCOPES else parent.scope
        self.score = 0.0
        self.length = self.linked = 0


def surrounds(name: str, attributes: dict[str, str]) -> bool | None:
    """Whether an element stands around the text, by its name and its class, id and role.

    None if only a part of a longer name says so, like has-sidebar, or if it is a
    form or a search: these may as well wrap the text.
    """
    if name == "form":
        return None
    if name in DROPPED:
        return True
    if not attributes or name in ("html", "body"):
        return False
    whole: set[str] = set()
    for key, value in attributes.items():
        value = value.lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif key in ("class", "id", "role"):
            whole.update(value.split())
    words = {w for token in whole for w in _WORD.findall(token)}
    if name == "main":
        return False
    marking = {"comment", "comments", "reply"} if name == "article" else AROUND - (OF_MAIN if words & MAIN else frozenset())
    return True if whole & (marking - WEAK) else None if words & marking else False


def decided(root: Node) -> None:
    """Elements that only a part of a name marks stand around the text, but for those that hold half of the page's text or more."""
    order: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node) and not c.around)
    if all(node.around is False for node in order):
        return
    held: dict[int, int] = {}
    for node in reversed(order):
        own = 0 if node.name == "a" else held.get(id(node), 0) + sum(len(c.strip()) for c in node.children if isinstance(c, str))
        held[id(node)] = own
        if node.parent is not None:
            held[id(node.parent)] = held.get(id(node.parent), 0) + own
    for node in order:
        if node.around is None:
            node.around = 2 * held[id(node)] < held[id(root)] or not held[id(node)]


def attributes_at(html: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes of a tag from behind its name on, the first of each name, and where the tag ends; beyond the page's end if it does not.

    A quoted value that is never closed is read as one without quotes.
    """
    found: dict[str, str] = {}
    while one := _ATTRIBUTE.match(html, at):
        at = one.end()
        found.setdefault(one[1].lower(), one[2] or one[3] or one[4] or "")
    at = _REST.match(html, at).end()
    return found, at + 1


def tree(html: str) -> Node:
    """The elements of a page. Missing end tags are supplied, stray ones ignored; comments and declarations are left out.

    Every character is looked at a bounded number of times: open elements are
    found by name, and each is closed once.
    """
    root = node = Node("html", None)
    opened: dict[str, list[Node]] = {}
    endless: set[str] = set()
    at, size = 0, len(html)

    def closed(to: Node) -> Node:
        up = node
        while up is not to:
            opened[up.name].pop()
            up = up.parent
        return to

    while at < size:
        start = html.find("<", at)
        if start < 0:
            start = size
        named = _NAME.match(html, start + 1)
        if named is None and start < size and html[start + 1 : start + 2] not in ("!", "?", "/"):
            start += 1  # no markup
            node.children.append(html[at:start])
            at = start
            continue
        if start > at:
            node.children.append(html[at:start])
        if start == size:
            break
        if named is None:
            comment = html.startswith("<!--", start)
            end = html.find("-->" if comment else ">", start + 2)
            at = size if end < 0 else end + (3 if comment else 1)
            continue
        name = named[1].lower()
        if html[start + 1] == "/":
            end = html.find(">", named.end())
            at = size if end < 0 else end + 1
            same = opened.get(name)
            if same and (name in SCOPES or same[-1].depth > node.scope.depth):
                node = closed(same[-1].parent)
            continue
        attributes, at = ({}, named.end() + 1) if html.startswith(">", named.end()) else attributes_at(html, named.end())
        if at > size:  # cut off by the page's end, text as it stands
            node.children.append(html[start:])
            break
        while node.parent is not None and name in CLOSED_BY.get(node.name, ()):
            node = closed(node.parent)
        if name in BLOCKS and node.block.name == "p" and name in CLOSED_BY["p"] and node.block.parent is not None:
            # A block inside unclosed inline markup of a paragraph ends both.
            node = closed(node.block.parent)
        child = Node(name, node, surrounds(name, attributes), " ".join(attributes.get("class", "").split()))
        node.children.append(child)
        if name in RAW:
            end = None if name in endless else re.compile(rf"</{name}\s*>", re.I).search(html, at)
            if end is None:
                endless.add(name)
                if name in ("title", "textarea"):
                    continue
            at = end.end() if end else size
        elif name not in VOID and html[at - 2 : at] != "/>":
            opened.setdefault(name, []).append(child)
            node = child
    return root


def measured(root: Node) -> list[Node]:
    """All elements that may hold text, in page order, with lengths of text and of text in links; strings are decoded."""
    order: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        order.append(node)
        kept: list[Node | str] = []
        for child in node.children:
            if isinstance(child, str):
                child = unescape(child)
                node.length += len(_SPACE.sub(" ", child).strip())
            elif child.around:
                continue
            kept.append(child)
        node.children = kept
        stack.extend(c for c in reversed(kept) if isinstance(c, Node))
    for node in reversed(order):
        if node.name == "a":
            node.linked = node.length
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked
    return order


def density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def spoken(node: Node) -> str:
    """The text right in a paragraph, without that of paragraphs inside it."""
    parts: list[str] = []
    stack: list[Node | str] = list(reversed(node.children))
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            parts.append(child)
        elif child.name not in BLOCKS:
            stack.extend(reversed(child.children))
    return _SPACE.sub(" ", "".join(parts)).strip()


def chosen(order: list[Node]) -> list[Node]:
    """The best container and those of its siblings that belong to it, in page order; one of its own class does.

    A paragraph is worth a point, one for each comma and one for each hundred
    characters, three of these at most; its parent gets all of it, the
    grandparent half, those above a third, a quarter and so on. A container's
    points are discounted by the share of its text that is in links. An article
    or main element starts with 25 points, so a short one stands against a long
    list.
    """
    scored: dict[int, Node] = {}
    for node in order:
        if node.name not in PARAGRAPHS and not (node.name in ("div", "section", "article") and len(spoken(node)) >= 25):
            continue
        text = spoken(node)
        if not text:
            continue
        points = (1 + text.count(",") + min(3.0, len(text) / 100)) * (1 - density(node))
        up = node.parent if node.name in PARAGRAPHS else node
        for depth in range(5):
            if up is None:
                break
            if id(up) not in scored:
                scored[id(up)] = up
                up.score += {"article": 25, "main": 25, "section": 2, "div": 2}.get(up.name, 0)
            up.score += points / (depth + 1)
            up = up.parent
    if not scored:
        return [order[0]]
    for node in scored.values():
        node.score *= 1 - density(node)
    best = max(scored.values(), key=lambda n: n.score)
    # Of a chain of containers with one child each the outer ones add nothing.
    if best.parent is None or best.name == "body":
        return [best]
    least = max(10.0, 0.2 * best.score)
    group = []
    for sibling in best.parent.children:
        if sibling is best:
            group.append(sibling)
        elif isinstance(sibling, Node):
            text = spoken(sibling) if sibling.name in PARAGRAPHS else ""
            twin = sibling.kind and (sibling.name, sibling.kind) == (best.name, best.kind)
            if (twin and density(sibling) < 0.5) or (id(sibling) in scored and sibling.score >= least) or (len(text) > 80 and density(sibling) < 0.25):
                group.append(sibling)
    return group


def lines(nodes: list[Node]) -> Iterator[str]:
    """The texts of the blocks, white space turned into one blank."""
    parts: list[str] = []

    def flush() -> Iterator[str]:
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            yield text

    for top in nodes:
        stack: list[tuple[Node | str, bool]] = [(top, False)]
        while stack:
            node, leaving = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif leaving:
                yield from flush()
            elif node.name == "br":
                parts.append(" ")
            else:
                if node.name in BLOCKS:
                    yield from flush()
                    stack.append((node, True))
                stack.extend((c, False) for c in reversed(node.children))
        yield from flush()


def main_text(html: str | None) -> str:
    """The blocks of a page's main text, one a line; empty if it has none."""
    if not html:
        return ""
    root = tree(html)
    decided(root)
    order = measured(root)
    return "\n".join(lines(chosen(order)))


def extracted(pages: DataFrame, html: str = "html", id: str = "page_id", url: str = "url") -> DataFrame:
    """(``id``, ``url``, text, n_chars) of every page.

    Each page is parsed to a tree on its own, by a scan for tags that supplies
    missing end tags; elements that surround a text (menus, page headers and
    footers, sidebars, notices, adverts, forms, scripts, styles, comments, and
    what is hidden) are left out by name, class, id and role. One that only a
    part of a class or id marks, like has-sidebar, stays if it holds half of the
    page's text outside links. Paragraphs pass
    points up to their ancestors (``chosen``); the best container is kept with
    the siblings that belong to it. Character references are decoded, white
    space inside a block is one blank, blocks are joined by one line feed.

    NULL, empty and blank pages, and pages of markup only, have an empty text.
    NULL ids and urls are kept. Rows that repeat get equal answers. Other
    columns are not read. A page is held in memory whole, one at a time.
    """
    schema = T.StructType(
        [
            T.StructField(id, pages.schema[id].dataType),
            T.StructField(url, T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[id, url, "text", "n_chars"])

    return pages.select(id, url, html).mapInArrow(read, schema)
