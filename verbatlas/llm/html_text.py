"""Operator 4, HTML extraction by tree scoring.

A page is read into a tree, forgiving unclosed and stray tags, in time linear in its length. What is
never part of an article goes by its tag: scripts, styles, forms, menus, sidebars, footers. A class, id
or role says that more goes: comments of readers, adverts, notices and the like always, unless the
element holds the headline of the page (h1) or its ``main``; widgets, boxes for sharing and the like if
they do not hold most of the text. Words of layout ("sidebar-right", "no-sidebar", "comments-open")
beside a name like "content" mark nothing. If nothing is left, only comments, adverts and consent go by name.

Every block of text passes points for its length and its commas to its parent, and half of them to the
grandparent; a container's points are discounted by its link density. If the best container lies in an
``article``, that is kept whole; else it is kept with those of its siblings that are blocks of text with
few links or score well, and boxes of links, copyright and subscription directly in it or beside it go. Its blocks are joined in page order.

Defined results: a null or empty page, and one without text, gives an empty string; equal pages give
equal texts; a page of any length is read whole, one at a time; character references are decoded;
rows without id or url are returned as they are; other columns are not looked at.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.llm import tokens
from verbatlas.session import spread

# Markup: comments, declarations, and tags with quoted attribute values that may hold ">".
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_BLANK = re.compile(r"\s+")

# Elements whose content is no text of the page; their end is searched for as it stands.
_RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
_DROPPED = _RAW | set(
    "head nav footer aside form noscript template iframe object embed button select option input svg canvas audio video map dialog menu".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# A start tag of these ends open elements of the set, as far as the nearest other part of a list or table.
_CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
_ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
_BOUNDARY = {"html", "body", "table", "td", "th", "caption", "button", "object"}

# Words of a class, id or role that mark what is not the article: what never comes back, what goes unless
# nothing else is left, and what goes unless it holds most of the text.
_NEVER = set(
    """ad ads advert advertisement advertising adverts adsense sponsor sponsored comment comments disqus respond replies
    cookie cookies consent gdpr outbrain taboola""".split()
)
_HARD = _NEVER | set(
    """nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar sidebars footer masthead notice notices
    newsletter subscribe subscription related recommended recommendations complementary contentinfo""".split()
)
_SOFT = set(
    """banner banners promo promoted promotion menu menus widget widgets alert popup modal overlay signup login share sharing
    social toolbar skip search""".split()
)
_GOOD = set("article body content entry main post story text page column".split())
# Ancestors named so hold headers of articles, not of sites.
_HOLDS_HEADER = set("article content entry main post story".split())
# First words of names that tell of other elements, and words of names that tell of layout or state.
_ABOUT = {"has", "no", "with", "without"}
_LAYOUT = set("left right open closed on off enabled disabled free none layout".split())
# Boxes that may stand in a container beside its text, and the beginnings of lines that never belong to it.
_BOXES = {"div", "section", "ul", "ol", "dl"}
_LEGAL = re.compile(r"\s*(©|\(c\)\s|copyright\b|all rights reserved|subscribe\b|sign up\b)", re.IGNORECASE)

_TABLE = {"table", "tr", "td", "th"}
_LISTS = {"li", "dt", "dd", "ul", "ol", "dl", "menu", "table", "td", "th"}
# End tags that close an element beyond a table cell or the like.
_CROSSES = _BOUNDARY | {"tr", "tbody", "article", "main", "section", "div"}


class _Node:
    __slots__ = ("bad", "block", "children", "good", "header", "listed", "parent", "points", "tabled", "tag")

    def __init__(self, tag: str, parent: _Node | None):
        self.tag, self.parent = tag, parent
        self.children: list = []  # nodes, and pieces of text
        self.points, self.good, self.bad = 0.0, False, ""
        # The nearest of this element and those around it that is a block, part of a table, part of a list.
        self.block = self if parent is None or tag not in _INLINE else parent.block
        self.tabled = self if tag in _TABLE else parent and parent.tabled
        self.listed = self if tag in _LISTS else parent and parent.listed
        # Whether a header in here belongs to an article.
        self.header = tag in ("article", "main") or parent is not None and parent.header


def _attributes(raw: str) -> tuple[str, bool, bool]:
    """What the attributes mark: "hidden", "never", "hard", "soft" or ""; a likely container; one with a header of its own."""
    good, header, hidden, found = False, False, False, []
    for name, value in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            for part in value.split():
                words = [w.lower() for w in _NAME.findall(part)]
                if words and words[0] in _ABOUT:
                    continue
                marks = [k for k, known in (("never", _NEVER), ("hard", _HARD), ("soft", _SOFT)) if not known.isdisjoint(words)]
                if marks:
                    found.append((marks[0], not _LAYOUT.isdisjoint(words)))
                else:
                    header |= not _HOLDS_HEADER.isdisjoint(words)
                good |= not _GOOD.isdisjoint(words)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in _BLANK.sub("", value.lower())
    if hidden:
        return "hidden", good, header
    kinds = {k for k, layout in found if not (layout and header)}
    return next((k for k in ("never", "hard", "soft") if k in kinds), ""), good, header and not kinds


class _Open:
    """How many elements of a tag are open, in all and since the last boundary."""

    def __init__(self):
        self.all: Counter = Counter()
        self.scopes: list[Counter] = [Counter()]

    def enter(self, tag: str) -> None:
        self.all[tag] += 1
        if tag in _BOUNDARY:
            self.scopes.append(Counter())
        self.scopes[-1][tag] += 1

    def leave(self, node: _Node, end: _Node) -> _Node:
        """Close ``node`` and what is around it up to ``end``; the element around that."""
        while True:
            self.all[node.tag] -= 1
            self.scopes[-1][node.tag] -= 1
            if node.tag in _BOUNDARY:
                self.scopes.pop()
            if node is end:
                return node.parent
            node = node.parent

    def has(self, tag: str) -> bool:
        return bool(self.all[tag] if tag in _CROSSES else self.scopes[-1][tag])


def parse(page: str) -> _Node:
    """The tree of a page without the elements that go by their tag; ``bad`` is what names say."""
    root = _Node("html", None)
    node, at, end = root, 0, len(page)
    opened = _Open()
    skipped: list[str] = []  # open elements inside of a dropped one
    inside: Counter = Counter()  # and their number by tag

    def add(text: str) -> None:
        if text and not skipped:
            node.children.append(html.unescape(text) if "&" in text else text)

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if skipped:
                if inside[tag]:
                    while True:
                        gone = skipped.pop()
                        inside[gone] -= 1
                        if gone == tag:
                            break
                    continue
                if tag not in ("body", "html", "article", "main"):
                    continue
                skipped.clear()  # the end of what holds the dropped element ends it
                inside.clear()
            if opened.has(tag):
                up = node
                while up.tag != tag:
                    up = up.parent
                node = opened.leave(node, up)
            continue
        if skipped:
            if tag not in _VOID and not m[3].endswith("/"):
                if tag in _RAW:
                    at = _after(page, at, tag)
                elif not (tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th")):
                    skipped.append(tag)
                    inside[tag] += 1
            continue
        if tag in ("html", "body"):
            continue
        if tag in _ENDS_P and node.block.tag == "p":
            node = opened.leave(node, node.block)
        if tag in _CLOSES:
            while (up := node.tabled if tag in _TABLE else node.listed) is not None and up.tag in _CLOSES[tag]:
                node = opened.leave(node, up)
        bad, good, header = _attributes(m[3]) if m[3].strip(" /") else ("", False, False)
        if tag in _RAW:
            at = _after(page, at, tag)
        elif tag in _VOID:
            if tag in ("br", "hr"):
                node.children.append("\n" if tag == "br" else _Node("hr", node))
            elif tag == "img":
                node.children.append("")
        elif tag in _DROPPED or tag == "header" and not node.header or bad == "hidden" and tag not in ("article", "main"):
            node.children.append(_Node("dropped", node) if tag not in _INLINE else "")
            skipped, inside = [tag], Counter([tag])
        else:
            child = _Node(tag, node)
            child.good = good or tag in ("article", "main")
            child.header |= header
            child.bad = "" if tag in ("article", "main") else bad
            node.children.append(child)
            node = child
            opened.enter(tag)
    return root


def prune(root: _Node, goes: tuple = ("never", "hard")) -> _Node:
    """Empty the elements that are no part of the article by their names.

    An element that holds an h1 or ``main`` stays. Of the others those marked as in ``goes`` go, and the
    other marked ones if they hold no more than half of the text outside of links that is left then.
    """
    holds, sizes = set(), _measure(root)
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, _Node)]
    for node in reversed(nodes):
        if node.tag in ("h1", "main") or id(node) in holds:
            holds.update([id(node)] + ([id(node.parent)] if node.parent is not None else []))

    def drop(wanted) -> None:
        stack = [root]
        while stack:
            node = stack.pop()
            if node.bad and id(node) not in holds and wanted(node):
                node.tag, node.children = "dropped" if node.tag not in _INLINE else "span", []
            stack += [c for c in node.children if isinstance(c, _Node)]

    drop(lambda node: node.bad in goes)
    sizes = _measure(root)
    left = sizes[id(root)][0] - sizes[id(root)][1]
    drop(lambda node: 2 * (sizes[id(node)][0] - sizes[id(node)][1]) <= left)
    return root


def _after(page: str, at: int, tag: str) -> int:
    """Behind the end tag of an element whose content is not markup; the end of the page without one."""
    m = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
    return m.end() if m else len(page)


def _measure(root: _Node) -> dict[int, tuple[int, int]]:
    """Characters of text and of text in links of every node, children first; no recursion."""
    sizes: dict[int, tuple[int, int]] = {}
    stack = [(root, False)]
    while stack:
        node, ready = stack.pop()
        if not ready:
            stack.append((node, True))
            stack += [(c, False) for c in node.children if isinstance(c, _Node)]
            continue
        total = links = 0
        for c in node.children:
            if isinstance(c, _Node):
                t, k = sizes[id(c)]
                total, links = total + t, links + k
            else:
                total += len(c.strip())
        sizes[id(node)] = (total, total if node.tag == "a" else links)
    return sizes


def _direct(node: _Node) -> str:
    """Text of a node and its inline children, without that of blocks in it."""
    out, stack = [], [node]
    while stack:
        for c in reversed(stack.pop().children):
            if isinstance(c, str):
                out.append(c)
            elif c.tag in _INLINE:
                stack.append(c)
    return " ".join(out).strip()


def best(root: _Node) -> list[_Node]:
    """The nodes to keep, in page order: the best container and siblings that belong to it."""
    sizes = _measure(root)
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, _Node)]
    scored: dict[int, _Node] = {}
    for node in nodes:
        if node.tag in _INLINE or node.tag in ("dropped", "hr"):
            continue
        text = _direct(node)
        if not text:
            continue
        total, links = max(1, len(text)), sizes[id(node)][1] if node.tag in ("p", "li", "td", "a") else 0
        points = (1.0 + text.count(",") + text.count("，") + min(3.0, len(text) / 100)) * max(0.0, 1.0 - links / max(total, 1))
        if node.tag in _HEADINGS:
            points = min(points, 1.0)
        # A block passes its points on; one that holds text and blocks is a container itself.
        holders = [node.parent, node.parent.parent if node.parent is not None else None]
        if node.tag not in ("p", "pre", "li", "td", "blockquote", *_HEADINGS):
            holders = [node, node.parent]
        for share, holder in zip((1.0, 0.5), holders, strict=True):
            if holder is not None:
                if id(holder) not in scored:
                    scored[id(holder)] = holder
                    holder.points = 25.0 if holder.good else 0.0
                holder.points += share * points
    if not scored:
        return [root] if sizes[id(root)][0] else []

    def density(node: _Node) -> float:
        total, links = sizes[id(node)]
        return links / total if total else 0.0

    final = {id(n): n.points * (1.0 - density(n)) for n in scored.values()}
    top = max(scored.values(), key=lambda n: final[id(n)])  # the first of equal ones
    up = top
    while up is not None:
        if up.tag == "article":
            top = up  # the outermost one
        up = up.parent
    if top.tag != "article":  # a box of links or of rights directly in the container
        boxes = [c for c in top.children if isinstance(c, _Node) and c.tag in _BOXES]
        gone = {id(c) for c in boxes if density(c) >= 0.5 or c.tag in ("div", "section") and _LEGAL.match(" ".join(blocks([c])))}
        top.children = [c for c in top.children if id(c) not in gone]
    if top.parent is None:
        return [top]

    def belongs(node: _Node) -> bool:
        total = sizes[id(node)][0]
        if node is top or node.tag in _HEADINGS:
            return True
        if node.tag in ("dropped", "hr") or node.tag in _INLINE or not total:
            return False
        if final.get(id(node), 0.0) >= max(10.0, 0.2 * final.get(id(top), 0.0)) and density(node) < 0.3:
            return True
        if top.tag == "article" or density(node) >= 0.25 or _LEGAL.match(" ".join(blocks([node]))):
            return False
        return True

    return [c for c in top.parent.children if isinstance(c, _Node) and belongs(c)]


def blocks(nodes: list[_Node]) -> list[str]:
    """Texts of the blocks below some nodes, white space made even, empty ones left out."""
    out: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = _BLANK.sub(" ", "".join(held)).strip()
        if text:
            out.append(text)
        held.clear()

    for node in nodes:
        stack: list = [node]
        while stack:
            item = stack.pop()
            if item is None:
                close()
            elif isinstance(item, str):
                held.append(item)
            else:
                if item.tag not in _INLINE:
                    close()
                    stack.append(None)
                stack += reversed(item.children)
        close()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    text = " ".join(blocks(best(prune(parse(page)))))
    return text or " ".join(blocks(best(prune(parse(page), ("never",)))))


def extract(pages: DataFrame, item_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` of every row."""
    rows = pages.select(F.col(item_id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "html"):
                found = [main_text(p) for p in part.column("html").to_pylist()]
                columns = [part.column("id"), part.column("url"), tokens.strings(found), pa.array(map(len, found), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_chars"])

    return spread(rows).mapInArrow(run, "id long, url string, text string, n_chars long")
