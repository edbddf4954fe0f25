"""Main text of HTML pages by tag-path ratios.

A page is read into text blocks, each with the path of tags from the root.  Per
path, text length and punctuation are summed over its blocks; text length per
block and punctuation per block are fused, weighted by the share of text outside
links, and smoothed over the blocks in page order.  Paths whose mean smoothed
value reaches a share of the page's (text-weighted) mean are content.  The
innermost element that holds all of their blocks is the article (or the
``article`` around it, or what has only headings besides), and its blocks are
the result, short ones and headings too; what is marked as menu, header,
footer, sidebar, notice, advert, form or comments doesn't count.  Marks can err
about wrappers: what holds the page's ``main`` is never furniture; a form, an
element whose class only mentions a mark (``share-enabled``), or one around an
``article`` isn't where it has more running text than all that is unmarked, and
any other but a menu, footer, aside or comments isn't where it has many times as
much.  A header inside an article that holds a heading is the article's own.
Where one ``article`` has most of the content, what is outside it doesn't count.

All work is a fixed number of passes over elements and blocks, however deep they
are nested.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometer.llm.common import arrow_map

#: Elements whose content is no visible running text.
UNSEEN = frozenset("head script style noscript template svg iframe object canvas audio video select datalist title annotation".split())
#: Of these, what may stand in a sentence; it doesn't end a block.
PHRASING = UNSEEN - {"head", "title"}
#: Elements that are furniture by their meaning.
FURNITURE = frozenset("nav footer aside form header menu dialog button fieldset textarea".split())
#: Words of class, id or role that mark furniture.
MARKS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside complementary footer header masthead contentinfo toolbar"
    " comment comments disqus replies reply respond share sharing social subscribe newsletter signup login related recommended widget pagination pager".split()
)
#: A name that ends in one of these is of reader comments.
COMMENTS = frozenset("comment comments commentlist commentform commentbox disqus replies reply respond".split())
#: How many times as much running text as all else makes sure furniture content.
FAR_MORE = 4
#: Furniture whatever it holds.
NEVER = frozenset("nav footer aside menu dialog button textarea".split())
#: A class with one of these words says what a page shows, not what its element is.
STATES = frozenset("has have with without no not is enable enabled disable disabled on off show shows hide hides".split())
#: Elements that flow inside a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup"
    " time tt u var wbr math mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mspace mstyle semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag closes these open siblings.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
SMOOTH = (0.25, 0.5, 0.25)
CONTENT_SHARE = 0.3
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_WORD = re.compile(r"[a-z]+")
_TAG = re.compile(r"<[a-zA-Z/!?]")
_MARK = re.compile(r"[^\w\s]")


class Node:
    """An open or closed element.  ``path`` numbers its tag path: equal for
    elements whose labels from the root are equal."""

    __slots__ = ("tag", "parent", "path", "bad", "holds", "own_header", "in_article", "titled")

    def __init__(self, tag: str, parent: Node | None, path: int, bad: int):
        self.tag, self.parent, self.path = tag, parent, path
        self.bad = bad  # 0 no furniture, 1 perhaps, 2 by its name, 3 in any case
        self.holds = 0  # 1 an unmarked article, 2 the main element
        self.own_header: Node | None = None  # the innermost header it is in
        self.in_article = parent is not None and (parent.in_article or parent.tag == "article")
        self.titled = False  # a header that holds a heading


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def _marks(attrs: list[tuple[str, str | None]]) -> list[list[str]]:
    """The words of each class, id and role."""
    return [_WORD.findall(name) for k, v in attrs if k in ("class", "id", "role") and v for name in v.lower().split()]


def _bad(tag: str, marks: list[list[str]]) -> int:
    """How surely an element is furniture, see ``Node``.  The last word of a
    name says what it is: ``post-comments`` are comments."""
    if tag in NEVER:
        return 3
    bad = 2 if tag == "header" else int(tag in FURNITURE)
    for words in marks:
        if STATES.isdisjoint(words) and words and words[-1] in COMMENTS:
            return 3
        if not MARKS.isdisjoint(words) and STATES.isdisjoint(words):
            bad = max(bad, 2 if words[-1] in MARKS else 1)
    return bad


class Reader(HTMLParser):
    """Blocks of text with their tag paths; closes what pages leave open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.at = Node("", None, 0, 0)
        #: In page order, parents before their children.
        self.nodes = [self.at]
        self.paths: dict[tuple[int, str], int] = {}
        self.unseen = 0
        self.links = 0
        self.blocks: list[Block] = []
        self.open: Block | None = None

    def handle_starttag(self, tag, attrs):
        if self.unseen and tag not in ("body", "main", "article"):
            if tag not in VOID and tag not in INLINE:
                self._down(tag, tag, 0)
            return
        if tag in VOID:
            if tag == "br" and self.open:
                self.open.parts.append(" ")
            elif tag == "hr":
                self.open = None
            return
        if tag in INLINE:
            self.links += tag == "a"
            return
        if tag in PHRASING:
            # What isn't seen ends neither a block nor a paragraph.
            self._down(tag, tag, 0)
            return
        self.open = None
        if tag == "p" or tag not in ("html", "body"):
            self._close({"p"} | CLOSES.get(tag, set()))
        elif tag in CLOSES:
            self._close(CLOSES[tag])
        marks = _marks(attrs) if attrs else []
        # A page's root is no furniture, whatever its classes say.
        bad = _bad(tag, marks) if tag not in ("html", "body", "article", "main") else 0
        if tag == "article" and any(words and words[-1] in COMMENTS for words in marks):
            bad = 3
        node = self._down(tag, ".".join([tag, *sorted({w for words in marks for w in words})]), bad)
        if tag == "header" or any(words[-1:] == ["header"] for words in marks):
            node.own_header = node
        if tag in HEADINGS and node.own_header:
            node.own_header.titled = True
        if tag == "main" or tag == "article" and not _bad(tag, marks):
            node, holds = node.parent, 2 if tag == "main" else 1
            while node is not None and node.holds < holds:
                node.holds = holds
                node = node.parent

    def _down(self, tag: str, label: str, bad: int) -> Node:
        path = self.paths.setdefault((self.at.path, label), len(self.paths) + 1)
        node = Node(tag, self.at, path, bad)
        node.own_header = self.at.own_header
        self.nodes.append(node)
        self.at = node
        self.unseen += tag in UNSEEN
        return node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def _close(self, tags: set[str]) -> None:
        """Close open elements of ``tags`` that are innermost."""
        while self.at.tag in tags:
            self._up()

    def _up(self) -> None:
        if not self.unseen:
            self.open = None
        self.unseen -= self.at.tag in UNSEEN
        self.at = self.at.parent

    def handle_endtag(self, tag):
        if tag in INLINE or tag in VOID:
            self.links -= tag == "a" and self.links > 0
            return
        node, unseen = self.at, self.unseen
        while unseen and node.tag != tag:
            unseen -= node.tag in UNSEEN
            node = node.parent
        if unseen:  # of something that isn't seen
            while self.at is not node:
                self._up()
            self._up()
            return
        self.open = None
        node = self.at
        while node.parent is not None and node.tag != tag:
            # A stray end tag doesn't close the element around it.
            if node.tag in ("table", "article", "body") and tag in ("p", "li", "td", "tr", "th"):
                return
            node = node.parent
        if node.parent is None:
            return
        while self.at is not node:
            self._up()
        self._up()

    def handle_data(self, data):
        if self.unseen:
            return
        if self.open is None:
            if not data.strip():
                return
            self.open = Block(self.at)
            self.blocks.append(self.open)
        self.open.parts.append(data)
        if self.links:
            self.open.linked += len(data.strip())


@dataclass
class Row:
    """A block with text."""

    text: str
    node: Node
    linked: int

    @property
    def running(self) -> int:
        return len(self.text) - self.linked


def _unfurnished(rows: list[Row], nodes: list[Node]) -> list[Row]:
    """The rows that are not in furniture.  Rows in doubtful furniture are taken
    path by path, the longest first, while a path has more running text than
    all that counts so far; then those in furniture by its name, while it has
    ``FAR_MORE`` times as much."""
    # How surely a node is in furniture, and the path of the innermost.
    level, kind = {id(nodes[0]): 0}, {id(nodes[0]): 0}
    for n in nodes[1:]:
        above = id(n.parent)
        bad = 0 if n.in_article and n.titled and n.bad < 3 else n.bad
        counts = bad == 3 or bad and n.holds < 2
        own = (3 if bad == 3 else 2 if bad == 2 and not n.holds else 1) if counts else 0
        level[id(n)] = max(level[above], own)
        kind[id(n)] = n.path if counts else kind[above]
    found: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, r in enumerate(rows):
        found[level[id(r.node)], kind[id(r.node)]].append(i)
    running = {k: sum(rows[i].running for i in at) for k, at in found.items()}
    kept = found.get((0, 0), [])
    total = running.get((0, 0), 0)
    for doubt, more in ((1, 1), (2, FAR_MORE)):
        for key in sorted((k for k in found if k[0] == doubt), key=running.get, reverse=True):
            if running[key] <= more * total:
                break
            total += running[key]
            kept = kept + found[key]
    return [rows[i] for i in sorted(kept)]


def _held(rows: list[Row], nodes: list[Node]) -> dict[int, int]:
    """How many of ``rows`` each node holds."""
    held = {id(n): 0 for n in nodes}
    for r in rows:
        held[id(r.node)] += 1
    for n in reversed(nodes[1:]):
        held[id(n.parent)] += held[id(n)]
    return held


def _content(rows: list[Row]) -> list[Row]:
    """The rows whose tag paths' ratios reach the threshold."""
    sums: dict[int, list[float]] = defaultdict(lambda: [0, 0, 0, 0])
    for r in rows:
        s = sums[r.node.path]
        for i, v in enumerate((len(r.text), len(_MARK.findall(r.text)), 1, r.linked)):
            s[i] += v
    fused = {p: chars / n * (1 + marks / n) * (1 - linked / chars) for p, (chars, marks, n, linked) in sums.items()}
    # Smooth over the page, then back to paths.
    values = [fused[r.node.path] for r in rows]
    padded = [values[0], *values, values[-1]]
    smooth = [sum(w * padded[i + j] for j, w in enumerate(SMOOTH)) for i in range(len(values))]
    totals: dict[int, list[float]] = defaultdict(lambda: [0, 0])
    for r, v in zip(rows, smooth):
        totals[r.node.path][0] += v
        totals[r.node.path][1] += 1
    weight = sum(len(r.text) for r in rows)
    mean = sum(len(r.text) * v for r, v in zip(rows, smooth)) / weight
    content = {p for p, (v, n) in totals.items() if v / n >= CONTENT_SHARE * mean}
    return [r for r in rows if r.node.path in content]


def _chief_article(content: list[Row], nodes: list[Node]) -> set[int] | None:
    """The nodes of the outermost article that has most of the content, if one
    has more than all the rest of the page."""
    outer: dict[int, Node | None] = {id(nodes[0]): None}
    for n in nodes[1:]:
        outer[id(n)] = outer[id(n.parent)] or (n if n.tag == "article" and n.bad < 3 else None)
    texts: dict[int, int] = defaultdict(int)
    for r in content:
        if (article := outer[id(r.node)]) is not None:
            texts[id(article)] += r.running
    if not texts:
        return None
    best = max(texts, key=texts.get)
    if 2 * texts[best] <= sum(r.running for r in content):
        return None
    return {id(n) for n in nodes if outer[id(n)] is not None and id(outer[id(n)]) == best}


def main_text(html: str | None) -> str:
    """The article's blocks, one a line; empty if there is none."""
    reader = Reader()
    reader.feed(html or "")
    if _TAG.match(reader.rawdata):
        reader.rawdata = ""  # a tag or comment that the page's end cuts is no text
    reader.close()
    nodes, rows = reader.nodes, []
    for b in reader.blocks:
        text = _SPACE.sub(" ", "".join(b.parts)).strip(" ")
        if text:
            rows.append(Row(text, b.node, min(b.linked, len(text))))
    rows = _unfurnished(rows, nodes)
    if not rows:
        return ""
    content = _content(rows)
    chief = _chief_article(content, nodes)
    if chief is not None:
        content = [r for r in content if id(r.node) in chief]
    # The innermost element with all content: the last of those that hold it all.
    held = _held(content, nodes)
    inner = next(n for n in reversed(nodes) if held[id(n)] == len(content))
    around = []
    while inner is not None:
        around.append(inner)
        inner = inner.parent
    around.reverse()
    ends = next((i for i, n in enumerate(around) if n.tag in BLOCK_ENDS), len(around))
    around = around[: max(ends, 1)]
    at = max((i for i, n in enumerate(around) if n.tag == "article"), default=len(around) - 1)
    # Its titles may stand beside it.
    others = _held([r for r in rows if r.node.tag not in HEADINGS], nodes)
    while at and others[id(around[at - 1])] == others[id(around[at])]:
        at -= 1
    inside = {id(around[at])}
    for n in nodes:
        if id(n.parent) in inside:
            inside.add(id(n))
    return "\n".join(r.text for r in rows if id(r.node) in inside)


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text: an article is what holds them, never one of them.
BLOCK_ENDS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption ul ol dl table tbody figure address".split())


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of the text) of each row of
    ``pages`` (page_id, url, html).  Null or empty HTML, and HTML without
    running text, gives an empty text.  An empty table gives no rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array([main_text(h) for h in batch.column(2).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = arrow_map(pages.select("page_id", "url", "html"), run, f"page_id {kind}, url string, text string", "html")
    return rows.withColumn("n_chars", F.length("text").cast("long"))
