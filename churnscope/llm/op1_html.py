"""HTML extraction by tree scoring.

A page becomes a tree of elements.  Paragraphs pass points for their length and commas to
their ancestors (all to the parent, less to those above); a container's score is discounted
by the share of its text that stands in links.  The best container is kept with those of
its siblings that score well or are paragraphs of prose.  Elements that are never content
(menus, forms, scripts and the like, by tag or role, or hidden) are taken out before.

Classes and ids only name candidates (adverts, side bars, comments of readers and the like).
A candidate goes unless it holds most of the page's paragraph points, and either has a main
heading or an article or leaves no prose outside, or its id is the anchor of an article's part
that isn't made of readers' signed entries.  Adverts, comments and side bars go however long
they are, if there is prose outside.  Paragraphs, headings, and what stands inside their
lines, go only by the class of an advert (paragraphs also of a comment); if nothing would be
left, names don't count.

Inside a block, white space becomes one space; blocks are joined by a line feed.  A null or
empty page, or one without text, gives the empty text.  Unclosed, misnested and cut-off
markup is read as far as it goes.  Repeated rows give repeated results, an empty table an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, in_slices, record_batch, table, texts_of

#: Characters of pages that are worked on at once.
SLICE_CHARS = 4_000_000
#: Tags: without an end, of raw text (never content), never content, starting a block, closing an open paragraph.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math object canvas audio video select".split())
_NEVER = frozenset("head nav footer aside form button menu dialog input label fieldset legend dir applet map".split())
_BLOCK = frozenset("address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html "
                   "li main ol p pre section summary table tbody tfoot thead tr caption ul".split())
_PARAGRAPHS = frozenset("p pre blockquote li dd dt td th figcaption h1 h2 h3 h4 h5 h6".split())
_CONTAINERS = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 3.0}
#: An element ends those open ones of the same kind up to a boundary.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",)}
_BOUNDS = frozenset("ul ol dl table body html article section div main td th".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
#: Words of a class or id (parted at marks and changes of case) that say an element isn't content.
_NOT_CONTENT = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion promoted banner banners "
    "nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs crumbs pagination pager paging toc sidebar sidebars aside rail "
    "header masthead topbar toolbar footer foot footnav colophon copyright legal cookie cookies consent gdpr notice notices notification "
    "notifications alert alerts disclaimer popup popups modal modals overlay lightbox newsletter subscribe subscription signup login signin "
    "register search searchbox share sharing social socials follow comment comments commentlist disqus discussion respond reply replies "
    "reactions related recommended recommendations recirc more-like widget widgets skip skiplink offcanvas hidden outbrain taboola paywall".split())
#: Words of a class or id that overrule some of the above.
_CONTENT, _OVERRULED = frozenset("article articlebody content entry hentry post story".split()), frozenset({"header", "widget"})
#: Words after which a class or id says nothing of the element's own kind (has-sidebar, no-comments, overflow-hidden).
_OTHERS = frozenset("has no not with without overflow".split())
#: Of the words above, those that title parts of articles too: as the id of such a part they are an anchor.
_TOPICS = frozenset(
    "advertising advertisement promotion promotions sponsors banner banners navigation paging legal copyright cookie cookies consent gdpr notice notices "
    "notification notifications alert alerts disclaimer subscription register search share sharing social discussion reply replies reactions related "
    "recommended recommendations respond follow rail foot skip hidden menu menus widgets".split())
#: Words of a class that say a block is a part of a text.
_PARTS = frozenset("section subsection chapter".split())
#: Classes and ids that are never a page's layout, and words that make them one; classes of adverts, which lines go by too.
_ADVERTS = frozenset("ad ads adv advert adverts advertisement advertisements sponsor sponsored".split())
_COMMENTS = frozenset("comment comments commentlist disqus".split())
_ASIDES = _ADVERTS | _COMMENTS | frozenset("sidebar sidebars related recommended outbrain taboola newsletter".split())
_LAYOUTS = frozenset("layout wrapper wrap container page main content body article post entry row grid column columns template theme site".split())
#: Ids under which readers write too; points that make prose.
_READERS, _PROSE = frozenset("discussion respond reply replies reactions".split()), 3.0
#: Elements that don't go by name, nor does what stands inside their lines.
_LINES = frozenset("p pre h1 h2 h3 h4 h5 h6".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_COPYRIGHT = re.compile(r"\s*(©|&copy;|\(c\) ?\d|copyright\b|all rights reserved)", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                   r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(/?>|\Z)|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Element:
    __slots__ = ("tag", "parent", "children", "dropped", "named", "lines", "article", "score", "chars", "link_chars")

    def __init__(self, tag: str, parent: Element | None, dropped: bool, named: str = ""):
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, named
        self.children: list[Element | str] = []
        self.article = tag in ("article", "main") or parent is not None and parent.article
        self.lines = tag in _LINES or tag not in _BLOCK and parent is not None and parent.lines
        self.score, self.chars, self.link_chars = 0.0, 0, 0


def _is_clutter(tag: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element is never content by its tag, its role or because it is hidden."""
    if tag in _NEVER or tag == "header" and not inside_article:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = values[0] or values[1] or values[2]
        name = name.lower()
        if name == "role" and value.lower() in _ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _words(names: str) -> set[str]:
    """The words of a class or id that speak of the element itself."""
    out: set[str] = set()
    for name in names.split():
        for word in map(str.lower, _NAME_PARTS.findall(name)):
            if word in _OTHERS:
                break
            out.add(word)
    return out


def _named(tag: str, attributes: str, parent: Element) -> str:
    """What class and id make of an element.

    "" nothing, "clutter" a candidate, "aside" one that is never a layout, "topic" a candidate
    unless it is prose, "readers" one unless it is prose without signed entries.
    """
    if not attributes or tag in ("html", "body", "article", "main"):
        return ""
    words: dict[str, set[str]] = {"class": set(), "id": set()}
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in words:
            words[name.lower()] |= _words(values[0] or values[1] or values[2])
    if tag in _LINES or tag not in _BLOCK and parent.lines:
        return "line" if words["class"] & (_ADVERTS | _COMMENTS if tag == "p" else _ADVERTS) else ""
    overruled = _OVERRULED if (words["class"] | words["id"]) & _CONTENT or tag == "header" else frozenset()
    by_class, by_id = (words[k] & _NOT_CONTENT - overruled for k in ("class", "id"))
    if by_class or by_id - _TOPICS:
        both = words["class"] | words["id"]
        return "aside" if both & _ASIDES and not both & _LAYOUTS else "clutter"
    if by_id & _READERS:
        return "readers"
    return ("topic" if tag == "section" or parent.article or words["class"] & _PARTS else "clutter") if by_id else ""


def parse(page: str) -> Element:
    """The tree of a page; dropped elements and candidates by name are marked."""
    root = Element("html", None, False)
    open_ = root
    at, size = 0, len(page)
    while at < size:
        mark = _MARK.search(page, at)
        if mark is None:
            open_.children.append(page[at:])
            break
        if mark.start() > at:
            open_.children.append(page[at : mark.start()])
        at = mark.end()
        end, start = mark[1], mark[2] or mark[5]
        if end:
            tag = end.lower()
            if tag == "p" and not _inside(open_, "p"):
                continue
            node = open_
            while node is not None and node.tag != tag:
                # an inline end doesn't close blocks
                node = None if tag in _INLINE and node.tag in _BLOCK else node.parent
            if node is not None and node.parent is not None:
                open_ = node.parent
        elif start:
            tag = start.lower()
            attributes = mark[3] if mark[2] else mark[6]
            if tag in ("html", "body"):
                continue
            if tag in _RAW:
                if not (attributes or "").endswith("/") and mark[4] != "/>":
                    close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                    at = close.end() if close else size
                continue
            if tag in _BLOCK:
                p = _inside(open_, "p")
                if p is not None:
                    open_ = p.parent
            ends = _ENDS.get(tag)
            if ends:
                node = open_
                while node.parent is not None and node.tag not in _BOUNDS - set(ends):
                    if node.tag in ends:
                        open_ = node.parent
                    node = node.parent
            if tag == "head" or tag in ("h1", "h2", "h3", "h4", "h5", "h6") and open_.tag[:1] == "h" and open_.tag[1:].isdigit():
                open_ = open_.parent if open_.parent is not None and tag != "head" else open_
            dropped = open_.dropped or _is_clutter(tag, attributes, open_.article)
            node = Element(tag, open_, dropped, "" if dropped else _named(tag, attributes, open_))
            open_.children.append(node)
            if tag not in _VOID and mark[4] != "/>" or tag not in _VOID and tag in _BLOCK | _INLINE:
                open_ = node
    return root


def _inside(node: Element | None, *tags: str) -> Element | None:
    """The nearest of node and its ancestors with one of these tags; a paragraph isn't looked for beyond a block."""
    while node is not None:
        if node.tag in tags:
            return node
        if tags == ("p",) and node.tag in _BLOCK:
            return None
        node = node.parent
    return None


def _walk(root: Element) -> Iterator[Element]:
    stack = [root]
    while stack:
        node = stack.pop()
        if not node.dropped:
            yield node
            stack.extend(c for c in reversed(node.children) if c.__class__ is Element)


def _measure(root: Element) -> list[Element]:
    """Fill in chars and link_chars; the kept elements in page order."""
    order = list(_walk(root))
    for node in reversed(order):
        node.chars = node.link_chars = 0
        for child in node.children:
            if child.__class__ is str:
                node.chars += len(child) - child.count(" ") if child.isspace() else len(child.strip())
            elif not child.dropped:
                node.chars += child.chars
                node.link_chars += child.chars if child.tag == "a" else child.link_chars
    return order


def _own_text(node: Element) -> str:
    """The text of a node without that of blocks inside it."""
    parts: list[str] = []
    stack: list[Element | str] = list(reversed(node.children))
    while stack:
        child = stack.pop()
        if child.__class__ is str:
            parts.append(child)
        elif not child.dropped and child.tag not in _BLOCK:
            stack.extend(reversed(child.children))
    return "".join(parts)


def _points(node: Element) -> float:
    """The points of a paragraph, or of a block with text of its own, for length and commas; 0 for others."""
    loose = node.tag in _BLOCK and any(c.__class__ is str and not c.isspace() for c in node.children)
    if node.tag not in _PARAGRAPHS and not loose:
        return 0.0
    text = _own_text(node).strip()
    if not text:
        return 0.0
    return (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - node.link_chars / max(1, node.chars))


def drop_named(root: Element) -> bool:
    """Drop the candidates by name that aren't content after all; whether there were any."""
    order = _measure(root)
    if not any(node.named for node in order):
        return False
    points = {node: _points(node) for node in order}
    for node in reversed(order):
        if node.parent is not None:
            points[node.parent] += points[node]
    whole = _prose_points(root, points)
    went, stack = False, [root]
    while stack:
        node = stack.pop()
        if node.named and _goes(node, points, whole):
            node.dropped = went = True
        else:
            stack.extend(c for c in node.children if c.__class__ is Element and not c.dropped)
    return went


def _prose_points(node: Element, points: dict[Element, float]) -> float:
    """The points under a node without those of candidates that are never a layout."""
    if node.named in ("aside", "line"):
        return 0.0
    inner = [c for c in node.children if c.__class__ is Element and not c.dropped]
    own = points[node] - sum(points[c] for c in inner)
    return own + sum(_prose_points(c, points) for c in inner)


def _goes(node: Element, points: dict[Element, float], whole: float) -> bool:
    """Whether a candidate isn't content after all."""
    root = node
    while root.parent is not None:
        root = root.parent
    if node.named == "line":
        return True
    if node.named == "aside":
        return 2 * points[node] <= points[root] or whole >= _PROSE
    prose = points[node] and node.link_chars < 0.25 * node.chars
    if node.named == "readers" and _signed(node):
        return 2 * points[node] <= points[root] or points[root] - points[node] >= _PROSE
    if node.named in ("topic", "readers") and prose:
        return False
    if 2 * points[node] <= points[root]:
        return True
    headed = any(n.tag in ("h1", "article", "main") for n in _walk(node))
    return not headed and points[root] - points[node] >= _PROSE and whole - _prose_points(node, points) >= _PROSE


def _signed(node: Element) -> bool:
    """Whether most of the entries of a node (two at least, of one kind) begin with a short line without an end mark."""
    entries = [c for c in _walk(node) if c is not node and c.tag in ("div", "li", "article", "section") and c.chars
               and not any(x.__class__ is Element and x.tag in ("div", "li", "article", "section") for x in c.children)]
    signed = 0
    for entry in entries:
        lines = blocks([entry])
        signed += len(lines) > 1 and len(lines[0]) <= 40 and not re.search(r"[.!?:]$", lines[0])
    return len(entries) > 1 and 2 * signed > len(entries)


def main_elements(root: Element) -> list[Element]:
    """The best container and the siblings that are kept with it, in page order."""
    order = _measure(root)
    if not root.chars:
        return []
    for node in order:
        node.score += _CONTAINERS.get(node.tag, 0.0) if node.chars else 0.0
        points = _points(node)
        if not points:
            continue
        above, share = node.parent if node.tag in _PARAGRAPHS else node, 1.0
        while above is not None and share > 0.1:
            above.score += points * share
            above, share = above.parent, share / 2
    scored = lambda n: n.score * (1 - n.link_chars / max(1, n.chars))
    candidates = [n for n in order if n.chars and n.tag not in _INLINE and n.tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6")]
    if not candidates:
        return [root]
    best = max(candidates, key=scored)
    # a list or table inside an article is part of it
    outer = _inside(best, "article", "main")
    best = outer if outer is not None else best
    if best.parent is None:
        return [best]
    least, kept, seen = max(10.0, 0.2 * scored(best)), [], False
    for sibling in best.parent.children:
        if sibling is best:
            kept.append(best)
            seen = True
        elif sibling.__class__ is Element and not sibling.dropped and sibling.chars:
            density = sibling.link_chars / sibling.chars
            prose = sibling.tag == "p" and density < 0.25 and (sibling.chars > 80 or re.search(r"[.!?]\s*$", _own_text(sibling)))
            if prose or sibling.tag not in _INLINE and density < 0.5 and scored(sibling) >= least:
                kept.append(sibling)
            elif sibling.tag in _HEADINGS and density < 0.25 and (not sibling.link_chars or sibling.tag in ("h1", "h2")) and not (seen and _nothing_after(sibling)):
                kept.append(sibling)
            elif kept and not sibling.link_chars and sibling.tag in _BLOCK - _HEADINGS and not _COPYRIGHT.match(" ".join(blocks([sibling]))):
                kept.append(sibling)  # a short part without links, between or after the parts that are kept
    return kept


def _nothing_after(node: Element) -> bool:
    """Whether no sibling with text without links follows, so that a heading has nothing under it."""
    after = False
    for sibling in node.parent.children:
        if sibling is node:
            after = True
        elif after and sibling.__class__ is Element and not sibling.dropped and sibling.chars > 2 * sibling.link_chars:
            return False
    return True


def blocks(nodes: list[Element]) -> list[str]:
    """The text of each block under the nodes, in page order."""
    out: list[str] = []
    parts: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(text)
        parts.clear()

    for root in nodes:
        stack: list[Element | str | None] = [root]
        breaks = 0
        while stack:
            node = stack.pop()
            if node is None:
                close()
            elif node.__class__ is str:
                parts.append(node)
                breaks = breaks if node.isspace() else 0
            elif node.dropped:
                continue
            elif node.tag == "br":
                breaks += 1
                parts.append(" ")
                if breaks > 1:  # two breaks part paragraphs
                    close()
            elif node.tag in _BLOCK:
                close()
                breaks = 0
                stack.append(None)
                stack.extend(reversed(node.children))
            else:
                if node.tag in ("td", "th"):
                    parts.append(" ")
                stack.extend(reversed(node.children))
        close()
    return out


def main_text(page: str) -> str:
    """The main text of a page."""
    root = parse(page)
    went = drop_named(root)
    text = "\n".join(blocks(main_elements(root)))
    return text if text or not went else "\n".join(blocks(main_elements(parse(page))))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of each row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = texts_of(batch, "html")
            for lo, hi in in_slices(map(len, raw), SLICE_CHARS):
                part = batch.slice(lo, hi - lo)
                yield record_batch(page_id=part.column("page_id"), url=part.column("url"),
                                   text=pa.array([main_text(p) for p in raw[lo:hi]], pa.string()))

    return arrow_stage(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))
