"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with its tag path from the
root.  Per path, the text length and the punctuation of its blocks are put in
relation to the number of blocks; both ratios are smoothed along the page and
fused; blocks of paths over a threshold are content.  The smallest element that
holds nearly all content is the article's region, and the short blocks inside
it (headings, one-word paragraphs) stay with it.  Elements whose tag, role or name
says that they are something else (menus, footers, adverts, forms, comments,
...) never take part, unless they wrap the article.

Marks (``article``, ``main``, ...) only set the region's edges: it grows to the
marked element around it, with the headline and lead before that element where
a further marked one holds both; if it spans several, those with a fair share
of the content are the text.  A page without marks gets its region, and the
headline before it, from the paths alone.

Work and memory grow with the length of a page, however deep it is: elements
know their path, and whether they are inside something, from their parent.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import extended

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？]")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template title textarea iframe svg object xmp".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
             "ruby s samp small span strike strong sub sup time tt u var wbr img".split())
# elements that are never part of an article
APART = set("nav footer aside form head menu dialog button select option input canvas audio video "
            "fieldset optgroup datalist map".split())
APART_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                  "menubar toolbar".split())
APART_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "sidebar sidenav menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment "
    "comments disqus replies respond share sharing social related recommended recommendations widget widgets "
    "pagination pager copyright disclaimer skip outbrain taboola".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MAIN = {"article", "main"}
MAIN_NAMES = {"articlebody", "main", "article"}
# start tags that end an open element of the listed kinds
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# blocks that hold one piece of text, not an article
_ALONE = HEADINGS | set("p li dt dd td th tr pre caption figcaption address summary".split())
REGION_SHARE = 0.8      # of all content, for an element to be the region
MARKED_SHARE = 0.2      # of the most content of a marked element, to be text too
_SCOPE = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "blockquote", "main"}


class _Element:
    """One open tag.  ``outer`` is the nearest element at or above it that is
    not inline, ``path`` the number of its tag path, ``inlines`` how many inline
    elements of each tag are open right inside it, ``marked`` the nearest marked
    element at or above it."""
    __slots__ = ("tag", "parent", "outer", "path", "apart", "named", "main", "holds_main", "inlines",
                 "gone", "heading", "marked", "header", "chars", "content", "paragraphs", "closed", "inside")

    def __init__(self, tag: str, attributes: str, parent: _Element | None, paths: dict):
        self.tag, self.parent, self.holds_main = tag, parent, False
        self.inlines: dict[str, int] = {}
        self.chars = self.content = self.paragraphs = 0
        self.closed = self.inside = False
        found = {}
        if attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                found.setdefault(name.lower(), next((v for v in values if v), ""))
        names = f"{found.get('class', '')} {found.get('id', '')}"
        words = {w.lower() for w in _NAME_PART.findall(names)} if names != " " else set()
        role = found.get("role", "").lower()
        hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower()
        self.named = bool(words & APART_NAMES) and tag not in ("html", "body")
        self.main = ((tag in MAIN or role in MAIN or found.get("itemprop", "").lower() in MAIN_NAMES)
                     and not self.named)
        self.apart = tag in APART or role in APART_ROLES or hidden and tag not in ("html", "body")
        if parent is None:
            self.outer, self.path = self, 0
        elif tag in INLINE:
            self.outer, self.path = parent.outer, parent.path
        else:
            first = found.get("class", "").split()
            step = (parent.path, f"{tag}.{first[0]}" if first else tag)
            self.outer, self.path = self, paths.setdefault(step, len(paths) + 1)
        if self.main:
            above = parent
            while above is not None and not above.holds_main:
                above.holds_main = True
                above = above.parent


class _Block:
    __slots__ = ("text", "where", "chars", "linked")

    def __init__(self, text: str, where: _Element, linked: int):
        self.text, self.where, self.chars, self.linked = text, where, len(text), linked


class _Stack:
    """The open elements, with how many of each tag there are."""

    def __init__(self):
        self.paths: dict[tuple[int, str], int] = {}
        self.all = [_Element("", "", None, self.paths)]     # every element, parents first
        self.open = [self.all[0]]
        self.tags: dict[str, int] = {}

    def push(self, tag: str, attributes: str) -> None:
        e = _Element(tag, attributes, self.open[-1], self.paths)
        self.all.append(e)
        self.open.append(e)
        self.tags[tag] = self.tags.get(tag, 0) + 1
        if tag in INLINE:
            e.outer.inlines[tag] = e.outer.inlines.get(tag, 0) + 1

    def has(self, tag: str) -> bool:
        return self.tags.get(tag, 0) > 0

    def _forget(self, e: _Element) -> None:
        self.tags[e.tag] -= 1
        if e.outer is not e:
            e.outer.inlines[e.tag] -= 1

    def cut(self, k: int) -> None:
        """Ends the element at place k and all inside it."""
        while len(self.open) > k:
            self._forget(self.open.pop())

    def end(self, tag: str) -> None:
        """An end tag: of the nearest open element of that tag."""
        if tag in INLINE:
            if self.open[-1].outer.inlines.get(tag, 0):
                k = len(self.open) - 1
                while self.open[k].tag != tag:
                    k -= 1
                self._forget(self.open[k])
                self.open[k].closed = True
                del self.open[k]
        elif self.has(tag):
            k = len(self.open) - 1
            while self.open[k].tag != tag:
                k -= 1
            self.open[k].closed = True
            self.cut(k)

    def make_room(self, tag: str) -> None:
        """Ends what a start tag of a block ends without an end tag."""
        ends = _CLOSES.get(tag, frozenset())
        if not self.has("p") and not any(map(self.has, ends)):
            return
        for k in range(len(self.open) - 1, 0, -1):
            kind = self.open[k].tag
            if kind in ends or kind == "p":
                for e in self.open[k:]:
                    e.closed = True
                self.cut(k)
                if not ends:
                    return
            elif kind in _SCOPE:
                return


def parsed(page: str) -> tuple[list[_Block], list[_Element]]:
    """Text blocks in page order, white space inside each as single spaces, and
    the page's elements, parents first."""
    out: list[_Block] = []
    stack = _Stack()
    parts: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(_Block(text, stack.open[-1].outer, min(linked, len(text))))
            parts.clear()
        linked = 0

    def said(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if stack.has("a"):
                linked += len(text.strip())

    search, end = _MARKUP.search, len(page)
    while at < end:
        m = search(page, at)
        if m is None:
            said(page[at:])
            break
        said(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if tag not in INLINE:
                flush()
            stack.end(tag)
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag not in INLINE:
            flush()
            stack.make_room(tag)
        if tag not in VOID:
            stack.push(tag, attributes)
    flush()
    return out, stack.all


def blocks_of(page: str) -> list[_Block]:
    """Text blocks in page order; white space inside each is single spaces."""
    return parsed(page)[0]


def _sum_up(elements: list[_Element], field: str) -> None:
    """Adds to each element what lies in the elements inside it."""
    for e in reversed(elements):
        if e.parent is not None:
            setattr(e.parent, field, getattr(e.parent, field) + getattr(e, field))


def _kept_apart(blocks: list[_Block], elements: list[_Element]) -> list[_Block]:
    """The blocks outside elements that are not part of an article.  One that
    wraps the article is no such element: it holds a marked element, or it is a
    form or was never closed and holds most of the page's text that is not
    linked, in three paragraphs or more."""
    for b in blocks:
        b.where.chars += b.chars - b.linked
        b.where.paragraphs += b.where.tag == "p"
    _sum_up(elements, "chars")
    _sum_up(elements, "paragraphs")
    most = 0.8 * elements[0].chars
    for e in elements:
        up = e.parent
        wraps = e.holds_main or ((e.tag == "form" or not e.closed) and e.chars > 0 and e.chars >= most
                                 and e.paragraphs >= 3)
        e.gone = (up is not None and up.gone) or (e.apart or e.named) and not wraps
        e.heading = e.tag in HEADINGS or up is not None and up.heading
        e.marked = e if e.main else up and up.marked
        e.header = (e.tag == "header" and not e.holds_main) or up is not None and up.header
    return [b for b in blocks if not b.where.gone
            and not (b.where.header and not (b.where.heading and b.where.marked))]


def _smooth(x: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Gaussian window of five blocks along the page; a neighbour under another
    parent path counts a tenth, so that what lies beside a block of text does
    not look like it."""
    total, weights = np.zeros(len(x)), np.zeros(len(x))
    for shift in range(-2, 3):
        at = np.clip(np.arange(len(x)) + shift, 0, len(x) - 1)
        weight = np.exp(-0.5 * shift ** 2) * np.where(parent[at] == parent, 1.0, 0.1)
        total += weight * x[at]
        weights += weight
    return total / weights


def _content(blocks: list[_Block]) -> np.ndarray:
    """Which blocks have a content path: fused ratios against a threshold."""
    _, path = np.unique([b.where.path for b in blocks], return_inverse=True)
    parent = np.array([-1 if b.where.parent is None else b.where.parent.path for b in blocks])
    chars = np.array([b.chars - b.linked for b in blocks], dtype=float)
    marks = np.array([len(_PUNCTUATION.findall(b.text)) for b in blocks], dtype=float)
    nodes = np.bincount(path)
    text_ratio = (np.bincount(path, chars) / nodes)[path]
    mark_ratio = (np.bincount(path, marks) / nodes)[path]
    fused = _smooth(text_ratio, parent) * (1 + _smooth(mark_ratio, parent))
    mean = np.bincount(path, fused) / nodes       # back from blocks to paths
    limit = min(fused.std(), 0.5 * fused.mean())
    return (mean[path] >= limit) & (chars * 2 >= np.array([b.chars for b in blocks]))


def _region(elements: list[_Element]) -> _Element:
    """The smallest element with nearly all content; a block alone (a paragraph,
    a heading, an item) is none."""
    at = total = elements[0]
    for e in elements:      # parents first: the last that fits is the deepest
        if e.content >= REGION_SHARE * total.content and e.outer is e and e.tag not in _ALONE:
            at = e
    return at


def _enter(elements: list[_Element], chosen: set[_Element]) -> None:
    for e in elements:
        e.inside = e in chosen or e.parent is not None and e.parent.inside


def extract(page: str | None) -> str:
    """The article of one page; empty if there is none."""
    blocks, elements = parsed(page or "")
    blocks = _kept_apart(blocks, elements)
    if not blocks:
        return ""
    good = _content(blocks)
    if not good.any():
        good = np.ones(len(blocks), dtype=bool)
    for b, ok in zip(blocks, good, strict=True):
        b.where.content += b.chars if ok else 0
    _sum_up(elements, "content")
    region = _region(elements)
    chosen = set()
    around = set()          # marked elements that hold it; the nearest one is the text
    at = region.marked
    while at is not None:
        around.add(at)
        at = at.parent.marked
    if around:
        chosen = {region.marked}
    if not chosen and region.holds_main:        # or the marked ones in it
        _enter(elements, {region})
        outermost = [e for e in elements if e.main and e.inside and not e.parent.marked]
        most = max(e.content for e in outermost)
        if most >= MARKED_SHARE * region.content:
            chosen = {e for e in outermost if e.content and e.content >= MARKED_SHARE * most}
    marked = bool(chosen)
    _enter(elements, chosen or {region})
    inside = [b.where.inside for b in blocks]
    first = inside.index(True) if True in inside else 0
    kept = [within if marked else bool(ok) or within and b.linked * 2 <= b.chars
            for b, ok, within in zip(blocks, good, inside, strict=True)]
    titled = any(k and b.where.heading for b, k in zip(blocks[first:first + 1], kept[first:], strict=False))
    for i in range(first):      # headline and lead before the region
        b = blocks[i]
        if b.linked * 2 > b.chars:
            continue
        if marked:
            kept[i] = kept[i] or b.where.marked in around
        else:
            kept[i] = kept[i] or not titled and b.where.heading
    return "\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


def html_extraction(pages: DataFrame, key: str = "page_id", markup: str = "html",
                    keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``text`` and ``n_chars`` (code points) of every page, with ``key`` and the
    columns ``keep``.  A null or empty page, and one without an article, gives
    the empty text.  Blocks are joined by one newline in page order.  Repeated
    rows and null keys pass through."""
    names = [key, *keep]
    src = pages.select(*names, F.col(markup).cast("string").alias("_markup"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(p.as_py()) for p in b.column(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*names, "text", "n_chars"])

    return src.mapInArrow(run, extended(src.select(*names), text="string", n_chars="long"))


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return html_extraction(spark.read.parquet(f"{sf_dir}/pages.parquet"))
