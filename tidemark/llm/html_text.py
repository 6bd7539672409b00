"""Main text of web pages by tag-path ratios.

A page's html is read into leaf blocks: runs of text between block tags, each with the path of block elements from
the root (tags with their class and id words).  Inline tags do not cut a block.  Then, for each page:

1. Blocks in head elements, scripts, styles, forms, menus, headers, footers and asides fall away by their tag;
   blocks below an element whose class, id or role names a menu, advert, notice, sidebar, comment section and
   the like fall away by that word, unless the element holds an ``article`` or ``main`` element.
2. Text length and punctuation are added up per tag path.  A path's text ratio (length without links, per block) and
   its punctuation ratio are fused to one score and smoothed along the page with a Gaussian.
3. If an article region is marked (``article``, ``main``, ``itemprop=articleBody``, or a content class), the path's
   length is padded with ``REGION_CHARS``, so that a short paragraph of an article passes; blocks outside fall away.
   Paths above the threshold (the standard deviation of the page's smoothed scores, at most ``ENOUGH_CHARS``) are
   content.  Without a marked region the element that holds most of the content text is the region.
4. Every block of a content path in the region is put out, in page order.

Pages are independent, so there is no shuffle; a task holds one Arrow batch, and its time is linear in the length of
the html.  Nothing is cut off.

Cases: null or empty html, and a page without content, give an empty text with 0 characters.  Html that breaks off
within a tag, comment, script or character reference is read to its end.  Html without any tag is one block and
stays whole.  Repeated rows and null ids or urls stay as they are.  Only the three named columns are read.
"""

from __future__ import annotations

import html
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load

PAGES = 256
#: Characters that a path in a marked article region is padded with, and the highest threshold.
REGION_CHARS, ENOUGH_CHARS = 120.0, 40.0
#: Share of link characters from which a path is a list of links.
LINK_SHARE = 0.6
#: Share of the content text that an element must hold for the region to move down into it.
MOST = 0.75
#: Regions with less than this part of the largest region's text are teasers.
TEASER = 0.25
SIGMA = 1.0

# Elements of the HTML standard.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark meter nobr output picture progress q "
                   "rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements closed by the start of one of the same set, inside the nearest element of ``SCOPE``.
SIBLINGS = {t: s for s in (frozenset(["li"]), frozenset(["dt", "dd"]), frozenset(["tr"]), frozenset(["td", "th"]),
                           frozenset(["thead", "tbody", "tfoot"]), frozenset(["option", "optgroup"])) for t in s}
SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]),
         "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"]), "thead": frozenset(["table"]), "tbody": frozenset(["table"]),
         "tfoot": frozenset(["table"]), "option": frozenset(["select"]), "optgroup": frozenset(["select"])}
KEEPS_P = frozenset(["html", "body", "div", "section", "article", "main", "td", "th", "li", "blockquote", "button", "table", "figure"])

#: Elements whose text is never main text.
DROPPED = frozenset("head title script style noscript template nav footer aside form button select option textarea input dialog menu iframe "
                    "object embed audio video canvas svg map noembed noframes datalist fieldset legend label".split())
#: Words of class, id and role that name something besides the article.
OTHER = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot adbox banner breadcrumb breadcrumbs comment comments "
                  "commentlist consent cookie cookies discussion disqus dropdown feedback footer form gdpr header hidden login masthead "
                  "menu menubar modal nav navbar navigation newsletter noprint notice notices notification notifications alert overlay "
                  "pager pagination popup popular promo promos promoted promotion recommended recommendations related reply replies "
                  "respond responses search share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored subscribe "
                  "subscription tagcloud teaser teasers toast toolbar trending widget widgets complementary contentinfo "
                  "advertorial disclaimer".split())
TALK = frozenset("comment comments commentlist discussion disqus reply replies respond responses".split())
#: Words of class, id and itemprop that name the article.
CONTENT = frozenset("article articlebody content contents entry post story maincontent main text".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
                  re.S)
_ATTR = re.compile(r"""(class|id|role|itemprop|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PUNCTUATION = ".,;:!?…、。，！？،؟।"
_HEADING = re.compile(r"h[1-6]\Z")


class Element:
    __slots__ = ("parent", "tag", "path", "other", "region", "holds_main", "inner")

    def __init__(self, parent, tag, path):
        self.parent, self.tag, self.path = parent, tag, path
        self.other = self.holds_main = self.inner = False
        self.region = 0


def _decoded(parts) -> str:
    text = "".join(parts)
    return " ".join((html.unescape(text) if "&" in text else text).split())


class Page:
    """Elements (parents first) and leaf blocks (element number, text, link characters) of one html text."""

    def __init__(self, source: str):
        self.paths: dict[tuple, int] = {}
        self.elements = [Element(-1, "", 0)]
        self.blocks: list[tuple[int, str, int]] = []
        self.stack, self.open, self.links = [0], {}, 0
        self.run: list[tuple[str, bool]] = []
        self._read(source)
        self._cut()

    def _cut(self):
        """Ends the running block."""
        if self.run:
            text = _decoded(t for t, _ in self.run)
            if text:
                self.blocks.append((self.stack[-1], text, len(_decoded(t for t, a in self.run if a))))
            self.run = []

    def _read(self, s: str):
        at, look = 0, 0
        while (tag_at := s.find("<", look)) >= 0:
            m = _TAG.match(s, tag_at)
            if m is None:                      # a literal <
                look = tag_at + 1
                continue
            if tag_at > at:
                self.run.append((s[at:tag_at], self.links > 0))
            at = look = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._close(tag)
                continue
            self._start(tag, m[3] or m[6] or "")
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(s, at)
                at = look = end.end() if end else len(s)
                self._close(tag)
        if at < len(s):
            self.run.append((s[at:], self.links > 0))

    def _pop(self, upto: int):
        for e in self.stack[upto:]:
            self.open[self.elements[e].tag] -= 1
        del self.stack[upto:]

    def _close_one_of(self, tags: frozenset, scope: frozenset):
        if not any(self.open.get(t) for t in tags):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.elements[self.stack[k]].tag
            if tag in tags:
                self._pop(k)
                return
            if tag in scope:
                return

    def _close(self, tag: str):
        if tag == "a":
            self.links = 0
        if tag in INLINE or tag == "br":
            if tag == "br":
                self.run.append((" ", False))
            return
        self._cut()
        self.links = 0
        if self.open.get(tag):
            k = len(self.stack) - 1
            while self.elements[self.stack[k]].tag != tag:
                k -= 1
            self._pop(k)

    def _start(self, tag: str, attributes: str):
        if tag == "br":
            self.run.append((" ", False))
            return
        if tag == "a":
            self.links = 1
        if tag in INLINE:
            return
        self._cut()
        self.links = 0
        if tag in VOID:
            return
        self._close_one_of(frozenset(["p"]), KEEPS_P)
        if tag in SIBLINGS:
            self._close_one_of(SIBLINGS[tag], SCOPE[tag])
        if _HEADING.match(tag) and _HEADING.match(self.elements[self.stack[-1]].tag):
            self._pop(len(self.stack) - 1)
        top = self.stack[-1]
        words, roles, out_of_sight = set(), set(), False
        for m in _ATTR.finditer(attributes) if attributes else ():
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") \
                    or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                out_of_sight = True
            elif name in ("class", "id", "role"):
                words.update(w.lower() for w in _WORD.findall(value))
                words.update(value.lower().split())
                if name == "role":
                    roles.add(value.lower())
            elif name == "itemprop" and value.lower() == "articlebody":
                roles.add("articlebody")
        key = (self.elements[top].path, tag, " ".join(sorted(words)))
        e = Element(top, tag, self.paths.setdefault(key, len(self.paths) + 1))
        parent = self.elements[top]
        e.inner = parent.inner or parent.tag in ("article", "main")
        if tag in DROPPED or out_of_sight or (tag == "header" and not e.inner):
            e.other, e.holds_main = True, False
        number = len(self.elements)
        if tag in ("article", "main") or roles & {"main", "articlebody"}:
            e.region = 2 if tag == "main" or "main" in roles else 1
            if words & TALK:
                e.other, e.region = True, 0
            else:
                up = top
                while up > 0 and not self.elements[up].holds_main:
                    self.elements[up].holds_main = True
                    up = self.elements[up].parent
        elif tag not in ("html", "body") and not _HEADING.match(tag):
            if words & (OTHER - {"header"} if e.inner else OTHER):
                e.other = True
            elif words & CONTENT:
                e.region = 3
        self.elements.append(e)
        self.stack.append(number)
        self.open[tag] = self.open.get(tag, 0) + 1


def _inside(page: Page, chosen: set[int]) -> list[bool]:
    out = [False] * len(page.elements)
    for i, e in enumerate(page.elements):
        out[i] = i in chosen or (e.parent >= 0 and out[e.parent])
    return out


def _mass(page: Page, blocks: list[tuple[int, str, int]]) -> list[int]:
    """Characters without links below each element."""
    mass = [0] * len(page.elements)
    for e, text, linked in blocks:
        mass[e] += len(text) - linked
    for i in range(len(mass) - 1, 0, -1):
        mass[page.elements[i].parent] += mass[i]
    return mass


def _down(page: Page, mass: list[int], top: int) -> int:
    """The lowest element below ``top`` on the way along children that hold ``MOST`` of the text."""
    total = mass[top]
    for i in range(top + 1, len(page.elements)):
        e = page.elements[i]
        if e.parent == top and mass[i] >= MOST * total and e.tag not in ("p", "table", "pre") and not _HEADING.match(e.tag):
            top = i
    return top


def _regions(page: Page, blocks: list) -> set[int]:
    """Elements marked as the article: the outermost of the narrowest kind that has text."""
    mass = _mass(page, blocks)
    for kind in (1, 2, 3):
        marked = {i for i, e in enumerate(page.elements) if e.region == kind and mass[i]}
        if not marked:
            continue
        covered = _inside(page, marked)
        outer = [i for i in marked if not covered[page.elements[i].parent]]
        largest = max(mass[i] for i in outer)
        if kind < 3:
            return {i for i in outer if mass[i] >= TEASER * largest}
        if largest >= 0.5 * mass[0]:
            return {_down(page, mass, max(outer, key=lambda i: mass[i]))}
    return set()


def _smooth(values: np.ndarray) -> np.ndarray:
    reach = math.ceil(2 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    padded = np.pad(values, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def _content_paths(page: Page, blocks: list, padding: float) -> set[int]:
    """Paths whose fused, smoothed ratio reaches the threshold."""
    length, linked, marks, count = {}, {}, {}, {}
    for e, text, links in blocks:
        p = page.elements[e].path
        length[p] = length.get(p, 0) + len(text) - links
        linked[p] = linked.get(p, 0) + links
        marks[p] = marks.get(p, 0) + sum(map(text.count, _PUNCTUATION))
        count[p] = count.get(p, 0) + 1
    score = {p: (length[p] + padding) / (count[p] + (padding > 0)) * math.log2(2 + marks[p] / count[p]) for p in count}
    links = {p for p in count if linked[p] > LINK_SHARE * (length[p] + linked[p])}
    along = [page.elements[e].path for e, _, _ in blocks]
    smooth = _smooth(np.array([0.0 if p in links else score[p] for p in along]))
    enough = min(float(smooth.std()), ENOUGH_CHARS)
    best = {}
    for p, v in zip(along, smooth.tolist()):
        best[p] = max(best.get(p, 0.0), v)
    return {p for p, v in best.items() if p not in links and v >= enough}


def main_text(source: str | None) -> str:
    """The main text of one page."""
    page = Page(source or "")
    if not page.blocks:
        return ""
    gone = [False] * len(page.elements)
    for i, e in enumerate(page.elements):
        gone[i] = (e.parent >= 0 and gone[e.parent]) or (e.other and not e.holds_main)
    blocks = [b for b in page.blocks if not gone[b[0]]]
    if not blocks:
        return ""
    regions = _regions(page, blocks)
    inside = _inside(page, regions or {0})
    blocks = [b for b in blocks if inside[b[0]]]
    paths = _content_paths(page, blocks, REGION_CHARS if regions else 0.0)
    if not regions:
        content = [b for b in blocks if page.elements[b[0]].path in paths]
        inside = _inside(page, {_down(page, _mass(page, content), 0)})
    return " ".join(text for e, text, _ in blocks if inside[e] and page.elements[e].path in paths)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars), one row per page."""
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, PAGES):
                part = batch.slice(i, PAGES)
                texts = [main_text(s.as_py()) for s in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(run, f"id {id_type}, url string, text string, n_chars long")


def op13(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(load(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
