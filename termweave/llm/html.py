"""Main text of web pages by the distribution of line blocks.

Markup is stripped so that every block of a page is a line. A line's weight is the length of its
text outside links; blocks inside menus, adverts, comments and the like weigh nothing and are left
out. Weights are summed over windows of ``WINDOW`` lines: text is kept from each point where the sum
surges over the page's threshold to the point where it dives to nothing.

Class names and ids are evidence. One that is the name of such a block (``sidebar``, ``ad-box``,
``cookie-notice``) leaves it out; one that only holds such a word (``social-history``, ``long-form``),
and the id of a section or paragraph of an article, raises the block's threshold: it stays if a
window inside it sums up to ``SURGE_NAMED``. Headings never go for their own names. Of a header inside
an article (``header``, ``entry-header``) the headings stay.

If a page marks its article (``article``, ``main``), lines outside it are left out as well, and inside
it a lower sum is a surge, and a sentence is one however short it is; lists of links go, with the
heading above them. Marks whose text is less than ``MARKED`` of what is kept without them, like a teaser's, count
for nothing. Of an article that is nothing but links, links weigh what text does. A link is an ``a``
with ``href`` and an end tag.

Character references are decoded; white space inside a block, line breaks included, becomes one
blank. Null, empty and textless pages give an empty text. Broken markup is read to its end: an open
element ends with the element around it. Repeated rows are extracted one by one.
"""

from __future__ import annotations

import html
import itertools
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T

#: Lines in a window, and the sum over a window that is a surge on any page.
WINDOW, SURGE = 3, 80
#: The same inside a marked article, and inside a block whose name speaks against it; the least share
#: of the text that a marked article has.
SURGE_INSIDE, SURGE_NAMED, MARKED = 20, 160, 0.25

# Fixed names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog footer form head header iframe input math menu "
    "meter nav noscript object optgroup option output progress script search select style svg template "
    "textarea title video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note "
    "search status toolbar".split()
)
#: What an open element of this name is ended by, besides its end tag.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
}
LISTS = frozenset("ul ol dl table select menu".split())
#: Words of class names and ids that name what isn't part of an article.
ASIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies copyright disclaimer disqus foot footer form "
    "gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup promo promotion recommended related replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Of these, words that as the last of several may mean something else.
OPEN = frozenset("form menu related search share social".split())
#: Words that name a box and say nothing of what is in it.
BOXES = frozenset(
    "area bar block body box button buttons col column container content copy div footer group holder "
    "icon icons inner item items left link links list main module outer panel right row section slot "
    "space text title top unit wrap wrapper zone".split()
)
#: Words before ``header`` that say that it is the article's own.
OWN = frozenset("article content entry post story".split())
#: What the names of an element say of it.
CLEAR, DOUBTFUL, HEADER, OUT = range(4)
#: Elements that are never left out for their class names.
WHOLE = frozenset("html body main".split())
#: First words of class names that describe a page's layout, like ``has-sidebar``.
LAYOUT = frozenset("has with without no is hide show".split())

TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[A-Za-z][^<>]*\Z""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![^\s/"'])(hidden)(?![^\s/>])""", re.S | re.I)
HREF = re.compile(r"""(?<![^\s"'])href\s*=""", re.I)
NEXT_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
SENTENCE = re.compile(r"""[.!?\u2026\u3002\uff01\uff1f]["'\u201d\u2019\u00bb)\]]*\Z""")
CREDIT = re.compile(r"(©|\(c\)|copyright\b|all rights reserved)", re.I)


def named(name: str, inside: bool) -> int:
    """What a class name or an id says of its element."""
    parts = [x.lower() for x in WORD.findall(name) if len(x) > 1 and not x.isdigit()]
    if not parts or parts[0] in LAYOUT:
        return CLEAR
    if parts[-1] == "header" and (inside or parts[0] in OWN):
        return HEADER
    if parts[0] in ASIDE:
        return OUT if all(x in ASIDE or x in BOXES for x in parts) else DOUBTFUL
    if parts[-1] in ASIDE:
        return DOUBTFUL if parts[-1] in OPEN else OUT
    return CLEAR


def evidence(tag: str, attributes: str, inside: bool) -> int:
    """What an element's attributes say of it; inside: it is part of a marked article."""
    got = {}
    for name, *values, flag in ATTRIBUTE.findall(attributes):
        got.setdefault((name or flag).lower(), html.unescape("".join(values)))
    if tag in WHOLE:
        return CLEAR
    if "hidden" in got or got.get("aria-hidden", "").lower() == "true":
        return OUT
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", got.get("style", ""), re.I):
        return OUT
    if tag == "article" and not inside:
        return CLEAR
    if got.get("role", "").lower() in ROLES:
        return OUT
    if tag in HEADINGS:
        return CLEAR
    anchor = inside and tag in ("section", "p")
    says = [named(x, inside) for x in got.get("class", "").split()]
    says += [min(named(x, inside), DOUBTFUL if anchor else OUT) for x in got.get("id", "").split()]
    return max(says, default=CLEAR)


class Open(NamedTuple):
    """An open element, and what holds for the text in it."""

    name: str
    out: bool = False
    article: bool = False
    link: bool = False
    header: bool = False
    heading: bool = False
    doubtful: int = 0  # the number of the outermost element around it whose name speaks against it


class Line(NamedTuple):
    """A block: its text, the length outside links, and where it is."""

    text: str
    weight: int
    article: bool
    heading: bool
    doubtful: int


class Lines:
    """Blocks of a page that aren't left out."""

    def __init__(self, page: str):
        self.found: list[Line] = []
        self.stack: list[Open] = []
        self.parts: list[str] = []
        self.plain = self.links = self.doubts = 0
        self.marked = False  # the page marks its article
        at, end = 0, len(page)
        while at < end:
            m = TAG.search(page, at)
            self._text(page[at : m.start() if m else end])
            if not m:
                break
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._close(name)
                continue
            attributes = m[3] or m[6] or ""
            link = name == "a" and bool(HREF.search(attributes))
            if link:
                closed = NEXT_LINK.search(page, at)
                link = bool(closed and closed[1])
            self._open(name, attributes, link)
            if name in RAW:
                stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end if name != "title" else at
                self._close(name)
        self._flush()

    def _text(self, text: str) -> None:
        top = self.stack[-1] if self.stack else Open("")
        if text and not top.out and (top.heading or not top.header):
            self.parts.append(text)
            if not self.links:
                self.plain += len(text.strip())

    def _flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                top = self.stack[-1] if self.stack else Open("")
                self.found.append(Line(text, min(self.plain, len(text)), top.article, top.heading, top.doubtful))
            self.parts, self.plain = [], 0

    def _pop(self, to: int) -> None:
        self.links -= sum(x.link for x in self.stack[to:])
        del self.stack[to:]

    def _open(self, name: str, attributes: str, link: bool) -> None:
        if name in BLOCKS:
            self._flush()
            for k in range(len(self.stack) - 1, -1, -1):
                top = self.stack[k].name
                if top == "p" or name in ENDS.get(top, ()):
                    self._pop(k)
                    break
                if top in BLOCKS and top not in ENDS or top in LISTS:
                    break
        elif name == "br":
            self._text(" ")
        if name in VOID:
            return
        around = self.stack[-1] if self.stack else Open("")
        says = evidence(name, attributes, around.article)
        own = name == "header" and around.article or says == HEADER
        out = around.out or says == OUT or name in DROPPED and not own
        article = around.article
        self.doubts += says == DOUBTFUL
        if name in ("article", "main") and not out:
            article = self.marked = True
        self.stack.append(
            Open(
                name, out, article, link, around.header or own, around.heading or name in HEADINGS,
                around.doubtful or (self.doubts if says == DOUBTFUL else 0),
            )
        )
        self.links += link

    def _close(self, name: str) -> None:
        if name in BLOCKS:
            self._flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].name == name:
                self._pop(k)
                return
            if name not in BLOCKS and self.stack[k].name in BLOCKS:
                return


def kept_lines(weights: list[int], least: int = SURGE) -> list[bool]:
    """Lines between surge and dive points of the sums over windows."""
    n = len(weights)
    sums = [sum(weights[k : k + WINDOW]) for k in range(n)]
    most = max(sums, default=0)
    surge = min(least, most / 2)
    out, k = [False] * n, 0
    while k < n:
        if not most or sums[k] < surge or not weights[k]:
            k += 1
            continue
        end = k
        while end < n and sums[end]:
            end += 1
        first = k
        while first and not out[first - 1] and weights[first - 1]:  # lines that led up to the surge
            first -= 1
        out[first:end] = [True] * (end - first)
        k = end
    return out


def without_doubtful(found: list[Line]) -> list[Line]:
    """The lines but for stretches that their names speak against and no window's sum speaks for."""
    out: list[Line] = []
    for doubtful, stretch in itertools.groupby(found, lambda x: x.doubtful):
        lines = list(stretch)
        weights = [x.weight for x in lines]
        if not doubtful or max(sum(weights[k : k + WINDOW]) for k in range(len(lines))) >= SURGE_NAMED:
            out += lines
    return out


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line feeds."""
    lines = Lines(page or "")
    found, marked = without_doubtful(lines.found), lines.marked
    weights = [x.weight for x in found]
    if marked:
        # what is kept of the page without its marks, outside of them and inside
        outside = sum(x.weight for x, k in zip(found, kept_lines(weights), strict=True) if k and not x.article)
        inside = sum(x.weight for x in found if x.article)
        marked = inside >= MARKED * (inside + outside)
    if marked:
        found = [x for x in found if x.article]
        # marks between links aren't running text, sentences are
        weights = [x.weight if 4 * x.weight >= len(x.text) else 0 for x in found]
        weights = [max(w, SURGE_INSIDE) if w and SENTENCE.search(x.text) else w for w, x in zip(weights, found, strict=True)]
        if not any(weights):
            weights = [len(x.text) for x in found]
    else:
        # a credit line at the edge of a page without marks belongs to its footer
        while found and CREDIT.match(found[-1].text):
            found.pop()
        weights = weights[: len(found)]
    keep = kept_lines(weights, SURGE_INSIDE if marked else SURGE)
    for k in range(len(found) - 2, -1, -1):
        if marked and found[k].heading and not keep[k + 1] and k and keep[k - 1]:
            keep[k] = False  # the heading of what is left out
        keep[k] = keep[k] or keep[k + 1] and found[k].heading  # the heading of what is kept
    return "\n".join(x.text for x, k in zip(found, keep, strict=True) if k)


def extracted(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), page: str = "html") -> DataFrame:
    """The kept columns, text and n_chars of each row."""
    src = pages.select(*keep, F.col(page).alias("_html"))
    kinds = "".join(f"`{c}` {src.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches):
        for batch in T.chunked(batches, "_html"):
            texts = [main_text(x) for x in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    return src.mapInArrow(run, f"{kinds}text string, n_chars long")
