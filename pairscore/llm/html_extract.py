"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events into lines, one per block of text. Each line has a ratio of its text, without
link text, to its tags; the ratios are smoothed by a Gaussian, and lines whose smoothed ratio passes the threshold (the
standard deviation, as in content extraction via tag ratios) form the content clusters.

* Where a page marks articles, all of them are its text, however short; else its main part is. Elements that are never part
  of a text (menus, forms, asides, scripts, hidden parts) are left out there, and so are those named for adverts, comments,
  sharing and the like. A weaker name (``form``, ``search``, ``notice``) may as well be what a section is about: there the
  ratios decide, and only lines outside the clusters go. An id of a section, being what links point to, is a weak name.
* Where nothing is marked, the clusters decide: the region is the smallest element with most of their text, and of it what
  lies from the first content line to the last is taken, without lists of links; beyond them only a heading before, and
  blocks of the same kind in the same element, unless they look like a menu or a copyright line.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from .common import map_text

# Element names of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
SILENT = frozenset("script style noscript template title head svg math canvas iframe object audio video textarea select button datalist map".split())
NOISE = frozenset("nav footer aside form menu dialog".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
CLOSES_P = BLOCK - frozenset("body html head option td th tr caption tbody thead tfoot".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold blocks; a region is one of these.
HOLDERS = frozenset("html body main article section div center td table tbody blockquote fieldset figure".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar status".split())
# Words in class and id attributes.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs footer header masthead "
    "sidebar aside cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login register share sharing "
    "social related recommended recommendations comment comments reply replies respond disqus discussion widget toolbar pagination pager search copyright legal disclaimer "
    "form paywall outbrain taboola teaser trending".split()
)
HARD_WORDS = frozenset(
    "comment comments replies respond disqus ad ads advert adverts advertisement cookie cookies nav navbar navigation menu footer breadcrumb breadcrumbs newsletter popup modal".split()
)
#: Names that within an article tell by themselves, since what they name may be prose too.
TELLING_WORDS = HARD_WORDS | frozenset(
    "adv advertising sponsor sponsored sidebar consent overlay subscribe subscription signup login register share sharing social related recommended recommendations paywall outbrain taboola".split()
)
ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored".split())
#: Of a section's id: what readers write, and adverts.
ID_WORDS = ADVERT_WORDS | frozenset("comment comments replies respond disqus".split())
#: Words that say nothing in a class, beside others.
NEUTRAL_WORDS = frozenset("box block list lists wrapper wrap container area section bar inner outer item items links link post posts group holder panel module top bottom left right thread form".split())
#: Elements that quote, and parts of a text's own: a discussion or a reply there is the author's.
QUOTES = frozenset("blockquote pre figure table p li".split())
OWN_WORDS = frozenset("discussion reply".split())
# How copyright lines begin, and what stands between the entries of a menu.
_COPYRIGHT = re.compile(r"^\s*(?:©|\(c\)\s|copyright\b)", re.I)
_MENU_MARKS = re.compile(r"\s+[|·•»›/]\s+|\s+::\s+")
LAYOUT_WORDS = frozenset("has with without no".split())  # as in has-sidebar: said of the part beside it
CONTENT_WORDS = frozenset("content main article entry story text body".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(frozen=True, slots=True)
class _Open:
    """An open element, and what holds inside it: of itself or of any element around it."""

    tag: str
    noise: bool = False
    silent: bool = False
    header: bool = False
    heading: bool = False
    link: bool = False
    article: bool = False  # an article or main part
    marked: str = ""  # "article" within one, "main" within a main part only
    suspect: bool = False  # named weakly for something else than text
    holder: int = 0
    state: str = ""


@dataclass(slots=True)
class _Line:
    text: str
    tags: int
    links: int  # characters of link text
    holder: int  # the number of the innermost element that holds blocks
    noise: bool
    heading: bool
    marked: str
    suspect: bool
    tag: str  # the innermost block it is in


class _Lines(HTMLParser):
    """Collects lines and the tree of elements that hold blocks. Elements are numbered in the order they open, so those
    within one are the numbers from its own to its last. All work is linear in the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.stack: list[_Open] = []
        self.open: Counter[str] = Counter()  # how many of each tag are open
        self.left: list[int] = []  # where in the stack menus, headers and footers are
        self.parts: list[str] = []
        self.tags = self.links = 0
        self.parents, self.ends, self.names = [0], [0], [""]  # of each holder, by number; 0 is the page

    @property
    def now(self) -> _Open:
        return self.stack[-1] if self.stack else _PAGE

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            now = self.now
            noise = now.noise or (now.header and not (now.heading and now.article))
            tag = next((e.tag for e in reversed(self.stack) if e.tag in BLOCK), "")
            self.lines.append(_Line(text, self.tags, self.links, now.holder, noise, now.heading, now.marked, now.suspect, tag))
            self.tags = self.links = 0

    def _push(self, tag: str, state: str) -> None:
        now, holder = self.now, self.now.holder
        if tag in HOLDERS:
            holder = len(self.parents)
            self.parents.append(now.holder)
            self.ends.append(holder)
            self.names.append(tag)
        self.open[tag] += 1
        if state and tag in _LEFT_OPEN:
            self.left.append(len(self.stack))
        self.stack.append(_Open(
            tag, now.noise or state == "noise", now.silent or state == "silent", now.header or state == "header", now.heading or tag in HEADINGS,
            now.link or tag == "a", now.article or (tag in ("article", "main") and state != "header"),
            "article" if tag == "article" else now.marked or ("main" if tag == "main" else ""), now.suspect or state == "suspect", holder, state))

    def _pop_to(self, depth: int) -> None:
        for element in self.stack[depth:]:
            self.open[element.tag] -= 1
            if element.tag in HOLDERS:
                self.ends[element.holder] = len(self.parents) - 1
        del self.stack[depth:]
        while self.left and self.left[-1] >= depth:
            self.left.pop()

    def _close_implied(self, tag: str) -> None:
        if tag in CLOSES_P and self.open["p"]:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i].tag == "p":
                    return self._pop_to(i)
                if self.stack[i].tag in BLOCK:
                    break
        if tag in CLOSED_BY_SAME:
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            if any(self.open[t] for t in same):
                for i in range(len(self.stack) - 1, -1, -1):
                    if self.stack[i].tag in same:
                        return self._pop_to(i)
                    if self.stack[i].tag in CLOSED_BY_SAME[tag]:
                        break

    def _state(self, tag: str, attrs: dict[str, str | None]) -> str:
        if tag in SILENT:
            return "silent"
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style") or ""):
            return "noise"
        if tag in ("html", "body", "main"):
            return ""
        if tag in NOISE or (attrs.get("role") or "").lower() in NOISE_ROLES:
            return "noise"
        if self.now.article:
            if named := self._named_within(tag, attrs):
                return named
        elif self._named_noise(tag, attrs):
            return "noise"
        words = _words(attrs.get("class")) | _words(attrs.get("id"))
        if tag == "header":
            return "header"
        return "header" if "header" in words and not words & (CONTENT_WORDS - {"main", "body"}) and tag not in HEADINGS and tag != "article" else ""

    @staticmethod
    def _named_within(tag: str, attrs: dict[str, str | None]) -> str:
        """What the names of an element say of it where the page says that this is its text: nothing, that it is "noise" or
        that it is "suspect". A name counts only if all its words do."""
        told = ""
        for attribute in ("class", "id"):
            for name in (attrs.get(attribute) or "").split():
                words = _words(name)
                if words & LAYOUT_WORDS or not words <= NOISE_WORDS | NEUTRAL_WORDS:
                    continue
                if tag in QUOTES:
                    telling = ADVERT_WORDS
                elif tag == "section" and attribute == "id":
                    telling = ID_WORDS
                else:
                    telling = TELLING_WORDS
                if words & telling:
                    return "noise"
                if words & NOISE_WORDS - OWN_WORDS - {"header"} and tag not in QUOTES:
                    told = "suspect"
        return told

    @staticmethod
    def _named_noise(tag: str, attrs: dict[str, str | None]) -> bool:
        words = _words(attrs.get("class")) | _words(attrs.get("id"))
        if not words or words & LAYOUT_WORDS:
            return False
        told = bool(words & CONTENT_WORDS)
        return bool(words & HARD_WORDS and not (tag == "article" and told)) or bool(words & NOISE_WORDS - {"header"} and not told and tag != "article")

    def handle_starttag(self, tag, attrs):
        state = self._state(tag, dict(attrs)) if tag not in VOID else ""
        if tag in BLOCK:
            self.flush()
            self._close_implied(tag)
            if tag in ("article", "main") and not state and self.left:  # a menu or header left open ends where the main part begins
                self._pop_to(self.left[0])
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag not in VOID:
            self._push(tag, state)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # "/>" means nothing in HTML

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                return self._pop_to(i)
            if tag not in BLOCK and self.stack[i].tag in BLOCK:
                return  # an inline end tag does not reach out of its block

    def handle_data(self, data):
        now = self.now
        if not now.silent:
            self.parts.append(data)
            if now.link:
                self.links += len(data.strip())

    def unknown_decl(self, data):
        pass

    def close(self):
        super().close()
        self.flush()
        self._pop_to(0)
        self.ends[0] = len(self.parents) - 1


_PAGE = _Open("")
_LEFT_OPEN = ("nav", "header", "footer", "menu")


def _words(value: str | None) -> frozenset[str]:
    return frozenset(w.lower() for w in _WORD.findall(value or ""))


def _events(html: str) -> _Lines:
    parser = _Lines()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # a malformed declaration
        parser = _Lines()
        parser.feed(re.sub(r"<!\[(?!CDATA\[)[^>]*>?", " ", html))
        parser.close()
    return parser


def smooth(ratios: np.ndarray, radius: int = 2, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel's present part is normalised."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    same = lambda a: np.convolve(a, kernel)[radius : radius + len(a)]
    return same(ratios) / same(np.ones(len(ratios)))


def tag_ratios(lines: list[_Line]) -> np.ndarray:
    """The smoothed text-to-tag ratio of each line."""
    return smooth(np.array([_ratio(x) for x in lines], dtype=float))


def _ratio(line: _Line) -> float:
    return max(0, len(line.text) - line.links) / max(1, line.tags)


def main_text(html: str | None, ratios_of=tag_ratios) -> str:
    """The main text of a page: blocks in page order, one a line, white space inside a block as one space. Null, empty
    and text-free pages give an empty text. Nothing is capped. ``ratios_of`` gives the lines' smoothed ratios."""
    page = _events(html or "")
    lines = page.lines
    own = [i for i, x in enumerate(lines) if not x.noise]
    if not own:
        return ""
    ratios = ratios_of(lines)
    threshold = min(ratios.std(), ratios[own].max())
    for kind in ("article", "main"):
        marked = [i for i in own if lines[i].marked == kind]
        if marked:
            return "\n".join(lines[i].text for i in _clear(lines, marked, ratios, threshold))
    content = [i for i in own if ratios[i] >= threshold] or own
    region = _region(page, content)
    within = [i for i in own if region <= lines[i].holder <= page.ends[region]]
    inside = [i for i in content if region <= lines[i].holder <= page.ends[region]]
    first, last, beside = inside[0], inside[-1], {(lines[i].holder, lines[i].tag) for i in inside}
    taken = [i for i in within if (first <= i <= last or (lines[i].holder, lines[i].tag) in beside) and not (_linked(lines[i]) and ratios[i] < threshold)]
    while len(taken) > 1 and _COPYRIGHT.search(lines[taken[-1]].text):
        taken.pop()
    if len(taken) > 1 and _menu(lines[taken[0]]) and not _menu(lines[taken[1]]):
        del taken[0]
    if len(taken) > 1 and _menu(lines[taken[-1]]) and not _menu(lines[taken[-2]]):
        taken.pop()
    at = taken[0] if taken else 0
    title = [i for i in own if at - 3 <= i < at and lines[i].heading]
    return "\n".join(lines[i].text for i in [*title, *taken])


def _clear(lines: list[_Line], marked: list[int], ratios: np.ndarray, threshold: float) -> list[int]:
    """The marked lines without those of weakly named parts that the ratios don't take for text; a heading there goes with
    the line after it."""
    kept, follows = [], False
    for i in reversed(marked):
        x = lines[i]
        taken = not x.suspect or min(ratios[i], _ratio(x)) >= threshold or (x.heading and follows)
        follows = taken and x.suspect
        if taken:
            kept.append(i)
    return kept[::-1]


def _linked(line: _Line) -> bool:
    return 2 * line.links > len(line.text)


def _menu(line: _Line) -> bool:
    """Entries of three words at most between marks; one such line alone is no part of the text that it stands before or after."""
    entries = _MENU_MARKS.split(line.text)
    return len(entries) > 2 and all(len(e.split()) <= 3 for e in entries)


def _region(page: _Lines, content: list[int]) -> int:
    """The innermost element with at least 0.7 of the content lines' text. 0 if only the page as a whole has as much."""
    mass = np.zeros(len(page.parents))
    for i in content:
        mass[page.lines[i].holder] += len(page.lines[i].text)
    total = mass.sum()
    for element in range(len(mass) - 1, 0, -1):  # the inner ones have the larger numbers
        mass[page.parents[element]] += mass[element]
    return next((e for e in range(len(mass) - 1, 0, -1) if mass[e] >= 0.7 * total and page.names[e] not in ("html", "body")), 0)


def extract_pages(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``page_id, url`` (or ``keep``), ``text`` and ``n_chars`` for each row, in code points. Null html gives an empty
    text; repeated rows and null ids come back as they are; other columns are ignored; an empty table gives an empty
    result."""

    def make():
        def run(pages):
            texts = [main_text(h) for h in pages]
            return texts, [len(t) for t in texts]

        return run

    return map_text(pages, "html", keep or ["page_id", "url"], "text string, n_chars long", make)
