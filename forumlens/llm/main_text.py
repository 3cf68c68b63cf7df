"""The main text of web pages by line-block distribution.

Markup is stripped so that each block of the page is one line; what stands in
menus, adverts, forms and the like leaves an empty line.  The lengths of the
lines are summed over sliding windows.  Text begins where the sums surge and
ends where they dive to nothing; the lines between are kept.  Article and main
elements, where a page has them, bound the lines that take part.
"""

from __future__ import annotations

import html as markup
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forumlens.llm import common as C

#: Lines in a window.
WINDOW = 3
#: A surge reaches this share of the highest sum.
SURGE = 0.2
#: A line with this share of its letters in links is a menu's, outside a marked article.
LINKED = 0.8

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp "
    "small strike strong sub sup time tt u var wbr img span".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never part of an article.
OUTSIDE = frozenset(
    "head nav footer aside form dialog menu button select datalist template svg math canvas object audio video "
    "map applet".split())
#: What an opening tag ends, up to the nearest of the second set.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select", "datalist"})}
#: Words of class, id and role that name what isn't the article.
OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion sidebar "
    "comment comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices alert alerts "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer masthead banner share sharing social related "
    "recommended recommendations newsletter subscribe subscription signup login popup modal overlay dialog pagination "
    "pager widget widgets toolbar search copyright disclaimer contentinfo complementary".split())
COMMENT_NAMES = frozenset("comment comments reply replies disqus".split())
#: ``has-sidebar`` and the like tell of a part elsewhere.
ABOUT = frozenset("has with without no not is show hide open".split())

_OPENS = re.compile(r"<(?:!--|(/?)([A-Za-z][^\s/>]*)|[!?/])")
_PLAIN_END = re.compile(r"[^<>\"']*>")
_STOP = re.compile(r">|=\s*([\"'])")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in RAW}
_NAMED = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?",
                    re.I)


class _Scan:
    """One walk over a page's markup; ``lines`` gets (text, letters, letters in links,
    number of the article or 0, in main)."""

    def __init__(self, text: str):
        self.text, self.no_more = text, set()
        self.open: list[tuple[str, bool, bool, int, bool]] = [("", False, False, 0, False)]
        self.articles = 0
        self.count: dict[str, int] = {}
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.parts: list[str] = []
        self.linked, self.in_link, self.skipped = 0, False, False

    def tag_end(self, at: int) -> int:
        """Behind the ``>`` that ends a tag; one within a quoted value doesn't."""
        if m := _PLAIN_END.match(self.text, at):
            return m.end()
        while m := _STOP.search(self.text, at):
            if not m[1]:
                return m.end()
            close = -1 if m[1] in self.no_more else self.text.find(m[1], m.end())
            if close < 0:  # never closed: an ordinary sign, and so are all later ones
                self.no_more.add(m[1])
                at = m.end()
            else:
                at = close + 1
        return len(self.text)

    def end_line(self) -> None:
        _, _, _, article, main = self.open[-1]
        line = " ".join("".join(self.parts).split())
        if line:
            self.lines.append((line, len(line), min(self.linked, len(line)), article, main))
        elif self.skipped:
            self.lines.append(("", 0, 0, article, main))
        self.parts, self.linked, self.skipped, self.in_link = [], 0, False, False

    def add(self, piece: str) -> None:
        _, drop, header, _, _ = self.open[-1]
        if drop or header:
            self.skipped = self.skipped or not piece.isspace()
            return
        piece = markup.unescape(piece)
        self.parts.append(piece)
        if self.in_link and self.open[-1][0] != "h1":
            self.linked += len(" ".join(piece.split()))

    def pop_to(self, k: int) -> None:
        while len(self.open) > k:
            self.count[self.open.pop()[0]] -= 1

    def end_before(self, name: str) -> None:
        """Ends the elements that ``name`` ends by opening: a paragraph, an item of its list."""
        what, bound = ENDS.get(name, ({"p"}, {"td", "th", "button", "object", "table"}))
        if any(self.count.get(w) for w in what):
            k = len(self.open) - 1
            while k and self.open[k][0] not in what | bound:
                k -= 1
            if self.open[k][0] in what:
                self.pop_to(k)

    def opened(self, name: str, inside: str) -> None:
        if name not in INLINE:
            self.end_line()
            self.end_before(name)
        _, drop, header, article, main = self.open[-1]
        if name in VOID:
            return
        if name == "a":
            self.in_link = True
        if name in INLINE and name != "span":
            return
        words = self.names(name, inside)
        if name == "main" or "main" in words and name in ("div", "section"):
            drop, header, main = drop and name != "main", False, True
        if name == "article":
            drop = drop or bool(words & COMMENT_NAMES)
            if not drop and not article:
                self.articles += 1
                article = self.articles
        elif name in HEADINGS:
            header = False if article or main else header
        elif name == "header" or "header" in words and name not in ("body", "html", "main"):
            header = True
        drop = drop or name in OUTSIDE or "!" in words
        if name not in ("html", "body", "main", "article") and name not in HEADINGS:
            drop = drop or bool(words & OUTSIDE_NAMES)
        if drop and not self.open[-1][1] and name == "span":
            self.end_line()
        self.open.append((name, drop, header, article, main))
        self.count[name] = self.count.get(name, 0) + 1

    def names(self, name: str, inside: str) -> set[str]:
        """Words of class, id and role; ``!`` if the element isn't shown."""
        found: set[str] = set()
        if not inside or inside.isspace():
            return found
        for m in _NAMED.finditer(inside):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key == "hidden" and value != "until-found" or key == "aria-hidden" and value == "true" \
                    or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                found.add("!")
            elif key in ("class", "id", "role"):
                for token in value.split():
                    words = re.split(r"[-_]+", token)
                    if not ABOUT.intersection(words):
                        found.update(words)
        return found

    def closed(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name not in INLINE:
            self.end_line()
        if self.count.get(name):
            k = len(self.open) - 1
            while self.open[k][0] != name:
                k -= 1
            if name == "span" and self.open[k][1]:
                self.end_line()
            self.pop_to(k)

    def run(self) -> list[tuple[str, int, int, int, bool]]:
        at, text = 0, self.text
        while m := _OPENS.search(text, at):
            if m.start() > at:
                self.add(text[at:m.start()])
            if m[2] is None:
                if m[0] == "<!--":
                    end = _COMMENT_END.search(text, m.start() + 2)
                    at = end.end() if end else len(text)
                else:
                    at = text.find(">", m.end()) + 1 or len(text)
                continue
            at, name = self.tag_end(m.end()), m[2].lower()
            if m[1]:
                self.closed(name)
            elif name in RAW:
                end = _RAW_END[name].search(text, at)
                at = end.start() if end else len(text)
                if name == "textarea":
                    self.skipped = True
            else:
                self.opened(name, text[m.end():at - 1])
        if at < len(text):
            self.add(text[at:])
        self.end_line()
        return self.lines


def between_surge_and_dive(sizes: np.ndarray, surge: float) -> np.ndarray:
    """Which lines lie between a surge (a window's sum reaches ``surge``, at
    least 1) and the dive after it (a window's sum is zero)."""
    n = len(sizes)
    total = np.zeros(n + WINDOW + 1, np.int64)
    np.cumsum(sizes, out=total[1:n + 1])
    total[n + 1:] = total[n]
    sums = total[WINDOW:n + WINDOW] - total[:n]  # of the window that begins at a line
    run = np.cumsum(np.concatenate([[1], (sums[1:] > 0) != (sums[:-1] > 0)])) if n else np.zeros(0, np.int64)
    peak = np.zeros(int(run[-1]) + 1 if n else 0, np.int64)
    np.maximum.at(peak, run, sums)
    return (sums > 0) & (peak[run] >= max(1, surge))


def _lengths(lines: list[tuple[str, int, int, int, bool]]) -> tuple[list[int], list[int]]:
    """The lengths that the windows slide over, and the line of each (-1: none).

    Only lines of article elements have a length where a page has any, else only
    those of its main elements, else all; but for articles, text in links counts
    as nothing.  Such an element begins and ends with a dive, and what in it is
    known to be something else leaves one empty line, however many blocks it has.
    """
    mark = next((m for m in (3, 4) if any(x[m] and x[0] for x in lines)), None)
    sizes: list[int] = []
    at: list[int] = []
    before, empty = 0, False
    for k, line in enumerate(lines):
        text, n, linked = line[:3]
        part = line[mark] if mark else 0
        if part != before:
            sizes += [0] * WINDOW
            at += [-1] * WINDOW
        elif part and not text and empty:
            continue
        if mark and not part:
            n = 0
        elif mark != 3:
            n = 0 if linked >= LINKED * max(n, 1) else n - linked
        sizes.append(n)
        at.append(k)
        before, empty = part, not text
    return sizes, at


def main_text(text: str | None) -> str:
    """The article of one page (see ``extract_main_text``)."""
    lines = _Scan(text or "").run()
    found, at = _lengths(lines)
    sizes = np.array(found, np.int64)
    sums = np.convolve(sizes, np.ones(WINDOW, np.int64)) if len(sizes) else sizes
    kept = between_surge_and_dive(sizes, SURGE * sums.max(initial=0))
    return " ".join(lines[at[k]][0] for k in np.flatnonzero(kept & (sizes > 0)))


def _extract(at: int):
    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, "made"])
    return run


def extract_main_text(pages: DataFrame, html_col: str = "html", result: str = "main_text") -> DataFrame:
    """``pages`` with a column ``result``: the main text of each page.

    That is what lies between surges and dives of the text lengths: among the
    lines of the page's article elements, without them among those of its main
    element, without either among those of the whole page.  An article far from
    the highest sum, such as a teaser, is left out; one that surges is kept
    whole.  Menus, headers, footers, sidebars, notices, adverts, forms, reader
    comments and hidden parts, known by element, class, id or role, leave empty
    lines; of a header within the article the headings stay.  Character
    references are decoded, white space within a block becomes one space, blocks
    are joined by one space.

    Null and empty pages, and pages without text, give ''.  Each page stands for
    itself, so repeated rows give equal results.  Broken markup (elements or
    quotes without end, cut tags) is read as browsers do, in time linear in the
    page.  If ``pages`` has a column ``result`` the new one gets underscores.
    """
    return C.add_in_arrow(pages, _extract(pages.columns.index(html_col)), C.free_name(pages, result), T.StringType())
