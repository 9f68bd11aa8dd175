"""The main text of web pages, by the distribution of text over their lines.

A page is stripped of its markup into lines, one for each block of text. Lines that can't be article text weigh
nothing: what stands outside ``article`` or ``main`` where a page has one, else links. The weights of ``WINDOW`` lines in a row
are added up; the sum surges where the text begins and dives to nothing where it ends, and what lies between is kept.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loadgrain.llm.common import small_batches, steps

# lines whose weights are added up, and the characters in them that make a surge if the page has so many
WINDOW = 3
SURGE = 86

# fixed values: names of HTML elements and of attributes
RAW = "script|style|title|textarea|noscript|iframe|noembed|noframes|template"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot "
    "thead tr ul".split()
)
# containers, whose edges leave an empty line
GROUP = set("body div section table tbody td article main center dl ol ul".split())
SPACED = {"br", "td", "th", "option"}
MAIN = {"article", "main"}
NEVER = set("nav footer aside menu search dialog button select svg canvas object audio video map datalist".split())
UNLESS_MAIN = {"form", "fieldset", "header"}
ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
HINTS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar widget "
    "newsletter subscribe signup login share sharing social related recommended comment comments disqus respond reply replies "
    "pagination pager toolbar copyright".split()
)
OWN_HEADER = {"header", "masthead"}

ATTRIBUTE_END = r"""(?:=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+(?:>|\Z)"""
# every alternative runs to the end of the page if nothing closes it, so that a page is read once
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b{ATTRIBUTE_END}.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<more>{ATTRIBUTE_END})|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
NAMED = re.compile(r"""\b(class|id|role|itemprop|style|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/>]|$)""", re.IGNORECASE)
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """Lines of a page (text, characters of it in links, number of the outermost main part or 0) and what to leave out."""

    def __init__(self, html: str):
        self.lines: list[str] = []
        self.linked: list[int] = []
        self.part: list[int] = []
        # first line, line behind the last, whether it goes even if it holds a main part, whether it holds one
        self.left_out: list[list] = []
        self.parts = 0
        self._text: list[str] = []
        self._links = 0
        self._stack: list[tuple[str, list | None, bool]] = []
        self._open: Counter[str] = Counter()
        self._within: list[list] = []
        self._main = 0
        self._read(html)

    def _read(self, html: str) -> None:
        at = 0
        for token in TOKEN.finditer(html):
            self._words(html[at : token.start()])
            at = token.end()
            name = token["name"]
            if name is None:
                continue
            name = name.lower()
            if token["close"]:
                self._closed(name)
            else:
                self._opened(name, token["more"])
        self._words(html[at:])
        self._end_line()
        while self._stack:
            self._pop(closed=False)

    def _words(self, text: str) -> None:
        if text:
            text = unescape(text) if "&" in text else text
            self._text.append(text)
            if self._open["a"]:
                self._links += len(text)

    def _end_line(self, gaps: int = 0) -> None:
        line = " ".join("".join(self._text).split()) if self._text else ""
        if line:
            self._add(line, min(self._links, len(line)))
        self._text, self._links = [], 0
        for _ in range(gaps):
            self._add("", 0)

    def _add(self, line: str, links: int) -> None:
        self.lines.append(line)
        self.linked.append(links)
        self.part.append(self.parts if self._main else 0)

    def _opened(self, name: str, more: str) -> None:
        if name in SPACED:
            self._text.append(" ")
        if name in BLOCK:
            self._end_line(1 if name in GROUP else 0)
        if name in VOID or more.endswith("/>") and name not in BLOCK:
            return
        marks = {k.lower(): a or b or c for k, a, b, c in NAMED.findall(more)} if "=" in more else {}
        role = marks.get("role", "").lower()
        words = {w.lower() for w in WORD.findall(f"{marks.get('class', '')} {marks.get('id', '')}")}
        hidden = marks.get("aria-hidden") == "true" or NOT_SHOWN.search(marks.get("style", "")) or HIDDEN.search(more)
        main = name in MAIN or role == "main" or marks.get("itemprop", "").lower() == "articlebody"
        # an article inside an article is a reader's comment
        go = name in NEVER or bool(hidden) or (name == "article" and self._open["article"] > 0)
        maybe = name in UNLESS_MAIN or role in ROLES or bool(words & HINTS)
        if self._main and (name == "header" or words & HINTS and words & HINTS <= OWN_HEADER):
            maybe = False  # a part's own title
        if name in ("html", "body") or (main and not (go or words & {"comment", "comments", "reply", "replies"})):
            go = maybe = False
        entry = None
        if go or maybe:
            self._end_line(0 if self._main else WINDOW)
            entry = [len(self.lines), None, go, None]
            self.left_out.append(entry)
            self._within.append(entry)
        elif main:
            for outer in reversed(self._within):
                if outer[3] is not None:
                    break  # so have all around it
                outer[3] = len(self.lines)
            if not self._within:
                self._end_line(0 if self._main else WINDOW)
                if not self._main:
                    self.parts += 1
                self._main += 1
        counts = main and entry is None and not self._within
        self._stack.append((name, entry, counts))
        self._open[name] += 1

    def _closed(self, name: str) -> None:
        if name in SPACED:
            self._text.append(" ")
        if name in BLOCK:
            self._end_line(1 if name in GROUP else 0)
        if not self._open[name]:
            return
        while self._stack[-1][0] != name:
            self._pop(closed=False)
        self._pop(closed=True)

    def _pop(self, closed: bool) -> None:
        name, entry, counts = self._stack.pop()
        self._open[name] -= 1
        if entry is not None:
            self._end_line(0 if self._main else WINDOW)
            entry[1] = len(self.lines)
            if not closed and entry[3] is not None:
                entry[1], entry[3] = entry[3], None  # never closed: it ends where a main part begins
            self._within.pop()
        if counts:
            self._end_line()
            self._main -= 1
            if not self._main:
                self._end_line(WINDOW)

    def kept(self, hints: bool) -> np.ndarray:
        """Which lines are left; without ``hints`` only what is never article text goes."""
        change = np.zeros(len(self.lines) + 1, np.int64)
        for begin, end, go, main in self.left_out:
            if go or (hints and main is None):
                change[begin] += 1
                change[end] -= 1
        return np.cumsum(change)[:-1] == 0

    def weights(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """Each line's weight, whether it may be kept, and whether the page has a main part."""
        size = np.fromiter(map(len, self.lines), np.int64, len(self.lines))
        part = np.array(self.part, np.int64)
        shown = self.kept(hints=True)
        if not (size * shown).any():
            shown = self.kept(hints=False)
        size = size * shown
        if (size * (part > 0)).any():
            return size * (part > 0), shown, True
        own = size - np.array(self.linked, np.int64) * shown
        return (own if own.any() else size), shown, False


def between_surge_and_dive(weight: np.ndarray, starts: np.ndarray, surge: np.ndarray) -> np.ndarray:
    """Marks of the lines of many pages that lie between a surge and a dive.

    A page is ``weight[starts[i]:starts[i + 1]]``, and ``WINDOW`` empty lines end each page. The distribution is the sum over ``WINDOW``
    lines; where it leaves nothing a stretch begins, where it is nothing again the stretch ends, and a stretch whose sum
    reaches the page's ``surge`` somewhere is kept from its first to its last line of any weight.
    """
    total = np.concatenate([[0], np.cumsum(weight)])
    window = total[np.minimum(np.arange(len(weight)) + WINDOW, len(weight))] - total[:-1]
    page = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    rises = window > 0
    begins = rises & ~np.concatenate([[False], rises[:-1]])
    if not begins.any():
        return np.zeros(len(weight), bool)
    stretch = np.cumsum(begins) - 1
    at = np.flatnonzero(rises)
    peak = np.zeros(int(begins.sum()), np.int64)
    np.maximum.at(peak, stretch[at], window[at])
    heavy = np.flatnonzero(weight > 0)
    first = np.full(len(peak), len(weight))
    last = np.full(len(peak), -1)
    np.minimum.at(first, stretch[heavy], heavy)
    np.maximum.at(last, stretch[heavy], heavy)
    good = peak >= surge[page[first]]
    line = np.arange(len(weight))
    return rises & good[stretch] & (line >= first[stretch]) & (line <= last[stretch])


def main_texts(pages: list[str | None]) -> list[str]:
    lines, weights, shown, size, surge = [], [], [], [], []
    for html in pages:
        page = Page(html or "")
        weight, may, main = page.weights()
        lines += page.lines + [""] * WINDOW
        weights += [weight, np.zeros(WINDOW, np.int64)]
        shown += [may, np.zeros(WINDOW, bool)]
        size.append(len(weight) + WINDOW)
        total = np.concatenate([[0], np.cumsum(weight)])
        highest = int((total[np.minimum(np.arange(len(weight)) + WINDOW, len(weight))] - total[:-1]).max(initial=0))
        surge.append(1 if main else max(min(SURGE, highest), 1))
    starts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    keep = between_surge_and_dive(np.concatenate(weights), starts, np.array(surge)) & np.concatenate(shown)
    out = []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        out.append("\n\n".join([lines[i] for i in (np.flatnonzero(keep[a:b]) + a).tolist() if lines[i]]))
    return out


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text, in place of any column of that name.

    Blocks of text are joined by an empty line; white space within one becomes a blank, character references are decoded.
    Menus, headers, footers, sidebars, notices, adverts, forms, scripts and readers' comments are told by element, role and
    the words of class and id; where such an element is never closed it ends at the next ``article`` or ``main``. If nothing
    would be left, only the elements count. A null, empty or text-less page has an empty text. Rows are kept as they are.
    """
    schema = pages.drop("text").schema.add("text", "string")

    def make(batches):
        for batch in steps(batches, html):
            names = [n for n in batch.schema.names if n != "text"]
            texts = main_texts(batch.column(batch.schema.get_field_index(html)).to_pylist())
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*names, "text"])

    return small_batches(pages).mapInArrow(make, schema)

