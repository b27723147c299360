"""Cards of web pages by selectors: a tolerant reader with a stack of open elements, in Arrow batches."""

from __future__ import annotations

import functools
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F

# Fixed values of HTML: elements without content, what a start tag closes, and where that search ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES |= dict.fromkeys("p div ul ol table section article nav h1 h2 h3 h4 h5 h6 header footer form blockquote pre".split(), {"p"})
WALLS = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
INNER = frozenset("table ul ol article section td th".split())

_PART = re.compile(r"\s*(?P<child>>)?\s*(?P<tag>[A-Za-z][\w-]*|\*)?(?P<rest>(?:[.#][\w-]+|\[[^\]]+\])*)")
_REST = re.compile(r"(?P<mark>[.#])(?P<name>[\w-]+)|\[\s*(?P<attr>[\w-]+)\s*(?:(?P<how>[~^$*]?=)\s*(?P<quote>[\"']?)(?P<value>.*?)(?P=quote)\s*)?\]")
_WANT = re.compile(r"^(?P<path>.*?)::(?P<what>text|attr\((?P<attr>[\w-]+)\))$")
HOW = {"=": str.__eq__, "^=": str.startswith, "$=": str.endswith, "*=": str.__contains__, "~=": lambda has, x: x in has.split()}


def selector(text: str) -> list[tuple[bool, str | None, list]]:
    """Steps of a selector, outermost first: child of the one before (else any descendant), tag, tests of attributes.

    Tags, ``.class``, ``#id``, ``[attr]`` with =, ^=, $=, *= and ~=, blanks and ``>``.
    """
    out, at, text = [], 0, text.strip()
    while at < len(text):
        m = _PART.match(text, at)
        tests = [("class" if r["mark"] == "." else "id", "~=" if r["mark"] == "." else "=", r["name"]) if r["mark"] else (r["attr"].lower(), r["how"], r["value"]) for r in _REST.finditer(m["rest"])]
        if m.end() == at or not (m["tag"] or m["rest"]):
            raise ValueError(f"not a selector: {text!r}")
        out.append((bool(m["child"]), m["tag"].lower() if m["tag"] and m["tag"] != "*" else None, tests))
        at = m.end()
    if not out:
        raise ValueError("an empty selector")
    return out


def fits(step: tuple, element: tuple[str, dict]) -> bool:
    _, tag, tests = step
    name, attrs = element
    if tag and tag != name:
        return False
    return all(a in attrs and (how is None or HOW[how](attrs[a] or "", value)) for a, how, value in tests)


def matches(steps: list, stack: list, low: int, high: int) -> bool:
    """Whether ``stack[high]`` is what ``steps`` select among ``stack[low:]`` (tag and attributes, outermost first)."""
    if high < low or not fits(steps[-1], stack[high]):
        return False
    if len(steps) == 1:
        return True
    if steps[-1][0]:
        return matches(steps[:-1], stack, low, high - 1)
    return any(matches(steps[:-1], stack, low, k) for k in range(high - 1, low - 1, -1))


class Cards(HTMLParser):
    """Reads a page; ``found`` has a list of values for each card, in the order in which cards begin.

    A field's value is that of its first match within the card, cards within it included. Text is the
    first text directly in a matching element that isn't blank.
    """

    def __init__(self, card: list, fields: list[tuple[list, str | None]]):
        super().__init__(convert_charrefs=True)
        self.card, self.fields = card, fields
        self.stack: list[tuple[str, dict]] = []
        self.open: list[tuple[int, list]] = []  # depth and values of the cards that are open
        self.waits: list[list[tuple[list, int]]] = []  # of each open element, the values that its text fills
        self.found: list[list] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if closes := CLOSES.get(tag):
            walls = WALLS.get(tag, INNER)
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in closes:
                    self.leave(k)
                    break
                if self.stack[k][0] in walls:
                    break
        self.stack.append((tag, dict(reversed(attrs))))  # of a repeated attribute the first counts
        waits: list = []
        self.waits.append(waits)
        top = len(self.stack) - 1
        if matches(self.card, self.stack, 0, top):
            self.open.append((top, [None] * len(self.fields)))
            self.found.append(self.open[-1][1])
        for i, (steps, attr) in enumerate(self.fields):
            if not self.open or not fits(steps[-1], self.stack[top]):
                continue
            for depth, values in self.open:
                if values[i] is None and matches(steps, self.stack, depth, top):
                    if attr is None:
                        waits.append((values, i))
                    elif attr in self.stack[-1][1]:
                        values[i] = self.stack[-1][1][attr] or ""
        if tag in VOID:
            self.leave(len(self.stack) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self.leave(k)
                return

    def leave(self, depth: int) -> None:
        """Closes all elements from ``depth`` on."""
        del self.stack[depth:], self.waits[depth:]
        while self.open and self.open[-1][0] >= depth:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.waits and (text := data.strip()):
            for values, i in self.waits[-1]:
                if values[i] is None:
                    values[i] = text


@functools.lru_cache(maxsize=64)
def wanted(card: str, fields: tuple[str, ...]) -> tuple[list, list]:
    out = []
    for f in fields:
        m = _WANT.match(f)
        if not m:
            raise ValueError(f"{f!r} doesn't end in ::text or ::attr(name)")
        out.append((selector(m["path"]), m["attr"]))
    return selector(card), out


def read(page: str, card: str, fields: tuple[str, ...]) -> list[list[str | None]]:
    parser = Cards(*wanted(card, fields))
    parser.feed(page)
    parser.close()
    return parser.found


def cards(html: Column, card: str, fields: tuple[str, ...]) -> Column:
    """For each card of a page the values of ``fields``, selectors that end in ::text or ::attr(name); null where nothing matches. A null page has no cards."""
    wanted(card, fields)  # errors at once

    @F.pandas_udf("array<array<string>>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: read(p, card, fields))

    return run(F.coalesce(html, F.lit("")))
