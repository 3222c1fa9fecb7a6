"""Markup tokens of a page in time proportional to its length.

A regex takes well-formed pages at full speed.  From the first ``<`` on that
begins nothing (or an element that is never closed), a scanner goes on that
remembers what it looked for in vain: "no such end beyond here", and the
quotes from which no tag end can be reached.  Nothing is looked for twice, so
a page of a million open quotes is read once.

This is a small helper of the page jobs, not a parser: it tells tags,
comments and raw elements from text, and leaves structure to its callers.
"""

from __future__ import annotations

import re
import string
import sys
from collections.abc import Iterator

# Used in Python workers, which may not have this package installed: ship this
# module's code with the task instead of by reference.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile(r"[>\"']")

#: (start, end, name, closing, attributes): a tag; closing is None for a raw
#: element taken whole, name is None for comments and declarations.
Token = tuple[int, int, "str | None", "bool | None", "str | None"]


class Markup:
    """How pages are read.  ``raw`` elements are taken whole with their
    content; ``bogus`` are the characters behind ``<`` that begin something to
    leave out up to the next ``>``; with ``open_ends`` a comment or raw element
    that is never closed reaches to the end of the page, else its start is
    read like any other."""

    def __init__(self, raw: tuple[str, ...], bogus: str = "!?", open_ends: bool = False):
        names = "|".join(raw)
        self.raw, self.bogus, self.open_ends = frozenset(raw), bogus, open_ends
        self.begin = re.compile(rf"<({names})\b", re.I)
        # first letters of names that are no raw element's
        self.plain = frozenset(string.ascii_letters) - {c for n in raw for c in (n[0].lower(), n[0].upper())}
        self.close = {n: re.compile(rf"</{n}\s*+>", re.I) for n in raw}
        self.fast = re.compile(
            r"<!--.*?-->|<(?!!--)[!?][^>]*+>"
            rf"|<(?P<raw>{names})\b[^>]*+>.*?</(?P=raw)\s*+>"
            r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attr>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
            r"|(?P<bare><)", re.S | re.I)

    def tokens(self, page: str) -> Iterator[Token]:
        """Tokens in order; what lies between them is text."""
        for m in self.fast.finditer(page):
            close, name, attr = m.group("close", "name", "attr")
            if name is not None:
                if not close and name[0] not in self.plain and self.begin.match(page, m.start()):
                    # a raw element without an end
                    yield from _Scan(self, page, m.start()).tokens()
                    return
                yield m.start(), m.end(), name.lower(), close != "", attr
            elif m["bare"]:
                yield from _Scan(self, page, m.start()).tokens()
                return
            else:
                raw = m["raw"]
                yield m.start(), m.end(), raw and raw.lower(), None, None


class _Scan:
    """The rest of a page, from ``at`` on."""

    def __init__(self, kind: Markup, page: str, at: int):
        self.kind, self.page, self.at = kind, page, at
        self.none: dict[str, int] = {}       # what is not found from a position on
        self.dead: set[int] = set()          # quotes from which no tag ends
        self.stop_from, self.stop = 0, -1    # the last search for a stop

    def tokens(self) -> Iterator[Token]:
        page, at = self.page, self.at
        while (start := page.find("<", at)) >= 0:
            got = self.token(start)
            if got is None:
                at = start + 1
                continue
            yield start, *got
            at = got[0]

    def find(self, what: str, at: int) -> int:
        if at >= self.none.get(what, len(self.page) + 1):
            return -1
        i = self.page.find(what, at)
        if i < 0:
            self.none[what] = at
        return i

    def raw_end(self, name: str, at: int) -> int:
        key = "</" + name
        if at >= self.none.get(key, len(self.page) + 1):
            return -1
        m = self.kind.close[name].search(self.page, at)
        if m is None:
            self.none[key] = at
            return -1
        return m.end()

    def tag_end(self, at: int) -> int:
        """The ``>`` that ends a tag whose attributes begin at ``at``."""
        page, path = self.page, []
        if not self.stop_from <= at <= self.stop:
            m = _STOP.search(page, at)
            self.stop_from, self.stop = at, m.start() if m else len(page)
        i = self.stop
        while i < len(page) and i not in self.dead:
            if page[i] == ">":
                return i
            path.append(i)
            j = self.find(page[i], i + 1)
            if j < 0:
                break
            m = _STOP.search(page, j + 1)
            i = m.start() if m else len(page)
        self.dead.update(path)
        return -1

    def token(self, start: int):
        page, kind = self.page, self.kind
        if page.startswith("<!--", start):
            i = self.find("-->", start + 4)
            if i >= 0 or kind.open_ends:
                return i + 3 if i >= 0 else len(page), None, None, None
        begun = kind.begin.match(page, start)
        if begun:
            name, i = begun[1].lower(), self.find(">", begun.end())
            end = self.raw_end(name, i + 1) if i >= 0 else -1
            if end >= 0 or kind.open_ends:
                return end if end >= 0 else len(page), name, None, None
        m = _NAME.match(page, start)
        if m:
            i = self.tag_end(m.end())
            if i >= 0:
                return i + 1, m[1].lower(), page[start + 1] == "/", page[m.end():i]
        if page[start + 1:start + 2] and page[start + 1] in kind.bogus:
            i = self.find(">", start + 2)
            if i >= 0:
                return i + 1, None, None, None
        return None
