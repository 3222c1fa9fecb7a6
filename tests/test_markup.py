"""Page tokens: the linear scanner against a plain regex, and in linear time."""

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketflow.functions.markup import Markup, _Scan

STRICT = Markup(("script", "style"))
OPEN = Markup(("script", "style", "title"), bogus="!?/", open_ends=True)
_TAG = r"<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
PLAIN_STRICT = re.compile(r"<!--.*?-->|<[!?][^>]*>|<(?P<raw>script|style)\b[^>]*>.*?</(?P=raw)\s*>|" + _TAG, re.S | re.I)
PLAIN_OPEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|title)\b[^>]*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)|" + _TAG + r"|<[!?/][^>]*>", re.S | re.I)


def plain(pattern, page):
    out = []
    for m in pattern.finditer(page):
        if m["name"]:
            out.append((m.start(), m.end(), m["name"].lower(), bool(m["close"]), m["attr"]))
        else:
            out.append((m.start(), m.end(), m["raw"] and m["raw"].lower(), None, None))
    return out


PIECES = st.lists(st.sampled_from(["<", ">", "\"", "'", "</", "a", "script", "style", "title", "<p ", "<!--", "-->", "--", "!", "?", "/", " ", "\n",
                                   "</script>", "</STYLE >", "<b x='1'>", "<td id=\"q>\">", "x=", "<script", "é"]), max_size=40).map("".join)


@settings(max_examples=1500, deadline=None)
@given(PIECES)
def test_as_a_plain_regex(page):
    for kind, pattern in ((STRICT, PLAIN_STRICT), (OPEN, PLAIN_OPEN)):
        want = plain(pattern, page)
        assert list(kind.tokens(page)) == want
        assert list(_Scan(kind, page, 0).tokens()) == want


@pytest.mark.parametrize("piece", ["<p \"", "<p '\"", "<a", "<!--", "<!", "<script", "<script>", "<style></", "<a '\" ", "</", "<p a=\"<p b='", "<", "<!-->",
                                   "<script></script  ", "<?x'"])
@pytest.mark.parametrize("kind", [STRICT, OPEN])
def test_linear(piece, kind):
    page = piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    for _ in kind.tokens(page):
        pass
    for _ in kind.tokens("<x>" + page + ">"):
        pass
    assert time.perf_counter() - start < 6
