"""Main text of HTML pages by the maximum-scoring subsequence.

A page is a sequence of tokens: words score positive, tags negative, and one
linear scan finds the contiguous region of the greatest sum.  A tag's weight
depends on its kind (name, and whether it opens or closes); the weights are
learned from labelled pages, whose label is the extent of their one
``<article>`` or ``<main>`` element: pages are scanned, and the weights of
tokens that are wrongly in or out of the found region are moved until the
regions agree (a structured perceptron with a margin).  Labelled pages may be
plain, so each is also learned in variants: with tables, lists, code, quotes
and the like between the paragraphs of its label and at its end, and with bare
link lists beside it, so that content of any shape inside an article is cheap
to cross and its edge is not.

The region is then cleaned: scripts, styles, menus, headers, footers, asides,
forms, notices, adverts and reader comments that lie inside it are left out,
character references decoded, white space made one blank inside a block, and
blocks joined by a newline.

Defined cases: a null or empty page, or one without a word, gives an empty
text; of regions with equal sums the first and longest holds; a ``<`` that
begins no tag is text; elements that are never closed end with the page;
repeated rows are treated alike; without labelled pages, as in an empty table,
the weights are the starting ones.  Pages of any length are read whole, in
time proportional to it, however broken they are.  Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.markup import Markup
from .common import hash_limit

#: Bound of the labelled sample, about (pages that have a label, chosen by a
#: hash of id and page).
SAMPLE_PAGES = 600
#: Variants of each sampled page.
VARIANTS = 3
EPOCHS = 8
#: While learning, words outside the label count so many times, and words
#: inside it one part of so many.
LURE = 3.0
#: Starting weights of tags; no tag ever scores above LEAST_TAG.
TAG, INLINE_TAG, LEAST_TAG = -1.0, -0.1, -0.01
STEP = 0.5
SEED = 3
UNSEEN = "*"

_MARKUP = Markup(("script", "style", "noscript", "template", "svg", "textarea", "select", "title", "iframe", "object"), bogus="!?/", open_ends=True)
_WORD = re.compile(r"[^\W_]")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Elements whose text is never main text.
SKIP = frozenset("nav header footer aside form button dialog menu".split())
#: Class tokens, ids and roles that mark such an element.
SKIP_CLASS = frozenset("""ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent notice
    notices alert popup modal newsletter subscribe nav navbar navigation menu breadcrumb breadcrumbs sidebar header footer comment
    comments reply replies disqus discussion share sharing social related recommended pagination pager contentinfo complementary
    search login signup""".split())
#: Tags that do not end a block.
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr br input""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open p or li ends where one of its kind, or the element around it, does.
_IMPLIED = frozenset("p li dt dd tr td th option".split())


#: Elements that no class marks, nor any element around a main text.
_MAIN = frozenset("main article".split())
_PAGE = _MAIN | {"html", "body"}
#: The id of one of these names its subject.
_NAMED = frozenset("section h1 h2 h3 h4 h5 h6".split())


def _marked(name: str, attr: str) -> bool:
    for m in _ATTR.finditer(attr):
        key = m[1].lower()
        if key in ("class", "role") or key == "id" and name not in _NAMED:
            value = (m[2] or m[3] or m[4] or "").strip().lower()
            if not SKIP_CLASS.isdisjoint([value] if key == "id" else value.split()):
                return True
    return False


def _skipped(rows: list, ends: dict, opens) -> list[tuple]:
    """Tokens; the elements that begin at ``opens`` are left out."""
    out, until = [], -1
    for i, (key, text, name) in enumerate(rows):
        if until < i and i in opens:
            until = ends[i]
        gone = i <= until
        out.append(("skip" if gone and (i in ends or key[:1] == "/") else key, text, name, gone or name == "raw"))
    return out


def tokens(page: str, weights: dict | None = None) -> list[tuple]:
    """(kind, text, tag, skipped): words of a text run, or a tag.  kind is
    the tag's key for the weights, or "" for a text run.  A class, id or role
    leaves out no element around a main text, and none that holds most words
    of the region found without that rule (beside a main or article element,
    only those inside it are kept so)."""
    rows, at, named, marked, mains, open_, ends = [], 0, [], [], [], {}, {}
    for start, end, name, closing, attr in _MARKUP.tokens(page):
        if start > at:
            rows.append(("", page[at:start], None))
        at = end
        if closing is None:
            if name:
                rows.append((name, "", "raw"))
            continue
        i = len(rows)
        rows.append((("/" if closing else "") + name, "", name))
        if closing:
            if open_.get(name):
                ends[open_[name].pop()] = i
        elif name not in VOID and not attr.endswith("/"):
            open_.setdefault(name, []).append(i)
            if name in _MAIN:
                mains.append(i)
            # only elements that are closed explicitly are left out, so that
            # an open p cannot swallow the page
            if name in SKIP:
                named.append(i)
            elif name not in _IMPLIED and name not in _PAGE and attr and _marked(name, attr):
                marked.append(i)
    if at < len(page):
        rows.append(("", page[at:], None))
    for left in open_.values():
        ends.update(dict.fromkeys(left, len(rows)))
    around = [*mains, len(rows)]
    marked = [i for i in marked if around[bisect_left(around, i)] >= ends[i]]
    if marked:
        toks = _skipped(rows, ends, set(named))
        a, b = best_region(scores(toks, weights or {}))
        words = [0, *accumulate(0 if key or gone or not a <= i < b else _count(text) for i, (key, text, _, gone) in enumerate(toks))]
        reach = [-1, *accumulate((ends[i] for i in mains), max)]
        marked = [i for i in marked if 2 * (words[min(ends[i], len(rows))] - words[i]) <= words[-1]
                  or mains and reach[bisect_right(mains, i)] < i]
    return _skipped(rows, ends, {*named, *marked})


def _count(text: str) -> int:
    return sum(1 for w in text.split() if _WORD.search(w))


def start_weight(key: str) -> float:
    return INLINE_TAG if key.lstrip("/") in INLINE else TAG


def weight(weights: dict, key: str) -> float:
    """Learned weight of a tag; one that no page had weighs what most do."""
    return weights.get(key) or weights.get(UNSEEN) or start_weight(key)


def scores(toks, weights: dict) -> list[float]:
    """One per word of a text run (none where it is left out), and each
    tag's weight."""
    return [(0.0 if skipped else float(_count(text))) if not key else weight(weights, key)
            for key, text, _, skipped in toks]


def best_region(score) -> tuple[int, int]:
    """(start, end) of the contiguous run of the greatest sum, by one scan;
    empty if no sum is above zero."""
    best, start, end, run, begin = 0.0, 0, 0, 0.0, 0
    for i, x in enumerate(score):
        if run <= 0 and x > 0:
            run, begin = 0.0, i
        run += x
        if run > best or run == best > 0 and begin == start:
            best, start, end = run, begin, i + 1
    return start, end


def label(toks) -> tuple[int, int] | None:
    """Extent of the text in the page's one article (or main) element."""
    for name in ("article", "main"):
        opened = [i for i, t in enumerate(toks) if t[0] == name]
        closed = [i for i, t in enumerate(toks) if t[0] == "/" + name]
        if len(opened) == 1 and len(closed) == 1 and opened[0] < closed[0]:
            words = [i for i in range(opened[0], closed[0]) if not toks[i][0] and _count(toks[i][1])]
            return (words[0], words[-1] + 1) if words else None
    return None


def _shapes() -> list[list[tuple[str, int]]]:
    """(kind, words) of content blocks that articles hold: few words in many
    tags, so that a region must be glad to cross them."""
    cells, links = "<tr><td>w</td><td>w</td></tr>", "<li><a>w w</a></li>"
    rows = "<tr><th scope=row><span>w</span></th><td><p>w</p></td></tr>"
    html = [
        f"<table>{cells * 60}</table>", f"<div><table><caption>w</caption><colgroup><col><col></colgroup><thead>{rows}</thead><tbody>{rows * 20}</tbody><tfoot>{rows}</tfoot></table></div>",
        "<table><tr><td><table>" + cells * 3 + "</table></td></tr></table>" * 1 + f"<table>{'<tr><td><table>' + cells + '</table></td></tr>'}</table>" * 8,
        f"<ul>{links * 60}</ul>", "<ol>" + "<li>w" * 40 + "</ol>", "<ul>" + "<li><p>w</p><ul><li>w</li></ul></li>" * 15 + "</ul>", "<dl>" + "<dt>w</dt><dd>w</dd>" * 40 + "</dl>",
        "<dl>" + "<div><dt><dfn>w</dfn><dd><ul><li>w</ul></div>" * 10 + "</dl>", "".join(f"<h{k}>w</h{k}>" * 6 for k in range(1, 7)),
        "<section><h2>w</h2><div><div><p>w</p></div></div></section>" * 10, "<blockquote><p><q>w</q></p><cite>w</cite></blockquote>" * 10,
        "<pre><code>w</code></pre>" * 15, "<figure><picture><source><img></picture><figcaption>w</figcaption></figure>" * 12, "<hr>" * 20, "<p><br><img>" * 20,
        "<details><summary>w</summary><p>w</p></details>" * 10, "<video><source><track></video><audio></audio><canvas></canvas><embed>" * 8,
        "<center><font>w</font></center><address>w</address>" * 12, "<main><div>w</div></main>" + "<hgroup><h2>w</h2></hgroup>" * 8,
        "<script>w</script><style>w</style><noscript>w</noscript><svg></svg><iframe></iframe><template></template>" * 6,
        "<p>" + "".join(f"<{t}>w</{t}>" for t in sorted(INLINE - VOID)) * 3, "<aside>w</aside><form><button>w</button></form>" * 6, "<math><mrow><mi>w</mi><mo>=</mo></mrow></math>" * 8,
        "<fieldset><legend>w</legend><label>w</label></fieldset>" * 8, "<article-x>w</article-x><x-y><z>w</z></x-y>" * 6,
    ]
    return [[(k, 0 if k else _count(text)) for k, text, _, _ in tokens(h)] for h in html]


#: A menu that no name marks.
_MENU = "<div><ul>" + "<li><a>w</a></li>" * 6 + "</ul></div>"


def _variants(keys: list, words: list, got: tuple[int, int], number: int) -> list[tuple]:
    """The page (kinds, words, label) with blocks inside its label, one behind
    each fourth paragraph or so, and menus around its element."""
    out, shapes = [], _shapes()
    menu = [(k, 0 if k else _count(text)) for k, text, _, _ in tokens(_MENU)]
    (a, b), step = got, 0
    breaks = [i + 1 for i in range(a, b) if keys[i][:1] == "/" and keys[i][1:] not in INLINE]
    outer = next((i for i in range(a, -1, -1) if keys[i] in _MAIN), a), next((i + 1 for i in range(b, len(keys)) if keys[i][1:] in _MAIN), b)
    for v in range(VARIANTS):
        put: dict = {}
        for at in [*breaks[v::4], b]:
            put[at] = shapes[(number * 7 + v * 11 + step) % len(shapes)]
            step += 1
        if (number + v) % 2:
            put = {outer[0]: menu, outer[1]: menu, **put}
        k2, w2, label, inside = [], [], [0, 0], 0
        for i in range(len(keys) + 1):
            if i == a:
                label[0] = len(k2)
            for k, w in put.get(i, ()):
                inside = a < i <= b
                k2.append(k)
                w2.append(w / LURE if inside else w * LURE)
                if inside and w:
                    label[1] = len(k2)
            if i < len(keys):
                k2.append(keys[i])
                w2.append(words[i])
                if a <= i < b and words[i]:
                    label[1] = len(k2)
        out.append((k2, w2, tuple(label)))
    return out


def learn(pages: list[str], epochs: int = EPOCHS) -> dict:
    """Tag weights from labelled pages: a structured perceptron.  While it
    learns, words outside the label count LURE times and those inside a part,
    so the weights keep out longer boilerplate and keep in shorter paragraphs
    than the sample has."""
    rows = []
    for number, toks in enumerate(map(tokens, pages)):
        got = label(toks)
        if got is not None:
            keys = [t[0] for t in toks]
            words = [w / LURE if got[0] <= i < got[1] else w * LURE for i, w in enumerate(0 if t[0] else w for t, w in zip(toks, scores(toks, {}), strict=True))]
            rows.append((keys, words, got))
            rows += _variants(keys, words, got, number)
    weights: dict = {}
    for _ in range(epochs):
        wrong = 0
        for keys, words, (a, b) in rows:
            c, d = best_region([w if not k else weights.get(k) or start_weight(k) for k, w in zip(keys, words, strict=True)])
            if (c, d) == (a, b):
                continue
            wrong += 1
            for i in range(min(a, c), max(b, d)):
                if keys[i] and (a <= i < b) != (c <= i < d):
                    old = weights.get(keys[i]) or start_weight(keys[i])
                    weights[keys[i]] = min(LEAST_TAG, old + (STEP if a <= i < b else -STEP))
        if not wrong:
            break
    if weights:
        weights[UNSEEN] = sorted(weights.values())[len(weights) // 2]
    return weights


def clean(toks) -> str:
    """Blocks of a region, without what is left out."""
    blocks, run = [], []
    for key, text, name, skipped in toks:
        if not key:
            if not skipped:
                run.append(text)
        elif name == "br" or name == "wbr":
            run.append(" " if name == "br" else "")
        elif name != "raw" and name not in INLINE:
            blocks.append("".join(run))
            run = []
    blocks.append("".join(run))
    out = (" ".join(_html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in out if b)


def extract(page: str | None, weights: dict) -> str:
    if not page:
        return ""
    toks = tokens(page, weights)
    a, b = best_region(scores(toks, weights))
    return clean(toks[a:b])


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict:
    """Weights from a bounded sample of the pages that have a label."""
    html = F.col("html").cast("string")
    one = [F.regexp_count(html, F.lit(rf"(?i)<{name}[\s/>]")) == 1 for name in ("article", "main")]
    known = pages.where(one[0] | one[1]).select(
        html.alias("html"), F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("page_id").cast("string"), html), 1).alias("h"))
    n = known.count()
    if not n:
        return {}
    rows = known.where(F.col("h") <= hash_limit(sample_pages / n)).toPandas().sort_values("h", kind="stable")
    return learn(rows["html"].tolist())


def _extractor(weights: dict):
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256)
                text = [extract(p, weights) for p in rows.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(text, pa.string()),
                                                  pa.array(map(len, text), pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def main_text(pages: DataFrame, weights: dict) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_extractor(weights), f"page_id {kind}, url string, text string, n_chars long")


def op7_html(spark, sf_dir):
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return main_text(pages, train(pages))
