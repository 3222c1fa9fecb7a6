"""Whole-table brute force for HTML, mixing, toxicity and languages, and cases
that once went wrong."""

import random
import re
import time
from collections import Counter, defaultdict

import brute as R
import pytest
from pyspark.sql import functions as F

from docketflow.llm import html, langid, mixing
from docketflow.llm.decontaminate import decontaminate
from docketflow.llm.registry import QUERIES

# -- HTML --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return html.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def article(page):
    """The one article element's blocks, by plain string work."""
    inner = re.search(r"<article\b[^>]*>(.*?)</article>", page, re.S)[1]
    inner = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>|<div class=\"(?:ad|comments)\">.*?</div>", "", inner, flags=re.S)
    inner = re.sub(r"<br ?/?>", " ", inner)
    inner = re.sub(r"</?(?:b|i|em|a|span|strong)\b[^>]*>", "", inner)
    import html as stdlib
    blocks = (" ".join(stdlib.unescape(b).split()) for b in re.split(r"<[^>]*>", inner))
    return "\n".join(b for b in blocks if b)


def test_pages_brute_force(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op7_html"](spark, sf_dir).collect()}
    want = {k: article(p) if p and "<article" in p else "" for k, p in pages.items()}
    assert got == {k: (t, len(t)) for k, t in want.items()} and sum(map(bool, want.values())) > 10


INSIDE = {
    "table": "<table>" + "<tr><td>one</td><td>two</td></tr>" * 100 + "</table>", "links": "<ul>" + "<li><a href=x>go</a></li>" * 60 + "</ul>",
    "definitions": "<dl>" + "<dt>a</dt><dd>b</dd>" * 80 + "</dl>", "nested tables": "<table>" + "<tr><td><table><tr><td>x</td></tr></table></td></tr>" * 50 + "</table>",
    "empty table": "<table>" + "<tr><td></td><td></td></tr>" * 200 + "</table>", "figures": "<figure><img><figcaption>c</figcaption></figure>" * 40,
    "code": "<pre><code>x</code></pre>" * 60, "boxes": "<div>" * 80 + "x" + "</div>" * 80, "unknown tags": "<my-box><my-cell>x</my-cell></my-box>" * 60,
    "scripts": "<script>var a = '<p>';</script>" * 60, "headings": "<h2>x</h2>" * 60,
}


@pytest.mark.parametrize("shape", sorted(INSIDE))
def test_whole_articles(weights, shape):
    """Whatever stands between two paragraphs, or ends the article."""
    first, last = "<p>" + "words of the first one " * 6 + "</p>", "<p>" + "words of the last one " * 6 + "</p>"
    for inner in (first + INSIDE[shape] + last, first + INSIDE[shape], first + (INSIDE[shape] + last) * 3):
        page = ('<html><head><title>t</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">buy this now</div>'
                f"<article><h1>A title</h1>{inner}</article><footer>foot words here</footer></body></html>")
        want = html.clean([t for t in html.tokens(f"<h1>A title</h1>{inner}", weights)])
        assert html.extract(page, weights) == want and len(want) > 100


@pytest.mark.parametrize("piece", ['<p "', "<a", "<!--", '<div class="', "<script>", "<p>w", "</p>", '<li>w <a x="', "<div class=ad>"])
def test_broken_pages_end(weights, piece):
    start = time.perf_counter()
    html.extract(piece * (1_000_000 // len(piece)), weights)
    assert time.perf_counter() - start < 12


def test_the_sample_is_of_labelled_pages(spark):
    """Few pages with a label among many; no ids."""
    rows = [(None, f"<body><div>{k} no label</div></body>") for k in range(300)]
    rows += [(None, f"<body><ul><li><a>menu {k}</a></li></ul><article><p>{'text words here ' * 8} {k}</p></article></body>") for k in range(3)]
    got = html.train(spark.createDataFrame(rows, "page_id long, html string"), sample_pages=20)
    assert got["article"] < html.TAG


# -- decontamination -----------------------------------------------------------------

def test_words_do_not_look_past_their_ends(spark, rows_of):
    sigma = "ΑΣ"
    item = f"{sigma} Β one two three four five six seven eight"
    docs = [(1, f"x {sigma}'Β one two three four five six seven eight y"), (2, item), (3, item.replace("Σ", "ς")),
            (4, f"{sigma}Β one two three four five six seven eight"), (5, item.lower()), (6, "İ " + item), (7, "K " + item.upper())]
    bench = [("a", item), ("b", "İstanbul"), ("c", "K")]
    got = decontaminate(spark.createDataFrame([*docs, (8, "İstanbul'K")], "doc_id long, text string"), spark.createDataFrame(bench, "item_id string, text string"))
    want = []
    for d, t in [*docs, (8, "İstanbul'K")]:
        n, hit, items = R.contamination(t, bench)
        want.append((d, n, hit, len(items)))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items") == want and want[0][2] == 10


# -- mixing --------------------------------------------------------------------------

def brute_targets(sizes):
    """Shares by weight with limits, by lowering and raising one level."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    low, high = 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        if sum(min(w[s] * level, 3 * sizes[s]) for s in sizes) < sum(sizes.values()):
            low = level
        else:
            high = level
    return {s: min(w[s] * high, 3 * sizes[s]) for s in sizes}


def check_mix(rows, slack):
    """Of (doc_id, text, source, size, target, source_size, taken)."""
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        assert r.size == len(R.WORD.findall(r.text or "")) and 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-6, abs=1e-6)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack * largest[s] + 1, s


def test_mix_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    got = QUERIES["op8_mixing"](spark, sf_dir)
    again = {r.doc_id: r.taken for r in QUERIES["op8_mixing"](spark, sf_dir).collect()}
    assert again == {r.doc_id: r.taken for r in got.collect()}
    check_mix(got.join(docs, "doc_id").collect(), 1)


@pytest.mark.parametrize("kind", ["equal texts, no ids", "one id", "all rows equal", "many sources"])
def test_mix_of_repeated_rows(spark, kind):
    rng = random.Random(4)
    rows = {
        "equal texts, no ids": [(None if k % 3 == 0 else k, "five words are in here", "abc"[k % 3]) for k in range(900)],
        "one id": [(7, f"{k} " * rng.randint(1, 9), rng.choice("ab")) for k in range(600)],
        "all rows equal": [(1, "two words", "a")] * 400 + [(2, "x", None)],
        "many sources": [(k, "w " * rng.randint(0, 9), f"s{k % 250}") for k in range(2000)],
    }[kind]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, figures = mixing.mix(docs, F.array("source"))
    figures = figures.withColumnRenamed("source", "_s")
    check_mix(got.join(figures, F.col("source").eqNullSafe(F.col("_s"))).collect(), 1)


def test_targets_table_as_the_plain_one(spark):
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 40):
        sizes = {f"s{k:02d}": rng.choice([0, 1, 5, 100, 10_000]) for k in range(n)} | ({None: 50} if n > 2 else {})
        table = spark.createDataFrame([(p, z) for (p,), z in zip(spark.createDataFrame([(s,) for s in sizes], "s string").select(
            F.to_json(F.array("s"))).collect(), sizes.values(), strict=True)], "pattern string, size long")
        got = {r.source: r.target for r in mixing.target_table(table).collect()}
        assert got == pytest.approx(mixing.targets(sizes)) and got == pytest.approx(brute_targets(sizes) if sum(sizes.values()) else got, rel=1e-6)


# -- classifiers: held-out accuracy ----------------------------------------------------

def test_languages_held_out(spark, sf_dir, small_docs):
    lang = {d["doc_id"]: d["lang"] for d in small_docs}
    got = [r for r in QUERIES["op9_language_id"](spark, sf_dir).collect() if r.held_out and lang[r.doc_id]]
    assert len(got) > 20 and all(r.held_out == (R.fold(r.doc_id, 5) == 0) for r in got)
    right = sum(r.lang_pred == lang[r.doc_id] for r in got if r.lang_pred != langid.UNKNOWN)
    assert right >= 0.97 * sum(r.lang_pred != langid.UNKNOWN for r in got)


def test_languages_of_rows_without_ids(spark):
    """The sample is drawn by id and text, so rows without an id teach."""
    words = {"en": "the of and to in that was", "de": "der die und ist nicht das mit"}
    rng = random.Random(6)
    rows = [(None, " ".join(rng.choice(words[k].split()) for _ in range(30)), k) for k in words for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample_docs=100)
    got = langid.identify(docs, model, ("lang",)).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.99 * len(got)


def test_toxicity_held_out(spark, sf_dir):
    """Toxic documents score above clean ones, also where none was learned."""
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic IS NOT NULL").collect()}
    groups = defaultdict(list)
    for r in QUERIES["op1_toxicity"](spark, sf_dir).collect():
        assert r.held_out == (R.fold(r.doc_id, 3) == 1) and r.predicted == (r.score >= 0.7)
        if r.doc_id in toxic:
            groups[r.held_out, toxic[r.doc_id]].append(r.score)
    for held in (False, True):
        high, low = groups[held, 1], groups[held, 0]
        if high and low:
            pairs = sum((a > b) + (a == b) / 2 for a in high for b in low) / (len(high) * len(low))
            assert pairs > 0.8


# -- near-duplicates ---------------------------------------------------------------

@pytest.mark.parametrize("threshold", [30, 50, 60, 85])
def test_low_thresholds_lose_no_pair(threshold):
    """Pairs just above the threshold in one open bucket are all confirmed."""
    import numpy as np
    import pandas as pd
    from docketflow.llm import setsketch
    rng = np.random.default_rng(threshold)
    n, rows = 400, []
    both = int(np.ceil(threshold * 2 * n / (100 + threshold))) + 1
    for k in range(60):
        a = rng.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
        for side, x in enumerate((a[:n], a[n - both:])):
            reg = setsketch.registers(x, np.array([0, len(x)]))
            rows.append((1, 2 * k + side, 2 * k + side, n, reg.tobytes(), 0, 0, 0, x.tobytes()))
    df = pd.DataFrame(rows, columns=["key", "cid", "root", "n", "registers", "block", "lo", "hi", "shingles"])
    got = setsketch._crosser(threshold)((0,), df)
    assert sorted(zip(got["a"], got["b"], strict=True)) == [(2 * k, 2 * k + 1) for k in range(60)]
