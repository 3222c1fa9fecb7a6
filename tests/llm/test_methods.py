"""The methods themselves, against brute force, round trips and held-out rows."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import brute as R

from docketflow.llm import brown, html, langid, mixing, setsketch, tokens, warc
from docketflow.llm.common import text_slices
from docketflow.llm.registry import QUERIES


def arrays(texts):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    return next((d, o) for _, d, o in text_slices([batch], limit=1 << 62))


# -- whole small tables ---------------------------------------------------------

def test_near_duplicates_brute_force(spark, sf_dir, small_docs, rows_of):
    docs = sorted(small_docs, key=lambda d: d["doc_id"])
    roots, sizes = R.components([d["text"] for d in docs])
    want = [(d["doc_id"], n, docs[r]["doc_id"], d["doc_id"] == docs[r]["doc_id"]) for d, n, r in zip(docs, sizes, roots, strict=True)]
    assert rows_of(QUERIES["op6_setsketch"](spark, sf_dir), "doc_id", "n_shingles", "component_id", "kept") == want


def test_near_copies_without_a_common_leader(spark):
    """A long chain: neighbours are linked, ends are far apart."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    chain = [list(words)]
    for _ in range(60):
        nxt = list(chain[-1])
        nxt[rng.randrange(len(nxt))] = f"x{rng.random()}"
        chain.append(nxt)
    texts = [" ".join(w) for w in chain] + [" ".join(f"y{i}-{k}" for i in range(40)) for k in range(5)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs).collect()}
    assert got == dict(enumerate(R.components(texts)[0]))


def test_frequent_words_are_placed_by_their_first_bits():
    bits = np.uint64(64 - brown._PREFIX)
    rng = np.random.default_rng(3)
    h = np.unique(np.concatenate([rng.integers(0, 2**64, 400, np.uint64), (np.uint64(7) << bits) + np.arange(50, dtype=np.uint64), [np.uint64(2**64 - 1)]]))
    for head in (h[::2], h[1::2], h[-1:], h[:0]):
        place, known = brown._placed(h, np.zeros(len(h), np.int64), head, brown._starts(head))
        assert (known == np.isin(h, head)).all() and (head[place[known] - brown.FORMS] == h[known]).all() and not place[~known].any()


def test_class_bigrams_of_the_last_pass_are_counted_in_the_texts(spark, small_docs):
    docs = spark.createDataFrame([(d["doc_id"], d["text"]) for d in small_docs[:40]] + [(None, None), (-1, "")], "doc_id long, text string")
    counts = brown._most(brown.word_counts(docs), 300)
    head = np.sort(counts["h"].to_numpy(np.int64).view(np.uint64))
    of = np.random.default_rng(1).integers(0, 9, brown.FORMS + len(head) + 1)
    of[-1] = 9
    assert (brown._bigrams(docs, head, of, 10) == brown._table(brown._sides(docs, head, of, 10), of, 10)).all()
    # only the counts that a further pass moves words by are kept
    kept = []
    sides = brown._sides
    brown._sides = lambda *a: kept.append(1) or sides(*a)
    try:
        brown.refine(docs, head, of, 10, 1)
    finally:
        brown._sides = sides
    assert kept == [1]


def test_base_scores_brute_force(spark, sf_dir, small_docs):
    want = dict(zip((d["doc_id"] for d in small_docs), R.base_scores([(d["doc_id"], d["text"]) for d in small_docs]), strict=True))
    got = QUERIES["op2_brown"](spark, sf_dir).collect()
    for r in got:
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_quality_brute_force(spark, sf_dir, small_docs, rows_of):
    got = rows_of(QUERIES["op3_quality"](spark, sf_dir), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted((d["doc_id"], *R.quality(d["text"])) for d in small_docs)


def test_host_verdict(spark):
    good, bad = " ".join(f"word{i}" for i in range(60)), "too short"
    rows = [(i, good, "fine") for i in range(200)] + [(i, bad, "poor") for i in range(200, 300)] + [(300, good, "poor"), (301, good, None), (302, good, "new")]
    from docketflow.llm.quality import quality
    got = {r.doc_id: r.kept for r in quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0] and got[301] and got[302] and not got[300] and not got[250]


def test_language_held_out(spark, sf_dir, small_docs):
    lang = {d["doc_id"]: d["lang"] for d in small_docs}
    got = [r for r in QUERIES["op9_language_id"](spark, sf_dir).collect() if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.95 * len(got)


def test_toxic_words_found(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    docs, labels = [], []
    for i in range(1200):
        toxic = i % 4 == 0
        text = [word() for _ in range(rng.randint(20, 400))] + ["vilewort", "Schimpf"] * toxic
        rng.shuffle(text)
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    from docketflow.llm.toxicity import score, train
    d = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels[:800], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in score(d, train(d, known)).collect()}
    assert np.mean([got[i] == t for i, t in labels[800:]]) > 0.97


def test_rare_toxic_grams_count():
    """In no clean document: 12 of 4,000 are beyond chance, 11 are not."""
    from docketflow.llm.toxicity import ratios
    r = ratios(np.array([55, 12, 11, 0, 0, 4000, 2000]), np.array([0, 0, 0, 0, 12, 4000, 2000]), 4000, 4000)
    assert r[0] > 4 and r[1] > 2.5 and r[4] == -r[1] and not r[[2, 3, 5, 6]].any()


# -- Brown classes ----------------------------------------------------------------

def test_exchange_is_a_local_optimum():
    rng = np.random.default_rng(0)
    m = 25
    p = rng.random((4, 4)) ** 4
    pairs = np.zeros((m, m))
    pairs[:-1, :-1] = rng.poisson(200 * p[np.arange(m - 1) % 4][:, np.arange(m - 1) % 4])
    pairs[-1, :], pairs[:, -1] = 5, 5

    def value(of):
        member = np.eye(of.max() + 1)[of]
        t = member.T @ pairs @ member
        f = lambda x: (x * np.log(np.maximum(x, 1e-12))).sum()
        return f(t) - f(t.sum(0)) - f(t.sum(1))

    of = brown.exchange(pairs, 5, 20)
    assert len({*of[:-1:4]}) == 1 and of[-1] == 4
    for w in range(m - 1):
        for c in range(4):
            other = of.copy()
            other[w] = c
            assert value(other) <= value(of) + 1e-6


# -- tokens -------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    x = np.random.default_rng(bits).integers(0, 2**bits, 1000)
    assert (tokens.unpack(tokens.pack(x, bits), bits, 1000) == x).all()
    assert (tokens.unpack(tokens.pack(x, bits), bits, 100, 333) == x[333:433]).all()


def test_encoder_equals_the_library():
    rng = random.Random(1)
    parts = ["a", "b", "s", "t", "re", "ll", "'", "'s", " ", "  ", "\n", "\t", "1", "23", "!", "é", "ö", "²", "漢", "😀", "ve", "d", "m", "-", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + ["", "a<|endoftext|>b"]
    enc = tokens.Encoder(tokens.tokenizer_path())
    ids, off = enc.encode(*arrays(texts[:-1]))
    want = [e.ids for e in enc.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [[*w, 0] for w in want[:-1]]
    ids, _ = enc.encode(*arrays(texts[-1:]))
    assert ids.tolist() == [*want[-1], 0]


def test_file_random_access(tmp_path):
    from pyarrow import fs
    store, path = fs.LocalFileSystem(), str(tmp_path / "x.tok")
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50_257, rng.integers(1, 40)) for _ in range(700)]
    out = tokens.FileWriter(store, path, 17)
    for i, d in enumerate(docs):
        out.add(i * 3, d)
    out.close()
    f = tokens.FileReader(store, path)
    assert f.docs == [i * 3 for i in range(700)]
    for i in (0, 255, 256, 511, 699):
        assert (f.ids(i) == docs[i]).all()
    assert np.concatenate([x for _, _, x in f.blocks()]).tolist() == np.concatenate(docs).tolist()


# -- sketches -------------------------------------------------------------------------

def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.85, 0.95):
        n = 2000
        common = rng.integers(0, 2**63, int(n * share), dtype=np.uint64)
        a = np.concatenate([common, rng.integers(0, 2**63, n - len(common), dtype=np.uint64)])
        b = np.concatenate([common, rng.integers(0, 2**63, n - len(common), dtype=np.uint64)])
        ra, rb, rab = (setsketch.registers(x, np.array([0, len(x)]))[0] for x in (a, b, np.concatenate([a, b])))
        assert (setsketch.merge(ra, rb) == rab).all()
        true = len(common) / (2 * n - len(common))
        more, less = int((ra > rb).sum()), int((ra < rb).sum())
        found, lead = setsketch.likelihood([more], [less], [setsketch.REGISTERS - more - less], [n], [n])
        assert abs(found[0] - true) < 0.15
        assert (lead[0] <= setsketch.SURE) or true < 0.8


# -- mixing -----------------------------------------------------------------------------

def test_targets():
    assert mixing.targets({"a": 100, "b": 100, "c": 100}) == pytest.approx({"a": 50.0, "b": 100.0, "c": 150.0})
    got = mixing.targets({"b": 10, "a": 1000, None: 5})  # weights: a 1, b 2, null 3
    assert got["b"] == 30 and got[None] == 15 and got["a"] == pytest.approx(970)


def brute_flow(patterns, quotas, repeat):
    """Least cost of a largest flow, by trying every split of small numbers."""
    from itertools import product
    names = sorted(patterns)
    best = (0, 0)
    ranges = [range(repeat * patterns[p] + 1) for p in names for _ in p]
    slots = [(p, s) for p in names for s in p]
    for pick in product(*ranges):
        by_p, by_s = {}, {}
        for (p, s), x in zip(slots, pick, strict=True):
            by_p[p], by_s[s] = by_p.get(p, 0) + x, by_s.get(s, 0) + x
        if any(by_p[p] > repeat * patterns[p] for p in by_p) or any(by_s[s] > quotas[s] for s in by_s):
            continue
        cost = sum(i // patterns[p] + 1 for p in by_p for i in range(by_p[p]))
        best = max(best, (sum(pick), -cost))
    return best


def test_route_is_cheapest():
    patterns, quotas = {("a",): 2, ("a", "b"): 2, ("b",): 1}, {"a": 5, "b": 4}
    flow = mixing.route(patterns, quotas, 2)
    by_p = {}
    for (p, _), x in flow.items():
        by_p[p] = by_p.get(p, 0) + x
    cost = sum(i // patterns[p] + 1 for p in by_p for i in range(by_p[p]))
    assert (sum(flow.values()), -cost) == brute_flow(patterns, quotas, 2)


def test_mix_meets_targets(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(1, 50), rng.choice(["a", "a", "b", "c", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    from pyspark.sql import functions as F
    got, figures = mixing.mix(docs, F.array("source"))
    want = {r.source: r.target for r in figures.collect()}
    taken = {}
    for r in got.collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 150


def test_overlapping_sources(spark):
    from pyspark.sql import functions as F
    rows = [(i, "one two three four", ["x", "y"] if i % 3 else ["x"]) for i in range(300)]
    got, figures = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, s array<string>"), F.col("s"))
    total = sum(r.taken for r in got.collect())
    assert abs(total - sum(r.target for r in figures.collect())) <= 16


# -- languages --------------------------------------------------------------------------

@pytest.mark.parametrize("k", [1, 2, 3, 4, 7, 8, 20])
def test_codebook(k):
    code = langid.codebook(k)
    assert code.shape[0] == k and len({tuple(c) for c in code}) == k
    if k > 2:
        assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= 2


def test_decoding_corrects_a_wrong_bit():
    code = langid.codebook(4)
    margins = code[2].astype(float) * 3
    margins[1] *= -1
    best, score, lead = langid.decode(margins[None], code, np.ones(code.shape[1]))
    assert best[0] == 2 and 0.5 < score[0] < 1 and lead[0] > 0


# -- HTML ---------------------------------------------------------------------------------

def test_best_region_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        x = [rng.choice([-2.0, -1.0, -0.5, 0.0, 1.0, 2.0]) for _ in range(rng.randint(0, 12))]
        a, b = html.best_region(x)
        assert sum(x[a:b]) == max([0.0, *(sum(x[i:j]) for i in range(len(x)) for j in range(i, len(x) + 1))])


def test_weights_keep_boilerplate_out():
    page = ("<body><ul>" + "<li><a href=x>go there</a></li>" * 8 + "</ul><article><h1>A title here</h1>" + "<p>Some words of an article.</p>" * 6
            + "</article><div>see also</div><ul><li><a>more of this</a></li></ul></body>")
    weights = html.learn([page] * 5)
    assert html.extract(page, weights) == "A title here\n" + "\n".join(["Some words of an article."] * 6)


@pytest.mark.parametrize("page", ["<", "<<<p>", "<!-- ", "<script>", "<p title='>'>x y</p>", "&#x41;&amp b", "<div class=ad>no</div>", "<nav>a b c", "</p></div>"])
def test_broken_markup(page):
    html.extract(page, {})


_P = "<p>Some words of a real text.</p>" * 6


@pytest.mark.parametrize("page", [
    f'<body class="has-sidebar">{_P}</body>', f'<body class="post header-image">{_P}</body>', f'<body class="sidebar">{_P}</body>',
    f'<article class="post comments-open comments">{_P}</article>', f'<section id="discussion">{_P}</section>',
    f'<div id="related-work">{_P}</div>', f'<div class="search-result">{_P}</div>', f'<div data-role="sidebar" title="class=ad">{_P}</div>',
    f'<div class="sidebar"><main>{_P}</main></div>', f'<div id="search">{_P}</div><div class="ad">no</div>'])
def test_classes_leave_the_text(page):
    assert html.extract(page, {}) == "\n".join(["Some words of a real text."] * 6)


def test_classes_drop_notices():
    page = f'<div class="ads comments">{_P * 3}</div><article>{_P}<div class="x ad">buy</div><p>The end of it.</p></article>'
    assert html.extract(page, {}) == "\n".join(["Some words of a real text."] * 6 + ["The end of it."])


# -- WARC -----------------------------------------------------------------------------------

def test_archive_round_trip():
    rows = [(1, "http://x/", b""), (2, None, "é\r\n\r\n".encode() * 500), (None, "u v", bytes(range(256)) * 700)]
    raw = b"".join(warc.record(i, u, p) for i, u, p in rows)
    got = list(warc.read_records(io.BytesIO(raw)))
    assert [(g["id"], g["payload"]) for g in got] == [(None if i is None else str(i), p) for i, _, p in rows]
    # each record is a gzip member of its own
    z = zlib.decompressobj(31)
    z.decompress(raw)
    assert z.eof and z.unused_data


def test_long_url():
    url = "http://x/" + "a b" * 600_000
    got, = warc.read_records(io.BytesIO(warc.record(1, url, b"text")))
    assert got["url"] == url.replace(" ", "%20") and got["payload"] == b"text"


def test_damage_is_found():
    raw = warc.record(1, "u", b"payload" * 300)
    with pytest.raises(warc.Damaged):
        list(warc.read_records(io.BytesIO(raw[:-20])))
    plain = bytearray(zlib.decompress(raw, 31))
    for a, b in ((b"payload", b"Payload"), (b"Content-Length: 2", b"Content-Length: 3")):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        bad = z.compress(bytes(plain.replace(a, b, 1))) + z.flush()
        with pytest.raises(warc.Damaged):
            list(warc.read_records(io.BytesIO(bad)))


def test_archives_roll_over(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 200) for i in range(50)], "id long, url string, payload string").repartition(2)
    uri = f"file://{tmp_path}/w"
    files = warc.write_archives(rows, uri, file_bytes=2000)
    assert files.count() > 2
    assert sorted(r.id for r in warc.read_archives(files, uri).collect()) == list(range(50))


# -- phrases and proximity -------------------------------------------------------------------

def test_proximity(spark):
    from docketflow.llm.decontaminate import proximity_matches
    docs = spark.createDataFrame([(1, "aa x x bb x x x x x x x x x aa"), (2, "aa " + "x " * 30 + "bb"), (3, "bb aa")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "aa bb x")], "item_id long, text string")
    got = sorted((r.doc_id, r.pos_a, r.pos_b) for r in proximity_matches(docs, items, gap=5).collect())
    assert got in ([(1, 0, 3), (3, 1, 0)], [(1, 3, 0), (3, 0, 1)])


def test_native_plan(spark, sf_dir):
    plan = QUERIES["op4_decontaminate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- SQL ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op3_quality", "op4_decontaminate", "op10_warc"])
def test_sql(spark, sf_dir, name):
    from oracle_compare import compare

    from docketflow.llm.oracle import ORACLE
    r = compare(spark, name, QUERIES[name], ORACLE[name], sf_dir)
    assert r["cols_equal"] and r["values_equal"], r["diff"]
