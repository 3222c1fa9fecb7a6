"""Every query over nulls, empty and long texts, ties, repeats, clashing
columns, and over empty tables."""

import hashlib
import math
import zlib

import numpy as np
import pytest
import brute as R
from edge_cases import BENCHMARK, EDGE, PAGE, PAGES

import corpus_pipeline
from docketflow.llm.registry import QUERIES
from docketflow.llm.setsketch import near_duplicates


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_empty_pipeline(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def test_documents_but_no_labels(spark, edge_dir):
    from docketflow.llm.toxicity import score, train
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    labels = spark.read.parquet(f"{edge_dir}/labels.parquet")
    assert {r.score for r in score(docs, train(docs, labels.where("false"))).collect()} == {0.0}
    assert {r.score for r in score(docs, train(docs, labels.where("toxic = 1"))).collect()} == {1.0}


def test_quality(spark, edge_dir, rows_of):
    got = rows_of(QUERIES["op3_quality"](spark, edge_dir), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = sorted(((d[0], *R.quality(d[1])) for d in EDGE), key=lambda r: tuple((x is not None, x) for x in r))
    assert got == want


def test_brown(spark, edge_dir):
    got = QUERIES["op2_brown"](spark, edge_dir).collect()
    want = R.base_scores([d[:2] for d in EDGE])
    key = lambda d, x: (d is None, d or 0, x[0], x[1], x[2], round(x[3], 6))
    assert sorted(key(r.doc_id, (r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in got) == \
        sorted(key(d[0], x) for d, x in zip(EDGE, want, strict=True))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert all(r.held_out == (R.fold(r.doc_id, 5) == 1) for r in got)


def test_decontaminate(spark, edge_dir, rows_of):
    got = rows_of(QUERIES["op4_decontaminate"](spark, edge_dir), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = []
    for d in EDGE:
        n, hit, items = R.contamination(d[1], BENCHMARK)
        want.append((d[0], n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), hit > 0))
    assert got == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))


def test_tokens(spark, edge_dir):
    from tokenizers import Tokenizer

    from docketflow.llm.tokens import tokenizer_path
    got = sorted(QUERIES["op5_token_ids"](spark, edge_dir).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d[0] for d in EDGE), key=lambda x: (x is not None, x))
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1])
    library = Tokenizer.from_file(tokenizer_path())
    digest = lambda t: zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == sorted((str(d[0]), digest(d[1])) for d in EDGE)


def test_near_duplicates(spark, edge_dir):
    got = QUERIES["op6_setsketch"](spark, edge_dir).collect()
    roots, sizes = R.components([d[1] for d in EDGE])
    least = {}
    for d, r in zip(EDGE, roots, strict=True):
        if d[0] is not None:
            least[r] = min(least.get(r, d[0]), d[0])
    want = [(d[0], n, least.get(r) if n else d[0]) for d, n, r in zip(EDGE, sizes, roots, strict=True)]
    assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(map(str, want))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_mixing(spark, edge_dir):
    from docketflow.llm.mixing import targets
    got = QUERIES["op8_mixing"](spark, edge_dir).collect()
    size = {}
    for d in EDGE:
        size[d[3]] = size.get(d[3], 0) + len(R.WORD.findall(d[1] or ""))
    want = targets(size)
    assert len(got) == len(EDGE) and all(r.taken <= 3 * r.size and (r.taken == 0 or r.taken % r.size == 0) for r in got)
    assert {(r.source_size, r.target) for r in got} <= {(size[s], want[s]) for s in size}
    assert all(t <= 3 * size[s] + 1e-9 for s, t in want.items())
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, QUERIES["op8_mixing"](spark, edge_dir).collect()), key=str)


def test_language(spark, edge_dir):
    got = QUERIES["op9_language_id"](spark, edge_dir).collect()
    assert len(got) == len(EDGE)
    assert all(0 <= r.score <= 1 and r.held_out == (R.fold(r.doc_id, 5) == 0) for r in got)
    unknown = sorted(str(d[0]) for d in EDGE if not any(c.isalpha() for c in d[1] or ""))
    assert sorted(str(r.doc_id) for r in got if r.lang_pred == "und") == unknown
    assert {r.lang_pred for r in got} <= {"en", "de", "fr", "und"}


def test_toxicity(spark, edge_dir):
    got = QUERIES["op1_toxicity"](spark, edge_dir).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_html(spark, edge_dir):
    got = QUERIES["op7_html"](spark, edge_dir).collect()
    text = "Head & line\nOne two three.\nFour five six seven"
    want = {PAGE: text, None: "", "": "", "no tags é": "no tags é", "y" * 1500: "y" * 1500, "<p>" * 3000 + "word": "word"}
    assert sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in got) == sorted((str(p[0]), str(p[1]), want[p[2]], len(want[p[2]])) for p in PAGES)


def test_warc(spark, edge_dir):
    got = QUERIES["op10_warc"](spark, edge_dir).collect()
    want = []
    for p in PAGES:
        raw = (p[2] or "").encode()
        same = [q[0] for q in PAGES if (q[2] or "").encode() == raw and q[0] is not None]
        first = max(same) if same else None
        other = len(raw) >= 1000 and first != p[0] and PAGES.count(p) and sum((q[2] or "").encode() == raw for q in PAGES) > 1
        want.append((p[0], len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if other else "response", first if other else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_pipeline_stages(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, edge_dir)
        assert docs.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append([r.doc_id for r in docs.collect()])
    known, single, clean, _ = kept
    assert sorted(map(str, known)) == sorted(str(d[0]) for d in EDGE if any(c.isalpha() for c in d[1] or ""))
    # one of each group: 1 of two rows, 8 of (8, 9, 10), 13 of (13, 15)
    assert sorted(map(str, single)) == sorted(map(str, [1, None, 5, 7, 8, 11, 12, 13, 14, 16]))
    assert not {1, 8, 12, 13} & set(clean) and {5, 7, 11, 14, 16} <= set(clean)


def test_pipeline_near_copies(spark, tmp_path):
    """Copies at 0.80 to 0.85 leave the pipeline's corpus; op6 links from 0.85."""
    texts, near = [], []
    for k in range(12):
        words = [f"w{k}x{i}" for i in range(100)]
        changed = ((40, 70), (39, 42), (40, 41), (20, 50, 80))[k % 4]
        other = [f"z{k}" if i in changed else w for i, w in enumerate(words)]
        sets = [R.shingle_set(" ".join(t)) for t in (words, other)]
        near.append(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        texts += [" ".join(words), " ".join(other)]
    # 80 of 100 shingles, at the threshold itself
    words = [f"v{i}" for i in range(94)]
    texts += [" ".join(words), " ".join(words[:84] + [f"u{i}" for i in range(10)])]
    sets = [R.shingle_set(t) for t in texts[-2:]]
    near.append(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
    assert [sum(x < y for x in near) for y in (0.8, 0.85, 1)] == [3, 10, 13] and near[-1] == 0.8
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in corpus_pipeline.deduplicate(spark, docs, str(tmp_path)).collect()}
    assert got == {i for i in range(len(texts)) if i % 2 == 0 or near[i // 2] < 0.8}
    linked = {r.doc_id for r in near_duplicates(docs).where("rid = keeper").collect()}
    assert linked == {i for i in range(len(texts)) if i % 2 == 0 or near[i // 2] < 0.85}
