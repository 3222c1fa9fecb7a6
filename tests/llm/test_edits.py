"""Repeated strings, fill-in-the-middle and conversation repair against brute
force."""

import random
from collections import defaultdict

import brute as R
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from edge_cases import CONVERSATIONS, EDGE

from docketflow.llm import conversations, middle, suffixes
from docketflow.llm.registry import QUERIES

SPANS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
CUTS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
AUDIT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


# -- suffix sort ------------------------------------------------------------------

def test_repeats_whole_table(spark, sf_dir, small_docs, rows_of):
    want = R.repeats([(d["doc_id"], d["text"]) for d in small_docs])
    assert sum(w[2] for w in want) > 0
    assert rows_of(QUERIES["op11_suffixes"](spark, sf_dir), *SPANS) == ordered(want)


def test_repeats_edges(spark, edge_dir, rows_of):
    assert rows_of(QUERIES["op11_suffixes"](spark, edge_dir), *SPANS) == ordered(R.repeats([d[:2] for d in EDGE]))


def overlapping(rng):
    """Texts of pieces of a common source, shifted, nested, repeated within a
    text, next to others' ends, and of 49 to 51 common bytes."""
    source = "".join(rng.choice("abäc ") for _ in range(900))
    rows = [(None, source[100:300]), (5, ""), (6, None)]
    for i in range(60):
        text = ""
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(800)
            text += source[a:a + rng.choice([20, 40, 49, 50, 51, 90, 200])] + rng.choice(["", "x", f"{i}-{rng.random()}"])
        rows.append((rng.randrange(40), text))
    rows += [(50, "z" * 400), (51, "z" * 49), (52, "y" + "z" * 50), (53, "zz" * 30), (54, rows[10][1]), (2, rows[10][1])]
    return rows


@pytest.mark.parametrize("split", [4096, 1])
def test_repeats_random(spark, monkeypatch, rows_of, split):
    """Also with every anchor of several runs split into strings."""
    monkeypatch.setattr(suffixes, "SPLIT", split)
    rows = overlapping(random.Random(3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.remove_repeats(docs, keep_text=True)
    assert rows_of(got, *SPANS) == ordered(R.repeats(rows))
    for r in got.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans
        assert len(r.kept) == r.n_bytes - r.n_removed


def test_repeats_in_pieces(monkeypatch):
    """Long texts in pieces and anchors packed many times over lose no
    repeated string."""
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 1000)
    monkeypatch.setattr(suffixes, "PACK_BYTES", 2000)
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefgh") for _ in range(9000))
    texts = [long, "q" * 70 + long[1000:8000], long[5000:5060], long[::-1], "", *(long[k:k + 300] for k in range(0, 900, 70))]
    keys = [b"%012d" % i for i in range(len(texts))]
    batch = pa.record_batch({"key": pa.array(keys), "m": pa.array(range(len(texts)), pa.int64()), "text": pa.array([t.encode() for t in texts])})
    assert any(base for *_, base in suffixes._pieces(iter([batch])))
    packed = pa.Table.from_batches(suffixes._anchors(3)(iter([batch])))
    assert packed.num_rows > 6 and max(packed["part"].to_pylist()) >= 3
    places = defaultdict(list)
    for part in set(packed["part"].to_pylist()):
        for r in suffixes._repeated(packed.filter(pc.equal(packed["part"], part))).to_pylist():
            places[r["key"]].append(r["places"])
    met = batch.append_column("places", pa.array([places[k] for k in keys], pa.list_(pa.binary())))
    got = {(r["key"], p + i) for b in suffixes._instances(iter([met])) for r in b.to_pylist()
           for p in (r["place"], *np.frombuffer(r["also"] or b"", np.int32)) for i in range(r["starts"])}
    count = defaultdict(int)
    for t in texts:
        for p in range(len(t) - 49):
            count[t[p:p + 50]] += 1
    for k, t in zip(keys, texts, strict=True):
        assert all((k, p) in got for p in range(len(t) - 49) if count[t[p:p + 50]] > 1)


def test_suffix_order():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 4):
        base = rng.integers(97, 97 + letters, 300).astype(np.uint8)
        parts = [base[a:a + n + 49] for a, n in zip(rng.integers(0, 200, 40), rng.integers(1, 27, 40), strict=True)]
        data, off = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        starts = np.concatenate([np.arange(off[i], off[i + 1] - 49) for i in range(len(parts))])
        order, same = suffixes.suffix_order(data, starts)
        got = [bytes(data[p:p + 50]) for p in order]
        assert sorted(order) == list(starts) and got == sorted(got)
        assert list(same) == [False, *(a == b for a, b in zip(got, got[1:], strict=False))]


def test_texts_move_once(spark):
    """The stored texts are joined without an exchange of theirs."""
    docs = spark.createDataFrame([(1, "a" * 60), (2, "b" * 60)], "doc_id long, text string")
    table = suffixes._bucketed(docs.selectExpr("unhex(hex(doc_id)) key", "text"), "key", 8)
    other = spark.range(5).selectExpr("unhex(hex(id)) key", "id").hint("merge")
    plan = table.join(other, "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key") == 1


# -- fill in the middle ---------------------------------------------------------

def test_middle_whole_table(spark, sf_dir, small_docs, rows_of):
    want = [(d["doc_id"], *R.middle(d["doc_id"], d["text"])) for d in small_docs]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert rows_of(QUERIES["op12_middle"](spark, sf_dir), *CUTS) == ordered(want)


def test_middle_edges(spark, edge_dir, rows_of):
    assert rows_of(QUERIES["op12_middle"](spark, edge_dir), *CUTS) == ordered((d[0], *R.middle(*d[:2])) for d in EDGE)


def test_middle_sentinels(spark, rows_of):
    """Sentinels within, across and beside texts; characters of all sizes."""
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["<", "P", "S", "M", ">", "é", "漢", "😀", "a"]) for _ in range(rng.randrange(12)))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = middle.restore(middle.fill_in_middle(docs)).collect()
    texts = dict(rows)
    assert all(r.restored == texts[r.doc_id] for r in out)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars) for r in out]
    assert sorted(got, key=lambda r: r[0]) == [(i, *R.middle(i, t)[:4]) for i, t in rows]


def test_restore_needs_only_output_and_form():
    data = np.frombuffer(b"<S>c<P>a<M>bplain<P>x<S><M>", np.uint8)
    form = np.array([middle.SPM, middle.PLAIN, middle.PSM])
    text, off = middle.gather(data, np.array([0, 12, 17, 27]), form)
    assert bytes(text) == b"abcplainx" and list(off) == [0, 3, 8, 9]


# -- conversations ----------------------------------------------------------------

def conversations_of(rows):
    out, damaged = {c: [] for c, *_ in rows}, R.damage(rows)
    for r in damaged:
        out[r[0]].append(r)
    for c, rs in out.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    return out


def test_repair_whole_table(spark, sf_dir, rows_of):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = [(c, *R.conversation(rs)) for c, rs in conversations_of(rows).items()]
    assert rows_of(QUERIES["op13_repair"](spark, sf_dir), "conv_id", *AUDIT) == ordered(want)


def test_repair_edges(spark, edge_dir, rows_of):
    want = [(c, *R.conversation(rs)) for c, rs in conversations_of(CONVERSATIONS).items()]
    assert any(w[-2] == "" for w in want) and {e for w in want for e in w[-2]} == set("DIKR")
    assert rows_of(QUERIES["op13_repair"](spark, edge_dir), "conv_id", *AUDIT) == ordered(want)


def test_cheapest_brute_force():
    """All short code strings, and long random ones."""
    fault, role = ["", "truncated", "blank"], ["s", "u", "a", "x"]
    rng = random.Random(5)
    cases = [[a, b, c] for a in range(12) for b in range(12) for c in range(12)]
    cases += [[rng.randrange(12) for _ in range(rng.randrange(4, 200))] for _ in range(200)]
    for codes in [[], *cases]:
        assert conversations.cheapest(bytes(codes)) == R.repair([fault[c // 4] for c in codes], [role[c % 4] for c in codes])


def test_repaired_turns(spark):
    """The turns that an audit gives, also for rows that were not damaged."""
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Why"), (1, 2, "user", "Why"), (2, 0, "user", "A."), (2, 1, "assistant", "B.")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = conversations.audits(docs)
    assert {r.conv_id: (r.audit, r.cost, r.truncated, r.duplicate) for r in found.collect()} == {1: ("IKDD", 8, 1, 1), 2: ("KK", 0, 0, 0)}
    turns = defaultdict(list)
    for r in conversations.repaired(docs, found).orderBy("conv_id", "seq").collect():
        turns[r.conv_id].append((r.seq, r.edit, r.role, r.text))
    assert turns == {1: [(0, "I", "user", ""), (1, "K", "assistant", "Hi.")], 2: [(0, "K", "user", "A."), (1, "K", "assistant", "B.")]}


def test_streamed_across_batches():
    """A conversation may go over any number of Arrow batches."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("fault", pa.int32()), ("initial", pa.int32())])
    rows = [(c, t, (c + t) % 4 if c else -1, (c * t) % 4) for c in range(6) for t in range(c * c + 1)]

    def run(size):
        parts = [rows[i:i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*p, strict=True), schema, strict=True)], schema=schema) for p in parts]
        return [x for b in conversations._auditor(pa.int64())(iter(batches)) for x in b.to_pylist()]
    assert run(1) == run(3) == run(1000) and len(run(7)) == 6
