"""Language identification by error-correcting output codes.

Each language has a codeword; one logistic classifier over hashed character
n-grams predicts each bit.  Decoding takes the codeword of least loss, each
bit weighted by how reliable it was in training; a close second place flags
the document as ambiguous.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
a null label is never learned; one known language is always predicted; with
none, as in an empty table, all are ``und``.  Equal losses go to the language
first in code point order.  Repeated rows are predicted alike; texts of any
length are read whole.  Only ``doc_id``, ``text`` and
``lang`` (for training) are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_limit, of_rows, text_slices
from .ngrams import code_points, grams, squeezed, tables

BITS = 12
ORDERS = (1, 2, 3)
#: Bound of the training sample: documents in all, and at least so many for
#: each language (chosen by a hash of id and text, so that rows that share an
#: id, or have none, are not all in or out).  Everything else covers all rows.
SAMPLE_DOCS = 4000
SAMPLE_LEAST = 40
#: Characters of the short piece that each sampled document adds.
PIECE = 40
AMBIGUOUS = 0.1
SEED = 5
_ROWS = 512
UNKNOWN = "und"


def vectors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, 2^BITS) square roots of n-gram shares, and the letters' count."""
    low, letter = tables()
    codes, off = code_points(data, off)
    keep = letter[codes]
    acc = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=acc[1:])
    letters = acc[off[1:]] - acc[off[:-1]]
    codes, off = squeezed(low[codes], off, keep)
    g = grams(codes, off, ORDERS, BITS)
    n, row = len(off) - 1, np.repeat(np.arange(len(off) - 1), np.diff(off))
    out = np.zeros(n << BITS)
    for k in range(len(ORDERS)):
        ok = g[:, k] >= 0
        each = np.bincount(row[ok], minlength=n)
        share = np.bincount((row[ok] << BITS) + g[ok, k], minlength=n << BITS)
        out += np.sqrt(share / np.repeat(np.maximum(each, 1), 1 << BITS))
    return out.reshape(n, -1).astype(np.float32), letters


def _chunks(batches):
    for rows, data, off in text_slices(batches):
        for i in range(0, rows.num_rows, _ROWS):
            j = min(i + _ROWS, rows.num_rows)
            yield rows.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]


def _pieces(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A short piece of each text, from a place that its hash names."""
    out = []
    for text, h in zip(rows.column("text").to_pylist(), rows.column("h").to_pylist(), strict=True):
        text = text or ""
        at = h % max(1, len(text) - PIECE)
        out.append(text[at:at + PIECE].encode())
    return np.frombuffer(b"".join(out), np.uint8), np.cumsum([0, *map(len, out)])


def _sample_vectors(batches):
    for rows, data, off in _chunks(batches):
        both = [vectors(data, off)[0], vectors(*_pieces(rows))[0]]
        yield pa.RecordBatch.from_arrays(
            [rows.column("lang"), rows.column("h"), *(pa.array([x.tobytes() for x in v.astype(np.float16)], pa.binary()) for v in both)],
            ["lang", "h", "whole", "piece"])


def codebook(k: int) -> np.ndarray:
    """(languages, bits) of +1 and -1.  Up to seven languages: every split in
    two.  More: the best by least distance of 64 seeded random codes."""
    if k <= 7:
        n = 2 ** (k - 1) - 1
        return np.array([[1 if i == 0 or (b + 1) >> (i - 1) & 1 == 0 else -1 for b in range(n)] for i in range(k)]).reshape(k, n)
    rng, best, most = np.random.default_rng(SEED), None, -1
    n = max(15, int(np.ceil(8 * np.log2(k))))
    for _ in range(64):
        code = rng.choice([-1, 1], (k, n))
        split = np.abs(code.sum(0)) < k
        gram = code @ code.T
        np.fill_diagonal(gram, -n)
        least = (n - gram.max()) // 2 if split.all() else -1
        if least > most:
            best, most = code, least
    return best


def fit(x: np.ndarray, y: np.ndarray, code: np.ndarray, steps: int = 120, ridge: float = 1e-5):
    """Weights of one logistic classifier per bit, and each bit's reliability."""
    t = ((code[y] + 1) / 2).astype(np.float32)
    n, d = x.shape
    w, b = np.zeros((d, t.shape[1]), np.float32), np.zeros(t.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = (1 / np.bincount(y, minlength=len(code))[y]).astype(np.float32)
    weight /= weight.sum()
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = (p - t) * weight[:, None]
        grad = x.T @ g + ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
        b -= 2 * g.sum(0)
    wrong = (weight[:, None] * (((x @ w + b) > 0) != (t > 0.5))).sum(0)
    wrong = np.clip(wrong, 1e-3, 0.49)
    return w, b, np.log((1 - wrong) / wrong)


def _fitter(index: dict, code: np.ndarray):
    """One task fits the classifiers from the sample's vectors, whose number
    is bounded; only the weights leave it."""
    def learn(batches):
        parts = []
        for b in batches:
            for i in range(0, b.num_rows, _ROWS):
                p = b.slice(i, _ROWS)
                x = [np.frombuffer(b"".join(p.column(c).to_pylist()), np.float16).reshape(p.num_rows, -1) for c in ("whole", "piece")]
                parts.append((p.column("lang").to_pylist(), p.column("h").to_numpy(), *x))
        if not parts:
            return
        y = np.array([index[lang] for p in parts for lang in p[0]])
        n = len(y)
        order = np.lexsort((np.concatenate([p[1] for p in parts]), y))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        x = np.empty((2 * n, 1 << BITS), np.float32)
        at = 0
        for _, _, whole, piece in parts:
            rows = place[at:at + len(whole)]
            x[rows], x[n + rows] = whole, piece
            at += len(whole)
        parts.clear()
        w, b, trust = fit(x, np.concatenate([y[order], y[order]]), code)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (w, b, trust.astype(np.float64))], ["w", "b", "trust"])
    return learn


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Model from the rows of ``docs`` (doc_id, text, lang) with a label."""
    known = docs.where("lang IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id").cast("string"), F.col("text").cast("string")), 1).alias("h"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return {"langs": []}
    share = max(SAMPLE_LEAST, sample_docs // len(langs))
    rule = F.lit(False)
    for lang in langs:
        rule = rule | (F.col("lang") == lang) & (F.col("h") <= hash_limit(share / counts[lang]))
    code = codebook(len(langs))
    if len(langs) == 1:
        return {"langs": langs}
    sample = known.where(rule).mapInArrow(_sample_vectors, "lang string, h long, whole binary, piece binary")
    model = sample.repartition(1).mapInArrow(_fitter({c: i for i, c in enumerate(langs)}, code), "w binary, b binary, trust binary").first()
    bits = code.shape[1]
    return {"langs": langs, "code": code, "w": np.frombuffer(model.w, np.float32).reshape(-1, bits).copy(),
            "b": np.frombuffer(model.b, np.float32).copy(), "trust": np.frombuffer(model.trust, np.float64).copy()}


def decode(margins: np.ndarray, code: np.ndarray, trust: np.ndarray):
    """Best language, its score and its lead over the second, per row."""
    loss = np.stack([(trust * np.logaddexp(0, -margins * c)).sum(1) for c in code], 1)
    order = np.argsort(loss, 1, kind="stable")
    best = loss[np.arange(len(loss)), order[:, 0]]
    second = loss[np.arange(len(loss)), order[:, 1]]
    p = 1 / np.exp(best[:, None] - loss).sum(1)
    return order[:, 0], np.clip(p, 0, 1), (second - best) / trust.sum()


def _predictor(shared, keep_text: bool):
    def predict(batches):
        model = shared.value
        langs = np.array([*model["langs"], UNKNOWN], object)
        for rows, data, off in _chunks(batches):
            x, letters = vectors(data, off)
            n = rows.num_rows
            if len(langs) <= 2:
                which, score, lead = np.zeros(n, int), np.full(n, float(len(langs) - 1)), np.ones(n)
            else:
                which, score, lead = decode(x @ model["w"] + model["b"], model["code"], model["trust"])
            unknown = letters == 0
            which = np.where(unknown, len(langs) - 1, which)
            text = {"text": rows.column("text")} if keep_text else {}
            yield of_rows(rows, **text, lang_pred=pa.array(langs[which], pa.string()), score=np.where(unknown, 0.0, score),
                          ambiguous=~unknown & (lead < AMBIGUOUS))
    return predict


def identify(docs: DataFrame, model: dict, columns=("doc_id",), keep_text: bool = False) -> DataFrame:
    """``columns`` (and the text) of every row, with lang_pred, score and
    ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS weights a bit
    rows = docs.select(*columns, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    text = ", text string" if keep_text else ""
    return rows.mapInArrow(_predictor(shared, keep_text), f"{kinds}{text}, lang_pred string, score double, ambiguous boolean")


def held_out(folds: int, fold: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def op9_language_id(spark, sf_dir):
    """Language of every document, learned without fold 0 of 5."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out(5, 0)))
    return identify(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score", "ambiguous")
