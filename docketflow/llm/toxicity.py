"""Toxicity: a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios.

Defined cases: a null or empty text has no n-grams and gets the score of the
intercept; labels that are null or belong to no document teach nothing; a
document with several labels teaches each of them; with labels of one class
or none the score is that class's share (0 without labels); repeated rows are
scored alike; a score of just the threshold is predicted 1; texts of any length
are read whole; an empty table gives an empty result.  Only ``doc_id`` and
``text`` of the documents and ``doc_id`` and ``toxic`` of the labels are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, hash_limit, of_rows, stored, text_slices
from .langid import held_out
from .ngrams import code_points, grams, squeezed, tables

BITS = 18
ORDERS = (3, 4, 5)
#: Bound of the training sample: labelled documents of each class.
SAMPLE_EACH = 4000
THRESHOLD = 0.7
#: An n-gram counts when its log-likelihood ratio against equal shares is that
#: of so many standard errors.
LEAST_Z = 4.0
SEED = 11


def present(data: np.ndarray, off: np.ndarray):
    """Hashed n-grams of each text, each once: values and offsets."""
    low, _ = tables()
    codes, coff = code_points(data, off)
    blank = codes < 256
    blank[blank] = SPACE[codes[blank]]
    codes, coff = squeezed(low[codes], coff, ~blank)
    g = grams(codes, coff, ORDERS, BITS).ravel()
    goff = coff * len(ORDERS)
    g = np.where(g < 0, 1 << BITS, g)  # n-grams beyond the end share a slot that is dropped
    index = np.arange(len(g), dtype=np.int32)
    slot = np.empty((1 << BITS) + 1, np.int32)
    keep = np.zeros(len(g), bool)
    for a, b in zip(goff[:-1].tolist(), goff[1:].tolist(), strict=True):
        x = g[a:b]
        slot[x] = index[a:b]
        keep[a:b] = slot[x] == index[a:b]
    keep &= g < (1 << BITS)
    at = np.flatnonzero(keep)
    return g[at], np.searchsorted(at, goff)


def _sample_grams(batches):
    for rows, data, off in text_slices(batches):
        g, goff = present(data, off)
        each = [g[a:b].tobytes() for a, b in zip(goff[:-1], goff[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column("toxic"), rows.column("h"), pa.array(each, pa.binary())],
                                         ["toxic", "h", "grams"])


def _count_grams(batches):
    """How many toxic and other texts of the sample hold each n-gram."""
    total = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for toxic, g in zip(batch.column("toxic").to_pylist(), batch.column("grams").to_pylist(), strict=True):
            total[toxic, np.frombuffer(g, np.int32)] += 1
    seen = np.flatnonzero(total.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[1, seen]), pa.array(total[0, seen])], ["gram", "pos", "neg"])


def evidence(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Twice the log-likelihood ratio of two shares against one, of each
    n-gram (the square of its standard errors).  It holds at zero counts,
    where a Wald error is at least 1 however large the sample is."""
    def f(k, n):
        return k * np.log(np.maximum(k, 1e-12) / n) + (n - k) * np.log(np.maximum(n - k, 1e-12) / n)

    pos, neg = np.asarray(pos, float), np.asarray(neg, float)
    return 2 * (f(pos, n_pos) + f(neg, n_neg) - f(pos + neg, n_pos + n_neg))


def ratios(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Log of the ratio of the smoothed shares of toxic and other texts that
    hold each n-gram.  Ratios that chance explains (see LEAST_Z) are dropped:
    a long text holds nearly all common n-grams, whose noise would add up."""
    r = np.log((pos + 1.0) / (n_pos + 2.0)) - np.log((neg + 1.0) / (n_neg + 2.0))
    r[evidence(pos, neg, n_pos, n_neg) < LEAST_Z ** 2] = 0
    return r


def _only(shared):
    def run(batches):
        use = shared.value
        for batch in batches:
            each = (np.frombuffer(g, np.int32) for g in batch.column("grams").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("h"), pa.array([g[use[g]].tobytes() for g in each], pa.binary())],
                                             ["toxic", "h", "grams"])
    return run


def fit(g: np.ndarray, off: np.ndarray, y: np.ndarray, r: np.ndarray, steps: int = 300, ridge: float = 2e-4):
    """Weights per n-gram and intercept of a logistic regression over the
    n-grams with a ratio, each scaled by it."""
    d, n = len(r), len(y)
    row = np.repeat(np.arange(n), np.diff(off))
    x = r[g].astype(np.float32)
    v, b, m, s = np.zeros(d), 0.0, np.zeros(d), np.zeros(d)
    for step in range(1, steps + 1):
        z = np.bincount(row, weights=x * v[g], minlength=n) + b
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        grad = np.bincount(g, weights=x * e[row], minlength=d) + ridge * v
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        v -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)
        b -= 2.0 * e.sum()
    return (v * r).astype(np.float32), float(b)


def train(docs: DataFrame, labels: DataFrame, sample_each: int = SAMPLE_EACH):
    """(weights or None, intercept) from labelled rows."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"),
        F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id").cast("string")), 1).alias("h"))
    counts = {r["toxic"]: r["count"] for r in known.where("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    if len(counts) < 2:
        share = 1.0 if 1 in counts else 0.0
        return None, share
    rule = F.lit(False)
    for c, n in counts.items():
        rule = rule | (F.col("toxic") == c) & (F.col("h") <= hash_limit(sample_each / n))
    # the sample is bounded by sample_each, so it can be broadcast
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known.where(rule)), "doc_id")
    # the sample stays on the executors: the driver gets a count per n-gram,
    # then only the n-grams that tell the classes apart
    sample = stored(rows.select("toxic", "h", "text").mapInArrow(_sample_grams, "toxic int, h long, grams binary"), "toxic-sample")
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return None, float(next(iter(size), 0))
    count = (sample.mapInArrow(_count_grams, "gram long, pos long, neg long").groupBy("gram")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toPandas())
    total = np.zeros((2, 1 << BITS), np.int64)
    for i, c in enumerate(("pos", "neg")):
        total[i, count["gram"].to_numpy()] = count[c].to_numpy()
    r = ratios(*total, size[1], size[0])
    use = docs.sparkSession.sparkContext.broadcast(r != 0)
    got = sample.mapInArrow(_only(use), "toxic int, h long, grams binary").toPandas()
    got = got.sort_values(["toxic", "h"], kind="stable")
    off = np.cumsum([0, *(len(x) // 4 for x in got["grams"])])
    return fit(np.frombuffer(b"".join(got["grams"]), np.int32), off, got["toxic"].to_numpy(), r)


def _scorer(shared):
    def score(batches):
        weights, bias = shared.value
        for rows, data, off in text_slices(batches):
            if weights is None:
                p = np.full(rows.num_rows, bias)
            else:
                g, goff = present(data, off)
                acc = np.zeros(len(g) + 1)
                np.cumsum(weights[g], dtype=np.float64, out=acc[1:])
                p = 1 / (1 + np.exp(-np.clip(acc[goff[1:]] - acc[goff[:-1]] + bias, -500, 500)))
            yield of_rows(rows, score=p, predicted=(p >= THRESHOLD).astype(np.int32))
    return score


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS weights
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scorer(shared), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def op1_toxicity(spark, sf_dir):
    """Score of every document, learned without fold 1 of 3."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.where(~held_out(3, 1)))
    return score(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")
