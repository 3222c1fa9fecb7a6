"""Near-duplicates by SetSketch registers over word shingles.

A register holds ``floor(1 - log_b(least hash))`` of a document's shingles,
the hashes being exponential; registers of a union are the greater of the two
(``merge``), and registers of similar sets are equal with a probability near
their Jaccard similarity.  Bands of registers give candidates; a joint maximum
likelihood estimate over the registers that are greater, less and equal drops
those that are surely below the threshold; the rest are verified on the full
shingle sets of whole texts.

No bucket is paired with itself.  Texts with equal shingle sets are one class
from the start.  In each bucket every class is compared with one leader (a
different one in each bucket), and the verified links are contracted to
components.  Only where a bucket still holds several components are classes
of different components compared, in blocks inside the tasks, so a link that
no leader has shown is still found: sketch against sketch, and what the
estimate cannot rule out on the full sets.

Defined cases: a text with fewer words than a shingle is one shingle, its
whole sequence; a null text or one without words has none and is linked with
nothing; a null ``doc_id`` counts after all others (its component may have
no id); rows that repeat a ``doc_id`` are compared like any others; of equal
ids the first row is kept; texts of any length are compared whole; an empty
table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, mix, of_rows, span_hashes, spans, stored, text_slices, window_hashes
from .components import components

SHINGLE = 5
#: Links have 100 * intersection >= threshold * union; this one is op6's.
THRESHOLD = 85
#: Bands for THRESHOLD: a pair at it is in no common band with 2e-7.
BAND_ROWS, BANDS = 5, 26
REGISTERS = BAND_ROWS * BANDS
#: SetSketch parameters: base, rate, and the greatest register.
BASE, RATE, LIMIT = 1.02, 20.0, 65_535
#: A pair is ruled out when its best likelihood is e^SURE times that of any
#: similarity at or above the threshold.
SURE = 18.0
#: Classes of one bucket that are compared at once with as many others.  A
#: class is copied once for each block of its bucket.
BLOCK = 2048
#: Standard errors by which the number of equal registers may fall short.
SHORT = 9.0
#: Bytes of sets that a task compares at once, about.
PART_BYTES = 16 << 20
_rng = np.random.default_rng(85)
_MULTIPLY = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_CHUNK = 1 << 15


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text: values (by text) and offsets."""
    n = len(off) - 1
    data = LOWER[data]
    s, e, row = spans(data, off)
    word = span_hashes(data, s, e)
    h, at = window_hashes(word, row, SHINGLE)
    rows = row[at]
    each = np.bincount(row, minlength=n)
    short = np.flatnonzero((each > 0) & (each < SHINGLE))
    if len(short):
        first = np.searchsorted(row, short)
        got = each[short].astype(np.uint64)
        for k in range(SHINGLE - 1):
            here = each[short] > k
            got[here] = mix(got[here] * np.uint64(0x9E3779B97F4A7C15) + word[first[here] + k])
        h, rows = np.concatenate([h, got]), np.concatenate([rows, short])
    key = mix(h ^ mix(rows.astype(np.uint64)))
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    keep = np.sort(order[new])
    h, rows = h[keep], rows[keep]
    if len(short):
        order = np.argsort(rows, kind="stable")
        h, rows = h[order], rows[order]
    return h, np.searchsorted(rows, np.arange(n + 1))


def registers(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, REGISTERS) uint16; a text without shingles has zeros."""
    n = len(off) - 1
    least = np.full((REGISTERS, n), 2**32 - 1, np.uint64)
    rows = np.repeat(np.arange(n), np.diff(off))
    for i in range(0, len(h), _CHUNK):
        x, r = h[i:i + _CHUNK], rows[i:i + _CHUNK]
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        here = r[first]
        for k in range(REGISTERS):
            v = np.minimum.reduceat((x ^ _FLIP[k]) * _MULTIPLY[k] >> np.uint64(32), first)
            least[k, here] = np.minimum(least[k, here], v)
    u = (least.T + 0.5) / 2.0**32
    value = np.floor(1 - np.log(-np.log1p(-u) / RATE) / math.log(BASE))
    out = np.clip(value, 0, LIMIT).astype(np.uint16)
    out[np.diff(off) == 0] = 0
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


_GRID = np.concatenate([np.linspace(0, 0.8, 33), np.linspace(0.81, 1, 39)])


def _log_p(x):
    return np.log(np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE), 1e-12))


def likelihood(more, less, equal, n_a, n_b, threshold: float = THRESHOLD / 100):
    """Joint estimate: the similarity of greatest likelihood, and by how much
    its log likelihood exceeds that of any similarity at or above the
    threshold.  The sets' sizes are known."""
    n_a, n_b = np.asarray(n_a, float)[:, None], np.asarray(n_b, float)[:, None]
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    j = np.minimum(_GRID, np.minimum(u / v, v / u) * (1 - 1e-9))
    up, down = np.maximum(u - v * j, 0), np.maximum(v - u * j, 0)
    a, b = _log_p(up), _log_p(down)
    same = np.log(np.maximum(1 - np.exp(a) - np.exp(b), 1e-12))
    total = np.asarray(more)[:, None] * a + np.asarray(less)[:, None] * b + np.asarray(equal)[:, None] * same
    best = np.argmax(total, 1)
    high = np.where(_GRID >= threshold - 0.005, total, -np.inf).max(1)
    row = np.arange(len(total))
    return j[row, best], total[row, best] - high


def _possible(a: np.ndarray, b: np.ndarray, n_a, n_b, threshold: int) -> np.ndarray:
    n_a, n_b = np.asarray(n_a, np.int64), np.asarray(n_b, np.int64)
    ok = 100 * np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b)
    i = np.flatnonzero(ok)
    more, less = (a[i] > b[i]).sum(1), (a[i] < b[i]).sum(1)
    _, lead = likelihood(more, less, REGISTERS - more - less, n_a[i], n_b[i], threshold / 100)
    ok[i] = lead <= SURE
    return ok


def _sketch(batches):
    for rows, data, off in text_slices(batches):
        h, hoff = shingles(data, off)
        reg = registers(h, hoff)
        # 128 bits of the set, whatever its order
        finger = []
        for salt in (0x51, 0xA7):
            acc = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + np.uint64(salt)), dtype=np.uint64)])
            finger.append(acc[hoff[1:]] - acc[hoff[:-1]])
        n = np.diff(hoff)
        yield of_rows(rows, n=n.astype(np.int64), print_a=finger[0].view(np.int64), print_b=finger[1].view(np.int64),
                      registers=pa.array([x.tobytes() for x in reg], pa.binary()))


def _regs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, REGISTERS)


def _estimator(threshold: int):
    def estimate(batches):
        for b in batches:
            if b.num_rows:
                ok = _possible(_regs(b.column("ra").to_pylist()), _regs(b.column("rb").to_pylist()),
                               b.column("na").to_numpy(), b.column("nb").to_numpy(), threshold)
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))
    return estimate


def _linker(threshold: int):
    """Pairs of texts whose full shingle sets are similar enough."""
    def linked(batches):
        for batch in batches:
            step = 64
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                n = part.num_rows
                sets = []
                for c in ("ta", "tb"):
                    got = [shingles(data, off) for _, data, off in text_slices([part.select([c])], c, 1 << 62)]
                    sets.append(got[0])
                (h, ho), (g, go) = sets
                ra, rb = np.repeat(np.arange(n), np.diff(ho)), np.repeat(np.arange(n), np.diff(go))
                key = np.concatenate([mix(h ^ mix(ra.astype(np.uint64))), mix(g ^ mix(rb.astype(np.uint64)))])
                row = np.concatenate([ra, rb])
                order = np.argsort(key)
                twice = key[order[1:]] == key[order[:-1]]
                both = np.bincount(row[order[1:]][twice], minlength=n)
                union = np.diff(ho) + np.diff(go) - both
                ok = (union > 0) & (100 * both >= threshold * union)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(ok))
    return linked


def _sets(batches):
    for rows, data, off in text_slices(batches):
        h, hoff = shingles(data, off)
        yield of_rows(rows, shingles=pa.array([h[a:b].tobytes() for a, b in zip(hoff[:-1], hoff[1:], strict=True)], pa.binary()))


def fewest_equal(threshold: int) -> int:
    """Equal registers that a pair at the threshold has at least: each is equal
    with a probability of the similarity or more."""
    share = threshold / 100
    return max(0, int(REGISTERS * share - SHORT * math.sqrt(REGISTERS * share * (1 - share))))


def _crosser(threshold: int):
    """Links between classes of one bucket and different components: those
    that the sketches cannot rule out are confirmed on the full sets.  One
    link from a class to a component is enough."""
    fewest = fewest_equal(threshold)

    def across(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        rows = rows.sort_values(["key", "lo", "hi", "cid"], kind="stable")
        reg = _regs(rows["registers"])
        cid, root, n, block, packed = (rows[c].to_numpy() for c in ("cid", "root", "n", "block", "shingles"))
        bound = rows[["key", "lo", "hi"]].to_numpy()
        cuts = np.flatnonzero(np.r_[True, (bound[1:] != bound[:-1]).any(1), True])
        lo, hi = bound[:, 1], bound[:, 2]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            left = np.arange(s, e)[block[s:e] == lo[s]]
            right = np.arange(s, e)[block[s:e] == hi[s]]
            place = None
            for i in left:
                js = right[(root[right] != root[i]) & ((cid[right] > cid[i]) if hi[s] == lo[s] else True)]
                js = js[(reg[js] == reg[i]).sum(1) >= fewest]
                if len(js):
                    js = js[_possible(np.broadcast_to(reg[i], (len(js), REGISTERS)), reg[js], np.full(len(js), n[i]), n[js], threshold)]
                if not len(js):
                    continue
                if place is None:  # the bucket's shingles, numbered
                    flat = np.concatenate([np.frombuffer(x, np.uint64) for x in packed[s:e]])
                    off = np.concatenate([[0], np.cumsum(n[s:e])])
                    different, place = np.unique(flat, return_inverse=True)
                    mark = np.zeros(len(different), bool)
                own = place[off[i - s]:off[i - s + 1]]
                mark[own] = True
                both = np.array([np.count_nonzero(mark[place[off[j]:off[j + 1]]]) for j in js - s])
                mark[own] = False
                js = js[100 * both >= threshold * (n[i] + n[js] - both)]
                js = js[np.unique(root[js], return_index=True)[1]]
                a.append(np.full(len(js), cid[i]))
                b.append(cid[js])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
        return pd.DataFrame({"a": a, "b": b})
    return across


def _verified(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    ta = texts.select(F.col("cid").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("cid").alias("b"), F.col("text").alias("tb"))
    return stored(pairs.join(ta, "a").join(tb, "b").mapInArrow(_linker(threshold), "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, rid: str | None = None, threshold: int = THRESHOLD,
                    band_rows: int = BAND_ROWS, bands: int = BANDS) -> DataFrame:
    """One row per document: doc_id, text_hash, rid (a number of the row, or
    the column given), n_shingles, component_id and keeper (the rid of the one
    row of its component to keep).  Candidates share one of ``bands`` bands of
    ``band_rows`` registers, at most REGISTERS in all; a lower threshold (in
    percent) takes shorter or more of them."""
    if band_rows * bands > REGISTERS:
        raise ValueError(f"more than {REGISTERS} registers in bands")
    kind = docs.schema["doc_id"].dataType.simpleString()
    number = F.col(rid) if rid else F.monotonically_increasing_id()
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), *([rid] if rid else [])).withColumn("text_hash", F.xxhash64("text"))
    sketch = source.select("doc_id", "text", "text_hash", number.cast("long").alias("rid")).mapInArrow(
        _sketch, f"doc_id {kind}, text_hash long, rid long, n long, print_a long, print_b long, registers binary")
    sketch = stored(sketch, "near-sketch")

    # classes of equal sets; the first row (by id) stands for the class
    by = ["n", "print_a", "print_b"]
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    classes = sketch.where("n > 0").groupBy(*by).agg(F.min(order).alias("_first"))
    classes = classes.select(*by, F.col("_first.doc_id").alias("class_id"), F.col("_first.rid").alias("cid"))
    rows = stored(sketch.where("n > 0").join(classes, by).drop("print_a", "print_b"), "near-rows")
    reps = rows.where("rid = cid").select("cid", "doc_id", "text_hash", "n", "registers")

    # buckets with more than one class
    width = 2 * band_rows
    band = F.array(*(F.xxhash64(F.substring("registers", width * k + 1, width), F.lit(k)) for k in range(bands)))
    keys = reps.select("cid", F.explode(band).alias("key"))
    lead = keys.groupBy("key").agg(F.min_by("cid", F.xxhash64("cid", "key")).alias("leader"), F.count(F.lit(1)).alias("size"))
    buckets = stored(keys.join(lead.where("size > 1"), "key"), "near-buckets")

    some = reps.select("cid", "n", "registers")
    pairs = buckets.where("cid <> leader").select(F.least("cid", "leader").alias("a"), F.greatest("cid", "leader").alias("b")).distinct()
    both = pairs.join(some.toDF("a", "na", "ra"), "a").join(some.toDF("b", "nb", "rb"), "b")
    pairs = stored(both.mapInArrow(_estimator(threshold), "a long, b long"), "near-pairs")

    need = buckets.select("cid").distinct().join(reps.select("cid", F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")), "cid")
    texts = stored(source.join(need, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")))
                   .select("cid", "text"), "near-texts")
    links = _verified(pairs, texts, threshold)
    roots = components(links)

    # buckets that still hold several components, one of those with the same
    # classes
    rooted = buckets.where("size > 2").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    mixed = rooted.groupBy("key").agg(
        F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.count(F.lit(1)).alias("_n"),
        F.bit_xor(F.xxhash64("cid")).alias("_x"), F.bit_xor(F.xxhash64("cid", F.lit(7))).alias("_y"))
    mixed = mixed.where("_lo < _hi").groupBy("_n", "_x", "_y").agg(F.min("key").alias("key")).select("key")
    open_ = rooted.join(mixed, "key").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("long"))
    open_ = open_.withColumn("block", F.pmod(F.xxhash64("cid", F.lit(1)), "blocks"))
    open_ = stored(open_.join(some, "cid").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "cid", "root", "n", "registers", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")), "near-open")
    size = open_.agg(F.coalesce(F.sum(8 * F.col("n") + 2 * REGISTERS), F.lit(0))).first()[0]
    sets = texts.join(open_.select("cid").distinct(), "cid", "left_semi").mapInArrow(_sets, "cid long, shingles binary")
    # as many tasks as the sets need, whatever the session's number
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + size // PART_BYTES)
    dealt = open_.join(sets, "cid").withColumn("part", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(parts))).repartition(parts, "part")
    more = stored(dealt.groupBy("part").applyInPandas(_crosser(threshold), "a long, b long").distinct(), "near-links")

    # links between the components so far
    r = roots.withColumnRenamed("root", "_r")
    more = more.join(r.toDF("a", "ra"), "a", "left").join(r.toDF("b", "rb"), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    joined = components(more)
    node = roots.unionByName(more.select(F.col("a").alias("node"), F.col("a").alias("root"))
                             .unionByName(more.select(F.col("b").alias("node"), F.col("b").alias("root")))).distinct()
    node = node.groupBy("node").agg(F.min("root").alias("root"))
    final = node.join(joined.toDF("_n", "_r"), F.col("root") == F.col("_n"), "left").select(
        F.col("node").alias("cid"), F.coalesce("_r", "root").alias("root"))
    final = final.join(rows.where("rid = cid").select("cid", "class_id"), "cid")
    first = final.groupBy("root").agg(F.min(F.struct(F.col("class_id").isNull(), "class_id", "cid")).alias("_m"))
    named = stored(final.join(first, "root").select("cid", F.col("_m.class_id").alias("_c"), F.col("_m.cid").alias("_k")), "near-named")

    out = rows.join(named, "cid", "left").select(
        "doc_id", "text_hash", "rid", F.col("n").alias("n_shingles"),
        F.when(F.col("_k").isNull(), F.col("class_id")).otherwise(F.col("_c")).alias("component_id"),
        F.coalesce("_k", "cid").alias("keeper"))
    empty = sketch.where("n = 0").select("doc_id", "text_hash", "rid", F.lit(0).cast("long").alias("n_shingles"),
                                         F.col("doc_id").alias("component_id"), F.col("rid").alias("keeper"))
    return out.unionByName(empty)


def op6_setsketch(spark, sf_dir):
    """Component of every document."""
    rows = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
