"""Language-model scores from Brown classes.

Exchange clustering puts words into classes so that class bigrams are as
likely as can be; class transitions and word emissions then give smoothed
log probabilities of whole texts.

The words' counts come from all training texts, in one shuffle.  Clustering
has a seed and passes over the corpus.  The seed puts the most frequent words
one by one, and all others by their shape (length, kind of first character,
closing mark), into classes.  Each pass then counts, for every one of the HEAD
most frequent words and for every form of the others (shape and last letters),
the classes on its left and right in all texts, and moves it to the class of
the greatest gain; the counts stay on the executors, where each word's are
summed and its class is chosen.  A pass that does not make the class bigrams
likelier is not kept.  The last pass needs class bigrams only, which are
counted in the texts.  A word seen once or twice goes with its form.

Counts and classes of the HEAD most frequent words, a fixed bound, go to all
tasks; every other token meets its count in a join on the word, in which no
key can be hot because the frequent words are not in it.

Words are told apart by 64-bit hashes.

Defined cases: a null or empty text is its end token alone; without training
texts, as in an empty table, all counts are zero; repeated rows are scored
each; a null ``doc_id`` is a training row; texts of any length are read whole;
of classes with equal gain the first holds.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, of_rows, span_hashes, spans, stored, text_slices
from .langid import held_out

#: Words whose counts every task holds, at most.
HEAD = 65_536
#: Times that such a word must occur; a rarer one tells less about its
#: neighbours than its form does.
OFTEN = 3
#: Words that the seed clusters one by one, at most.
SEEDS = 800
CLASSES = 64
ROUNDS = 8
#: Passes over the corpus that move words and forms to better classes.
PASSES = 2
#: Strength of the class unigram in the smoothed transitions.
BACKOFF = 4.0
#: Different words that a task counts before it hands them on.
_HELD = 1_500_000

#: First bits of a hash that frequent words are looked up by.
_PREFIX = 18

_LENGTHS, _FIRST, _LAST = 12, 4, 3
SHAPES = _LENGTHS * _FIRST * _LAST
#: Forms of each shape, by a hash of the last three bytes.
_ENDINGS = 128
FORMS = SHAPES * _ENDINGS
_FIRST_KIND = np.full(256, 2, np.uint8)
_FIRST_KIND[0x61:0x7B] = 0
_FIRST_KIND[0x80:] = 1
_FIRST_KIND[0x30:0x3A] = 3
_LAST_KIND = np.full(256, 2, np.uint8)
_LAST_KIND[0x61:0x7B] = 0
_LAST_KIND[0x80:] = 0
_LAST_KIND[0x30:0x3A] = 0
_LAST_KIND[0x2E] = 1


def tokens(data: np.ndarray, off: np.ndarray):
    """Hash, form and row of each word; ``form // _ENDINGS`` is its shape."""
    data = LOWER[data]
    s, e, row = spans(data, off)
    if not len(s):
        return np.empty(0, np.uint64), s, row
    length = np.minimum(e - s, _LENGTHS) - 1
    shape = (length * _FIRST + _FIRST_KIND[data[s]]) * _LAST + _LAST_KIND[data[e - 1]]
    back = [np.where(e - s > k, data[np.maximum(e - 1 - k, 0)], 0).astype(np.uint32) for k in range(3)]
    ending = ((back[0] | back[1] << np.uint32(8) | back[2] << np.uint32(16)) * np.uint32(0x9E3779B1)) >> np.uint32(25)
    return span_hashes(data, s, e), shape * _ENDINGS + ending.astype(np.int64), row


def _merged(h, form, n):
    order = np.argsort(h)
    h, form, n = h[order], form[order], n[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
    return h[first], form[first], np.add.reduceat(n, first) if len(h) else n


def _count_words(batches):
    held, size = [], 0

    def out():
        return _merged(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def rows(h, form, n):
        for i in range(0, len(h), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(h[i:i + 65_536].view(np.int64)), pa.array(form[i:i + 65_536].astype(np.int32)),
                                              pa.array(n[i:i + 65_536])], ["h", "form", "n"])

    for _, data, off in text_slices(batches):
        h, form, _ = tokens(data, off)
        held.append(_merged(h, form, np.ones(len(h), np.int64)))
        size += len(held[-1][0])
        if size > _HELD:
            h, form, n = out()
            if len(h) > _HELD // 2:
                yield from rows(h, form, n)
                held, size = [], 0
            else:
                held, size = [(h, form, n)], len(h)
    if held:
        yield from rows(*out())


def word_counts(docs: DataFrame) -> DataFrame:
    """h, form and n of every word of ``docs``."""
    got = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_words, "h long, form int, n long")
    return stored(got.groupBy("h", "form").agg(F.sum("n").alias("n")), "brown-words")


def _most(counts: DataFrame, limit: int):
    """The words of the greatest counts, at most ``limit``: those at or above
    the least count that at most ``limit`` words reach."""
    spectrum = counts.groupBy("n").count().toPandas().sort_values("n", ascending=False)
    fits = spectrum[spectrum["count"].cumsum() <= limit]
    if not len(fits):
        return counts.limit(0).toPandas()
    return counts.where(F.col("n") >= int(fits["n"].min())).toPandas().sort_values(["n", "h"], ascending=[False, True])


def _items(h, form, words: np.ndarray):
    """Item of each token for the seed: a seed word's place, or its shape."""
    shape = form // _ENDINGS
    if not len(words):
        return shape
    at = np.minimum(np.searchsorted(words, h), len(words) - 1)
    return np.where(words[at] == h, SHAPES + at, shape)


def _starts(head: np.ndarray) -> np.ndarray:
    """How many of the sorted ``head`` are below each value of a hash's first
    bits: the first place where a word that begins so can stand."""
    return np.searchsorted(head, np.arange(1 << _PREFIX, dtype=np.uint64) << np.uint64(64 - _PREFIX)).astype(np.int32)


def _placed(h, form, head: np.ndarray, starts: np.ndarray):
    """Place of each token among forms and frequent words, and whether it is
    one of the latter."""
    if not len(head):
        return form, np.zeros(len(h), bool)
    last = len(head) - 1
    at = np.minimum(starts[h >> np.uint64(64 - _PREFIX)], last)
    # hashes are spread evenly, so few words begin alike
    behind = np.flatnonzero(head[at] < h)
    while len(behind):
        at[behind] += 1
        behind = behind[at[behind] <= last]
        behind = behind[head[at[behind]] < h[behind]]
    at = np.minimum(at, last)
    known = head[at] == h
    return np.where(known, FORMS + at, form), known


def _sequences(item, row, n_rows: int, end: int):
    """(before, after, row of after) of each bigram, with the end item before
    the first and after the last token of a text."""
    each = np.bincount(row, minlength=n_rows)
    full = np.full(len(item) + n_rows, end, np.int64)
    full[np.arange(len(item)) + row] = item
    rows = np.repeat(np.arange(n_rows), each + 1)
    before = np.empty_like(full)
    before[1:] = full[:-1]
    before[0] = end
    return before, full, rows


def _count_pairs(shared):
    def run(batches):
        words, m = shared.value
        total = np.zeros(m * m, np.int64)
        for rows, data, off in text_slices(batches):
            h, form, row = tokens(data, off)
            a, b, _ = _sequences(_items(h, form, words), row, rows.num_rows, m - 1)
            total += np.bincount(a * m + b, minlength=m * m)
        cell = np.flatnonzero(total)
        for i in range(0, len(cell), 65_536):
            c = cell[i:i + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(total[c])], ["cell", "n"])
    return run


def _f(x):
    return x * np.log(np.maximum(x, 1e-12))


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the class bigrams, up to what no class changes."""
    return float(_f(table).sum() - _f(table.sum(1)).sum() - _f(table.sum(0)).sum())


def gains(table: np.ndarray, right: np.ndarray, left: np.ndarray, own: float) -> np.ndarray:
    """What the log likelihood of the class bigrams ``table`` gains if an item
    that is not in it joins each class: ``right`` and ``left`` are its bigrams
    with the classes behind and before it, ``own`` those with itself."""
    base = _f(table)
    gain = (_f(table + right) - base).sum(1) + (_f(table.T + left) - base.T).sum(1)
    d = np.diag(table)
    gain += _f(d + right + left + own) - _f(d) - (_f(d + right) - _f(d)) - (_f(d + left) - _f(d))
    # sums of rows and columns, which have the item's bigrams with other
    # classes wherever it goes
    out, into = table.sum(1) + left, table.sum(0) + right
    gain -= _f(out + right.sum() + own) - _f(out) + _f(into + left.sum() + own) - _f(into)
    return gain


def _without(table, old: int, right, left, own):
    """The table and the item's bigrams, without the item in its class."""
    table[old] -= right
    table[:, old] -= left
    table[old, old] += own
    right[old] -= own
    left[old] -= own


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each item; the last item (a text's end) has a class of its
    own.  Each item in turn goes to the class that makes the class bigrams
    likeliest, until none moves."""
    m = len(pairs)
    pairs = pairs.astype(np.float64)
    weight = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-weight[:-1], kind="stable")
    order = order[weight[order] > 0]
    k = max(1, min(classes - 1, len(order)))
    of = np.zeros(m, np.int64)
    of[order] = np.arange(len(order)) % k
    of[-1] = k
    member = np.zeros((m, k + 1))
    member[np.arange(m), of] = 1
    table = member.T @ pairs @ member
    for _ in range(rounds):
        moved = 0
        for w in order.tolist():
            old = of[w]
            right, left, own = pairs[w] @ member, pairs[:, w] @ member, pairs[w, w]
            _without(table, old, right, left, own)
            gain = gains(table, right, left, own)
            new = int(np.argmax(gain[:k]))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            table[new] += right
            table[:, new] += left
            table[new, new] += own
            if new != old:
                member[w, old], member[w, new] = 0, 1
                of[w] = new
                moved += 1
        if not moved:
            break
    return of


def _count_sides(shared):
    """Per frequent word or form the classes before and behind it, and how
    often it stands beside itself: counts of a whole task, then one row an
    item."""
    def run(batches):
        head, of, k = shared.value
        starts, width, end = _starts(head), 2 * k + 1, len(of) - 1
        # one of the counts' own type: with another, numpy takes a slow path
        total, one = np.zeros(len(of) * width, np.int32), np.int32(1)
        for rows, data, off in text_slices(batches):
            h, form, row = tokens(data, off)
            a, b, _ = _sequences(_placed(h, form, head, starts)[0], row, rows.num_rows, end)
            np.add.at(total, b * width + of[a], one)
            np.add.at(total, a * width + k + of[b], one)
            np.add.at(total, a[a == b] * width + 2 * k, one)
        cell = np.flatnonzero(total)
        item, n = cell // width, total[cell]
        cuts = np.flatnonzero(np.r_[True, item[1:] != item[:-1], True]) if len(cell) else np.zeros(1, np.int64)
        cell = (cell % width).astype(np.uint16)
        for i in range(0, len(cuts) - 1, 8192):
            edge = cuts[i:i + 8193]
            yield pa.RecordBatch.from_arrays(
                [pa.array(item[edge[:-1]].astype(np.int32)), pa.array([cell[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:], strict=True)], pa.binary()),
                 pa.array([n[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:], strict=True)], pa.binary())], ["item", "cells", "counts"])
    return run


def _lists(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of the byte strings of ``column``, and how many each has."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    size = np.dtype(kind).itemsize
    return data.view(kind) if off[0] % size == 0 else np.frombuffer(data.tobytes(), kind), np.diff(off) // size


def _choose(shared):
    """Of the items of one task, whose counts have met there: the class of the
    greatest gain."""
    def run(batches):
        of, k, table = shared.value
        width = 2 * k + 1
        place, held = np.full(len(of), -1), np.zeros(0)
        for b in batches:
            if b.num_rows:
                item = b.column("item").to_numpy()
                first = np.unique(item[place[item] < 0])
                place[first] = len(held) // width + np.arange(len(first))
                held = np.concatenate([held, np.zeros(len(first) * width)])
                cells, each = _lists(b.column("cells"), np.uint16)
                np.add.at(held, np.repeat(place[item], each) * width + cells, _lists(b.column("counts"), np.int32)[0].astype(np.float64))
        out = []
        for item in np.flatnonzero(place >= 0).tolist():
            sides = held[place[item] * width:(place[item] + 1) * width]
            left, right, own = sides[:k].copy(), sides[k:2 * k].copy(), sides[-1]
            old = new = int(of[item])
            if item != len(of) - 1:
                rest = table.copy()
                _without(rest, old, right, left, own)
                gain = gains(rest, right, left, own)
                new = int(np.argmax(gain[:k - 1]))
                new = new if gain[new] > gain[old] + 1e-9 else old
            out.append((item, new))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in zip(*out, strict=True)], ["item", "class"])
    return run


def _sides(docs: DataFrame, head: np.ndarray, of: np.ndarray, k: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((head, of, k))
    return stored(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_sides(shared), "item int, cells binary, counts binary"), "brown-sides")


def _sum(tables: DataFrame, k: int) -> np.ndarray:
    got = [np.frombuffer(r[0], np.int64).reshape(k, k) for r in tables.toLocalIterator()]
    return np.sum(got, axis=0, dtype=np.int64) if got else np.zeros((k, k), np.int64)


def _one_table(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])


def _table(sides: DataFrame, of: np.ndarray, k: int) -> np.ndarray:
    """Class bigrams: the items' counts of the classes before them, summed by
    class in the tasks."""
    def run(batches):
        total = np.zeros(k * k, np.int64)
        for b in batches:
            if b.num_rows:
                cells, each = _lists(b.column("cells"), np.uint16)
                counts, _ = _lists(b.column("counts"), np.int32)
                into = np.repeat(of[b.column("item").to_numpy()], each)
                before = np.flatnonzero(cells < k)
                total += np.bincount(cells[before].astype(np.int64) * k + into[before], weights=counts[before], minlength=k * k).astype(np.int64)
        yield _one_table(total)
    return _sum(sides.mapInArrow(run, "total binary"), k)


def _bigrams(docs: DataFrame, head: np.ndarray, of: np.ndarray, k: int) -> np.ndarray:
    """Class bigrams, counted in the texts."""
    shared = docs.sparkSession.sparkContext.broadcast((head, of, k))

    def run(batches):
        head, of, k = shared.value
        starts, total = _starts(head), np.zeros(k * k, np.int64)
        for rows, data, off in text_slices(batches):
            h, form, row = tokens(data, off)
            a, b, _ = _sequences(of[_placed(h, form, head, starts)[0]], row, rows.num_rows, of[-1])
            total += np.bincount(a * k + b, minlength=k * k)
        yield _one_table(total)
    return _sum(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "total binary"), k)


def refine(docs: DataFrame, head: np.ndarray, of: np.ndarray, k: int, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(classes, class bigrams) after passes in which every frequent word and
    every form goes where it gains most.  In a pass all move at once, so one
    that ends worse than it began is undone."""
    sides = _sides(docs, head, of, k)
    table = _table(sides, of, k)
    for left in range(passes, 0, -1):
        shared = docs.sparkSession.sparkContext.broadcast((of, k, table.astype(np.float64)))
        moved = sides.repartition("item").mapInArrow(_choose(shared), "item int, class int").toPandas()
        new = of.copy()
        new[moved["item"].to_numpy(np.int64)] = moved["class"].to_numpy(np.int64)
        if (new == of).all():
            break
        if left > 1:
            sides = _sides(docs, head, new, k)
            after = _table(sides, new, k)
        else:  # no further pass needs the words' own counts
            after = _bigrams(docs, head, new, k)
        if likelihood(after.astype(np.float64)) <= likelihood(table.astype(np.float64)):
            break
        of, table = new, after
    return of, table


def seed(docs: DataFrame, words: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of each shape, each of ``words`` and the end, by exchange."""
    m = SHAPES + len(words) + 1
    shared = docs.sparkSession.sparkContext.broadcast((words, m))
    cells = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_pairs(shared), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())  # at most m * m
    pairs = np.zeros(m * m, np.int64)
    pairs[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(np.int64)
    return exchange(pairs.reshape(m, m), classes)


def train(docs: DataFrame, head: int = HEAD, seeds: int = SEEDS, classes: int = CLASSES, passes: int = PASSES, often: int = OFTEN) -> dict:
    """The model, and the stored counts of all words of ``docs``."""
    counts = word_counts(docs)
    ends = docs.count()
    sums = counts.groupBy("form").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    words, distinct = int(sums["n"].sum()), int(sums["v"].sum())
    top = _most(counts.where(F.col("n") >= often), head)
    one = np.sort(top.head(seeds)["h"].to_numpy(np.int64).view(np.uint64))
    first = seed(docs, one, classes)
    k = int(first.max()) + 1
    top = top.iloc[np.argsort(top["h"].to_numpy(np.int64).view(np.uint64))] if len(top) else top
    known, form = top["h"].to_numpy(np.int64).view(np.uint64), top["form"].to_numpy(np.int64)
    of = np.concatenate([np.repeat(first[:SHAPES], _ENDINGS), first[_items(known, form, one)], first[-1:]])
    of, table = refine(docs, known, of, k, passes)
    # distinct words of each form and frequent word, then of each class
    kinds = np.zeros(len(of), np.int64)
    kinds[sums["form"].to_numpy(np.int64)] = sums["v"].to_numpy(np.int64)
    np.subtract.at(kinds, form, 1)
    kinds[FORMS:-1] = 1
    kinds[-1] = int(ends > 0)
    kinds = np.bincount(of, weights=kinds, minlength=k)
    unigram = (table.sum(0) + 0.5) / (table.sum() + 0.5 * k)
    move = (table + BACKOFF * unigram) / (table.sum(1, keepdims=True) + BACKOFF)
    total = words + ends
    return {
        "counts": counts, "total": total, "class": of, "move": np.log10(move),
        "emit": np.log10(table.sum(0) + 0.5 * (kinds + 1)), "base": np.log10(total + 0.5 * (distinct + (ends > 0) + 1)),
        "head": known, "end": ends, "head_n": top["n"].to_numpy(np.int64), "least": int(top["n"].min()) if len(top) else 2**62,
    }


def _local(shared):
    """Per text what needs no join, and the tokens that do."""
    def run(batches):
        model = shared.value
        head, log_n, of = model["head"], np.log10(model["head_n"] + 0.5), model["class"]
        starts = _starts(head)
        for rows, data, off in text_slices(batches):
            n = rows.num_rows
            h, form, row = tokens(data, off)
            place, known = _placed(h, form, head, starts)
            a, b, r = _sequences(of[place], row, n, of[-1])
            steps = np.bincount(r, weights=model["move"][a, b] - model["emit"][b], minlength=n)
            logs = np.bincount(row[known], weights=log_n[place[known] - FORMS], minlength=n) + np.log10(model["end"] + 0.5)
            size = np.bincount(row, minlength=n) + 1
            seen = np.bincount(row[known], minlength=n) + (model["end"] > 0)
            # one row a text and rare word, with its count there
            key, rare = h[~known], row[~known]
            order = np.lexsort((key, rare))
            key, rare = key[order], rare[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (rare[1:] != rare[:-1])]) if len(key) else np.empty(0, np.int64)
            times = np.diff(np.r_[first, len(key)])
            rid = rows.column("rid").to_numpy()
            yield of_rows(rows, h=pa.nulls(n, pa.int64()), tf=pa.nulls(n, pa.int64()), n_tokens=size.astype(np.int64),
                          n_known=seen.astype(np.int64), logs=logs, steps=steps)
            for i in range(0, len(first), 65_536):
                f = first[i:i + 65_536]
                none = lambda t: pa.nulls(len(f), t)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [none(rows.schema.field("doc_id").type), pa.array(rid[rare[f]]), pa.array(key[f].view(np.int64)), pa.array(times[i:i + 65_536]),
                     none(pa.int64()), none(pa.int64()), none(pa.float64()), none(pa.float64())],
                    ["doc_id", "rid", "h", "tf", "n_tokens", "n_known", "logs", "steps"])
    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10 probability) and
    perplexity of every row."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast({k: v for k, v in model.items() if k != "counts"})
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), F.col("text").cast("string").alias("text"))
    both = stored(rows.mapInArrow(_local(shared), f"doc_id {kind}, rid long, h long, tf long, n_tokens long, n_known long, "
                                  "logs double, steps double"), "brown-scores")
    rare = model["counts"].where(F.col("n") < model["least"]).select("h", "n")
    met = both.where("h IS NOT NULL").select("rid", "h", "tf").join(rare, "h", "left")
    n = F.coalesce("n", F.lit(0))
    tail = met.groupBy("rid").agg(F.sum(F.col("tf") * F.log10(n + 0.5)).alias("_logs"),
                                  F.sum(F.when(n > 0, F.col("tf")).otherwise(0)).alias("_known"))
    all_ = both.where("h IS NULL").drop("h", "tf").join(tail, "rid", "left")
    logs = F.col("logs") + F.coalesce("_logs", F.lit(0.0))
    value = logs + F.col("steps")
    return all_.select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
                       (logs - F.col("n_tokens") * F.lit(float(model["base"]))).alias("base_score"), value.alias("score"),
                       F.pow(F.lit(10.0), -value / F.col("n_tokens")).alias("perplexity"))


def op2_brown(spark, sf_dir):
    """Scores of every document, learned without fold 1 of 5."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out(5, 1)))
    return score(docs, model).select("doc_id", held_out(5, 1).alias("held_out"), "n_tokens", "n_known",
                                     F.lit(model["total"]).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
