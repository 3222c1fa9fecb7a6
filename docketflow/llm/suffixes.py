"""Removal of repeated byte strings by a distributed difference-cover suffix
sort.

A byte goes if a string of 50 bytes that covers it also starts in a document
of smaller id.  A full suffix array of a corpus would move every byte many
times, so work is discarded as early as it can be, each time exactly:

1. equal texts are one text (of the least id; its copies go whole);
2. every 50-byte string is dealt to its *anchor*, the 20-byte string of least
   hash in it, of which there are about 2 in 32 positions; strings whose
   anchor occurs once in the corpus are unique, and are discarded;
3. the strings of one anchor lie in a run; where a run of equal bytes is in a
   smaller document, all of it goes (first within a task, so that a run that
   a third of all documents hold moves as often as there are tasks).

What is left are the runs of least id, dealt by anchor, so that equal strings
meet; an anchor that has one run left needs no sort.  The suffixes of the
others are sorted by difference cover: positions that are 1 or 2
modulo 3 are sorted by triples of 8-byte words, the triples get names, pairs of
names (24 bytes apart) are sorted in turn, which orders these suffixes; the
others are sorted by their first byte and the rank behind it, and merged in by
one or two bytes and a rank.  Prefixes of neighbours are then compared, and
each group of equal 50-byte prefixes takes the least id.  Runs of an anchor
with very many different ones (the edges of a passage that a third of all
documents share) are split into their strings, which are aggregated before
they move.

Texts are shuffled once, into a bucketed table, and met there by everything
that is found later.

Defined cases: a null text is empty; texts of fewer than 50 bytes lose
nothing; a null id counts after all others; rows of one id are no repeats of
each other; a repeated row is treated like the first; long texts are scanned
in overlapping pieces; an empty table gives an empty table.  Only ``doc_id``
(a whole number) and ``text`` are read.  Strings are compared byte by byte;
whole texts and runs are told apart by 96 bits of hash.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, rows_of, scratch, span_hashes, stored, text_slices

LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1
#: Bytes of text whose anchors a task packs into one row for each part, and
#: whose runs it compares before they move.
PACK_BYTES = 32 << 20
#: Bytes of a text's key: a hash.
KEY = 12
#: Bytes of text behind the anchors of one part, and of runs sorted at once.
ANCHOR_BYTES, SORT_BYTES = 256 << 20, 4 << 20
#: An anchor with more different runs is split into single strings.
SPLIT = 4096
_LOW = np.uint64((1 << 26) - 1)
_OTHER = np.random.default_rng(50).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BIG = 2**63 - 1


# -- anchors and runs ---------------------------------------------------------

def _packed(h: np.ndarray) -> np.ndarray:
    """Hash with its position in the low bits: a minimum is the leftmost."""
    return (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)


def runs(data: np.ndarray, off: np.ndarray):
    """First start, number of starts, anchor and hash of each run: the starts
    of 50-byte strings of one text that have one anchor."""
    n = len(data)
    z = np.empty(0, np.int64)
    if n < LENGTH:
        return z, z, z, z.view(np.uint64)
    at = np.arange(n - GRAM + 1)
    h = span_hashes(data, at, at + GRAM)
    v, width = _packed(h), 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        v, width = np.minimum(v[:-step], v[step:]), width + step
    left = np.repeat(off[1:], np.diff(off))[:len(v)] - np.arange(len(v))
    starts = np.flatnonzero(left >= LENGTH)
    if not len(starts):
        return z, z, z, z.view(np.uint64)
    anchor = (v[starts] & _LOW).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return starts[cut], np.diff(np.r_[cut, len(starts)]), anchor[cut], h[anchor[cut]]


def _pieces(batches):
    """(rows, data, off, base) like ``text_slices``; a long text comes in
    pieces that overlap by all but one byte of a string."""
    for rows, data, off in text_slices(batches, limit=SLICE_BYTES):
        if len(off) > 2 or len(data) <= 2 * SLICE_BYTES:
            yield rows, data, off, 0
            continue
        for b in range(0, len(data) - LENGTH + 1, SLICE_BYTES):
            part = data[b:b + SLICE_BYTES + LENGTH - 1]
            yield rows, part, np.array([0, len(part)]), b


def _pack(found: list, keys: list[bytes], parts: int, turn: int):
    """Rows (part, hashes, keys, counts, positions) of the gathered anchors.
    Of one hash two stay, which shows its part that it repeats; the others
    are known to repeat and go under a part of their own, without hashes."""
    h, doc, pos = (np.concatenate(x) for x in zip(*found, strict=True))
    part = ((h & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int64)
    code = h >> np.uint64(32)
    order = np.lexsort((code, part))
    same = (part[order][1:] == part[order][:-1]) & (code[order][1:] == code[order][:-1])
    third = np.r_[False, False, same[1:] & same[:-1]] if len(h) > 1 else np.zeros(len(h), bool)
    known = np.zeros(len(h), bool)
    known[order[third]] = True
    part[known] = parts + turn % parts
    order = np.lexsort((pos, doc, part))
    part, code, doc, pos = part[order], code[order].astype(np.uint32), doc[order], pos[order].astype(np.uint32)
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        edge = np.flatnonzero(np.r_[True, doc[a + 1:b] != doc[a:b - 1], True])
        yield (int(part[a]), b"" if part[a] >= parts else code[a:b].tobytes(), b"".join(keys[d] for d in doc[a:b][edge[:-1]]),
               np.diff(edge).astype(np.uint32).tobytes(), pos[a:b].view(np.uint8).reshape(-1, 4).T.tobytes())


def _anchors(parts: int):
    names = ["part", "hashes", "keys", "counts", "places"]

    def gather(batches):
        found, keys, size, turn, first = [], [], 0, 0, 0
        for rows, data, off, base in _pieces(batches):
            if base == 0:
                first = len(keys)
                keys += rows.column("key").to_pylist()
                turn = int.from_bytes(keys[first][:4], "little")
            start, _, anchor, h = runs(data, off)
            if len(h):
                row = rows_of(start, off)
                found.append((h, row + first, anchor - off[row] + base))
            size += len(data)
            if size >= PACK_BYTES:
                if found:
                    yield from _records(_pack(found, keys, parts, turn + base), names)
                # further pieces of a long text need its key
                found, keys, size, first = [], keys[first:], 0, 0
        if found:
            yield from _records(_pack(found, keys, parts, turn), names)
    return gather


def _records(rows, names):
    out = list(zip(*rows, strict=True))
    types = [pa.int32(), *[pa.binary()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


def _repeated(table: pa.Table) -> pa.Table:
    """Of one part: the anchors whose hash occurs twice, by text."""
    rows = [c.to_pylist() for c in table.select(["hashes", "keys", "counts", "places"]).columns]
    size = [len(p) // 4 for p in rows[3]]
    code = np.frombuffer(b"".join(rows[0]), np.uint32)
    twice = np.ones(sum(size), bool)
    if len(code):  # a part has hashes in all rows or in none
        order = np.argsort(code, kind="stable")
        same = code[order][1:] == code[order][:-1]
        twice[order] = np.r_[False, same] | np.r_[same, False]
    key, place, at = [], [], 0
    for k, c, p, n in zip(rows[1], rows[2], rows[3], size, strict=True):
        here, at = twice[at:at + n], at + n
        if not here.any():
            continue
        count = np.frombuffer(c, np.uint32)
        p = np.frombuffer(p, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()[here]
        each = np.bincount(np.repeat(np.arange(len(count)), count)[here], minlength=len(count))
        cut = np.concatenate([[0], np.cumsum(each)])
        for d in np.flatnonzero(each):
            key.append(k[KEY * d:KEY * d + KEY])
            place.append(p[cut[d]:cut[d + 1]].tobytes())
    return pa.table({"key": pa.array(key, pa.binary()), "places": pa.array(place, pa.binary())})


# -- runs of the texts ----------------------------------------------------------

def _met(found: list) -> pa.RecordBatch:
    """Gathered runs: those whose bytes are also in one of smaller id are
    full (without a hash; touching ones of a text are joined), the others stay
    open.  An open run that a text repeats is one row, with its further places
    in ``also``."""
    keys, text, m, c1, c2, place, starts = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((place, text, m, c2, c1))
    head = np.r_[True, (c1[order][1:] != c1[order][:-1]) | (c2[order][1:] != c2[order][:-1])]
    first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    gone = m[order] > m[order][first]
    again = ~gone & ~head & np.r_[False, text[order][1:] == text[order][:-1]]
    also = np.full(len(order), None, object)
    edge = np.flatnonzero(np.r_[again, False] != np.r_[False, again])
    for i, j in zip(edge[::2], edge[1::2], strict=True):
        also[order[i - 1]] = place[order[i:j]].astype(np.int32).tobytes()
    full, drop = np.zeros(len(order), bool), np.zeros(len(order), bool)
    full[order], drop[order] = gone, again
    keys, text, m, c1, c2, place, starts, full, also = (x[~drop] for x in (keys, text, m, c1, c2, place, starts, full, also))
    joins = np.r_[False, full[1:] & full[:-1] & (text[1:] == text[:-1]) & (place[1:] == place[:-1] + starts[:-1])]
    begin = np.flatnonzero(~joins)
    starts = np.add.reduceat(starts, begin)
    keys, m, c1, c2, place, full, also = (x[begin] for x in (keys, m, c1, c2, place, full, also))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.tolist(), pa.binary()), pa.array(m, mask=full), pa.array(c1, mask=full), pa.array(c2, mask=full),
         pa.array(place.astype(np.int32)), pa.array(starts.astype(np.int32)), pa.array(also.tolist(), pa.binary())],
        ["key", "m", "c1", "c2", "place", "starts", "also"])


def _instances(batches):
    """The runs of repeated anchors: where they are, and 96 bits of their
    bytes, unless a smaller document is known to hold them."""
    gathered, size, texts = [], 0, 0
    for rows, data, off, base in _pieces(batches):
        texts += len(off) if base == 0 else 0
        start, count, anchor, _ = runs(data, off)
        row = rows_of(start, off)
        lists = rows.column("places")
        want = []
        for r in np.unique(row):
            p = np.frombuffer(b"".join(lists[int(r)].as_py()), np.uint32).astype(np.int64) - base + off[r]
            want.append(p[(p >= off[r]) & (p < off[r + 1])])
        at = np.flatnonzero(np.isin(anchor, np.concatenate(want))) if want else np.empty(0, np.int64)
        if len(at):
            start, count, row = start[at], count[at], row[at]
            end = start + count + LENGTH - 1
            keys = np.array(rows.column("key").to_pylist(), object)
            gathered.append((keys[row], row + texts, rows.column("m").to_numpy()[row], span_hashes(data, start, end).view(np.int64),
                             span_hashes(_OTHER[data], start, end).view(np.int64).astype(np.int32), start - off[row] + base, count))
        size += len(data)
        if size >= PACK_BYTES and gathered:
            yield _met(gathered)
            gathered, size = [], 0
    if gathered:
        yield _met(gathered)


def _bodies(batches):
    """The bytes of the open runs, with the hash of their anchor."""
    for rows, data, off in text_slices(batches):
        chosen = rows.column("open")
        each = pc.list_value_length(chosen).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(chosen)
        if not len(flat):
            continue
        place, starts = flat.field("place"), flat.field("starts")
        row = np.repeat(np.arange(rows.num_rows), each)
        s = place.to_numpy() + off[row]
        n = starts.to_numpy().astype(np.int64)
        e = s + n + LENGTH - 1
        size = np.concatenate([[0], np.cumsum(e - s)])
        body = data[np.arange(size[-1]) + np.repeat(s - size[:-1], e - s)]
        grams = size[:-1, None] + np.arange(WINDOW)
        h = span_hashes(body, grams.ravel(), grams.ravel() + GRAM).reshape(grams.shape)
        least = np.argmin(h & ~_LOW, axis=1)
        anchor = h[np.arange(len(h)), least].view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [rows.column("key").take(pa.array(row)), place, rows.column("m").take(pa.array(row)), starts, pa.array(anchor),
             pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(size), pa.py_buffer(body)]).cast(pa.binary())],
            ["key", "place", "m", "starts", "anchor", "body"])


# -- the suffix sort -----------------------------------------------------------

def suffix_order(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` (each has 50 bytes) in order of their first
    50 bytes, and whether each shares all of them with the one before."""
    size = len(data)
    padded = np.concatenate([data, np.zeros(80, np.uint8)])
    word = np.zeros(size + 72, np.uint64)  # eight bytes from each position on
    for k in range(8):
        word |= padded[k:k + size + 72].astype(np.uint64) << np.uint64(56 - 8 * k)
    letter = padded.astype(np.uint64)

    # sampled suffixes: those behind the starts that are 1 or 2 modulo 3
    here = np.zeros(size + 72, bool)
    here[starts] = here[starts + 1] = here[starts + 2] = True
    here[::3] = False
    q = np.flatnonzero(here)
    # sort their triples of words, and those a triple further on; name them
    here[q + 24] = True
    t = np.flatnonzero(here)
    order = np.lexsort((word[t + 16], word[t + 8], word[t]))
    a = t[order]
    new = np.r_[True, (word[a[1:]] != word[a[:-1]]) | (word[a[1:] + 8] != word[a[:-1] + 8]) | (word[a[1:] + 16] != word[a[:-1] + 16])]
    name = np.zeros(size + 72, np.uint64)
    name[a] = np.cumsum(new)
    # recurse on the names: two of them are 48 bytes
    rank = np.zeros(size + 72, np.uint64)
    pair = name[q] << np.uint64(32) | name[q + 24]
    order = np.argsort(pair)
    rank[q[order]] = np.cumsum(np.r_[False, pair[order][1:] != pair[order][:-1]])

    def tail(p):
        return word[p + 48] >> np.uint64(48)

    def by_one(p):
        return letter[p] << np.uint64(56) | rank[p + 1] << np.uint64(8) | letter[p + 49]

    def by_two(p):
        return letter[p] << np.uint64(56) | letter[p + 1] << np.uint64(48) | rank[p + 2]

    sampled, rest = starts[starts % 3 != 0], starts[starts % 3 == 0]
    sampled = sampled[np.argsort(rank[sampled] << np.uint64(16) | tail(sampled))]
    rest = rest[np.argsort(by_one(rest))]
    # merge
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    place = np.arange(len(rest)) + np.searchsorted(by_one(one), by_one(rest)) + np.searchsorted(by_two(two), by_two(rest))
    out = np.empty(len(starts), np.int64)
    own = np.zeros(len(starts), bool)
    own[place] = True
    out[own], out[~own] = rest, sampled

    # compare adjacent prefixes
    same = np.zeros(len(out), bool)
    a, b = out[:-1], out[1:]
    equal = tail(a) == tail(b)
    for k in range(0, 48, 8):
        equal &= word[a + k] == word[b + k]
    same[1:] = equal
    return out, same


def _covered(table: pa.Table) -> pa.Table:
    """Of the runs of one part: which starts have their string in a run of
    smaller id, as bits."""
    anchor = table.column("anchor").to_numpy()
    order = np.argsort(anchor)
    twin = anchor[order][1:] == anchor[order][:-1]
    some = np.zeros(len(anchor), bool)
    some[order] = np.r_[False, twin] | np.r_[twin, False]
    table = table.filter(pa.array(some))
    if not table.num_rows:
        return pa.table({"key": pa.array([], pa.binary()), "place": pa.array([], pa.int32()), "mask": pa.array([], pa.int64())})
    body = table.column("body").cast(pa.large_binary()).combine_chunks()
    body = body if isinstance(body, pa.LargeBinaryArray) else body.chunk(0)
    size = np.frombuffer(body.buffers()[1], np.int64)[body.offset:body.offset + len(body) + 1]
    data = np.frombuffer(body.buffers()[2], np.uint8)[size[0]:size[-1]]
    off = size - size[0]
    n, m = table.column("starts").to_numpy().astype(np.int64), table.column("m").to_numpy()
    first = np.concatenate([[0], np.cumsum(n)])
    run = np.repeat(np.arange(len(n)), n)
    nth = np.arange(first[-1]) - first[run]
    starts = off[run] + nth
    order, same = suffix_order(data, starts)
    at = np.searchsorted(starts, order)
    head = np.flatnonzero(~same)
    least = np.repeat(np.minimum.reduceat(m[run[at]], head), np.diff(np.r_[head, len(at)]))
    gone = at[least < m[run[at]]]
    mask = np.zeros(len(n), np.int64)
    np.bitwise_or.at(mask, run[gone], np.int64(1) << nth[gone])
    some = pa.array(np.flatnonzero(mask))
    return pa.table({"key": table.column("key").take(some), "place": table.column("place").take(some), "mask": pa.array(mask[mask != 0])})


def _masks(bodies: DataFrame) -> DataFrame:
    """key, place, mask of the runs that share a string with one of smaller
    id."""
    hot = stored(bodies.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SPLIT).select("anchor"), "suffix-hot")
    size = bodies.agg(F.coalesce(F.sum(F.col("starts") + (LENGTH - 1)), F.lit(0))).first()[0]
    parts = max(int(bodies.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + size // SORT_BYTES)
    cold = bodies.join(hot, "anchor", "left_anti").withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(parts)).cast("int"))
    out = cold.repartition(parts, "part").groupBy("part").applyInArrow(_covered, "key binary, place int, mask long")
    # strings of hot anchors: the least id of each, aggregated before it moves
    each = F.transform(F.sequence(F.lit(0), F.col("starts") - 1), lambda i: F.substring(F.col("body"), i + 1, F.lit(LENGTH)))
    strings = bodies.join(hot, "anchor", "left_semi").select("key", "place", "m", F.posexplode(each).alias("nth", "string"))
    least = strings.groupBy("string").agg(F.min("m").alias("least"))
    met = strings.join(least, "string").where("least < m")
    split = met.groupBy("key", "place").agg(F.expr("bit_or(shiftleft(1L, nth))").alias("mask"))
    return out.unionByName(split)


# -- the job --------------------------------------------------------------------

def _removed(keep_text: bool):
    def remove(batches):
        for rows, data, off in text_slices(batches):
            n = len(data)
            change = np.zeros(n + 1, np.int32)

            def listed(name):
                column = rows.column(name)
                each = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                flat, row = pc.list_flatten(column), np.repeat(np.arange(rows.num_rows), each)
                return flat, row, flat.field("place").to_numpy() + off[row]

            def further(flat):
                """Number of an entry and its other places in its text."""
                some = np.flatnonzero(flat.field("also").is_valid())
                places = [np.frombuffer(x, np.int32) for x in flat.field("also").take(pa.array(some)).to_pylist()]
                return np.repeat(some, [len(x) for x in places]), np.concatenate(places) if places else np.empty(0, np.int64)

            def cover(s, length):
                np.add.at(change, s, 1)
                np.add.at(change, s + length, -1)
            flat, row, s = listed("full")
            length = flat.field("starts").to_numpy() + (LENGTH - 1)
            cover(s, length)
            i, place = further(flat)
            cover(place + off[row[i]], length[i])
            # masks of open runs, at their first place and at the others
            flat, row, s = listed("part")
            mask = flat.field("mask").to_numpy()
            whole, of_row, of_place = listed("open")
            i, place = further(whole)
            order = np.argsort(s)
            if len(s) and len(i):
                at = order[np.minimum(np.searchsorted(s, of_place[i], sorter=order), len(s) - 1)]
                same = s[at] == of_place[i]
                s, mask = np.concatenate([s, place[same] + off[of_row[i[same]]]]), np.concatenate([mask, mask[at[same]]])
            for k in range(WINDOW):
                cover(s[(mask >> k) & 1 == 1] + k, LENGTH)
            gone = np.cumsum(change[:n]) > 0
            # a run of removed bytes ends with its text
            first = np.zeros(n + 1, bool)
            first[off] = True
            begin = np.flatnonzero(gone & (np.r_[True, ~gone[:-1]] | first[:n])) if n else np.empty(0, np.int64)
            end = np.flatnonzero(gone & (np.r_[~gone[1:], True] | first[1:])) + 1 if n else np.empty(0, np.int64)
            own = rows_of(begin, off)
            spans = np.bincount(own, minlength=rows.num_rows)
            total = np.concatenate([[0], np.cumsum(gone)])
            kept = data[~gone]
            koff = off - total[off]
            pair = pa.StructArray.from_arrays([pa.array(begin - off[own]), pa.array(end - off[own])], ["start", "end"])
            cols = [rows.column("key"), rows.column("m"), pa.array(total[off[1:]] - total[off[:-1]]), pa.array(spans),
                    pa.array([hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(koff[:-1], koff[1:], strict=True)]),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(spans)]).astype(np.int32)), pair)]
            if keep_text:
                cols.append(pa.array([kept[a:b].tobytes() for a, b in zip(koff[:-1], koff[1:], strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, ["key", "m", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][:len(cols)])
    return remove


def _bucketed(df: DataFrame, by: str, number: int) -> DataFrame:
    """``df`` as a stored table whose joins on ``by`` need no shuffle of it."""
    spark, name = df.sparkSession, f"suffix_texts_{uuid.uuid4().hex}"
    df.write.bucketBy(number, by).option("path", scratch(spark, name)).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, spans (array of start, end; bytes), and with ``keep_text``
    kept: the bytes that stay."""
    spark = docs.sparkSession
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    bits = F.concat(*(F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64("text"), F.xxhash64(F.lit(7), "text"))))
    key = F.unhex(F.substring(bits, 1, 2 * KEY))
    source = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", key.alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_BIG)).alias("m"))
    texts = _bucketed(source.groupBy("key").agg(F.min("m").alias("m"), F.first("text").alias("text")), "key", number)

    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(number, 1 + size // ANCHOR_BYTES)
    packed = texts.select("key", "text").mapInArrow(_anchors(parts), "part int, hashes binary, keys binary, counts binary, places binary")
    found = packed.repartition(parts, "part").groupBy("part").applyInArrow(_repeated, "key binary, places binary")
    found = found.groupBy("key").agg(F.collect_list("places").alias("places"))
    shared = stored(texts.join(found, "key").select("key", "m", "text", "places").mapInArrow(
        _instances, "key binary, m long, c1 long, c2 int, place int, starts int, also binary"), "suffix-runs")

    known = shared.where("c1 is not null")
    least = known.groupBy("c1", "c2").agg(F.min("m").alias("least"))
    met = known.join(least, ["c1", "c2"]).select("key", "place", "starts", "also", (F.col("m") > F.col("least")).alias("gone"))
    met = met.unionByName(shared.where("c1 is null").select("key", "place", "starts", "also", F.lit(True).alias("gone")))
    at = F.struct("place", "starts", "also")
    met = stored(met.groupBy("key").agg(F.collect_list(F.when(F.col("gone"), at)).alias("full"), F.collect_list(F.when(~F.col("gone"), at)).alias("open")),
                 "suffix-met")
    bodies = stored(texts.join(met.where(F.size("open") > 0).select("key", "open"), "key").select("key", "m", "text", "open").mapInArrow(
        _bodies, "key binary, place int, m long, starts int, anchor long, body binary"), "suffix-bodies")
    part = stored(_masks(bodies), "suffix-masks").groupBy("key").agg(F.collect_list(F.struct("place", "mask")).alias("part"))
    schema = "key binary, m long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    result = stored(texts.join(met.join(part, "key", "left"), "key", "left").select("key", "m", "text", "full", "open", "part").mapInArrow(
        _removed(keep_text), schema + (", kept binary" if keep_text else "")), "suffix-result")

    rows = source.select("doc_id", "key", F.col("m").alias("_own"), F.octet_length("text").cast("long").alias("n_bytes"))
    copy = (F.col("_own") > F.col("m")) & (F.col("n_bytes") >= LENGTH)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    out = [F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
           F.when(copy, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
           F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
           F.when(copy, whole).otherwise(F.col("spans")).alias("spans")]
    if keep_text:
        out.append(F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    return rows.join(result, "key").select("doc_id", "n_bytes", *out)


def op11_suffixes(spark, sf_dir):
    """Bytes that every document loses and a digest of what it keeps."""
    rows = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
