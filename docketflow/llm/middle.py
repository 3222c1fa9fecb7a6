"""Fill-in-the-middle: each text is cut in prefix, middle and suffix, and the
pieces are put in another order behind sentinels.

No text is cut or joined by itself.  A batch of texts is one byte array; the
cuts of all its texts are scanned for at once, each cut adds the change of
displacement at its byte to a difference array, and the cumulative sum tells
every byte how far it moves.  One numpy scatter writes all outputs; one gather
over the same displacements, which are found again from the sentinels in the
outputs, restores all texts.

Defined cases: a null text is empty; an empty text, a text that holds a
sentinel and the share of texts that the seed leaves out are ``plain`` (given
as they are); a null ``doc_id`` counts as the empty string in the seed; rows
that repeat an id and a text give equal rows, and there are no ties.  Texts
are cut between code points, so a cut never parts a character.  A text of any
length is handled whole, alone if it is longer than a slice.  An empty table
gives an empty table.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, text_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_LETTERS = (PREFIX, SUFFIX, MIDDLE)
#: Texts in a hundred that are transformed, and of these in a hundred the ones
#: with the suffix in front.
TRANSFORMED, SUFFIX_FIRST = 90, 20
FORMS = np.array(["plain", "psm", "spm"])
PLAIN, PSM, SPM = 0, 1, 2


def sentinels(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, row and kind (0 prefix, 1 suffix, 2 middle) of every sentinel
    that lies within one text."""
    n = len(data) - 2
    if n <= 0:
        z = np.empty(0, np.int64)
        return z, z, z
    at = np.flatnonzero((data[:n] == 0x3C) & (data[2:] == 0x3E))
    kind = np.full(256, -1)
    kind[[s[1] for s in _LETTERS]] = range(3)
    k = kind[data[at + 1]]
    at, k = at[k >= 0], k[k >= 0]
    row = rows_of(at, off)
    inside = at + 3 <= off[row + 1]
    return at[inside], row[inside], k[inside]


def _shifts(n: int, size: int, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Displacement of each of ``n`` bytes: the running sum of the changes at
    the given positions."""
    change = np.zeros(n + 1, np.int32 if size < 2**31 else np.int64)
    for at, by in steps:
        np.add.at(change, at, by.astype(change.dtype))
    return np.cumsum(change[:n], dtype=change.dtype)


def _steps(form, start, cut, end, out):
    """Where the displacement changes and by how much: at the starts of the
    three pieces of each text.  ``cut`` holds the two cuts of each text."""
    first, last = cut
    m, s = last - first, end - last
    prefix = np.choose(form, [out - start, out + 3 - start, out + 6 + s - start])
    middle = np.choose(form, [out - start, out + 9 + s - start, out + 9 + s - start])
    suffix = np.choose(form, [out - start, out + 6 - m - start, out + 3 - last])
    # the displacement before a text's first byte is that of the text before
    before = np.concatenate([[0], suffix[:-1]])
    return [(start, prefix - before), (first, middle - prefix), (last, suffix - middle)]


def scatter(data: np.ndarray, off: np.ndarray, form: np.ndarray, cut: tuple[np.ndarray, np.ndarray]):
    """The outputs of all texts: bytes and offsets."""
    start, end = off[:-1], off[1:]
    ooff = off + 9 * np.concatenate([[0], np.cumsum(form != PLAIN)])
    out = ooff[:-1]
    got = np.empty(ooff[-1], np.uint8)
    shift = _shifts(len(data), len(got), _steps(form, start, cut, end, out))
    got[np.arange(len(data)) + shift] = data
    moved = form != PLAIN
    o, p = out[moved], (cut[0] - start)[moved]
    s, psm = (end - cut[1])[moved], form[moved] == PSM
    places = np.where(psm, o, o + 3 + s), np.where(psm, o + 3 + p, o), np.where(psm, o + 6 + p + s, o + 6 + p + s)
    for place, mark in zip(places, _LETTERS, strict=True):
        for k in range(3):
            got[place + k] = mark[k]
    return got, ooff


def gather(data: np.ndarray, off: np.ndarray, form: np.ndarray):
    """The texts that gave the outputs ``data``: bytes and offsets.  The three
    sentinels of an output tell where its cuts were."""
    moved = form != PLAIN
    at, row, kind = sentinels(data, off)
    own = moved[row]
    place = np.zeros((3, len(form)), np.int64)
    place[kind[own], row[own]] = at[own]
    toff = off - 9 * np.concatenate([[0], np.cumsum(moved)])
    start, end, out = toff[:-1], toff[1:], off[:-1]
    psm = form == PSM
    s = np.where(psm, place[2] - place[1], place[0] - place[1]) - 3
    p = np.where(psm, place[1], place[2]) - place[0] - 3
    first = np.where(moved, start + p, start)
    last = np.where(moved, end - s, start)
    shift = _shifts(int(toff[-1]), len(data), _steps(form, start, (first, last), end, out))
    return data[np.arange(toff[-1]) + shift], toff


def _strings(data: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def _cuts(data, off, u):
    """Code points, form and byte cuts of each text from its four numbers."""
    n_rows = len(off) - 1
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(chars, off)
    n = np.diff(first)
    a, b = u[0] % (n + 1), u[1] % (n + 1)
    p, q = np.minimum(a, b), np.maximum(a, b)
    held = np.zeros(n_rows, bool)
    held[sentinels(data, off)[1]] = True
    form = np.where(u[3] % 100 < SUFFIX_FIRST, SPM, PSM)
    form[(n == 0) | held | (u[2] % 100 >= TRANSFORMED)] = PLAIN
    ends = np.append(chars, len(data))
    place = [np.where(form == PLAIN, off[:-1], np.where(k == n, off[1:], ends[np.minimum(first[:-1] + k, len(chars))])) for k in (p, q)]
    return n, form, p, q, place


def _transform(batches):
    for rows, data, off in text_slices(batches):
        u = [rows.column(f"_u{k}").to_numpy() for k in range(1, 5)]
        n, form, p, q, cut = _cuts(data, off, u)
        got, ooff = scatter(data, off, form, cut)
        plain = form == PLAIN
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(n), pa.array(FORMS[form]), pa.array(p, mask=plain), pa.array(q - p, mask=plain), _strings(got, ooff).cast(pa.string())],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, salt: str = "1:") -> DataFrame:
    """One row per document: doc_id, n (code points), form, prefix_chars,
    middle_chars, output.  The cuts and the form come from the SHA-256 of
    ``salt`` and the id, so reruns agree."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    seed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    u = [F.conv(F.substring(seed, 8 * k - 7, 8), 16, 10).cast("long").alias(f"_u{k}") for k in range(1, 5)]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *u)
    return rows.mapInArrow(_transform, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """The rows with ``restored``: the text rebuilt from output and form alone."""
    def back(batches):
        for b, data, off in text_slices(batches, output):
            kinds = np.searchsorted(FORMS, b.column(form).to_numpy(zero_copy_only=False).astype(FORMS.dtype))
            text, toff = gather(data, off, kinds)
            yield pa.RecordBatch.from_arrays([*b.columns, _strings(text, toff).cast(pa.string())], [*b.schema.names, "restored"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(back, f"{schema}, restored string")


def op12_middle(spark, sf_dir):
    """Form, cuts and digests of every document."""
    rows = restore(fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
o AS (SELECT *, substr(t, 1, p) AS a, substr(t, p + 1, q - p) AS m, substr(t, q + 1) AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
                        WHEN 'spm' THEN '<S>' || z || '<P>' || a || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o
"""
