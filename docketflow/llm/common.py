"""Helpers shared by the training-data operators: stored intermediate
tables, and words of whole texts as numpy arrays (one Arrow batch at a
time, no per-row Python)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import SparkSession

from ..session import scratch_path, stored

__all__ = ["LOWER", "SPACE", "hash_limit", "mix", "of_rows", "open_store", "scratch", "span_hashes", "spans", "stored", "text_slices", "window_hashes"]

#: Bytes of text handled at once in a Python worker.  A single longer text
#: is handled alone and whole.
SLICE_BYTES = 1 << 20

#: ``[\x20\x09-\x0D]`` as a lookup table over bytes (UTF-8 never uses these
#: bytes inside a longer character).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder, with the scheme of the
    file system that Spark finds it in."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}"))
    return path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark writes it."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    for scheme in ("s3a", "s3n"):
        uri = uri.replace(f"{scheme}://", "s3://", 1) if uri.startswith(f"{scheme}://") else uri
    return fs.FileSystem.from_uri(uri)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows of at most ``limit`` bytes of
    text, or one row with more.  A null text has no bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        data = col.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), n)
            yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


def spans(data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE):
    """Start, end and row of each maximal run of non-separator bytes; a run
    never crosses a text's end."""
    n = len(data)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, z
    word = ~sep[data]
    first = np.zeros(n + 1, bool)
    first[off] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:n]
    end = word.copy()
    end[:-1] &= ~word[1:] | first[1:n]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    return s, e, rows_of(s, off)


def rows_of(pos: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Row that holds each byte position (ascending)."""
    return np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(pos, off)))


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    got = _powers.get(kind)
    if got is None or len(got) < n:
        size = max(n, SLICE_BYTES + 1)
        got = np.full(size, base, np.uint64)
        got[0] = 1
        got = np.cumprod(got, dtype=np.uint64)
        if size <= 2 * SLICE_BYTES:
            _powers[kind] = got
    return got[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (one to one)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(values: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``values`` (bytes, or uint64 codes):
    differences of a prefix sum of code * base^position."""
    codes = _BYTE[values] if values.dtype == np.uint8 else values
    n = len(codes)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _power("up", _BASE, n), out=acc[1:])
    return mix((acc[e] - acc[s]) * _power("down", _INVERSE, n + 1)[s] + (e - s).astype(np.uint64))


def window_hashes(h: np.ndarray, row: np.ndarray, width: int):
    """Hash and first index of each window of ``width`` words of one row."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(row[:n] == row[width - 1:])
    got = np.zeros(len(at), np.uint64)
    for k in range(width):
        got = got * _BASE + h[at + k]
    return mix(got), at


def of_rows(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """The batch without its text, with new columns."""
    names = [f.name for f in batch.schema if f.name != "text" and f.name not in columns]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(v) for v in columns.values())],
                                      [*names, *columns])


def hash_limit(share: float) -> int:
    """The greatest 63-bit hash that a sample of ``share`` of the rows takes."""
    return min(int(share * 2**63), 2**63 - 1)
