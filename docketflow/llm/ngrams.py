"""Character n-grams of whole texts, for the two linear classifiers."""

from __future__ import annotations

import numpy as np

_tables: dict[str, np.ndarray] = {}


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case (where that is one character), and
    whether it is a letter."""
    if not _tables:
        n = 0x110000
        low = np.arange(n, dtype=np.uint32)
        for i in range(n):
            x = chr(i).lower()
            if len(x) == 1 and ord(x) != i:
                low[i] = ord(x)
        _tables["low"] = low
        _tables["letter"] = np.fromiter((chr(i).isalpha() for i in range(n)), bool, n)
    return _tables["low"], _tables["letter"]


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and their offsets as code points and their offsets."""
    first = (data & 0xC0) != 0x80
    at = np.flatnonzero(first)
    b = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    lead = b[at]
    out = lead.copy()
    for least, mask, extra in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        i = np.flatnonzero(lead >= least)
        code = lead[i] & mask
        for k in range(1, extra + 1):
            code = code << np.uint32(6) | b[at[i] + k] & np.uint32(0x3F)
        out[i] = code
    return np.minimum(out, 0x10FFFF), np.searchsorted(at, off)


def squeezed(codes: np.ndarray, off: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters that are not kept become one blank a run; each text begins
    and ends with one.  Returns codes (0: blank) and offsets."""
    low = np.where(keep, codes, 0).astype(np.uint32)
    drop = np.zeros(len(low), bool)
    drop[1:] = (low[1:] == 0) & (low[:-1] == 0)
    drop[off[:-1][off[:-1] < len(low)]] = False
    lead = np.flatnonzero(~drop)
    low, off = low[lead], np.searchsorted(lead, off)
    # a blank before and after each text
    n = len(off) - 1
    out = np.zeros(len(low) + 2 * n, np.uint32)
    row = np.repeat(np.arange(n), np.diff(off))
    out[np.arange(len(low)) + 2 * row + 1] = low
    return out, off + 2 * np.arange(n + 1)


def grams(codes: np.ndarray, off: np.ndarray, orders, bits: int) -> np.ndarray:
    """(characters, orders) hashed n-grams that begin at each character, and
    -1 where the n-gram would leave the text."""
    n = len(codes)
    out = np.full((n, len(orders)), -1, np.int32)
    left = np.repeat(off[1:], np.diff(off)) - np.arange(n)  # characters to the text's end
    c = codes.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(max(orders)):
        m = n - k
        if m <= 0:
            break
        h[:m] = (h[:m] + c[k:] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h[:m] ^= h[:m] >> np.uint64(29)
        if k + 1 in orders:
            i = orders.index(k + 1)
            got = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int32)
            out[:, i] = np.where(left > k, got, -1)
    return out
