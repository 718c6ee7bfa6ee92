"""Vectorised word and byte-gram hashing over Arrow string columns.

A piece is a run of documents of at most ``PIECE_BYTES`` (one longer document
is a piece of its own); memory of a task follows the piece, not the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20
# Odd multipliers of the polynomial and mixing hashes.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_CHAIN = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and document offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    n = len(col)
    if n == 0 or col.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def pieces(off: np.ndarray, size: int = PIECE_BYTES):
    """(first, last) document ranges of at most ``size`` bytes each."""
    first, n = 0, len(off) - 1
    while first < n:
        last = int(np.searchsorted(off, off[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, _BASE, np.uint64)
    down = np.full(n + 1, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def byte_codes(fold: bool = False) -> np.ndarray:
    """A 64-bit code per byte value; ``fold`` gives A-Z the codes of a-z."""
    idx = np.arange(256, dtype=np.uint64)
    if fold:
        idx[65:91] += np.uint64(32)
    return mix((idx + np.uint64(1)) * np.uint64(_BASE))


def prefix_sums(codes: np.ndarray, up: np.ndarray) -> np.ndarray:
    """S with hash of bytes [i, j) = (S[j] - S[i]) * down[i]."""
    s = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:len(codes)], out=s[1:])
    return s


def separators(kind: str) -> np.ndarray:
    """256 flags: bytes that end a word.

    ``space``: 0x20 and 0x09-0x0D.  ``plain``: every ASCII byte that is no
    letter and no digit.
    """
    sep = np.zeros(256, bool)
    if kind == "space":
        sep[[0x20, 9, 10, 11, 12, 13]] = True
    else:
        sep[:0x80] = True
        sep[0x30:0x3A] = sep[0x41:0x5B] = sep[0x61:0x7B] = False
    return sep


def word_hashes(data: np.ndarray, off: np.ndarray, kind: str):
    """Words of the documents of a piece, A-Z folded to a-z.

    Returns (document index, hash) per word, in text order.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = ~separators(kind)[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:n]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    up, down = powers(n)
    sums = prefix_sums(byte_codes(fold=True)[data], up)
    hashes = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
    return np.searchsorted(off, s, "right") - 1, hashes


def chain(first: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of consecutive word hashes."""
    h = mix(first)
    for nxt in rest:
        h = mix(h * _CHAIN + nxt)
    return h


def shingles(doc: np.ndarray, words: np.ndarray, n_docs: int, k: int):
    """Distinct hashes of the k-word shingles of each document.

    A document with fewer than k words, but not none, has one shingle: its
    whole sequence.  Returns (document index, hash), sorted by both.
    """
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(count)])
    out_doc, out_hash = [], []
    if len(words) >= k:
        m = len(words) - k + 1
        whole = doc[:m] == doc[k - 1:]
        h = chain(*[words[j:m + j] for j in range(k)])
        out_doc.append(doc[:m][whole])
        out_hash.append(h[whole])
    for size in range(1, k):
        at = np.flatnonzero(count == size)
        if len(at):
            w = [words[first[at] + j] for j in range(size)]
            out_doc.append(at)
            out_hash.append(chain(*w) ^ np.uint64(size))
    if not out_doc:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    d, h = np.concatenate(out_doc), np.concatenate(out_hash)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]
