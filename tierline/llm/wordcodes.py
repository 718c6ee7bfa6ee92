"""White-space words of whole pieces of text as integer codes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tierline.llm.textbytes import separators

_SPACE = separators("space")


def word_codes(data: np.ndarray, off: np.ndarray,
               apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first, codes, words) of the documents data[off[d]:off[d + 1]].

    Document d has the words ``words[codes[first[d]:first[d + 1]]]``: its
    maximal runs of bytes other than 0x20 and 0x09-0x0D.  Equal words have
    equal codes; nothing is hashed away.  ``apart`` flags bytes before which a
    word is cut as well.
    """
    n = len(data)
    if n == 0:
        return np.zeros(len(off), np.int64), np.zeros(0, np.int64), pa.array([], pa.large_binary())
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    if apart is not None:
        start |= apart & word
    at = np.flatnonzero(start)
    letters = data[word]
    ends = np.append((np.cumsum(word) - 1)[at], len(letters)).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(at),
                                  [None, pa.py_buffer(ends), pa.py_buffer(letters)]).dictionary_encode()
    return np.searchsorted(at, off, "left"), found.indices.to_numpy().astype(np.int64), found.dictionary
