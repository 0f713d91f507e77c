"""Column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

Each round puts in one symbol of every text, from the last to the first: round j inserts all suffixes of length j. Where
a new suffix goes follows from the transform alone (its first symbol is the one that stands before the suffix of the round before,
and equal symbols keep their order), and its common prefix with its neighbours is one more than the least
common prefix between the places of their tails. No suffix is compared with another, and no text is looked at but for its next symbol.
"""

from __future__ import annotations

import numpy as np

LONGEST = 254


def _least(lcp: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Least of ``lcp[start:stop + 1]`` for each pair, through minima over powers of two."""
    size = stop - start + 1
    level = np.frexp(size)[1] - 1
    out, table, width = np.zeros(len(size), dtype=lcp.dtype), lcp, 1
    for k in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[start[at]], table[stop[at] - width + 1])
        if 2 * width > len(lcp):
            break
        table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def construct(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, common) of all suffixes in order: 256 * text + start, and the length that each has in common with the one before.

    Texts are of ``LONGEST`` bytes at most, of UTF-8 or parts of it (no byte is 255). Equal suffixes are in order of their texts.
    """
    m, size = len(texts), np.array([len(t) for t in texts], dtype=np.int64)
    longest = int(size.max(initial=0))
    ends = np.cumsum(size)
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8) + np.uint8(1)  # 0 is the end before the first symbol
    before = lambda docs, j: np.where(size[docs] > j, flat[np.maximum(ends[docs] - j - 1, 0)], 0).astype(np.uint8) if len(flat) else np.zeros(len(docs), dtype=np.uint8)
    docs = np.arange(m)
    bwt, lcp, suffix, place = before(docs, 0), np.zeros(m, dtype=np.uint8), docs * 256 + size, np.arange(m)
    for j in range(1, longest + 1):
        n = len(bwt)
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        ended = int((bwt == 0).sum())
        docs = np.flatnonzero(size >= j)
        r = rank[place[docs]]
        near = np.unique(np.concatenate([r, r + 1]))  # the new suffixes and those behind them
        near = near[near < n]
        one, two = order[near - 1], order[near]
        same = (near > 0) & (bwt[one] == bwt[two])
        common = np.zeros(len(near), dtype=np.uint8)
        common[same] = _least(lcp, one[same] + 1, two[same]) + np.uint8(1)
        at = m + r - ended
        old = np.ones(n + len(docs), dtype=bool)
        old[at] = False
        grown = []
        for kept, new in ((bwt, before(docs, j)), (lcp, np.uint8(0)), (suffix, docs * 256 + size[docs] - j)):
            x = np.empty(len(old), dtype=kept.dtype)
            x[old], x[at] = kept, new
            grown.append(x)
        bwt, lcp, suffix = grown
        lcp[m + near - ended] = common
        place[docs] = at
    return suffix, lcp
