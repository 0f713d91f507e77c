"""Word shingles as 64-bit numbers, for many texts at a time.

Words are runs of anything but space and the controls from tab to return, A to Z lowered. A word's
number is a polynomial of its bytes; a shingle's, a mix of its words' numbers. Different shingles of one
pair of texts get the same number about once in 2**64 pairs of shingles.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, 2 * len(_powers))
        back = U(pow(int(_BASE), -1, 1 << 64))
        first = np.ones(n, dtype=np.uint64)
        first[1:] = _BASE
        _powers = np.cumprod(first, dtype=np.uint64)
        first[1:] = back
        _inverse = np.cumprod(first, dtype=np.uint64)
    return _powers, _inverse


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number, text) of every word, in order."""
    raw = [t.encode().lower() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    b = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    powers, inverse = _tables(len(b) + 1)
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + U(1)) * powers[: len(b)], out=total[1:])
    number = mix((total[stop] - total[start]) * inverse[start] + (stop - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))
    return number, np.searchsorted(ends, start, side="right")


def shingle_sets(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, offsets): the distinct shingles of text i, ascending, are shingles[offsets[i]:offsets[i + 1]].

    A text of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    if not texts:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    number, of = word_numbers(texts)
    n_words = np.bincount(of, minlength=len(texts))
    step = U(0xC2B2AE3D27D4EB4F)
    m = max(0, len(number) - width + 1)
    value, factor = np.zeros(m, dtype=np.uint64), U(1)
    with np.errstate(over="ignore"):
        for k in range(width):
            value += number[k : k + m] * factor
            factor = factor * step
        whole = of[:m] == of[width - 1 : width - 1 + m]
        value, owner = mix(value[whole]), of[:m][whole]
        short = np.flatnonzero((n_words > 0) & (n_words < width))
        if len(short):
            first = np.searchsorted(of, short)
            extra = []
            for i, a in zip(short, first, strict=True):
                v, factor = U(n_words[i]), step
                for x in number[a : a + n_words[i]]:
                    v, factor = v + x * factor, factor * step
                extra.append(v)
            value, owner = np.concatenate([value, mix(np.array(extra, dtype=np.uint64))]), np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])


def set_numbers(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One signed 64-bit number per set; equal sets have equal numbers."""
    total = np.concatenate([[U(0)], np.cumsum(mix(shingles ^ U(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
    return mix(total[offsets[1:]] - total[offsets[:-1]] + (offsets[1:] - offsets[:-1]).astype(np.uint64)).view(np.int64)


def odd_sketches(shingles: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Parity bits of each set: every element flips one of at least two bits an element.

    Two sets' sketches differ in at most as many bits as the sets differ in elements, for certain.
    """
    size = np.diff(offsets)
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64))
    base = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(size)), size)
    at = base[owner] + (mix(shingles ^ U(0x3C6EF372FE94F82B)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=base[-1]) & 1).astype(np.uint8)).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the shorter's length (which keeps the bound)."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())
