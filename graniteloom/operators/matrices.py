"""Scores as matrix products, in Arrow batches: what is near in a block of vectors, BM25 of few queries' words.

Products only tell what is in reach of a k-th score; that is scored again term by term, and rounded as Spark rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Places that scores are rounded to before they are ranked.
DIGITS = 6
#: Scores that a task holds at once, and numbers that are scored again at once.
CELLS, AGAIN = 1 << 21, 1 << 20


def rounded(x: np.ndarray, digits: int = DIGITS) -> np.ndarray:
    """Half away from zero by the decimal digits, as Spark's ``round``: what is near a border goes by its digits."""
    y = np.abs(x) * 10.0**digits
    out = np.copysign(np.floor(y + 0.5), x) / 10.0**digits + 0.0
    with np.errstate(invalid="ignore"):
        near = np.flatnonzero(np.abs(y - np.floor(y) - 0.5) <= y * 1e-15)
    for i in near.tolist():
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) + 0.0
    return out


def first_k(query: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Which rows are the k best of their query, by score (NaN is above all, as in Spark), then place."""
    order = np.lexsort((place, -np.where(np.isnan(score), np.inf, score), query))
    query = query[order]
    return order[np.arange(len(query)) - np.searchsorted(query, query) < k]


class Vectors:
    """Vectors of one block by length; null ones have length -1."""

    def __init__(self, column: pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
        self.length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.start = np.cumsum(np.maximum(self.length, 0)) - np.maximum(self.length, 0)

    def rows(self, at: np.ndarray, length: int) -> np.ndarray:
        return self.flat[self.start[at][:, None] + np.arange(length)]


def _sums(products: np.ndarray) -> np.ndarray:
    """Sums of rows, added up in order."""
    return np.cumsum(products, axis=1)[:, -1]


def _equal(queries: pa.ChunkedArray, docs: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents by value, and for each query where those of its value begin and end."""
    both = pc.rank(pa.chunked_array(queries.chunks + docs.chunks, queries.type), sort_keys="ascending", tiebreaker="dense").to_numpy()
    q, d = both[: len(queries)], both[len(queries) :]
    order = np.argsort(d, kind="stable")
    return order, np.searchsorted(d[order], q), np.searchsorted(d[order], q, side="right")


def nearest(k: int, others: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For a block of queries and one of documents, (id, vec, other0, ...) each: the k nearest by cosine of those that differ in all ``other`` columns."""

    def run(queries: pa.Table, docs: pa.Table) -> pa.Table:
        docs = docs.take(pc.sort_indices(docs["id"], null_placement="at_start"))
        n, width = queries.num_rows, docs.num_rows
        asked, found = [], []
        scores = []
        if n and width:
            q, d = Vectors(queries["vec"]), Vectors(docs["vec"])
            apart = [_equal(queries[f"other{i}"], docs[f"other{i}"]) for i in range(others)]
            lengths = np.intersect1d(q.length[q.length > 0], d.length[d.length > 0]).tolist()
            with np.errstate(all="ignore"):
                units = {}
                for size in lengths:
                    at = np.flatnonzero(d.length == size)
                    rows = d.rows(at, size)
                    norm = np.sqrt(_sums(rows * rows))[:, None]
                    units[size] = at, np.where(norm == 0, 0.0, rows / norm).T
                step = max(1, CELLS // width)
                for a in range(0, n, step):
                    b = min(n, a + step)
                    score = np.zeros((b - a, width))
                    for size, (at, unit) in units.items():
                        mine = np.flatnonzero(q.length[a:b] == size)
                        if len(mine):
                            rows = q.rows(a + mine, size)
                            norm = np.sqrt(_sums(rows * rows))[:, None]
                            product = np.where(norm == 0, 0.0, rows / norm) @ unit
                            if len(mine) == b - a and len(at) == width:
                                score = product
                            else:
                                score[np.ix_(mine, at)] = product
                    score[np.isnan(score)] = np.inf
                    for order, low, high in apart:
                        for i in np.flatnonzero(high[a:b] > low[a:b]).tolist():
                            score[i, order[low[a + i] : high[a + i]]] = -np.inf
                    take = score > -np.inf
                    if width > k:
                        kth = np.partition(score, width - k, axis=1)[:, width - k]
                        take &= score >= kth[:, None] - 2 * 10.0**-DIGITS
                    query, doc = np.nonzero(take)
                    query += a
                    exact = np.zeros(len(query))
                    alike = (q.length[query] == d.length[doc]) & (q.length[query] > 0)
                    for size in lengths:
                        some = np.flatnonzero(alike & (q.length[query] == size))
                        each = max(1, AGAIN // size)
                        for c in range(0, len(some), each):
                            part = some[c : c + each]
                            x, y = q.rows(query[part], size), d.rows(doc[part], size)
                            norm = np.sqrt(_sums(x * x)) * np.sqrt(_sums(y * y))
                            exact[part] = np.where((norm > 0) | np.isnan(norm), _sums(x * y) / norm, 0.0)
                    exact = rounded(exact)
                    keep = first_k(query, exact, doc, k)
                    asked.append(query[keep])
                    found.append(doc[keep])
                    scores.append(exact[keep])
        at = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64))
        return pa.table({"query": queries["id"].take(at(asked)), "doc": docs["id"].take(at(found)), "score": pa.array(np.concatenate(scores) if scores else np.zeros(0))})

    return run


def counted(words: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc, words) to (doc, length, word, times): which of the given words a text has (their places, ascending) and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(words, type=pa.string())
        for batch in batches:
            length = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            word = pc.fill_null(pc.index_in(batch.column(1).flatten(), value_set=asked), -1).to_numpy(zero_copy_only=False)
            key = np.repeat(np.arange(len(length)), length) * len(words) + word
            key, times = np.unique(key[word >= 0], return_counts=True)
            row, word = np.divmod(key, max(len(words), 1))
            at = pa.array(np.searchsorted(row, np.arange(len(length) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (word, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(length.astype(np.int32)), *lists], names=["doc", "length", "word", "times"])

    return run


class Asked:
    """Words (places) of queries, in blocks of queries: (first query, words ascending, place among them, query from the first, times)."""

    def __init__(self, query: np.ndarray, word: np.ndarray, queries: int):
        order = np.argsort(query, kind="stable")
        query, word = query[order], word[order]
        self.blocks, a = [], 0
        while a < queries:
            low = np.searchsorted(query, a)
            b = min(queries, a + 256, max(a + 1, int(query[min(len(query) - 1, low + 8192)]))) if len(query) > low + 8192 else min(queries, a + 256)
            high = np.searchsorted(query, b)
            words, place = np.unique(word[low:high], return_inverse=True)
            self.blocks.append((a, b, words, place, query[low:high] - a))
            a = b
        self.held = {} if sum(len(w) * (b - a) for a, b, w, *_ in self.blocks) <= 2 * CELLS else None

    def matrix(self, i: int) -> np.ndarray:
        """How often a word (row) is asked by a query (column); kept where all blocks are small."""
        if self.held is not None and i in self.held:
            return self.held[i]
        a, b, words, place, query = self.blocks[i]
        out = np.zeros((len(words), b - a))
        np.add.at(out, (place, query), 1)
        if self.held is not None:
            self.held[i] = out
        return out


def bm25(query: np.ndarray, word: np.ndarray, least: np.ndarray, ids: pa.Array, idf: np.ndarray, mean: float, k1: float, b: float, boost: float, k: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc, length, word, times) to (query, doc, score, matched): all that have the least number of a query's words, or the k best of a task.

    ``query`` and ``word`` are pairs of places; ``least``, ``ids`` are by query, ``idf`` by word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Asked(query, word, len(ids))
        held: list[tuple | None] = [None] * len(asked.blocks)
        bar = np.full(len(ids), -np.inf)

        def out(q, docs, score, matched):
            return pa.RecordBatch.from_arrays([ids.take(pa.array(q)), docs, pa.array(score), pa.array(matched.astype(np.int64))], names=["query", "doc", "score", "matched"])

        def part(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            size = pc.list_value_length(rows.column(2)).to_numpy(zero_copy_only=False)
            row, w = np.repeat(np.arange(len(size)), size), rows.column(2).flatten().to_numpy(zero_copy_only=False)
            tf, share = rows.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64), k1 * (1 - b + b * rows.column(1).to_numpy(zero_copy_only=False) / mean)
            value = idf[w] * tf * (k1 + 1) / (tf + share[row])
            for i, (low, high, words, *_) in enumerate(asked.blocks):
                if not len(words):
                    continue
                at = np.minimum(np.searchsorted(words, w), len(words) - 1)
                hit = np.flatnonzero(words[at] == w)
                weights, has, times = np.zeros((len(size), len(words))), np.zeros((len(size), len(words))), asked.matrix(i)
                weights[row[hit], at[hit]], has[row[hit], at[hit]] = value[hit], 1
                matched = has @ times
                take = matched >= least[low:high]
                score = weights @ times * boost
                if k is not None:
                    mark = np.where(take, score, -np.inf)
                    take &= score >= bar[low:high] - 2 * 10.0**-DIGITS
                    if len(size) > k:
                        take &= score >= np.partition(mark, len(size) - k, axis=0)[len(size) - k] - 2 * 10.0**-DIGITS
                r, q = np.nonzero(take)
                if not len(r):
                    continue
                found = q + low, rows.column(0).take(pa.array(r)), score[r, q], matched[r, q]
                if k is None:
                    yield out(*found)
                    continue
                if held[i] is not None:
                    found = tuple(pa.concat_arrays([x, y]) if isinstance(x, pa.Array) else np.concatenate([x, y]) for x, y in zip(held[i], found, strict=True))
                keep = first_k(found[0], rounded(found[2]), pc.rank(found[1], sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False), k)
                q, docs, s, m = found[0][keep], found[1].take(pa.array(keep)), found[2][keep], found[3][keep]
                held[i] = q, docs, s, m
                full = np.bincount(q, minlength=len(ids)) >= k
                worst = np.full(len(ids), np.inf)
                np.minimum.at(worst, q, s)
                bar[full] = worst[full]

        for batch in batches:
            step = max(1, CELLS // max([1, *(len(words) + high - low for low, high, words, *_ in asked.blocks)]))
            for a in range(0, batch.num_rows, step):
                yield from part(batch.slice(a, step))
        for found in held:
            if found is not None:
                yield out(*found)

    return run
