"""Best-fit packing of tokenized documents: bounded-space online best-fit.

Each task keeps a fixed number of open bins, held in a bitset keyed by free space: bit f of an integer is
set if some open bin has f tokens free. A piece goes to the open bin with the least free space that
holds it (the lowest set bit at or above its length); if none does, a new bin is opened, and if all
are open already, the fullest closes first. Bins that are full close at once. What a task has open at its end is
not a sequence yet: those bins are packed again as pieces by a second, smaller pass, which merges
bins of different tasks. A pass has a task for every ``MERGE`` bins; passes end when one task has them all, or when
a pass merges few, as bins that are each more than half full stay as they are on any number of tasks. Bins
with less than a 64th of their length free are left alone.

A document's ids are those that the tokenizer file gives (no special tokens added), then id 0.
Only documents longer than a sequence are cut, into full pieces; the first may be shorter.

A tokenizer file whose ids are those of a byte-level BPE with ids in the order of its merges is run by
``tiktoken``, which gives the same ids faster; texts with a special token's string or with a very
long run without spaces, and every text of other tokenizer files, go to ``tokenizers`` itself.

Defined cases: a null text is empty (one piece, id 0 alone); null and repeated ids are documents of their
own; an empty table gives an empty table; further columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from graniteloom.llm.common import Scratch, documents

LENGTH = 2048
OPEN_BINS = 256
END_ID = 0
#: Bins that one task of a merging pass packs (about), and the share that a pass must leave at most for another to follow.
MERGE, SHRINK = 20_000, 0.8
#: The split of byte-level BPE into words. A fixed value.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_RUN = re.compile(r"\S{4000}|\s{4000}")


def _byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks of a byte-level BPE file, or None if the file says anything that ranks alone do not."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    vocab, special = model["vocab"], {t["content"] for t in spec["added_tokens"]}
    ids = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if ids != sorted(ids):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}


class Tokens:
    """Ids of texts by a tokenizers file."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks, self.fast = _byte_ranks(json.loads(self.tokenizer.to_str())), None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        """Little-endian 32-bit ids of ``text``."""
        if self.fast is None or any(s in text for s in self.special) or (len(text) > 8000 and _LONG_RUN.search(text)):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self.fast.encode_to_numpy(text).astype("<u4").tobytes()


class OpenBins:
    """Open bins in a bitset keyed by free space."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.count, self.bits = length, most, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def put(self, n: int, new_bin) -> tuple[int, int, int | None]:
        """Place ``n`` tokens: (bin, offset, the bin that closed to make room)."""
        closed = None
        fit = self.bits >> n
        if fit:
            free = n + ((fit & -fit).bit_length() - 1)
            bin_ = self._take(free)
        else:
            if self.count >= self.most:
                closed = self._take((self.bits & -self.bits).bit_length() - 1)
            free, bin_ = self.length, new_bin()
        if free - n:
            self.by_free.setdefault(free - n, []).append(bin_)
            self.bits |= 1 << (free - n)
            self.count += 1
        return bin_, self.length - free, closed

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_ = bins.pop()
        self.count -= 1
        if not bins:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        return bin_

    def left(self) -> list[tuple[int, int]]:
        """(bin, tokens in it) of what is open."""
        return [(b, self.length - free) for free, bins in self.by_free.items() for b in bins]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, offset bigint, ids binary"
BINS = "bin bigint, size bigint, into bigint, at bigint"


def _pack_partition(length: int, open_bins: int, tokenizer: str | None, with_ids: bool):
    """Tokenize, cut and pack one task's documents; bins are numbered within the task's own range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, bins = Tokens(tokenizer), OpenBins(length, open_bins)
        next_bin = TaskContext.get().partitionId() << 40
        end = np.array([END_ID], dtype="<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

        def new_bin() -> int:
            nonlocal next_bin
            next_bin += 1
            return next_bin

        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens(text.as_py() or "") + end
                n = len(ids) // 4
                first = n if n <= length else n % length or length
                at = 0
                for k in range(1 + (n - first) // length):
                    size = first if k == 0 else length
                    part = ids[4 * at : 4 * (at + size)]
                    bin_, offset, _ = (new_bin(), 0, None) if size == length else bins.put(size, new_bin)
                    out.append((doc_id, k, at, size, zlib.crc32(part), bin_, offset, part if with_ids else None))
                    at += size
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(schema), schema, strict=True)], schema=schema)

    return run


def _merge_bins(length: int, open_bins: int):
    """Pack one task's bins, as pieces, into each other: into is the bin that takes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, open_bins)
        schema = pa.schema([("bin", pa.int64()), ("size", pa.int64()), ("into", pa.int64()), ("at", pa.int64())])
        for batch in batches:
            out = []
            for bin_, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                into, at, _ = bins.put(size, lambda b=bin_: b)
                out.append((bin_, size, into, at))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 4, schema, strict=True)], schema=schema)

    return run


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, open_bins: int = OPEN_BINS, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    ``tokenizer`` is the path of a tokenizers file (default: the public byte-level one); executors read it.
    """
    scratch = Scratch(df.sparkSession, "packing")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = scratch.keep(rows.mapInArrow(_pack_partition(length, open_bins, tokenizer, with_ids), PIECES), "pieces")
    # Only bins with room for something are packed again: a row per open or early closed bin, at most a few hundred a task and those the bound forced shut.
    open_ = pieces.groupBy("bin").agg(F.sum("length").alias("size")).where(F.col("size") < length - length // 64)
    left, moved, level = open_.count(), None, 0
    while True:
        n = max(1, -(-left // MERGE))
        packed = scratch.keep(open_.repartition(n, "bin").sortWithinPartitions(F.desc("size"), "bin").mapInArrow(_merge_bins(length, open_bins), BINS), f"merge-{level}")
        step = packed.select("bin", "into", "at")
        if moved is None:
            moved = step
        else:
            later = step.select(F.col("bin").alias("_b"), F.col("into").alias("_into"), F.col("at").alias("_at"))
            moved = moved.join(later, F.col("into") == F.col("_b"), "left").select("bin", F.coalesce("_into", "into").alias("into"), (F.col("at") + F.coalesce("_at", F.lit(0))).alias("at"))
        open_ = packed.groupBy(F.col("into").alias("bin")).agg(F.sum("size").alias("size")).where(F.col("size") < length - length // 64)
        before, left = left, open_.count()
        if n == 1 or left > SHRINK * before:
            break
        level += 1
    moved = moved.select(F.col("bin").alias("_bin"), "into", "at")
    out = pieces.join(moved, F.col("bin") == F.col("_bin"), "left")
    ids = ["ids"] if with_ids else []
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("at", F.lit(0))).cast("long").alias("offset"), *ids)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed."""
    return pack(documents(spark, sf_dir))
