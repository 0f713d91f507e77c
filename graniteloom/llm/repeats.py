"""Exact removal of repeated byte strings of 100 bytes across a corpus.

Equal strings are found by the column-wise construction of a collection's Burrows-Wheeler transform and
common prefixes (``columns``: one symbol of each text per round). It makes as many passes over a collection as its longest text has bytes, so it
isn't given whole documents but the places where a repeat can be, dealt to blocks that fit in memory:

* The anchor of a 100-byte string is its 32-byte substring of least hash (leftmost). Equal strings have equal
  anchors at equal places, and neighbouring strings share anchors: about one in 35 bytes is one.
* Anchors are dealt by hash. Those found once, or only in exact copies of one text, are done.
* Where an anchor recurs, the bytes around it that its strings can reach (168 at most) are a text of a collection; equal ones but the first are
  repeats whole. The others are cut to what another shares, and the different ones of about ``BLOCK`` bytes, whole anchors at a time, are one collection: its suffixes that
  have 100 bytes or more in common with their neighbours are equal strings, and all but the first in order of the corpus are repeats.
* Anchors that recur ``CROWDED`` times or more are dealt again by whole string, as a plain sort by string.

Exact copies of an earlier text are removed whole without looking inside.

Defined cases: a null text is empty; texts under 100 bytes lose nothing; rows that repeat an id and a text are one
document (each row gets its result); rows that repeat an id with another text count as documents in
order of the text's hash; a null id is not before or after any other, so such rows lose nothing and take nothing; an empty table
gives an empty table; further columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from graniteloom.llm.columns import construct
from graniteloom.llm.common import Scratch, documents, release
from graniteloom.llm.shingles import U, _tables, mix

LENGTH, ANCHOR = 100, 32
CROWDED = 20_000
CHUNK, HELD = 400_000, 400_000
#: Bytes of a collection (about) that equal strings are looked for in.
BLOCK = 300_000
#: Places whose hashes are compared at once: each is packed with its hash, in ``PLACE_BITS``, so a block has no more.
PLACE_BITS = 24
PLACES = 1 << PLACE_BITS


def least_places(h: np.ndarray, reach: int) -> np.ndarray:
    """For each run of ``reach`` hashes, the place of its least (by the upper bits, leftmost), in blocks of ``PLACES`` that overlap by a run less one."""
    low = U((1 << PLACE_BITS) - 1)
    out = np.empty(len(h) - reach + 1, dtype=np.int64)
    for a in range(0, len(out), PLACES - reach + 1):
        part = h[a : a + PLACES]
        least, width = (part & ~low) | np.arange(len(part), dtype=np.uint64), 1
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
        out[a : a + len(least)] = a + (least & low).astype(np.int64)
    return out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, place, hash, first, last) of every anchor: its strings start ``first`` down to ``last`` bytes before it."""
    none = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.int64, np.int64))
    size = np.array([len(t) for t in texts], dtype=np.int64)
    b = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(b) < LENGTH:
        return none
    powers, inverse = _tables(len(b) + 1)
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + U(1)) * powers[: len(b)], out=total[1:])
    m = len(b) - ANCHOR + 1
    h = mix((total[ANCHOR:] - total[:m]) * inverse[:m])
    anchor = least_places(h, LENGTH - ANCHOR + 1)
    ends = np.cumsum(size)
    starts = ends - size
    owner = np.repeat(np.arange(len(texts)), size)[: len(anchor)]
    p = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= ends[owner])
    if not len(p):
        return none
    a = anchor[p]
    new = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    at, lo, hi = a[new], p[new], p[np.concatenate([new[1:], [len(p)]]) - 1]
    of = owner[lo]
    return of, at - starts[of], h[at], at - lo, at - hi


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with about ``CHUNK`` bytes of text."""
    for batch in batches:
        texts, a, size = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()), 0, 0
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for b, n in enumerate(lengths, 1):
            size += n
            if size >= CHUNK or b == len(lengths):
                yield batch.slice(a, b - a), [t or b"" for t in texts.slice(a, b - a).to_pylist()]
                a, size = b, 0


_ROW = np.dtype([("h", "<u8"), ("doc", "<i8"), ("th", "<i8"), ("at", "<u4"), ("first", "u1"), ("last", "u1")])
_PACKED = np.dtype([("h", "<u8"), ("at", "<u4"), ("first", "u1"), ("last", "u1")])
_OWNER = np.dtype([("doc", "<i8"), ("th", "<i8"), ("n", "<u4")])


def _send(buckets: int):
    """Rows (bucket, packed): anchors by bucket of their hash, each document named once a bucket."""

    def send(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        r = np.concatenate(rows)
        bucket = (((r["h"] >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        r, bucket = r[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        full = np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
        for first in range(0, len(full), 64):
            ks = full[first : first + 64]
            yield pa.RecordBatch.from_arrays([pa.array(ks, type=pa.int64()), pa.array([pack(r[cuts[k] : cuts[k + 1]]) for k in ks], type=pa.binary())], names=["bucket", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch, texts in _slices(batches, "text"):
            docs, hashes = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            of, at, h, first, last = anchors(texts)
            r = np.empty(len(of), dtype=_ROW)
            r["h"], r["doc"], r["th"], r["at"], r["first"], r["last"] = h, docs[of], hashes[of], at, first, last
            rows.append(r)
            held += len(r)
            if held >= HELD:
                yield from send(rows)
                rows, held = [], 0
        if held:
            yield from send(rows)
        rows = []
        release()

    return run


def pack(r: np.ndarray) -> bytes:
    """Rows of one bucket, documents in runs."""
    new = np.flatnonzero(np.concatenate([[True], (r["doc"][1:] != r["doc"][:-1]) | (r["th"][1:] != r["th"][:-1])]))
    owner = np.empty(len(new), dtype=_OWNER)
    owner["doc"], owner["th"], owner["n"] = r["doc"][new], r["th"][new], np.diff(np.concatenate([new, [len(r)]]))
    rest = np.empty(len(r), dtype=_PACKED)
    for name in _PACKED.names:
        rest[name] = r[name]
    return np.uint32(len(owner)).tobytes() + owner.tobytes() + rest.tobytes()


def unpack(b: bytes) -> np.ndarray:
    k = int(np.frombuffer(b, dtype="<u4", count=1)[0])
    owner = np.frombuffer(b, dtype=_OWNER, count=k, offset=4)
    rest = np.frombuffer(b, dtype=_PACKED, offset=4 + k * _OWNER.itemsize)
    out = np.empty(len(rest), dtype=_ROW)
    for name in _PACKED.names:
        out[name] = rest[name]
    out["doc"], out["th"] = np.repeat(owner["doc"], owner["n"]), np.repeat(owner["th"], owner["n"])
    return out


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket, anchors that recur at another place or in another text; of exact copies, the first document's."""

    def close(held: list[bytes]) -> Iterator[pa.RecordBatch]:
        r = np.concatenate([unpack(b) for b in held])
        r = r[np.lexsort((r["doc"], r["at"], r["th"], r["h"]))]
        new = np.ones(len(r), dtype=bool)
        new[1:] = (r["h"][1:] != r["h"][:-1]) | (r["th"][1:] != r["th"][:-1]) | (r["at"][1:] != r["at"][:-1])
        r = r[new]
        first = np.flatnonzero(np.concatenate([[True], r["h"][1:] != r["h"][:-1]]))
        size = np.diff(np.concatenate([first, [len(r)]]))
        many = np.repeat(size, size)
        r, many = r[many > 1], many[many > 1]
        for a in range(0, len(r), 50_000):
            x, n = r[a : a + 50_000], many[a : a + 50_000]
            cols = [x["doc"], x["th"], x["h"].view(np.int64), x["at"].astype(np.int32), x["first"].astype(np.int32), x["last"].astype(np.int32), n >= CROWDED]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=["doc_id", "th", "h", "at", "first", "last", "crowded"])

    bucket, held = None, []
    for batch in batches:
        for k, b in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if k != bucket and held:
                yield from close(held)
                held = []
            bucket = k
            held.append(b.as_py())
    if held:
        yield from close(held)
    held = []
    release()


_CONTEXT = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("crowded", pa.bool_()), ("around", pa.binary())])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that an anchor's strings reach, for each of a text's recurring anchors."""
    for batch in batches:
        for a in range(0, batch.num_rows, 200):
            out: list[list] = [[] for _ in _CONTEXT]
            part = batch.slice(a, 200)
            for doc, th, text, found in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                raw = (text or "").encode()
                for x in found:
                    at, first, last = x["at"], x["first"], x["last"]
                    for c, v in zip(out, (x["h"], doc, th, at, first, last, x["crowded"], raw[at - first : at - last + LENGTH]), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, _CONTEXT, strict=True)], schema=_CONTEXT)


_SPAN = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _repeated(contexts: list[tuple]) -> list[tuple[int, int, int, int]]:
    """Spans (doc_id, th, start, end) of repeats among different contexts (doc_id, th, at, first, around), those of one anchor in order of the corpus."""
    suffix, common = construct([c[4] for c in contexts])
    edge = np.flatnonzero(common < LENGTH)
    leader = np.repeat(np.minimum.reduceat(suffix, edge), np.diff(np.concatenate([edge, [len(suffix)]])))
    again = np.sort(suffix[suffix != leader])
    if not len(again):
        return []
    new = np.flatnonzero(np.concatenate([[True], np.diff(again) != 1]))
    out = []
    for a, b in zip(again[new].tolist(), again[np.concatenate([new[1:], [len(again)]]) - 1].tolist(), strict=True):
        doc, th, at, first, _ = contexts[a >> 8]
        out.append((doc, th, at - first + (a & 255), at - first + (b & 255) + LENGTH))
    return out


def _alike(parts: list[bytes]) -> list[int]:
    """How many leading bytes of each string some other of the list shares, at most: in order, a neighbour shares the most."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out, last = [0] * len(parts), 0
    for k, i in enumerate(order):
        following = 0
        if k + 1 < len(order):
            a, b = parts[i], parts[order[k + 1]]
            n = min(len(a), len(b))
            x = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
            following = n - (x.bit_length() + 7) // 8
        out[i], last = max(last, following), following
    return out


def _shared(contexts: list[tuple]) -> list[tuple]:
    """Different contexts of one anchor, cut to what some other shares to the left and right of the anchor; no repeat lies outside."""
    right = _alike([c[4][c[3] :] for c in contexts])
    left = _alike([c[4][: c[3]][::-1] for c in contexts])
    return [(d, th, at, k, c[f - k : f + n]) for (d, th, at, f, c), k, n in zip(contexts, left, right, strict=True) if k + n >= LENGTH]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeats, of contexts sorted by (h, doc_id, th, at)."""
    anchor, before, whole, mine, block, size = None, None, set(), [], [], 0

    def table(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 4, _SPAN, strict=True)], schema=_SPAN)

    def close(out: list[tuple]) -> None:
        """Of the anchor's contexts, what is shared: copies of an earlier one are repeats, the others join the block."""
        nonlocal size
        seen, rest = set(), []
        for doc, th, at, first, around in _shared(mine) if len(mine) > 1 else []:
            if (first, around) in seen:
                out.append((doc, th, at - first, at - first + len(around)))
            else:
                seen.add((first, around))
                rest.append((doc, th, at, first, around))
        if len(rest) > 1:
            block.extend(rest)
            size += sum(len(c[4]) for c in rest)
        if size >= BLOCK:
            out += _repeated(block)
            block.clear()
            size = 0

    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        cols = [batch.column(i).to_pylist() for i in range(6)] + [batch.column(7).to_pylist()]
        for h, doc, th, at, first, last, around in zip(*cols, strict=True):
            if h != anchor:
                close(out)
                anchor, before, whole, mine = h, None, set(), []
            if (doc, th, at) == before:
                continue
            before = (doc, th, at)
            if (first, last, around) in whole:
                out.append((doc, th, at - first, at - last + LENGTH))
            else:
                whole.add((first, last, around))
                mine.append((doc, th, at, first, around))
        yield table(out)
    out = []
    close(out)
    yield table(out + _repeated(block))
    whole, mine = set(), []
    block.clear()
    release()


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, th, start) of every string of crowded anchors; key is a 128-bit hash of the string."""
    for batch in batches:
        for a in range(0, batch.num_rows, 2000):
            part, keys, docs, hashes, starts = batch.slice(a, 2000), [], [], [], []
            for doc, th, at, first, last, around in zip(*(part.column(i).to_pylist() for i in (1, 2, 3, 4, 5, 7)), strict=True):
                for o in range(first, last - 1, -1):
                    keys.append(hashlib.blake2b(around[first - o : first - o + LENGTH], digest_size=16).digest())
                    docs.append(doc)
                    hashes.append(th)
                    starts.append(at - o)
            yield pa.RecordBatch.from_arrays([pa.array(keys, type=pa.binary()), pa.array(docs, type=pa.int64()), pa.array(hashes, type=pa.int64()), pa.array(starts, type=pa.int64())], names=["key", "doc_id", "th", "start"])


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _apply(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "th", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
        for batch in batches:
            out: list[tuple] = []
            for doc, th, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                raw, runs = (text or "").encode(), merge([(x["start"], x["end"]) for x in spans])
                edges = [0, *(e for r in runs for e in r), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                row = (doc, th, len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "ignore")) if with_text else row)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()][: len(names)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(names), types, strict=True)], names=names)

    return run


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row; with ``with_text``, kept_text too.

    kept_text leaves out characters of which a repeat takes only some bytes.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "repeats")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    with_id = docs.where("doc_id IS NOT NULL")
    packed = with_id.select("doc_id", "th", "text").mapInArrow(_send(16 * n_parts), "bucket bigint, packed binary")
    found = packed.repartition(n_parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_recurring, "doc_id bigint, th bigint, h bigint, at int, first int, last int, crowded boolean")
    found = scratch.keep(found, "anchors")
    lists = found.groupBy("doc_id", "th").agg(F.collect_list(F.struct("h", "at", "first", "last", "crowded")).alias("found"))  # as long as the text
    reached = scratch.keep(with_id.join(lists, ["doc_id", "th"]).select("doc_id", "th", "text", "found"), "texts")
    context = "h bigint, doc_id bigint, th bigint, at int, first int, last int, crowded boolean, around binary"
    around = reached.select("doc_id", "th", "text", "found").mapInArrow(_contexts, context)
    spans = around.where("NOT crowded").repartition(n_parts, "h").sortWithinPartitions("h", "doc_id", "th", "at").mapInArrow(_compare, "doc_id bigint, th bigint, start bigint, end bigint")
    spans = scratch.keep(spans, "spans")
    if not found.where("crowded").isEmpty():
        hot = reached.select("doc_id", "th", "text", F.filter("found", lambda x: x["crowded"]).alias("found")).where(F.size("found") > 0)
        rows = hot.mapInArrow(_contexts, context).mapInArrow(_strings, "key binary, doc_id bigint, th bigint, start bigint").distinct()
        rows = scratch.keep(rows, "strings")
        place = F.struct("doc_id", "th", "start")
        firsts = rows.groupBy("key").agg(F.min(place).alias("first")).select("key", "first.doc_id", "first.th", "first.start")
        # Told apart by all four columns, so that a string met everywhere isn't one task's.
        again = rows.join(firsts, ["key", "doc_id", "th", "start"], "left_anti").select("doc_id", "th", "start", (F.col("start") + LENGTH).alias("end"))
        spans = spans.unionByName(scratch.keep(again, "crowded"))
    per = spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    out = "doc_id bigint, th bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text string" * with_text
    cut = reached.select("doc_id", "th", "text").dropDuplicates(["doc_id", "th"]).join(per, ["doc_id", "th"]).select("doc_id", "th", "text", "spans").mapInArrow(_apply(with_text), out)
    cut = cut.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), *[F.col(c).alias(f"_{c}") for c in ("n_removed", "n_spans", "kept_sha256", *["kept_text"] * with_text)])
    firsts = with_id.groupBy(F.col("th").alias("_t")).agg(F.min("doc_id").alias("first_doc"))
    plain = docs.select("doc_id", "th", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha"), *[F.col("text")] * with_text)
    rows = plain.join(firsts, F.col("th") == F.col("_t"), "left").join(cut, (F.col("doc_id") == F.col("_doc")) & (F.col("th") == F.col("_th")), "left")
    copy = F.coalesce((F.col("doc_id") > F.col("first_doc")) & (F.col("n_bytes") >= LENGTH), F.lit(False))
    pick = lambda whole, cut_, kept: F.when(copy, whole).otherwise(F.coalesce(cut_, kept))
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    return rows.select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("_n_removed"), zero).alias("n_removed"), pick(one, F.col("_n_spans"), zero).alias("n_spans"),
        pick(F.sha2(F.lit(""), 256), F.col("_kept_sha256"), F.col("sha")).alias("kept_sha256"),
        *[pick(F.lit(""), F.col("_kept_text"), F.col("text")).alias("kept_text")] * with_text,
    )


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats of all documents."""
    return without_repeats(documents(spark, sf_dir))
