"""N-gram Jaccard join by PartEnum signatures.

Two documents link if 100 * |A & B| >= ``PERCENT`` * |A | B| for their sets of word shingles. Sets whose
Jaccard similarity is 0.8 or more differ in at most (|A| + |B|) / 9 shingles. PartEnum turns that into equality:

* Sets of up to ``SMALL`` shingles: every shingle is a partition of its own; the subsets that leave out
  at most one are enumerated (such sets differ by one shingle, or by one in each).
* Larger sets: bands of size, each up to 1.6 times its least size. In a band whose linked sets differ in k shingles at
  most, the domain is hashed into n1 groups of n2 partitions with n1 * (k2 + 1) > k, so linked sets have a group in which at most k2
  partitions differ: every subset of n2 - k2 partitions of every group is enumerated, its content is a
  signature (``_scheme``). A set signs in its own band, and in the next if a set there could link with it.
* Subsets whose partitions are all empty are signed only by sets that need them: to spoil a group for a set, a
  linked one must differ in k2 + 1 of its partitions, or in all that aren't empty and then some. If what all groups ask together is more
  than the set can differ in, a signature that isn't empty is shared (``signatures``).

Groups that share a signature are never paired off whole. Exact copies of a set are one node. Every
group first offers its smallest member to the others (a star); each node then has the nearest of its leaders checked, and components follow.
Pairs that are a group of their own and aren't in one component by then are all checked. Groups that are in one component are done. What more than ``CROWDED`` sets outside of a group's
largest component share is split by the signatures of a second, independent partitioning (linked sets share one under every seed, so
the pair of signatures is a finer exact key). In the groups that are left, rounds of leaders from outside the largest component (about ``LEADERS`` a
group) are held against all members of other components. In the first round a node leads in two of its groups and has its one nearest
member checked, which joins most components; then a leader has the nearest of every component checked, eight times as many each round, until all are.
Nothing is capped or dropped.

Nearness is read from odd sketches (parity bits, two or more a shingle): linked sets' sketches differ in no more bits than the
sets in shingles, so a pair whose sketches differ in more is ruled out without a text being moved; the rest are checked on whole texts. Leader and members
meet in a task as sorted streams, the leader first; hot leaders and groups are dealt over salts of about ``SALT`` members.

Defined cases: a null or empty text has no shingles, links with nothing and is its own component;
repeated rows are copies of each other; rows with a null id link like any other and
take their component's smallest id, null if none in it has an id; rows that repeat an id with other texts are nodes of their own
under the same id; an empty table gives an empty table; further columns are ignored; texts of any length are read whole.
Sets are compared by 64-bit numbers of shingles, nodes by one 64-bit number of the set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from graniteloom.llm.common import Scratch, documents, release
from graniteloom.llm.components import components
from graniteloom.llm.shingles import U, mix, odd_sketches, set_numbers, shingle_sets

WIDTH = 5
#: Fixed by the bounds above: 4 in 5, and (1 - 0.8) / (1 + 0.8) = 1 / 9.
PERCENT = 80
SMALL = 9
#: Leaders of a group in a round (about), members of a salt (about), sets outside a group's largest component from which it is split again, and seeds to split by.
LEADERS, SALT, CROWDED, SEEDS = 1024, 500, 4096, 3
#: Rows of ids or groups that are broadcast at most (some 20 MB), counted before; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Characters of text that are turned into numbers at once, and signatures held before they are sent on.
CHUNK, HELD = 300_000, 300_000


def _bands(most: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    low, high = [], []
    a = SMALL + 1
    while a < most:
        low.append(a)
        high.append(int(a * 1.6))
        a = high[-1] + 1
    return np.array(low), np.array(high)


LOW, HIGH = _bands()
DIFFER = 2 * HIGH // 9


def _scheme(k: int) -> tuple[int, int, int]:
    """(n1, k2, n2) for sets that differ in ``k`` partitions at most: n1 * (k2 + 1) > k, with some groups to spare in large bands."""
    if k <= 3:
        return 1, k, k + 4
    k2, n2 = (3, 7) if k <= 8 else (3, 6) if k <= 12 else (2, 5) if k <= 30 else (2, 4)
    n1 = -(-(k + 1) // (k2 + 1))
    return n1 + (1 + n1 // 25 if k > 8 else 0), k2, n2


def differ(size: np.ndarray, band: int) -> np.ndarray:
    """How many shingles a set of this size and a set of the band that it links with differ in at most."""
    return (size + np.minimum(HIGH[band], size * 5 // 4)) // 9


def signatures(shingles: np.ndarray, offsets: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of the given sets."""
    size = np.diff(offsets)
    owner = np.repeat(np.arange(len(size)), size)
    scattered = mix(shingles + U(0x5851F42D4C957F2D))
    total = np.concatenate([[U(0)], np.cumsum(scattered, dtype=np.uint64)])
    sums = total[offsets[1:]] - total[offsets[:-1]]
    tiny = (size >= 4) & (size <= SMALL)
    at = np.flatnonzero(tiny[owner])
    out_s = [mix(sums[tiny] ^ U(0x1234567)), mix((sums[owner[at]] - scattered[at]) ^ U(0x1234567))]
    out_o = [np.flatnonzero(tiny), owner[at]]
    own = np.where(size > SMALL, np.searchsorted(HIGH, size), -1)
    # Sets below the first band can sign in that one alone, as their next.
    up = np.where((size >= 4) & (size * 5 // 4 >= LOW[own + 1]), own + 1, -1)
    for band in sorted(({*own.tolist()} | {*up.tolist()}) - {-1}):
        sets = np.flatnonzero((own == band) | (up == band))
        n1, k2, n2 = _scheme(int(DIFFER[band]))
        n, parts = size[sets], n1 * n2
        inside = np.repeat(offsets[sets] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        salt = mix(np.array([band + 1 + 1000 * seed], dtype=np.uint64) * U(0x9E3779B97F4A7C15))[0]
        part = ((mix(shingles[inside] ^ salt) >> U(32)) * U(parts)) >> U(32)
        place = np.repeat(np.arange(len(sets)) * parts, n) + part.astype(np.int64)
        content = np.zeros(len(sets) * parts, dtype=np.uint64)
        np.add.at(content, place, scattered[inside])
        full = (np.bincount(place, minlength=len(content)) > 0).reshape(len(sets), n1, n2)
        # What a linked set must differ in to share no signature that isn't empty.
        asked = np.minimum(k2 + 1, full.sum(axis=2)).sum(axis=1)
        subsets = np.array(list(combinations(range(n2), n2 - k2)))
        number = mix((np.arange(n1 * len(subsets), dtype=np.uint64) + salt) * U(0x2545F4914F6CDD1D)).reshape(1, n1, len(subsets))
        sig = mix(content.reshape(len(sets), n1, n2)[:, :, subsets].sum(axis=3, dtype=np.uint64) + number)
        keep = full[:, :, subsets].any(axis=3) | (asked <= differ(n, band))[:, None, None]
        out_s.append(sig[keep])
        out_o.append(np.broadcast_to(sets[:, None, None], sig.shape)[keep])
    return np.concatenate(out_s), np.concatenate(out_o)


def chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches with about ``CHUNK`` characters of text."""
    for batch in batches:
        texts, a, size = batch.column(batch.schema.get_field_index(column)), 0, 0
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for b, n in enumerate(lengths, 1):
            size += n
            if size >= CHUNK or b == len(lengths):
                yield batch.slice(a, b - a), [x or "" for x in texts.slice(a, b - a).to_pylist()]
                a, size = b, 0


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches, "text"):
        s, at = shingle_sets(texts, WIDTH)
        n = np.diff(at)
        node = pa.array(set_numbers(s, at), mask=n == 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), node, pa.array(odd_sketches(s, at), type=pa.binary())], names=["doc_id", "n_shingles", "node", "sketch"])
    release()


def _sign(buckets: int, seed: int = 0):
    """Rows (bucket, pairs): packed (signature, node) pairs of a bucket of signatures; rows have a text, and for later seeds the groups it is in, ``gids``."""

    def send(sig: list[np.ndarray], node: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        s, n = np.concatenate(sig), np.concatenate(node)
        bucket = ((s >> U(32)) * U(buckets)) >> U(32)
        order = np.argsort(bucket, kind="stable")
        s, n, bucket = s[order], n[order], bucket[order].astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.concatenate([edge[1:], [len(s)]])
        for first in range(0, len(edge), 256):
            some = list(zip(edge[first : first + 256].tolist(), ends[first : first + 256].tolist(), strict=True))
            packed = [pack(s[a:b], n[a:b]) for a, b in some]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[[a for a, _ in some]]), pa.array(packed, type=pa.binary())], names=["bucket", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, node, held, seen = [], [], 0, set()
        for batch, texts in chunks(batches, "text"):
            shingles, at = shingle_sets(texts, WIDTH)
            nodes = set_numbers(shingles, at)
            if seed:
                s, of = signatures(shingles, at, seed)
                gids = batch.column(batch.schema.get_field_index("gids"))
                start, flat = np.asarray(gids.offsets), np.asarray(gids.values).view(np.uint64)
                for i in range(len(texts)):
                    g, mine = flat[start[i] : start[i + 1]], s[of == i]
                    for a in range(0, len(g), max(1, HELD // max(len(mine), 1))):
                        some = g[a : a + max(1, HELD // max(len(mine), 1))]
                        sig.append(mix((mine[None, :] + some[:, None] * U(0x9E6C63D0876A9A47)).ravel()))
                        node.append(np.full(len(sig[-1]), nodes[i]))
                        held += len(sig[-1])
                        if held >= HELD:
                            yield from send(sig, node)
                            sig, node, held = [], [], 0
                continue
            fresh = [i for i, x in enumerate(nodes.tolist()) if x not in seen and not seen.add(x)]  # a copy in this task has signed already
            if len(fresh) < len(nodes):
                size = np.diff(at)[fresh]
                inside = np.repeat(at[:-1][fresh] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                shingles, nodes, at = shingles[inside], nodes[fresh], np.concatenate([[0], np.cumsum(size)])
            s, of = signatures(shingles, at)
            sig.append(s)
            node.append(nodes[of])
            held += len(s)
            if len(seen) > 100_000:
                seen.clear()
            if held >= HELD:
                yield from send(sig, node)
                sig, node, held = [], [], 0
        if held:
            yield from send(sig, node)
        sig, node, seen = [], [], set()
        release()

    return run


def pack(s: np.ndarray, n: np.ndarray) -> bytes:
    """Nodes, and 32 bits of each one's signature: twelve bytes a pair, however many buckets there are.

    Signatures that agree in 32 bits and the bucket only make candidates, which are checked on texts.
    """
    return n.astype("<i8").tobytes() + s.astype("<u4").tobytes()


def unpack(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = len(b) // 12
    return np.frombuffer(b, dtype="<u4", offset=8 * k).astype(np.uint64), np.frombuffer(b, dtype="<i8", count=k)


_GROUP = pa.schema([("gid", pa.int64()), ("leader", pa.int64()), ("node", pa.int64())])


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups, of rows sorted by bucket: rows (gid, leader, node); gid null for groups of two, whose pairs are checked after the star.

    Equal pairs and equal groups of a task are told once as far as a bounded memory of them goes.
    """
    told: set = set()

    def close(bucket: int, held: list[bytes]) -> pa.RecordBatch:
        got = [unpack(b) for b in held]
        s, n = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        order = np.lexsort((n, s))
        s, n = s[order], n[order]
        new = np.ones(len(s), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (n[1:] != n[:-1])
        s, n = s[new], n[new]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, dtype=np.int64)
        size = np.diff(np.concatenate([first, [len(s)]]))
        two = first[size == 2]
        pairs = [p for p in set(zip(n[two].tolist(), n[two + 1].tolist(), strict=True)) if p not in told]
        if len(told) > 300_000:
            told.clear()
        told.update(pairs)
        gids, leaders, nodes = [np.zeros(0, dtype=np.int64)], [np.array([p[0] for p in pairs], dtype=np.int64)], [np.array([p[1] for p in pairs], dtype=np.int64)]
        for a, m in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            members = n[a : a + m]
            key = hashlib.blake2b(members.tobytes(), digest_size=16).digest()
            if key in told:
                continue
            told.add(key)
            gid = mix(np.array([s[a]], dtype=np.uint64) + np.array([bucket], dtype=np.uint64) * U(0xD1B54A32D192ED03)).view(np.int64)
            gids.append(np.repeat(gid, m - 1))
            leaders.append(np.repeat(members[:1], m - 1))
            nodes.append(members[1:])
        g = np.concatenate(gids)
        gid = pa.array(np.concatenate([np.zeros(len(pairs), dtype=np.int64), g]), mask=np.arange(len(pairs) + len(g)) < len(pairs))
        return pa.RecordBatch.from_arrays([gid, pa.array(np.concatenate(leaders)), pa.array(np.concatenate(nodes))], schema=_GROUP)

    bucket, held = None, []
    for batch in batches:
        for k, b in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if k != bucket and held:
                yield close(bucket, held)
                held = []
            bucket = k
            held.append(b.as_py())
    if held:
        yield close(bucket, held)
    told, held = set(), []
    release()


class _Sketch:
    """A sketch as a number, folded to the lengths at which it is asked for."""

    def __init__(self, sketch: bytes):
        self.bits, self.of = 8 * len(sketch), {8 * len(sketch): int.from_bytes(sketch, "little")}

    def folded(self, bits: int) -> int:
        if bits not in self.of:
            wide, width = self.folded(2 * bits), bits
            self.of[bits] = (wide >> width) ^ (wide & ((1 << width) - 1))
        return self.of[bits]


_NEAR = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("far", pa.float64()), ("more", pa.bool_())])


def _near(most: int | None, by_root: bool = True):
    """Of rows (key, salt, lead, node, root, n, sketch) in order of key, salt and leaders first: pairs (leader a, member b) of different roots that sketches don't rule out.

    ``most`` of each leader and root (or of each leader alone), the nearest. Rows without b and with ``more`` name the leaders that have pairs beyond
    these: the one whose list was full, and the one left out of it if that leads too (as two leaders are compared once).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leads, lead_nodes = None, [], set()
        found: dict[tuple[int, int], list[tuple[float, int]]] = {}
        more: set[int] = set()
        out: list[tuple] = []

        def close() -> None:
            for (a, _), bs in found.items():
                out.extend((at[0], a, b, far, False) for far, b in bs)
            out.extend((at[0], a, None, None, True) for a in more)
            found.clear()
            more.clear()

        def table() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(_NEAR), _NEAR, strict=True)], schema=_NEAR)
            out.clear()
            return done

        for batch in batches:
            for key, salt, lead, node, root, n, sketch in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if (key, salt) != at:
                    if at is not None:
                        close()
                    at, leads, lead_nodes = (key, salt), [], set()
                x = _Sketch(sketch)
                if lead:
                    leads.append((node, root, n, x))
                    lead_nodes.add(node)
                    continue
                also = node in lead_nodes  # two leaders are compared once
                for a, root_a, n_a, y in leads:
                    if root_a == root or 10 * n_a < 8 * n or 10 * n < 8 * n_a or (also and a >= node):
                        continue
                    bits = min(x.bits, y.bits)
                    d = (x.folded(bits) ^ y.folded(bits)).bit_count()
                    if 9 * d > n + n_a:
                        continue
                    pair = (d / (n + n_a), node)
                    if most is None:
                        out.append((key, a, node, pair[0], False))
                        continue
                    bs = found.setdefault((a, root if by_root else 0), [])
                    bs.append(pair)
                    if len(bs) > most:
                        last = max(bs)
                        bs.remove(last)
                        more.add(a)
                        if last[1] in lead_nodes:
                            more.add(last[1])
            if len(out) > 10_000:
                yield table()
        if at is not None:
            close()
        yield table()
        release()

    return run


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, salt, lead, node, text) in order of key, salt and the leader first: the members (a, b) that link with it."""
    at, mine = None, None
    for batch, texts in chunks(batches, "text"):
        s, offsets = shingle_sets(texts, WIDTH)
        a, b = [], []
        for r, (key, salt, lead, node) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)):
            v = s[offsets[r] : offsets[r + 1]]
            if lead:
                at, mine = (key, salt), v.copy()
            elif at == (key, salt) and len(mine) and len(v):
                place = np.minimum(np.searchsorted(mine, v), len(mine) - 1)
                both = int((mine[place] == v).sum())
                if 100 * both >= PERCENT * (len(mine) + len(v) - both):
                    a.append(key)
                    b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], names=["a", "b"])
    release()


class _Join:
    """The tables of one run: nodes, groups and components."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str):
        self.spark = df.sparkSession
        self.scratch = Scratch(self.spark, "jaccard")
        self.n_parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self.docs = docs.select(F.struct("doc_id", F.xxhash64("text").alias("th")).alias("row"), "text")
        row = f"struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()},th:bigint>"
        feats = self.docs.mapInArrow(_features, f"doc_id {row}, n_shingles bigint, node bigint, sketch binary")
        self.feats = self.scratch.keep(feats.select("doc_id.*", "n_shingles", "node", "sketch"), "features")
        row = F.struct("doc_id", "th")
        rep = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), row)), F.min(row)).alias("rep")
        nodes = self.feats.where("node IS NOT NULL").groupBy("node").agg(rep, F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch"))
        self.nodes = self.scratch.keep(nodes, "nodes")
        self.roots = None

    def small(self, df: DataFrame, name: str) -> DataFrame:
        """A table to join with: broadcast if it was counted to be small enough."""
        kept, told = self.scratch.counted(df, name)
        return F.broadcast(kept) if told[0] <= BROADCAST_ROWS else kept

    def groups(self, texts: DataFrame, seed: int, name: str) -> DataFrame:
        packed = texts.mapInArrow(_sign(16 * self.n_parts, seed), "bucket bigint, pairs binary")
        grouped = packed.repartition(self.n_parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_group, "gid bigint, leader bigint, node bigint")
        return self.scratch.keep(grouped, name)

    def deal(self, leads: DataFrame, members: DataFrame, about: DataFrame, name: str) -> DataFrame:
        """Leaders (key, node, ...) and members (key, node, ...) with what ``about`` says of each node, as sorted streams of (key, salt).

        A key with many members has several salts, each with all its leaders.
        """
        hot = self.small(members.groupBy("key").count().where(F.col("count") > SALT).select(F.col("key").alias("_k"), F.ceil(F.col("count") / SALT).cast("int").alias("salts")), f"{name}-hot")
        salts = F.coalesce("salts", F.lit(1))
        place = lambda df: df.join(hot, F.col("key") == F.col("_k"), "left")
        rest = [c for c in members.columns if c != "key"]
        m = place(members).select("key", F.pmod(F.xxhash64("node"), salts).cast("int").alias("salt"), F.lit(False).alias("lead"), *rest)
        a = place(leads).select("key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(True).alias("lead"), *rest)
        return m.unionByName(a).join(about, "node").repartition(self.n_parts, "key", "salt").sortWithinPartitions("key", "salt", F.desc("lead"))

    def near(self, leads: DataFrame, members: DataFrame, most: int | None, name: str, by_root: bool = True) -> DataFrame:
        rows = self.deal(leads, members, self.nodes.select("node", "n", "sketch"), name).select("key", "salt", "lead", "node", "root", "n", "sketch")
        return self.scratch.keep(rows.mapInArrow(_near(most, by_root), "key bigint, a bigint, b bigint, far double, more boolean"), name)

    def check(self, pairs: DataFrame, name: str) -> None:
        """Add the links among pairs of nodes (a, b) and bring components up to date."""
        pairs, told = self.scratch.counted(pairs.select("a", "b").distinct(), f"{name}-pairs")
        if self.roots is not None and told[0] == 0:
            return
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        asked = self.small(nodes.join(self.nodes, "node").select(F.col("node"), F.col("rep").alias("of")), f"{name}-asked")
        texts = self.scratch.keep(self.docs.join(asked, F.col("row") == F.col("of")).select("node", "text"), f"{name}-texts")
        leads = pairs.select(F.col("a").alias("key"), F.col("a").alias("node")).distinct()
        rows = self.deal(leads, pairs.select(F.col("a").alias("key"), F.col("b").alias("node")), texts, f"{name}-deal")
        found, told = self.scratch.counted(rows.select("key", "salt", "lead", "node", "text").mapInArrow(_check, "a bigint, b bigint"), f"{name}-links")
        self.scratch.drop(f"{name}-texts", f"{name}-asked", f"{name}-pairs")
        if self.roots is None:
            self.roots = components(found, self.scratch, f"{name}-roots")
        elif told[0] > 0:
            self.roots = self.joined(found, name)

    def joined(self, links: DataFrame, name: str) -> DataFrame:
        """Roots after further links: components of the links among roots so far, which each older node then takes over.

        A root is its component's smallest node and has no row, so older links aren't gone through again.
        """
        old = self.roots
        end = lambda c: old.select(F.col("node").alias(f"_{c}"), F.col("root").alias(f"root_{c}"))
        met = links.join(end("a"), F.col("a") == F.col("_a"), "left").join(end("b"), F.col("b") == F.col("_b"), "left")
        among = met.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a <> b")
        new = components(among, self.scratch, f"{name}-roots")
        moved = old.join(new.select(F.col("node").alias("_n"), F.col("root").alias("to")), F.col("root") == F.col("_n"), "left").select("node", F.coalesce("to", "root").alias("root"))
        return self.scratch.keep(moved.unionByName(new), f"{name}-rooted")

    def undecided(self, members: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Members (gid, node, root, outside, total) of groups in more than one component, and these groups.

        ``outside``: members of the group that aren't in its largest component, or null for those that are.
        """
        m = self.scratch.keep(members.join(self.roots, "node", "left").select("gid", "node", F.coalesce("root", "node").alias("root")), f"{name}-rooted")
        sizes = m.groupBy("gid", "root").count().groupBy("gid").agg(F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("count", "root")).alias("big"), F.sum("count").alias("total"), F.max("count").alias("most"))
        split = self.small(sizes.where("roots > 1").select(F.col("gid").alias("_g"), "big", "total", (F.col("total") - F.col("most")).alias("outside")), f"{name}-split")
        return m.join(split, F.col("gid") == F.col("_g")).select("gid", "node", "root", F.when(F.col("root") != F.col("big"), F.col("outside")).alias("outside")), split

    def pairs_of_two(self, groups: DataFrame, near: DataFrame) -> DataFrame:
        """Pairs (a, b) among ``near`` that are a group of two, which no round sees, and whose ends haven't met yet."""
        end = lambda c: self.roots.select(F.col("node").alias(f"_{c}"), F.col("root").alias(f"root_{c}"))
        met = near.join(end("a"), F.col("a") == F.col("_a"), "left").join(end("b"), F.col("b") == F.col("_b"), "left")
        apart = self.small(met.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"), "two-apart")
        return groups.where("gid IS NULL").join(apart, (F.col("leader") == F.col("a")) & (F.col("node") == F.col("b"))).select("a", "b")

    def run(self) -> None:
        groups = self.groups(self.docs.select("text"), 0, "groups")
        star = groups.select(F.col("leader").alias("key"), "node", F.col("node").alias("root")).distinct()
        leads = groups.select(F.col("leader").alias("key"), F.col("leader").alias("node"), F.col("leader").alias("root")).distinct()
        near = self.near(leads, star, None, "star")
        first = self.scratch.keep(near.groupBy("b").agg(F.min_by("a", F.struct("far", "a")).alias("a")), "star-first")
        self.check(first, "star-check")
        self.check(self.pairs_of_two(groups, near.join(first, ["a", "b"], "left_anti")), "two-check")
        hot = groups.where("gid IS NOT NULL")
        live = hot.select("gid", "node").unionByName(hot.select("gid", F.col("leader").alias("node")).distinct())
        for seed in range(1, SEEDS + 1):
            members, split = self.undecided(live, f"split-{seed}")
            crowded = split.where(F.col("outside") > CROWDED).select("_g")
            if seed == SEEDS or crowded.isEmpty():
                break
            live = self.scratch.keep(members.select("gid", "node"), f"live-{seed}")
            again = live.join(crowded, F.col("gid") == F.col("_g"), "left_semi").groupBy("node").agg(F.collect_list("gid").alias("gids"))  # as long as a node's signatures
            of = self.small(again.join(self.nodes, "node").select("gids", F.col("rep").alias("of")), f"crowded-{seed}")
            finer = self.groups(self.docs.join(of, F.col("row") == F.col("of")).select("gids", "text"), seed, f"groups-{seed}")
            # Groups of two go through the rounds too, under a number of their own.
            finer = finer.select(F.coalesce("gid", F.xxhash64("leader", "node", F.lit(seed))).alias("gid"), "leader", "node")
            fine = finer.select("gid", "node").unionByName(finer.select("gid", F.col("leader").alias("node")).distinct())
            live = live.join(crowded, F.col("gid") == F.col("_g"), "left_anti").unionByName(fine)
        k = 0
        while True:
            members = self.scratch.keep(members, f"members-{k}")
            leads = members.where("outside IS NOT NULL")
            if k == 0:  # in a few of a node's groups first, as most links are found in any of them
                turn = F.row_number().over(W.partitionBy("node").orderBy(F.xxhash64("gid")))
                leads = leads.withColumn("turn", turn).where(F.col("turn") <= 2)
            chance = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(1 << 30)) / F.lit(float(1 << 30))
            leads = self.scratch.keep(leads.where(chance * F.col("outside") < LEADERS).select(F.col("gid").alias("key"), "node", "root"), f"leads-{k}")
            of = self.small(leads.select(F.col("key").alias("_g")).distinct(), f"led-{k}")
            against = members.join(of, F.col("gid") == F.col("_g"), "left_semi").select(F.col("gid").alias("key"), "node", "root")
            near = self.near(leads, against, 8 ** (k + 1) if k else 1, f"near-{k}", by_root=k > 0)
            self.check(near.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), f"check-{k}")
            unfinished = near.where("more").select("key", F.col("a").alias("node")).distinct()
            done = leads.select("key", "node").join(unfinished, ["key", "node"], "left_anti").withColumnRenamed("key", "gid")
            live, told = self.scratch.counted(members.join(done, ["gid", "node"], "left_anti").select("gid", "node"), f"live-round-{k}")
            k += 1
            members, split = self.undecided(live, f"round-{k}")
            if told[0] == 0 or split.isEmpty():
                break

    def rooted(self) -> DataFrame:
        named = self.nodes.select("node", "rep").join(self.roots.withColumnRenamed("root", "root_node"), "node", "left").withColumn("root_node", F.coalesce("root_node", "node"))
        smallest = named.groupBy("root_node").agg(F.min("rep.doc_id").alias("component_id"))
        of = named.join(smallest, "root_node").select(F.col("node").alias("_node"), "component_id", F.col("root_node").alias("root"))
        out = self.feats.join(of, F.col("node") == F.col("_node"), "left")
        return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "th", "root")


def linked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    return _rooted(df, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def _rooted(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``linked`` with ``th``, a hash of the text, and ``root``, which tells components apart that one id names (null without words)."""
    join = _Join(df, id_col, text_col)
    join.run()
    return join.rooted()


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are their component's smallest id; of rows that repeat an id in one component, the first by text.

    Rows that repeat an id with texts of several components are kept or dropped by each; a text without words is a component of its own.
    Of a component in which no row has an id, the first by text stays; rows without an id or words all stay.
    """
    rooted = _rooted(df, id_col, text_col)
    keep = rooted.where("doc_id = component_id").select("doc_id", "th", "root").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), row.alias("row"))
    kept = rows.join(keep, (F.col("id") == F.col("doc_id")) & (F.xxhash64("text") == F.col("th")))
    own_root = F.when(F.col("root").isNull(), F.col("th"))
    kept = kept.withColumn("n", F.row_number().over(W.partitionBy("id", "root", own_root).orderBy("text"))).where("n = 1").select("row")
    no_id = rows.where("id IS NULL")
    if not no_id.isEmpty():
        left = rooted.where("doc_id IS NULL AND component_id IS NULL").select("th", "root").distinct()
        own = no_id.join(left, F.xxhash64("text") == F.col("th"))
        one = own.where("root IS NOT NULL").withColumn("n", F.row_number().over(W.partitionBy("root").orderBy("text"))).where("n = 1").select("row")
        kept = kept.unionByName(one).unionByName(own.where("root IS NULL").select("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in df.columns])


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents."""
    return linked(documents(spark, sf_dir))
