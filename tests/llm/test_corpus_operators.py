"""Operators over a corpus against brute force: search, near duplicates, repeats, packing, mixing, pipeline."""

import gc
import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from graniteloom.llm import columns, jaccard, mixing, packing, repeats, search
from graniteloom.llm.common import Scratch, release_driver
from graniteloom.llm.components import components
from graniteloom.llm.shingles import odd_sketches, set_numbers, shingle_sets
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, source string, _n int, node long, spans string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "s") for r in rows], DOCS)


def near_corpus(seed=1):
    """Copies, near copies around the threshold, tiny texts, shared passages, edges."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6)))
    passage = [word() for _ in range(12)]
    rows = []
    for _ in range(60):
        base = [word() for _ in range(r.choice([1, 4, 5, 6, 8, 9, 12, 14, 20, 40, 90]))] + (passage if r.random() < 0.4 else [])
        for _ in range(r.randint(1, 6)):
            t = list(base)
            for _ in range(r.randint(0, max(1, len(t) // 30))):
                t[r.randrange(len(t))] = word()
            if r.random() < 0.3:
                t += [word() for _ in range(r.randint(0, 2))]
            rows.append(" ".join(t).upper() if r.random() < 0.2 else " ".join(t))
    rows += [None, "", "  \n", "x", "X"]
    r.shuffle(rows)
    return [(i, t, f"s{i % 3}") for i, t in enumerate(rows)]


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets, parent = {i: shingles(t) for i, t, *_ in rows}, {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("how", [{}, {"LEADERS": 6, "SALT": 3, "CROWDED": 4, "BROADCAST_ROWS": 0, "HELD": 50}])
def test_jaccard(spark, monkeypatch, how):
    """Also with few leaders a round, hot groups, groups split by later seeds, and joins that are shuffled."""
    for name, value in how.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = near_corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked(table(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_signatures_are_exact():
    """Every pair of sets that links shares a signature."""
    rng = np.random.default_rng(1)
    for size in [*range(4, 30), 45, 70, 120, 400]:
        sets = []
        base = rng.integers(0, 2**63, size=size, dtype=np.int64).astype(np.uint64)
        for _ in range(12):
            k = rng.integers(0, max(1, size // 8) + 1)
            s = np.concatenate([base[k:], rng.integers(0, 2**63, size=rng.integers(0, max(1, size // 8) + 1), dtype=np.int64).astype(np.uint64)])
            sets.append(np.unique(s))
        flat, at = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        for seed in (0, 1):
            sig, of = jaccard.signatures(flat, at, seed)
            have = [set(sig[of == i].tolist()) for i in range(len(sets))]
            for i in range(len(sets)):
                for j in range(i):
                    both = len(np.intersect1d(sets[i], sets[j]))
                    union = len(sets[i]) + len(sets[j]) - both
                    if 100 * both >= 80 * union and both != union:
                        assert have[i] & have[j], (size, i, j)


def test_jaccard_chains(spark):
    """A middle text that shares one signature with each neighbour, which share none: both links count, whichever is nearer."""
    rows = []
    for c in range(12):
        words = [f"c{c}w{i}" for i in range(13)]
        rows += [(3 * c + i, " ".join(w), "s") for i, w in enumerate((["first", *words[1:]], words, [*words[:-1], "last"]))]
    assert {i: c for i, _, c in jaccard.linked(table(spark, rows)).collect()} == {i: 3 * (i // 3) for i, *_ in rows}


def test_a_leader_left_out_of_a_full_list_has_more():
    """Leader 2 is left out of leader 1's list and has no list of its own, so it isn't done."""
    sets = {1: range(100), 2: range(4, 104), 3: range(1, 100)}
    rows = []
    for lead, nodes in ((True, (1, 2)), (False, (1, 2, 3))):
        for node in nodes:
            s = np.array(sets[node], dtype=np.uint64)
            sketch = odd_sketches(s, np.array([0, len(s)]))[0]
            rows.append((7, 0, lead, node, node if node != 3 else 9, len(s), sketch))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["key", "salt", "lead", "node", "root", "n", "sketch"])
    out = [r for b in jaccard._near(1, by_root=False)([batch]) for r in b.to_pylist()]
    assert (1, 2) not in {(r["a"], r["b"]) for r in out}
    assert {r["a"] for r in out if r["more"]} >= {1, 2}


def test_shingles():
    texts = ["a b c d e f", "A b c d e", "one two", "", "  ", "x " * 9, "a b c d e f"]
    s, at = shingle_sets(texts)
    assert np.diff(at).tolist() == [len(shingles(t)) for t in texts]
    n = set_numbers(s, at)
    assert n[0] == n[6] and len({*n[:3].tolist()}) == 3


def test_jaccard_edges(spark):
    rows = [(None, "a b c d e f g"), (7, "a b c d e f g"), (7, "a b c d e f g"), (3, "a b c d e f g"), (None, "lonely words"), (9, None)]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, __gl_n int, node string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard.linked(df).collect()), key=str)
    assert got == sorted([(None, 3), (7, 3), (7, 3), (3, 3), (None, None), (9, 9)], key=str)
    out = jaccard.deduplicated(df)
    assert out.columns == df.columns and sorted(str(r["doc_id"]) for r in out.collect()) == ["3", "9", "None"]
    assert jaccard.linked(df.limit(0)).count() == 0


def test_deduplicated_by_id_and_component(spark):
    """A text isn't lost to another text of its id; near copies of one id or of a smaller id go."""
    base = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcd"]
    near = [f"{t} more" for t in base]
    rows = [(3, base[0]), (7, near[0]), (7, base[1]), (7, near[1]), (7, base[2]), (7, base[2]), (8, base[3]), (8, None), (8, ""), (9, near[2])]
    out = jaccard.deduplicated(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, node string"))
    assert Counter((x["doc_id"], x["text"]) for x in out.collect()) == Counter([(3, base[0]), (7, base[1]), (7, base[2]), (8, base[3]), (8, None), (8, "")])


@pytest.mark.parametrize("how", [{}, {"BROADCAST_ROWS": 0}])
def test_rows_without_an_id_link(spark, monkeypatch, how):
    """Near copies are linked whether or not they have an id: also two without, and two with an id by a third without."""
    for name, value in how.items():
        monkeypatch.setattr(jaccard, name, value)
    words = [f"w{i}" for i in range(13)]
    chain = [" ".join(w) for w in (["first", *words[1:]], words, [*words[:-1], "last"])]
    base = [" ".join(f"{c}{i}" for i in range(40)) for c in "ab"]
    rows = [(4, chain[0]), (None, chain[1]), (9, chain[2]), (6, base[0]), (None, f"{base[0]} more"), (None, base[1]), (None, f"{base[1]} more"), (None, base[1]), (None, ""), (None, None)]
    df = table(spark, [(*r, "s") for r in rows])
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard.linked(df).collect())
    assert got == Counter([(4, 4), (None, 4), (9, 4), (6, 6), (None, 6), *[(None, None)] * 5])
    left = Counter((r["doc_id"], r["text"]) for r in jaccard.deduplicated(df).collect())
    assert left == Counter([(4, chain[0]), (6, base[0]), (None, base[1]), (None, ""), (None, None)])


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links, Scratch(spark, "t"), "c").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def brute_repeats(rows):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows):
        b = (t or "").encode()
        cov = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                cov[p : p + 100] = b"\1" * 100
            else:
                seen.add(b[p : p + 100])
        kept = bytes(x for x, c in zip(b, cov, strict=True) if not c)
        out[i] = (len(b), sum(cov), sum(1 for j in range(len(cov)) if cov[j] and (j == 0 or not cov[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


def repeat_corpus():
    r = random.Random(7)
    text = lambda n: "".join(r.choice("abcdeé ß") for _ in range(n))
    passages = [text(n) for n in (99, 100, 101, 130, 300)]
    rows = []
    for i in range(60):
        t = text(r.randint(0, 200))
        for _ in range(r.randint(0, 3)):
            t += r.choice(passages) + text(r.randint(0, 60))
        rows.append(t)
    rows += ["a" * 500, "a" * 150, "ab" * 200, rows[0], rows[3], "", None, text(90), passages[4] + passages[4]]
    return [(i, t, "s") for i, t in enumerate(rows)]


def test_columns():
    """The construction gives all suffixes in order, with their common prefixes."""
    r = random.Random(6)
    for n in (0, 1, 2, 7, 40):
        texts = [bytes(r.choice(b"ab\xf4\x00") for _ in range(r.choice([0, 1, 3, 30, 168]))) for _ in range(n)]
        texts += texts[:2]
        want = sorted((t[k:], i, k) for i, t in enumerate(texts) for k in range(len(t) + 1))
        suffix, common = columns.construct(texts)
        assert [(i, k) for _, i, k in want] == [(x >> 8, x & 255) for x in suffix.tolist()]
        length = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: E731, B905
        assert common.tolist() == [0] * min(len(want), 1) + [length(a[0], b[0]) for a, b in zip(want, want[1:])]  # noqa: B905


@pytest.mark.parametrize("crowded", [20_000, 3])
def test_repeats(spark, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    rows = repeat_corpus()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.without_repeats(table(spark, rows)).collect()}
    assert got == brute_repeats(rows)


def test_repeats_edges(spark):
    t = "q" + "0123456789" * 15
    rows = [(1, t, "s"), (1, t, "s"), (None, t, "s"), (2, t, "s"), (3, None, "s")]
    got = sorted(((r["doc_id"], r["n_removed"]) for r in repeats.without_repeats(table(spark, rows), with_text=True).collect()), key=str)
    inner = brute_repeats([(1, t)])[1][1]
    assert got == sorted([(1, inner), (1, inner), (None, 0), (2, len(t)), (3, 0)], key=str)
    assert repeats.without_repeats(table(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("crowded", [20_000, 3])
def test_repeats_of_an_id_with_other_texts(spark, monkeypatch, crowded):
    """Rows that repeat an id with another text are documents in order of the text's hash."""
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    rows = [(i // 3, t, s) for i, t, s in repeat_corpus()]
    r = random.Random(8)
    p = "".join(r.choice("abcde") for _ in range(240))
    rows += [(50, p + "x" * k, "s") for k in range(1, 5)] + [(51, "y" * 150, "s"), (51, "0123456789" * 5 + p, "s"), (52, p + "z", "s")]
    df = table(spark, rows)
    hashed = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")).distinct().collect()
    order = {(x["doc_id"], x["th"]): x["text"] for x in hashed}
    want = brute_repeats([(k, order[k]) for k in sorted(order)])
    got = [(x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in repeats.without_repeats(df).collect()]
    key = {(x["doc_id"], x["text"]): (x["doc_id"], x["th"]) for x in hashed}
    assert Counter(got) == Counter((i, *want[key[i, t or ""]]) for i, t, _ in rows)


def test_anchors_in_blocks(monkeypatch):
    """Blocks of places give the anchors of one block."""
    texts = [(t or "").encode() for _, t, _ in repeat_corpus()]
    want = repeats.anchors(texts)
    for places in (69, 70, 137, 1000):
        monkeypatch.setattr(repeats, "PLACES", places)
        assert all((x == y).all() for x, y in zip(want, repeats.anchors(texts), strict=True)), places


def test_anchors_of_a_long_text():
    """Past 16 MiB a text has the anchors that its bytes have elsewhere."""
    n = (1 << 24) - 2000
    tail = np.random.default_rng(5).integers(97, 123, size=5000, dtype=np.uint8).tobytes()
    _, at, h, first, last = repeats.anchors([b"a" * n + tail])
    _, at_2, h_2, first_2, last_2 = repeats.anchors([tail])
    mine = at - first >= n  # strings that are in the tail throughout
    assert mine.sum() > 100 and at.max() > 1 << 24 and (first >= last).all() and (last >= 0).all() and (first <= 68).all()
    found = set(zip((at[mine] - n).tolist(), h[mine].tolist(), first[mine].tolist(), last[mine].tolist(), strict=True))
    assert found <= set(zip(at_2.tolist(), h_2.tolist(), first_2.tolist(), last_2.tolist(), strict=True)) and len(found) >= len(at_2) - 1


def test_packing(spark):
    r = random.Random(9)
    texts = [None, "", "hello <|endoftext|> there"] + [" ".join(r.choice(["alpha", "beta,", "gamma\n", "déjà", "12345"]) for _ in range(r.randint(1, 900))) for _ in range(60)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(5, texts[5], "s"), (None, "x", "s")]
    out = packing.pack(table(spark, rows).repartition(3), length=512, open_bins=4, with_ids=True).collect()
    tok = packing.Tokens().tokenizer
    assert len({(x["doc_id"], x["piece"]) for x in out if x["doc_id"] == 5}) * 2 == sum(x["doc_id"] == 5 for x in out)
    for i, t in enumerate(texts):
        if i == 5:
            continue
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        parts = sorted((x for x in out if x["doc_id"] == i), key=lambda x: x["piece"])
        assert [x["piece"] for x in parts] == list(range(len(parts))) and all(x["length"] == 512 for x in parts[1:])
        at = 0
        for x in parts:
            raw = np.array(ids[at : at + x["length"]], dtype="<u4").tobytes()
            assert x["start"] == at and x["ids_crc32"] == zlib.crc32(raw) and bytes(x["ids"]) == raw
            at += x["length"]
        assert at == len(ids)
    by = {}
    for x in out:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 512
    assert packing.pack(table(spark, rows).limit(0)).count() == 0


def test_open_bins():
    r, bins, made = random.Random(1), packing.OpenBins(100, 3), [0]

    def new():
        made[0] += 1
        return made[0]

    held = {}
    for _ in range(500):
        n = r.randint(1, 100)
        free = {b: f for f, bs in bins.by_free.items() for b in bs}
        fits = [f for f in free.values() if f >= n]
        b, offset, closed = bins.put(n, new)
        assert offset == held.get(b, 0)
        if fits:
            assert 100 - held.get(b, 0) == min(fits) and closed is None
        elif closed is not None:
            assert len(free) == 3 and free[closed] == min(free.values())
        held[b] = offset + n
        assert held[b] <= 100 and bins.count <= 3


def test_targets(spark):
    r = random.Random(11)
    for _ in range(6):
        sizes = {f"s{i:02d}": r.choice([0, 1, 10, 500, 5000]) for i in range(r.randint(1, 9))}
        rows = [*sizes.items(), (None, 40)]
        got = {x["source"]: x["target"] for x in mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
        names = [*sorted(sizes), None]
        w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
        size = {**sizes, None: 40}
        total, want, free = 1.5 * sum(size.values()), {}, set(names)
        while True:
            share = {s: (total - sum(want.values())) * w[s] / sum(w[x] for x in free) for s in free}
            over = [s for s in free if share[s] > 2 * size[s] + 1e-9]
            if not over:
                want |= share
                break
            want |= {s: 2.0 * size[s] for s in over}
            free -= set(over)
            if not free:
                break
        assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_mixing(spark):
    r = random.Random(12)
    rows = [(i, " ".join("w" for _ in range(r.choice([0, 1, 5, 30, 80]))), r.choice(["a", "a", "b", "c", None])) for i in range(900)] + [(None, "x y", "b"), (1, None, "a"), (7, "r s t", "c"), (7, "r s t", "c")]
    df = table(spark, rows)
    a = mixing.mix(df).collect()
    assert sorted(map(str, a)) == sorted(map(str, mixing.mix(df.repartition(7)).collect())) and len(a) == len(rows)
    biggest = 80
    for s in ("a", "b", "c", None):
        mine = [x for x in a if x["source"] == s]
        taken = sum(x["copies"] * x["size"] for x in mine)
        assert abs(taken - mine[0]["target"]) <= biggest / 2 + 1e-6
        assert all(0 <= x["copies"] <= 2 for x in mine) and mine[0]["source_size"] == sum(x["size"] for x in mine)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert Counter(x["doc_id"] for x in out.collect()) == Counter(i for x in a for i in [x["doc_id"]] * x["copies"])
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed(df.limit(0)).count() == 0


def test_search(spark):
    r = random.Random(13)
    rows = [(i, " ".join(r.choice(["a", "b", "C", "dd", "e", "ff", f"r{i % 50}", f"u{i}"]) for _ in range(r.randint(0, 40))), "s") for i in range(400)] + [(400, None, "s"), (None, "a b", "s"), (20, None, "s")]
    rows[40] = (40, rows[60][1], "s")
    docs = table(spark, [x for x in rows if x[0] != 20 or x[1]]).repartition(5)
    got = {}
    for x in search.search(docs.where("doc_id % 20 = 0"), docs, k=7).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["doc_id"], x["score"]))
    words = {i: Counter(re.findall(r"\S+", (t or "").lower())) for i, t, _ in rows if i is not None and (i != 20 or t)}
    n, df = len(words), Counter(w for c in words.values() for w in c)
    mean = sum(sum(c.values()) for c in words.values()) / n
    for q in range(0, 400, 20):
        score = {}
        for i, c in words.items():
            s = sum(m * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w, m in words.get(q, {}).items() if w in c)
            if s > 0:
                score[i] = s
        want = sorted(score, key=lambda i: (-round(score[i], 6), i))[:7]
        assert [i for _, i, _ in sorted(got.get(q, []))] == want


def test_query_words_take_little_memory():
    """Packing 1,000 queries of 1,000 words holds no object for each word."""
    n, each = 1000, 1000
    words = np.random.default_rng(1).permutation(np.arange(n * each, dtype=np.int64)) * 7919 - 10**9
    batches = [pa.RecordBatch.from_arrays([pa.array(np.full(each, q)), pa.array(words[q * each : (q + 1) * each]), pa.array(words[q * each : (q + 1) * each] / 3)], names=["query_id", "word", "weight"]) for q in range(n)]
    tracemalloc.start()
    seen = 0
    for out in search._pack_queries(iter(batches)):
        for r in out.to_pylist():
            mine = np.sort(words[r["query_id"] * each : (r["query_id"] + 1) * each].view(np.uint64))
            assert r["words"] == mine.tobytes() and r["weights"] == (mine.view(np.int64) / 3).tobytes()
            seen += 1
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n and most < 50_000_000


def test_query_words_across_batches():
    """A query whose rows go on in the next batch is one query."""
    batches = [pa.RecordBatch.from_arrays([pa.array(q), pa.array(w), pa.array([float(x) for x in w])], names=["query_id", "word", "weight"]) for q, w in (([1, 1, 2], [5, -3, 4]), ([2, 2], [9, 1]), ([2, 3], [2, 8]), ([4], [6]))]
    got = {r["query_id"]: np.frombuffer(r["words"], dtype=np.uint64).view(np.int64).tolist() for b in search._pack_queries(iter(batches)) for r in b.to_pylist()}
    assert got == {1: [5, -3], 2: [1, 2, 4, 9], 3: [8], 4: [6]}


@pytest.mark.parametrize("how", [{}, {"OFTEN": 3, "CELLS": 300, "POSTINGS": 40}, {"OFTEN": 1, "DIGITS": 15}])
def test_shards_against_sums_in_order(monkeypatch, how):
    """A task's shards give the best of all documents, and scores to the last digit as sums word by word."""
    for name, value in how.items():
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, size=rng.integers(0, 60)) if x < 500) for _ in range(400)] + [None, ""]
    texts[300:310] = [texts[7]] * 10
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    monkeypatch.setattr(search, "SHARD_CHARACTERS", 8000)
    index = [r for b in search._build(iter([rows])) for r in b.to_pylist()]
    assert len(index) > 3 and sum(r["n"] for r in index) == len(texts) and sum(r["texts"] for r in index) == len(texts) - 1
    assert sum(r["words"] for r in index) == sum(len((t or "").split()) for t in texts)
    counts = [Counter(dict(zip(w.tolist(), n.tolist(), strict=True))) for w, _, n, _ in (search._counts([t or ""]) for t in texts)]
    shards = pa.RecordBatch.from_arrays([pa.array([r["data"] for r in index])], names=["data"])
    df = Counter()
    for b in search._statistics(iter([shards])):
        for r in b.to_pylist():
            df[r["word"] % 2**64] += r["n"]
    assert df == Counter(w for c in counts for w in c)
    mean, block = 20.0, []
    for q in range(0, 400, 20):
        words = np.array(sorted(counts[q]), dtype=np.uint64)
        block.append((q, words, np.array([counts[q][w] * math.log1p(400 / df[w]) for w in words.tolist()])))
    held = type("Held", (), {"value": search.Queries([x for x in block if len(x[1])])})
    got = {}
    for b in search._ask(7, mean, held)(iter([shards])):
        for r in b.to_pylist():
            got.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    for q, words, weights in block:
        score = {}
        for d, c in enumerate(counts):
            share, total = search.K1 * (1 - search.B + search.B * float(sum(c.values())) / mean), 0.0
            for w, x in zip(words.tolist(), weights.tolist(), strict=True):
                if w in c:
                    total += x * (c[w] * (search.K1 + 1) / (c[w] + share))
            if total > 0:
                score[d] = float(np.round(total, search.DIGITS))
        assert got.get(q, []) == sorted(score.items(), key=lambda x: (-x[1], x[0]))[:7]


def test_alike_texts_stand_together():
    """Texts of two vocabularies that come in turn are in blocks of their own, in a shard and among queries, so that a product takes half of the blocks."""
    r = random.Random(5)
    texts = [" ".join(r.choices([f"{'ab'[i % 2]}{w}" for w in range(60)], k=80)) for i in range(4 * search.BLOCK)]
    shard = search.Shard(np.arange(len(texts)), texts)
    asked = search.Queries([(i, w, np.ones(len(w))) for i, t in enumerate(texts) for w, *_ in [search._counts([t])]])
    for ids in (shard.ids, asked.ids):
        assert sorted(ids.tolist()) == list(range(len(texts)))
        assert len(set((ids[: len(ids) // 2] % 2).tolist())) == len(set((ids[len(ids) // 2 :] % 2).tolist())) == 1


def test_scores_that_single_precision_does_not_tell_apart():
    """Texts whose scores differ by some 1e-9 of themselves are ranked as in doubles, though the product is in single precision."""
    rng = np.random.default_rng(8)
    # Of each pair of words, which weigh nearly the same, a text has one.
    words, weight = [f"w{i}" for i in range(300)], np.repeat(rng.uniform(50, 150, 150), 2) + 0.00001 * rng.integers(0, 9, 300)
    has = np.arange(0, 300, 2) + rng.integers(0, 2, (200, 150))
    number = search.word_numbers([" ".join(words)])[0]
    rows = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([" ".join(words[i] for i in h) for h in has.tolist()])], names=["doc_id", "text"])
    (index,) = [r for b in search._build(iter([rows])) for r in b.to_pylist()]
    asked = np.argsort(number)
    held = type("Held", (), {"value": search.Queries([(q, number[asked], weight[asked]) for q in (1, 2)])})
    got = [tuple(r.values()) for b in search._ask(7, 150.0, held)(iter([pa.RecordBatch.from_arrays([pa.array([index["data"]])], names=["data"])])) for r in b.to_pylist()]
    best = sorted(((i, float(np.round(weight[h].sum(), 6))) for i, h in enumerate(has)), key=lambda x: (-x[1], x[0]))[:7]
    assert got == [(q, *x) for q in (1, 2) for x in best]


def test_an_index_is_small():
    """A shard takes less than 16 bytes a word of its texts and is read for its statistics too, so that no other pass over texts is needed."""
    texts = [" ".join(f"w{(7 * i + k * k) % 3000}" for k in range(200)) for i in range(300)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], names=["doc_id", "text"])
    (shard,) = [r for b in search._build(iter([rows])) for r in b.to_pylist()]
    assert shard["n"] == 300 and len(shard["data"]) < 16 * shard["words"]


def test_search_repeated_rows(spark):
    """Rows that repeat an id and text more than k times take one place, in one shard or several."""
    rows = [(i, f"apple w{i} " + "pear " * (i % 5), "s") for i in range(30)]
    rows.append((7, "pear apple apple", "s"))  # an id with another text is another document
    want = None
    for df in (table(spark, rows).coalesce(1), table(spark, rows + [rows[0]] * 12 + [rows[7]] * 40).coalesce(1), table(spark, [rows[0]] * 40 + rows).repartition(3)):
        queries = df.where("doc_id = 0").limit(1)
        got = [(x["rank"], x["doc_id"], x["score"]) for x in search.search(queries, df, k=5).orderBy("rank").collect()]
        want = want or got
        assert got == want and [x[0] for x in got] == [1, 2, 3, 4, 5] and got[0][1] == 0


def test_a_kept_table_leaves_no_freed_memory_in_the_driver(spark):
    """Freed blocks between used ones stay in an arena of the JVM's malloc until it is told to give them back."""
    jvm = spark.sparkContext._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()
    used = lambda: sum(int(x) for x in re.findall(r"\nPss_Anon:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text())) // 1024
    if not release_driver(spark):
        pytest.skip("a Java without the command")
    scratch = Scratch(spark, "trim")
    scratch.keep(spark.range(1), "first")
    blocks = [jvm.java.nio.ByteBuffer.allocateDirect(60_000) for _ in range(2000)]
    blocks = blocks[::20]
    for _ in range(3):
        gc.collect()
        jvm.System.gc()
        time.sleep(0.3)
    before = used()
    scratch.keep(spark.range(1), "rows")
    assert used() < before - 50
    assert len(blocks) == 100


def test_pipeline_chains(spark, tmp_path):
    """The near-duplicate stage leaves the smallest id of each chain, though one link of a chain isn't its middle text's nearest."""
    import corpus_pipeline as pipeline

    rows = []
    for c in range(12):
        words = [f"c{c}w{i}" for i in range(13)]
        rows += [(3 * c + i, " ".join(w), "s") for i, w in enumerate((["first", *words[1:]], words, [*words[:-1], "last"]))]
    assert {r["doc_id"] for r in pipeline.near_copies_out(spark, table(spark, rows), str(tmp_path)).collect()} == set(range(0, 36, 3))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as pipeline

    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    docs, labels = [], []
    for i in range(240):
        t = [word() for _ in range(r.randint(15, 60))]
        toxic = i % 5 == 0
        if toxic:
            t[r.randrange(len(t))] = r.choice(["blockhead", "nitwit"])
        docs.append((i, " ".join(t), "en", f"s{i % 4}", 0))
        labels.append((i, 1, int(toxic)))
    docs.append((300, docs[1][1], "en", "s1", 0))
    docs.append((301, docs[2][1] + " password: hunter22zz", "en", "s2", 0))
    docs.append((302, " ".join(word() for _ in range(30)) + " password: hunter22zz", "en", "s2", 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = rows.columns
    for name, stage in pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, rows, str(tmp_path)).write.parquet(out)
        rows = spark.read.parquet(out)
        seen.append(rows)
        if name != "packing":
            assert rows.columns == columns
    toxic = {i for i, _, y in labels if y}
    kept = {x["doc_id"] for x in seen[0].collect()}
    assert len(kept & toxic) <= 2 and len({i for i, *_ in docs} - toxic - kept) <= 4
    after = {x["doc_id"] for x in seen[1].collect()}
    rest = [(x["doc_id"], x["text"]) for x in seen[0].collect()]
    assert after == {c for _, c in brute_components(rest).values()}
    clean = {x["doc_id"]: x["text"] for x in seen[2].collect()}
    assert set(clean) == after and all("hunter22zz" not in t for t in clean.values()) and clean[302].endswith("<SECRET>")
    assert {x["doc_id"] for x in seen[3].collect()} <= after and seen[3].count() > 0
    assert sum(x["length"] for x in seen[4].collect()) == sum(len(packing.Tokens()(x["text"])) // 4 + 1 for x in seen[3].collect())
    assert pipeline.run(spark, str(tmp_path)).count() == seen[4].count()
