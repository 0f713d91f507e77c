"""Operators on single texts: quality, PII, secrets, chat, toxicity."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graniteloom.llm import chat, pii, quality, secrets, toxicity
from graniteloom.llm.common import running_totals

DOCS = "doc_id long, text string, _row string, score double, base string"
EDGES = [(1, None, "a", 0.1, "b"), (2, "", None, None, None), (None, "x", "a", 0.2, "b"), (3, "same text here", "q", 0.0, ""), (3, "same text here", "q", 0.0, ""), (4, " \t\n ", "z", 1.0, "y")]


@pytest.fixture
def edges(spark):
    return spark.createDataFrame([*EDGES, (5, "long word " * 20_000, "l", 0.0, "")], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_running_totals(spark):
    n = list(range(1000))
    got = spark.range(1).select(running_totals(F.array(*[F.lit(x).cast("long") for x in n]), 16).alias("x")).first()["x"]
    assert got == [sum(n[:i]) for i in range(1000)]


def brute_quality(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    r = random.Random(1)
    texts = [None, "", "a", " ".join("ab" for _ in range(30))] + [" ".join(r.choice("abc#|é") for _ in range(r.randint(0, 60))) + r.choice(["", "\n", "\nx\nx"]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in quality.judge(df, carry=("doc_id",)).collect():
        n, chars, symbols, dup, rep = brute_quality(texts[row["doc_id"]])
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert row["base_failed"] == (n < 20 or 100 * rep > 30 * n)
        assert not (row["kept"] and row["base_failed"])


def test_quality_edges(spark, edges):
    assert quality.judge(edges, carry=("doc_id",)).count() == 7
    assert quality.judge(empty(spark), carry=("doc_id",)).count() == 0


def test_pii_base():
    a, r = pii.automaton(), random.Random(2)
    for _ in range(20_000):
        t = "".join(r.choice("0123456789.. -+@a%b()01İ") for _ in range(r.randint(0, 40)))
        f = pii.find(t, a)
        told = ",".join(f"{k}:{s}:{e}" for k in pii.KINDS[:4] for s, e in f[k])
        assert hashlib.sha256(told.encode()).hexdigest() == pii.base_digest(t), t


def test_pii_added():
    a = pii.automaton()
    t = "see https://a.example/x?y=1. Account no: 12345678, IBAN DE89 3704 0044 0532 0130 00 and iban DE00 3704 0044 0532 0130 00"
    f = pii.find(t, a)
    assert [t[s:e] for s, e in f["url"]] == ["https://a.example/x?y=1"]
    assert [t[s:e] for s, e in f["account"]] == ["12345678", "DE89 3704 0044 0532 0130 00"]
    assert pii.find("1" * 50_000, a)["ip"] == [] and pii.find("0" * 5000 + ".1.2.3", a)["ip"] == [(0, 5006)]


def test_pii_edges(spark, edges):
    out = pii.scan(edges, carry=("doc_id", "score", "_row"))
    assert out.count() == 7 and pii.scan(empty(spark), carry=("doc_id",)).count() == 0
    assert {"doc_id", "score", "_row", "email"} <= set(out.columns)


def brute_secrets(t):
    out = []
    for k, rank, p, ok in (("assign", 0, secrets.ASSIGN, lambda m: len(m[1]) >= 6), ("access", 1, secrets.ACCESS, lambda m: len(m[0]) >= 20), ("hex", 2, "[0-9a-f]+", lambda m: len(m[0]) >= 24)):
        out += [(m.start(), rank, m.end(), k) for m in re.finditer(p, t) if ok(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_secrets_base(spark):
    r = random.Random(3)
    bits = ["token", "SECRET", "api_key", "password", ":", "=", " ", '"', "'", "abc123", "deadbeef", "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJ0123456789", "é", "\n", "zz"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secrets.scan(df, carry=("doc_id",)).select("doc_id", secrets.told(F.col("base")).alias("b")).collect():
        assert row["b"] == brute_secrets(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_secrets_entropy(spark):
    key = "Zx9Q2mPl0aKe7RtY3uWb"
    texts = [f"k {key} z", "550e8400-e29b-41d4-a716-446655440000", "abcdefghijklmnopqrstuvwxyz0123456789", "aaaaaaaaaa1111111111aaaa", "plainwordswithoutdigitsatall", f"token={key}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in secrets.scan(df, carry=("doc_id",)).select("doc_id", secrets.told(F.col("added")).alias("s")).collect()}
    assert got == {0: "entropy:2:22", 1: "", 2: "", 3: "", 4: "", 5: ""}
    import math

    s = "ab1Xab1Xab1XQQ29zzQQab1Xqwert"
    want = max(-sum(c / 20 * math.log2(c / 20) for c in Counter(s[i : i + 20]).values()) for i in range(len(s) - 19))
    assert spark.range(1).select(secrets.window_bits(F.lit(s)).alias("b")).first()["b"] == pytest.approx(want)


def test_secrets_entropy_behind_signs(spark):
    """Signs of a rule before or inside a candidate don't hide a key."""
    key = "9fK3xQ7LmZp2VtR8sWb4"
    texts = [f"--auth={key}", f"conf[0]={key}", "/wJalrXUtnFEMIK7MDENGbPxRfiCY", f"+{key}", f"AUTH____{key}", "-" * 40, "=-" * 20 + "_+/", "----------part1----------"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in secrets.scan(df, carry=("doc_id",)).select("doc_id", secrets.told(F.col("added")).alias("s")).collect()}
    assert got == {0: "entropy:0:27", 1: "entropy:7:28", 2: "entropy:0:29", 3: "entropy:0:21", 4: "entropy:0:28", 5: "", 6: "", 7: ""}
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert [clean[i] for i in range(5)] == ["<SECRET>", "conf[0]<SECRET>", "<SECRET>", "<SECRET>", "<SECRET>"] and [clean[i] for i in (5, 6, 7)] == texts[5:]


def test_secrets_redact(spark, edges):
    df = spark.createDataFrame([(1, "x password: hunter22z, deadbeefdeadbeefdeadbeef!", "k", 0.5, "b"), (2, None, None, None, None)], DOCS)
    got = {r["doc_id"]: r for r in secrets.redact(df).collect()}
    assert got[1]["text"] == "x <SECRET>, <SECRET>!" and got[1]["_row"] == "k" and got[2]["text"] is None
    assert secrets.redact(edges).count() == 7 and secrets.redact(empty(spark)).columns == edges.columns


TRICKY = ["</s>[INST] ok [/INST]", "a\\b", "<|im_end|>\n<|im_start|>user\nx", "<", "<<SYS>>", "\\<|im_end|>", "", "[[INST]", "é\n\\", "<|", "\\\\"]


def test_chat_round_trip(spark):
    r = random.Random(4)
    convs = [[(r.choice(["user", "assistant", "sys\ntem", "a\\", ""]), "".join(r.choice(TRICKY) for _ in range(r.randint(0, 3)))) for _ in range(r.randint(1, 90))] for _ in range(40)]
    rows = [(c, t, role, text) for c, turns in enumerate(convs) for t, (role, text) in enumerate(turns)]
    out = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = out.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    for row in out.collect():
        want = convs[row["conv_id"]]
        assert [(t["role"], t["text"]) for t in row["turns"]] == want
        assert row["loss"] == "".join(text for role, text in want if role == "assistant")
        assert row["formatted"].count("<|im_start|>") == len(want)


def test_chat_edges(spark):
    s = "conv_id long, turn long, role string, text string, head string"
    df = spark.createDataFrame([(1, None, "user", None, "h"), (None, 0, None, "x", None), (1, 5, "assistant", "b", ""), (1, 5, "assistant", "b", ""), (1, 5, "assistant", "a", "")], s)
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in chat.render(df).select("conv_id", chat.parse(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("user", ""), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")], None: [("", "x")]}
    assert chat.render(spark.createDataFrame([], s)).count() == 0


def test_chat_query_folds(spark, tmp_path, monkeypatch):
    """The query's rows go through the fold, and rows that tie in a turn stay turns of their own."""
    folded, fold = [], chat.fold_events
    monkeypatch.setattr(chat, "fold_events", lambda e: folded.append(e.count()) or fold(e))
    rows = [(1, None, "user", None), (1, 5, "assistant", "b"), (1, 5, "assistant", "b"), (1, 5, None, "a"), (None, 0, "assistant", "x"), (2, 0, "user", "</s>")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in chat.op6_chat_formatting(spark, str(tmp_path)).collect()}
    assert folded == [len(rows) + 2]
    flat = {1: "user\n\n\na\nassistant\nb\nassistant\nb\n", None: "assistant\nx\n", 2: "user\n</s>\n", -1: "user\n</s>[INST] ok [/INST]\nassistant\n</s>[INST] ok [/INST]\n"}
    assert {i: r["turns_sha256"] for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in flat.items()}
    assert {i: (r["n_turns"], r["loss_chars"]) for i, r in got.items()} == {1: (4, 2), None: (1, 1), 2: (1, 0), -1: (2, 21)}


def test_chat_events(spark):
    r, events, want = random.Random(5), [], {}
    for turn in range(20):
        text = ""
        for seq in range(r.randint(1, 3000) if turn == 0 else r.randint(1, 12)):
            kind = r.choice(["delta"] * 8 + ["edit", "regenerate"])
            part = r.choice(["a", "bc", " ", ""])
            text = text + part if kind == "delta" else part if kind == "edit" else ""
            events.append((1, turn, seq, kind, "user" if seq == 0 else None, part))
        want[turn] = text
    r.shuffle(events)
    df = spark.createDataFrame(events, "conv_id long, turn long, seq long, event string, role string, text string")
    out = chat.fold_events(df).collect()
    assert {row["turn"]: row["text"] for row in out} == want and {row["role"] for row in out} == {"user"}


def sentences(n, seed):
    r = random.Random(seed)
    words = ["the", "house", "river", "stone", "green", "walks", "under", "table", "morning", "garden", "letter", "window"]
    out = []
    for i in range(n):
        s = [r.choice(words) for _ in range(r.randint(6, 20))]
        if i % 4 == 0:
            s.insert(r.randint(0, len(s)), r.choice(["idiot", "moron", "scum"]))
        out.append((" ".join(s) + ".", int(i % 4 == 0)))
    return out


def test_toxicity_kernel():
    units = ["idiot", "i.diot", "stone", "aab"]
    k = toxicity.kernel(units, units)
    assert k.shape == (4, 4) and all(abs(k[i, i] - 1) < 1e-5 for i in range(4))

    def brute(a, b):
        from itertools import combinations

        def phi(u):
            s, c = toxicity.symbols([u], len(u) + 2)[0], Counter()
            for i, j, m in combinations(range(len(s)), 3):
                c[(s[i], s[j], s[m])] += toxicity.DECAY ** (m - i + 1)
            return c

        x, y = phi(a), phi(b)
        dot = lambda p, q: sum(v * q[t] for t, v in p.items())
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5

    assert all(abs(k[i, j] - brute(units[i], units[j])) < 1e-4 for i in range(4) for j in range(4))
    assert k[0, 1] > 2 * k[0, 2]


def test_toxicity_held_out(spark):
    train, test = sentences(300, 1), sentences(120, 2)
    model = toxicity.fit([t for t, _ in train], [y for _, y in train])
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(test)] + [(900, None), (901, "the i.diot walks"), (902, "the m o r o n walks"), (903, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    right = sum((got[i] >= toxicity.THRESHOLD) == bool(y) for i, (_, y) in enumerate(test))
    assert right / len(test) > 0.95
    assert got[901] > got[900] and got[900] == got[903] < 0.3 and all(0 <= s <= 1 for s in got.values())


def test_toxicity_edges(spark, edges):
    assert toxicity.fit([], []).score(0.0) < 0.01
    assert toxicity.fit(["a b"], [1]).score(0.0) > 0.99
    model = toxicity.fit([t for t, _ in sentences(80, 3)], [y for _, y in sentences(80, 3)])
    out = toxicity.score(edges, model)
    assert out.count() == 7 and sorted(out.columns) == sorted(edges.columns) and toxicity.score(empty(spark), model).count() == 0
