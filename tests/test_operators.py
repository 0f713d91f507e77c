"""Operators over small tables: store, seeds, stages, streams, chunker, sources."""

import json
import textwrap

from pyspark.sql import functions as F

from graniteloom.operators import chunker, retrieval, search, seeds, stages
from graniteloom.operators.store import Collection
from graniteloom.plans import registry
from graniteloom.sources import datasets
from graniteloom.streaming import streams


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_collection(spark, tmp_path):
    c = Collection(spark, str(tmp_path / "c"))
    assert not c.exists()
    c.upsert(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "_id string, n int, s string"))
    c.upsert(spark.createDataFrame([("b", 5), ("d", 7)], "_id string, n int"))
    assert rows(c.read(), "_id", "n", "s") == sorted([("a", 1, "x"), ("b", 5, "y"), ("d", 7, None)])
    c.replace(spark.createDataFrame([("a", 9)], "_id string, n int"))
    assert c.get("a")["s"] is None and c.get("zz") == {}
    c.delete(spark.createDataFrame([("a",), ("nope",)], "_id string"))
    assert c.delete_where(F.col("n") > 6) == 1
    assert rows(c.read(), "_id", "n") == [("b", 5)]
    assert c.count(all=F.lit(True), none=F.col("n") > 9) == {"all": 1, "none": 0}
    try:
        c.update(spark.createDataFrame([("q", 1)], "_id string, n int"))
        raise AssertionError("no error")
    except KeyError:
        pass
    assert rows(c.get_many(spark.createDataFrame([("b",), ("b",), ("x",)], "_id string"), ["n"], keep_missing=True), "_id", "n") == [("b", 5), ("x", None)]
    c.vacuum()
    assert len(c.versions()) == 1


def test_seed_upsert(spark):
    schema = "_id string, source_type string, source_name string, source_item_id string, candidate_repo_urls array<string>"
    old = spark.createDataFrame([("a", "t", "n", "1", ["x", "y"]), ("b", "t", "n", "2", ["x"]), ("c", "t", "n", "3", ["x"])], schema).withColumn("status", F.lit("registered"))
    for n in ("first_seen_at", "last_seen_at", "last_ingested_at"):
        old = old.withColumn(n, F.to_timestamp(F.lit("2020-01-01")))
    new = spark.createDataFrame([("a", "t", "n", "1", [" y", "x", ""]), ("b", "t", "n", "2", ["x", "z"]), ("d", "t", "n", "4", ["q"])], schema)
    out = seeds.seed_upsert(old, new, F.to_timestamp(F.lit("2021-01-01")))
    assert rows(out, "_id", "status") == [("a", "registered"), ("b", "ingested"), ("c", "registered"), ("d", "ingested")]


def test_plan_shards(spark):
    e = spark.createDataFrame([("a", 10, "light"), ("b", 7, "light"), ("c", 7, "light"), ("d", 3, "light"), ("e", 0, "light")], "repo_id string, weight bigint, phase string")
    assert rows(stages.plan_shards(e, 2), "repo_id", "shard") == [("a", 0), ("b", 1), ("c", 1), ("d", 0), ("e", 0)]


def test_rate_limit(spark):
    e = spark.createDataFrame([("k", t) for t in (0.0, 1.0, 2.0, 10.0, 10.5, 11.0)], "key string, at double")
    got = rows(streams.rate_limit(e, "key", "at", 2, 10), "at", "allowed")
    assert got == [(0.0, True), (1.0, True), (2.0, False), (10.0, True), (10.5, False), (11.0, True)]


def test_rate_limit_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([("k", t) for t in (0.0, 1.0, 2.0, 10.0)], "key string, at double").coalesce(1).write.parquet(str(src))
    out = streams.rate_limit_stream(spark.readStream.schema("key string, at double").parquet(str(src)), 2, 10)
    q = out.writeStream.format("memory").queryName("limited").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("limited"), "at", "allowed") == [(0.0, True), (1.0, True), (2.0, False), (10.0, True)]


def test_backfill(spark, tmp_path):
    src, out = str(tmp_path / "s"), str(tmp_path / "o")
    spark.range(5).write.parquet(src)
    for _ in range(2):
        streams.backfill(spark, src, out, str(tmp_path / "c"), "id bigint", lambda s: s.where("id > 1"))
    assert spark.read.parquet(out).count() == 3
    assert streams.should_continue(5, 5, 1) and not streams.should_continue(4, 5, 1)


def test_fusion(spark):
    rule = spark.createDataFrame([(1, "a", 3.0), (1, "b", 1.0)], "source_id int, chunk_id string, score double")
    knn = spark.createDataFrame([(1, "b", 0.9), (1, "c", 0.9)], "source_id int, chunk_id string, score double")
    assert rows(retrieval.fuse(rule, knn), "rank", "chunk_id", "fused") == [(1, "b", 1.0), (2, "a", 1.0), (3, "c", 0.0)]
    assert rows(retrieval.scale(knn.where("chunk_id = 'c'"), ["source_id"], "score", [F.asc("chunk_id")]), "scaled") == [(1.0,)]


def test_bool_query(spark):
    df = spark.range(10)
    q = search.bool_query(filter=[F.col("id") > 2], must_not=[F.col("id") == 5], should=[F.col("id") == 4, F.col("id") == 6], at_least=1)
    assert rows(df.where(q), "id") == [(4,), (6,)]


def test_knn_and_phrase(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0])], "i int, v array<double>")
    assert rows(search.knn(v.where("i = 1"), v, "i", "i", "v", "v", 2), "rank", "doc") == [(1, 1), (2, 2)]
    d = spark.createDataFrame([(1, "the quick brown fox jumps"), (2, "quick the brown fox"), (3, None)], "i int, t string")
    q = spark.createDataFrame([(7, "Quick brown fox"), (8, "fox"), (9, "")], "i int, t string")
    assert rows(search.phrase(q, d, "i", "i", F.col("t"), F.col("t")), "query", "doc") == [(7, 1), (8, 1), (8, 2)]


def test_chunker(spark):
    source = textwrap.dedent('''
        import os

        class Box:
            """A box."""

            def put(self, item, *, size=1):
                # keep it
                name = f(item, size=size)
                if name and item:
                    self.items.append(name)
                return self.put(item)
    ''')
    got = {c.symbol_name: c for c in chunker.python_chunks(source)}
    put = got["put"]
    assert put.chunk_type == "function" and put.enclosing_class == "Box" and got["Box"].chunk_type == "class"
    assert "#" not in put.normalized_code and "FUNC_0" in put.anonymized_code and "ARG_0" in put.anonymized_code and "self.items.append" in put.anonymized_code and "size=ARG" in put.anonymized_code
    assert put.call_tokens == ["f", "self.items.append", "self.put"] and "branch" in put.control_flow_tags and "and" in put.operator_tokens
    assert chunker.python_chunks("def f(:\n") == []
    files = spark.createDataFrame([("r", "a.py", "python", source), ("r", "b.txt", "unknown", "x\n" * 100), ("r", "c.py", "python", None)], "repo_id string, file_path string, language string, text string")
    out = chunker.chunk_files(files)
    assert rows(out.where("file_path = 'b.txt'"), "start_line", "end_line") == [(1, 80), (61, 100)]
    assert out.where("chunk_type = 'function'").count() == 1


def test_datasets(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"records": [{"repo": "o/r", "id": 7}, {"repo": ""}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"metadata": {"repo": "https://github.com/x/y"}}]))
    (tmp_path / "c.jsonl").write_text('{"repo": "p/q", "id": "k"}\n\n')
    got = datasets.benchmark_seeds(datasets.read_records(spark, str(tmp_path / "*.json"), "json"), "d")
    assert rows(got, "candidate_repo_urls") == [(["https://github.com/o/r"],), (["https://github.com/x/y"],)]
    assert rows(datasets.benchmark_seeds(datasets.read_records(spark, str(tmp_path / "c.jsonl"), "jsonl"), "d"), "source_item_id") == [("k",)]
    m = spark.createDataFrame([("r1", 0), ("r2", 1)], "repo_id string, shard_index int")
    datasets.write_manifest(m, str(tmp_path / "m"), "b1", "extract")
    assert rows(datasets.read_manifest(spark, str(tmp_path / "m"), "b1", "extract", "repo_id string, shard_index int", 1), "repo_id") == [("r2",)]


def test_snapshot(spark, tmp_path):
    root = tmp_path / "snap"
    (root / "src").mkdir(parents=True)
    (root / "node_modules").mkdir()
    (root / "src" / "a.py").write_text("x = 1\ny = 2")
    (root / "src" / "b.bin").write_bytes(b"a\0b")
    (root / "node_modules" / "c.js").write_text("no")
    got = datasets.read_snapshot(spark, str(root), "github:o/r")
    assert rows(got, "file_path", "language", "line_count", "is_code_file") == [("src/a.py", "python", 2, True)]


def test_validate_empty(spark):
    repos = spark.createDataFrame([("r", "chunked", "extracted", 1, None, None, None, None, "")], "repo_id string, chunk_status string, file_extract_status string, expected_files bigint, expected_code_files bigint, expected_chunks bigint, expected_functions bigint, expected_classes bigint, chunk_strategy string")
    files = spark.createDataFrame([], "repo_id string, is_code_file boolean")
    names = "validation_status chunk_type symbol_name structure_signature ast_node_sequence raw_hash normalized_hash anonymized_hash ast_root_node_type".split()
    chunks = spark.createDataFrame([], "repo_id string, " + ", ".join(f"{n} string" for n in names))
    r = stages.validate(repos, files, chunks).first()
    assert r["status"] == "validation_failed" and r["failed_rules"] == ["no_extracted_file_docs", "no_extracted_code_file_docs", "no_chunk_docs"] and r["warning_rules"] == ["text_file_count_mismatch"]


def test_structural_top_k(spark):
    """Every row as a query against brute force: large groups of equal tokens, lists, repeated ids, nulls, few others."""
    import math
    import random

    rng = random.Random(3)
    docs = [(i, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3"]), [rng.choice("abc") for _ in range(rng.randrange(3))]) for i in range(300)]
    docs += [(5, "en", "s1", ["a"]), (400, "rare", None, None), (401, None, None, None), (None, "en", "s1", [])]
    df = spark.createDataFrame(docs, "i int, chunk_type string, symbol_type string, call_tokens array<string>")
    boosts, own = {"chunk_type": 1.0, "symbol_type": 1.0, "call_tokens": 2.0}, []
    for i, kind, symbol, calls in docs:
        own.append((i, {("chunk_type", kind), ("symbol_type", symbol), *(("call_tokens", c) for c in calls or ())} - {("chunk_type", None), ("symbol_type", None)}))
    count = {}
    for _, ts in own:
        for t in ts:
            count[t] = count.get(t, 0) + 1
    scores = {}
    for q, a in own:
        for d, b in own:
            if None not in (q, d) and q != d and a & b:
                scores[q, d] = scores.get((q, d), 0) + sum(boosts[t[0]] * math.log1p((len(docs) - count[t] + 0.5) / (count[t] + 0.5)) for t in a & b)
    want = []
    for q in sorted({q for q, _ in scores}):
        best = sorted((-round(s, 6), d) for (a, d), s in scores.items() if a == q)[:10]
        want += [(q, r, d, -s) for r, (s, d) in enumerate(best, 1)]
    got = search.structural(df, df, "i", "i", 10)
    assert rows(got.withColumn("score", F.round("score", 6)), "query", "rank", "doc", "score") == want


def test_structural_query_takes_every_document(spark):
    found = registry.queries()["structural_overlap_topk"](spark, "/root/testdata/sf0.001")
    assert found.select("query").distinct().count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_knn_in_blocks(spark, monkeypatch):
    """Blocks of a few vectors against brute force: ties, copies, zeros, nulls, other lengths, columns that must be equal or differ."""
    import math
    import random

    rng = random.Random(5)
    some = [[rng.choice([-1.0, 0.0, 0.5, 2.0]) for _ in range(3)] for _ in range(60)]
    table = [(f"n{i}", rng.choice(["x", "y"]), rng.choice(["r", "s", "t"]), v) for i, v in enumerate(some + some[:20])]
    table += [("z0", "x", "r", [0.0, 0.0, 0.0]), ("z1", "x", "s", None), ("z2", "y", "t", [1.0]), ("z3", "x", "t", [1.0, None, 2.0]), ("z4", None, "r", [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(table, "i string, label string, repo string, v array<float>")

    def cosine(a, b):
        if a is None or b is None or len(a) != len(b) or None in a + b or not any(a) or not any(b):
            return 0.0
        dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
        return round(dot(a, b) / (math.sqrt(dot(a, a)) * math.sqrt(dot(b, b))), 6) + 0.0

    want = []
    for i, label, repo, v in table:
        near = sorted((-cosine(v, w), j) for j, other, far, w in table if label is not None and label == other and repo != far)
        want += [(i, r, j, -s) for r, (s, j) in enumerate(near[:4], 1)]
    monkeypatch.setattr(search, "DOC_NUMBERS", 30)
    monkeypatch.setattr(search, "QUERY_NUMBERS", 60)
    got = search.knn(df, df, "i", "i", "v", "v", 4, ("label",), ("repo",))
    assert rows(got, "query", "rank", "doc", "score") == sorted(want)


def test_bm25_of_few_queries(spark, monkeypatch):
    """Blocks of queries, copies, repeated ids, nulls: the same as by joining words, and no pair is shuffled."""
    import random

    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice("abcdefghij") * rng.choice([1, 1, 2]) for _ in range(rng.randrange(n)))
    some = [text(30) for _ in range(80)]
    docs = spark.createDataFrame([*enumerate(some), *((100 + i, t) for i, t in enumerate(some[:30])), (7, " ".join("a" for _ in some[7].split())), (300, None), (None, "a a b"), (None, "c b c")], "i int, t string")
    queries = spark.createDataFrame([*((f"q{i}", text(9)) for i in range(300)), ("q5", "a zz"), ("n", None)], "q string, t string")
    for percent in (0, 60):
        found = {}
        for most in (0, 1_000_000):
            monkeypatch.setattr(search, "BROADCAST_WORDS", most)
            hits = search.bm25(queries, docs, "q", "i", F.col("t"), F.col("t"), least_percent=percent)
            top = search.bm25(queries, docs, "q", "i", F.col("t"), F.col("t"), least_percent=percent, k=3)
            keep = lambda df, *c: sorted((tuple(r) for r in df.select("query", "doc", "matched", F.round("score", 9).alias("s"), *c).where("query <> 'q5'").collect()), key=repr)
            found[most] = keep(hits), keep(top, "rank")
        assert found[0] == found[1_000_000] and found[0][0]
    plan = search.bm25(queries, docs.where("i < 7"), "q", "i", F.col("t"), F.col("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
