"""Shapes of results, the composed retrieval and the dataset helpers on small tables."""

import io
import tarfile

from graniteloom.operators import hybrid, payloads
from graniteloom.sources import datasets
from pyspark.sql import functions as F


def test_reasons_and_repo(spark):
    df = spark.createDataFrame([([" a ", "", "Hybrid similarity score after scaling: 1", None, "b", "c", "d"],), (None,)], "r array<string>")
    assert [x["s"] for x in df.select(payloads.shown_reasons(F.col("r")).alias("s")).collect()] == [["a", "b", "c"], []]
    registry = spark.createDataFrame([("r1", "https://x/r1", "own", "one", "MIT", None, "public", True)], "repo_id string, canonical_repo_url string, owner string, repo_name string, repo_license_spdx string, repo_license_name string, repo_visibility string, repo_is_fork boolean")
    out = payloads.with_source_repo(spark.createDataFrame([("r1", " "), ("r2", "u2"), (None, None)], "repo_id string, repo_url string"), registry)
    got = {x["repo_id"]: x["source_repo"].asDict() for x in out.collect()}
    assert got["r1"]["repo_url"] == "https://x/r1" and got["r1"]["owner"] == "own" and got["r1"]["is_fork"] is True and got["r1"]["license_name"] == ""
    assert got["r2"]["repo_url"] == "u2" and got["r2"]["license_spdx"] == "" and got["r2"]["is_fork"] is False and got[None]["repo_id"] == ""


def test_reader_and_rerank(spark):
    row = {"chunk_id": "c", "repo_id": "r", "file_path": "f", "symbol_name": "", "raw_code": "x", "language": "go", "chunk_type": "t", "anonymized_code": "a"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)).select(F.struct("*").alias("c"))
    repo = F.struct(F.lit("u").alias("repo_url"), F.lit(" ").alias("license_spdx"), F.lit("M").alias("license_name"))
    review = F.struct(F.lit("high").alias("risk_level"), F.lit(0.7).alias("risk_score"), F.lit("raw_hash_match").alias("strongest_evidence_type"), F.lit("MIT").alias("license_spdx"), F.array(F.lit("one")).alias("reasons"))
    fused = F.struct(F.lit(1.0).alias("score"), F.lit(2).alias("source_count"), F.lit(0.5).alias("rule_based_scaled_score"), F.lit(0.5).alias("knn_scaled_score"))
    arms = F.array(F.lit("knn"))
    c = F.col("c")
    got = df.select(payloads.for_reader(repo, review, c["file_path"], c["symbol_name"], c["raw_code"], arms).alias("a"), payloads.for_rerank(c, c, repo, fused, review, arms).alias("b")).first()
    assert got["a"]["repository"]["license_spdx"] is None and got["a"]["location"]["symbol_name"] is None and got["a"]["review_priority"]["level"] == "high" and got["a"]["review_reasons"] == ["one"]
    assert got["b"]["candidate_chunk"]["language"] == "go" and got["b"]["hybrid"]["source_count"] == 2 and got["b"]["license_review"]["license_spdx"] == "MIT"
    seen = df.select(payloads.evidence(F.array(F.struct(F.lit("v").alias("variant_id"), F.lit(None).cast("string").alias("variant_name"), F.lit("exact").alias("family"), F.lit(None).cast("double").alias("raw_score"), F.lit("0.5").alias("normalized_score"), F.lit(3).alias("rank")))).alias("e")).first()["e"][0]
    assert (seen["variant_name"], seen["raw_score"], seen["normalized_score"], seen["rank"]) == ("", 0.0, 0.5, 3)


def test_listing(spark):
    df = spark.createDataFrame([("s", "a", 0.12345678, "high"), ("s", "b", 0.9, "low"), ("t", "c", 0.1, "high")], "source_id string, chunk_id string, aggregate_score double, risk_level string")
    got = {r["source_id"]: r for r in payloads.listing(df, ["source_id"], [F.desc("aggregate_score")]).collect()}
    assert got["s"]["candidate_count"] == 2 and (got["s"]["high"], got["s"]["low"]) == (1, 1)
    assert [(c["rank"], c["chunk_id"], c["aggregate_score"]) for c in got["s"]["candidates"]] == [(1, "b", 0.9), (2, "a", 0.123457)]


def test_hybrid(spark):
    rows = [("1", "r1", "go", "h", "n", "x", [1.0, 0.0]), ("2", "r2", "go", "h", "n", "x", [1.0, 0.1]), ("3", "r3", "go", "q", "n", "x", [0.0, 1.0]), ("4", "r1", "go", "h", "n", "x", None), ("5", "r2", "py", "z", "z", "z", [1.0, 0.0])]
    corpus = spark.createDataFrame(rows, "chunk_id string, repo_id string, language string, raw_hash string, normalized_hash string, anonymized_hash string, embedding array<double>")
    got = [(r["source_id"], r["chunk_id"], r["source_count"], r["knn_status"], r["retrieval_sources"]) for r in hybrid.by_repo(corpus, "r1").orderBy("source_id", "rank").collect()]
    assert got == [("1", "2", 2, "ok", ["rule_based", "knn"]), ("1", "3", 2, "ok", ["rule_based", "knn"]), ("4", "2", 1, "skipped", ["rule_based"]), ("4", "3", 1, "skipped", ["rule_based"])]
    assert {r["source_id"] for r in hybrid.by_repo(corpus, "r1", most=1).collect()} == {"1"} and hybrid.by_chunk(corpus, "5").count() == 0


def test_datasets(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "b.json").write_text('[{"repo": "o/r"}, {"repo": "o/s", "id": "7"}]')
    (tmp_path / "d" / "a.jsonl").write_text('{"repo": "o/t"}\n')
    paths = datasets.dataset_paths(spark, {"dataset_paths": ["d/*.json", " ", 3, f"{tmp_path}/d/*"]}, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["b.json", "a.jsonl"]
    assert datasets.enabled({"a": {"enabled": True, "rule_type": "x"}, "b": {"enabled": "yes"}, "c": {"enabled": True}}, "x").keys() == {"a"}
    ids = [r["source_item_id"] for r in datasets.benchmark_seeds(datasets.read_records(spark, f"{tmp_path}/d/b.json", "json"), "n").collect()]
    assert ids == ["b:0", "7"]
    base = str(tmp_path / "m")
    datasets.write_manifest(spark.createDataFrame([("r", 1, "old", 0), ("r", 2, "new", 0), ("q", 1, "one", 1)], "repo_id string, recorded_at long, status string, shard_index int"), base, "b", "s")
    got = {r["repo_id"]: r["status"] for r in datasets.read_manifest(spark, base, "b", "s", "repo_id string, recorded_at long, status string, shard_index int").collect()}
    assert got == {"r": "new", "q": "one"}


def test_archives(spark, tmp_path):
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as tar:
        for name, data in (("top/a.py", b"a"), ("top/sub/b.py", b""), ("../evil", b"e"), ("/abs", b"e")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
        link = tarfile.TarInfo("top/link")
        link.type, link.linkname = tarfile.SYMTYPE, "/etc/passwd"
        tar.addfile(link)
    got = {(r["archive"], r["file_path"]): bytes(r["content"]) for r in datasets.read_archives(spark, f"{tmp_path}/*.tar.gz").collect()}
    assert got == {("x.tar.gz", "a.py"): b"a", ("x.tar.gz", "sub/b.py"): b""}
