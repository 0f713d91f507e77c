"""Column functions against hand-computed expectations."""

import pytest
from pyspark.sql import functions as F

from graniteloom.functions import classify, registries, review, text as T, tokens, urls


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("https://github.com/Own/Repo.git", "https://github.com/Own/Repo"),
        ("git+https://github.com/o/r", "https://github.com/o/r"),
        ("git@github.com:o/r.git", "https://github.com/o/r"),
        ("ssh://git@github.com/o/r", "https://github.com/o/r"),
        ("git://github.com/o/r", "https://github.com/o/r"),
        ("github:o/r", "https://github.com/o/r"),
        ("https://www.github.com/o/r/tree/main?x#y", "https://github.com/o/r"),
        ("https://github.com/o/r.git.git", "https://github.com/o/r.git"),
        ("https://gitlab.com/o/r", None),
        ("ftp://github.com/o/r", None),
        ("https://github.com/o", None),
        ("https://github.com/" + "o" * 39 + "/r", "https://github.com/" + "o" * 39 + "/r"),
        ("https://github.com/" + "o" * 40 + "/r", None),
        ("https://github.com/o/" + "r" * 101, None),
        ("", None),
    ],
)
def test_canonical(spark, raw, want):
    assert one(spark, urls.canonical(F.col("u"))["url"], u=raw) == want


def test_references(spark):
    t = "a https://github.com/o/r.git, git@github.com:p/q; (github:x/y) github.com/o/r"
    assert one(spark, urls.references(F.col("t")), t=t) == ["https://github.com/o/r.git", "git@github.com:p/q", "github:x/y", "https://github.com/o/r"]


def test_manifests(spark):
    text = '{"dependencies": {"a": "github:o/r#v1", "b": "x/y", "c": "^1.0"}, "overrides": 3}'
    assert one(spark, urls.manifest_references(F.lit("web/package.json"), F.col("t")), t=text)[-2:] == ["https://github.com/o/r", "https://github.com/x/y"]
    flow = "jobs:\n    uses: actions/checkout@v4\n  - uses: not/first@v1\n"
    assert one(spark, urls.manifest_references(F.lit(".github/workflows/ci.yml"), F.col("t")), t=flow) == ["https://github.com/actions/checkout"]
    assert one(spark, classify.manifest_score(F.lit("./vendor/x/go.mod")))["score"] == 6


@pytest.mark.parametrize(
    ("spdx", "family", "strict"),
    [("", "unknown", "unknown"), ("AGPL-3.0", "strong_copyleft", "strong_copyleft"), ("LGPL-2.1", "strong_copyleft", "weak_copyleft"), ("MPL-2.0", "weak_copyleft", "weak_copyleft"), ("MIT", "notice", "notice"), ("0BSD", "notice", "public_domain"), ("CC0-1.0", "public_domain", "public_domain"), ("Odd", "other", "other")],
)
def test_licences(spark, spdx, family, strict):
    assert one(spark, classify.licence_family(F.col("s"))["family"], s=spdx) == family
    assert one(spark, classify.licence_family(F.col("s"), strict=True)["family"], s=spdx) == strict


@pytest.mark.parametrize(
    ("path", "language", "code", "licence"),
    [("a/b.PY", "python", True, False), ("LICENSE-MIT", "license", False, True), ("Dockerfile", "dockerfile", True, False), ("x/.env", "unknown", False, False), ("c.yaml", "config", False, False), ("r.md", "document", False, False), ("bin/x", "unknown", False, False), ("", "unknown", False, False)],
)
def test_files(spark, path, language, code, licence):
    got = one(spark, classify.file_class(F.col("p")), p=path)
    assert (got["language"], got["is_code"], got["is_license"]) == (language, code, licence)


def test_test_paths(spark):
    yes = ["tests/a.py", "src/__tests__/b.js", "test.js", "a/spec_x.rb", "x.test.tsx", "m_test.go", "Tests.py"]
    no = ["src/a.py", "contest/a.py", "latest.js", ""]
    df = spark.createDataFrame([(p,) for p in yes + no], "p string").select("p", classify.is_test_path(F.col("p")).alias("t"))
    assert {r["p"] for r in df.collect() if r["t"]} == set(yes)


def test_times(spark):
    now = F.to_timestamp(F.lit("2024-01-01 00:30:00"))
    assert one(spark, classify.is_stale(classify.utc(F.lit("2024-01-01T00:00:00")), now, 1800)) is True
    assert one(spark, classify.is_stale(classify.utc(F.lit("2024-01-01T00:00:01Z")), now, 1800)) is False
    assert one(spark, classify.is_stale(classify.utc(F.lit("junk")), now, 1800)) is True
    t = F.to_timestamp
    assert one(spark, classify.is_newer(F.lit(None).cast("timestamp"), now)) is False
    assert one(spark, classify.is_newer(now, F.lit(None).cast("timestamp"))) is True
    assert one(spark, classify.incremental_since(F.lit(None).cast("timestamp"), t(F.lit("2024-03-02 01:00:00")), now, 2)) == "2024-02-29"
    assert one(spark, classify.with_since(F.lit("topic:x"), F.lit("2024-01-01"))) == "topic:x pushed:>=2024-01-01"
    assert one(spark, classify.with_since(F.lit("x created:>1"), F.lit("2024-01-01"))) == "x created:>1"


def test_lines(spark):
    assert one(spark, T.lines(F.lit("a\r\nb\n"))) == ["a", "b"]
    w = one(spark, T.line_windows(F.lit("\n".join(map(str, range(1, 11)))), 4, 2))
    assert [(x["start_line"], x["end_line"]) for x in w] == [(1, 4), (3, 6), (5, 8), (7, 10)]
    assert one(spark, T.line_windows(F.lit(""), 4, 2)) == []
    assert [(x["start_line"], x["end_line"]) for x in one(spark, T.line_windows(F.lit("a\nb\nc"), 2, 5))] == [(1, 2), (2, 3)]


def test_terms(spark):
    assert sorted(one(spark, tokens.identifier_terms(F.lit("getHttpServer2.on-click")))) == ["2", "click", "get", "http", "server"]
    got = one(spark, tokens.identifier_terms(F.lit("readOnly_value")))
    assert sorted(got) == ["only", "read"]
    assert one(spark, T.ordered_distinct(F.array(F.lit(" b"), F.lit("a"), F.lit("b"), F.lit(""), F.lit(None).cast("string"))), ) == ["b", "a"]
    assert one(spark, T.ordered_distinct(F.array(F.lit("b"), F.lit("a"), F.lit("c")), 2)) == ["b", "a"]


def test_scores(spark):
    assert one(spark, review.variant_score(F.lit(2.0), F.lit(4.0), F.lit(0), F.lit(100))) == pytest.approx(0.65)
    assert one(spark, review.variant_score(F.lit(0.0), F.lit(4.0), F.lit(0), F.lit(100))) == 0
    assert one(spark, review.strongest(F.array(F.lit("summary"), F.lit("raw_code"), F.lit("normalized_code"))))["type"] == "normalized_code_match"
    c = review.Cascade(F.lit(0.9)).add(F.lit(0.3)).cap(0.8, F.lit(True)).cap(0.1, F.lit(False)).floor(F.lit(0.2))
    assert one(spark, c.column()) == pytest.approx(0.8)
    assert [one(spark, review.level(F.lit(x))) for x in (0.95, 0.94, 0.8, 0.79, 0.6, 0.59)] == ["critical", "high", "high", "medium", "medium", "low"]


def test_registries(spark):
    pack = '{"packages": {"o/r": [{"homepage": "https://h", "source": {"url": "https://s"}, "support": {"issues": "https://i"}}, {"homepage": "https://h"}]}}'
    assert one(spark, registries.candidate_urls("packagist", F.lit(pack))) == ["https://h", "https://s", "https://i"]
    assert one(spark, registries.candidate_urls("cpan", F.lit('{"resources": {"repository": {"url": "u", "web": "w"}}, "download_url": " d "}'))) == ["u", "w", "d"]
    assert one(spark, registries.candidate_urls("maven", F.lit("{}"))) == []
    pom = '<project xmlns="http://x"><url>https://p</url><scm><url>https://s</url></scm></project>'
    got = one(spark, registries.pom_fields(F.lit(pom)))
    assert (got["project_url"], got["scm_url"]) == ("https://p", "https://s")
    assert set(registries.REGISTRIES) >= {"pypi", "npm", "nuget", "maven", "cratesio", "hexpm", "rubygems", "cpan", "hackage", "cocoapods", "packagist", "pubdev", "gomod", "swiftpm"}


def overlap_struct(**given):
    base = {"calls": 0, "identifiers": 0, "operators": 0, "boilerplate": 0, "support": 0}
    ints = {k: given.get(k, v) for k, v in base.items()}
    none = F.array().cast("array<string>")
    lists = {k: F.array(*[F.lit(x) for x in given[k]]) if given.get(k) else none for k in ("domain", "high_signal", "families", "traits")}
    return F.struct(*[F.lit(v).alias(k) for k, v in ints.items()], *[c.alias(k) for k, c in lists.items()], F.lit(given.get("conflict", False)).alias("conflict"), F.lit(given.get("source_primary", "")).alias("source_primary"), F.lit(given.get("candidate_primary", "")).alias("candidate_primary"))


@pytest.mark.parametrize(
    ("kind", "base", "n", "aggregate", "given", "risk"),
    [
        ("raw_hash_match", 0.99, 1, 0.65, {}, 1.0),
        ("anonymized_hash_match", 0.92, 1, 0.0, {}, 0.95),
        ("structural_similarity", 0.22, 4, 1.0, {}, 0.35),
        ("raw_code_match", 0.56, 1, 0.5, {}, 0.55),
        ("anonymized_code_match", 0.58, 2, 0.5, {"identifiers": 5, "support": 1}, 0.55),
        ("raw_code_match", 0.56, 1, 0.5, {"calls": 2, "identifiers": 4, "operators": 4, "support": 3}, 0.56 + 0.03 + 0.05 + 4 * 0.008 + 4 * 0.004 + 2 * 0.02),
        ("raw_code_match", 0.56, 4, 1.0, {"identifiers": 4, "operators": 4, "support": 2, "domain": ["swipe"]}, min(0.68 + 4 * 0.005 + 4 * 0.003, 0.56 + 0.12 + 0.1 + 0.02 + 0.032 + 0.016)),
        ("raw_code_match", 0.56, 1, 0.5, {"calls": 1, "support": 1, "domain": ["swipe"], "conflict": True}, 0.52),
        ("raw_code_match", 0.56, 1, 0.5, {"calls": 1, "support": 1, "domain": ["swipe"], "candidate_primary": "config_setter"}, 0.38),
    ],
)
def test_rule_review(spark, kind, base, n, aggregate, given, risk):
    o = overlap_struct(**given)
    got = one(spark, review.rule_review(F.lit(kind), F.lit(base), F.lit(n), F.lit(aggregate), o, F.lit(aggregate), F.lit(False)))
    assert got["risk_score"] == pytest.approx(round(risk, 4), abs=1e-4)
    assert one(spark, review.rule_review(F.lit(kind), F.lit(base), F.lit(n), F.lit(aggregate), o, F.lit(aggregate), F.lit(True)))["risk_level"] == "same_repo"


@pytest.mark.parametrize(
    ("fused", "rule", "knn", "kind", "base", "n", "given", "spdx", "risk", "told"),
    [
        (1.0, True, False, "normalized_hash_match", 0.95, 1, {}, "MIT", 0.9, "normalized_hash_match"),
        (2.0, True, True, "raw_hash_match", 0.99, 1, {}, "GPL-3.0", 1.0, "raw_hash_match"),
        (1.0, False, True, "unknown", 0.0, 0, {}, "MIT", 0.52, "embedding_knn_match"),
        (1.0, False, True, "unknown", 0.0, 0, {"calls": 2, "identifiers": 6, "operators": 6, "support": 3}, "MIT", 0.82, "embedding_knn_match"),
        (1.0, True, False, "anonymized_code_match", 0.58, 1, {"support": 1}, "", 0.52, "anonymized_code_match"),
    ],
)
def test_hybrid_review(spark, fused, rule, knn, kind, base, n, given, spdx, risk, told):
    got = one(spark, review.hybrid_review(F.lit(fused), F.lit(rule), F.lit(knn), F.lit(kind), F.lit(base), F.lit(n), overlap_struct(**given), F.lit(fused / 2), F.lit(spdx)))
    assert got["evidence_type"] == told and got["risk_score"] == pytest.approx(risk, abs=1e-4)
