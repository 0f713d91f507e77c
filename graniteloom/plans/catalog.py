"""Registered queries over the driver's tables, each with the SQL that it is held against.

The tables stand in for the corpus: documents are chunks of repositories (one per source), benchmark passages are query chunks,
pages are seeds, supplier and nation the registry, orders the stage states, events the stage events, parts and line items
the files and their weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from graniteloom.functions import classify, registries, review, text as T, tokens, urls
from graniteloom.operators import hybrid, retrieval, search, seeds, stages
from graniteloom.operators.store import stale, upsert
from graniteloom.plans.registry import register
from graniteloom.session import table
from graniteloom.streaming import streams

NOW = "1998-08-02 00:00:00"


def now():
    return F.to_timestamp(F.lit(NOW))


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as chunks."""
    text = F.col("text")
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("chunk_id"), F.concat(F.lit("github:"), F.col("source"), F.lit("/corpus")).alias("repo_id"), F.col("lang").alias("language"),
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id"), F.lit(".txt")).alias("file_path"), text.alias("raw_code"),
        T.sha1_text(text).alias("raw_hash"), T.sha1_text(T.normalized(text)).alias("normalized_hash"), T.sha1_text(T.folded(text)).alias("anonymized_hash"), F.lit("valid").alias("validation_status"),
    )


_NORMALIZED = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[ \t]+', ' ', 'g'), '(?m)[ \t]+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"
_FOLDED = r"regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', ' ', 'g')"
CHUNKS_SQL = f"""
chunk AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, 'github:' || source || '/corpus' AS repo_id, lang AS language, source || '/' || doc_id || '.txt' AS file_path, text AS raw_code,
                 sha1(coalesce(text, '')) AS raw_hash, sha1({_NORMALIZED}) AS normalized_hash, sha1({_FOLDED}) AS anonymized_hash FROM documents)"""
_HITS_SQL = f"""
WITH {CHUNKS_SQL},
h AS (SELECT chunk_id, repo_id, 'raw_hash' AS name, raw_hash AS value FROM chunk UNION ALL SELECT chunk_id, repo_id, 'normalized_hash', normalized_hash FROM chunk UNION ALL SELECT chunk_id, repo_id, 'anonymized_hash', anonymized_hash FROM chunk),
p AS (SELECT a.chunk_id AS source_id, b.chunk_id, a.name, row_number() OVER (PARTITION BY a.chunk_id, a.name ORDER BY b.chunk_id) - 1 AS rank
      FROM h a JOIN h b ON a.name = b.name AND a.value = b.value AND a.chunk_id <> b.chunk_id AND a.repo_id <> b.repo_id),
hits AS (SELECT *, CASE WHEN name = 'raw_hash' THEN 100 ELSE 85 END AS priority FROM p WHERE rank < 10)"""


@register("hash_match_topk", f"""{_HITS_SQL},
s AS (SELECT *, (0.7 + 0.3 / (rank + 1)) * priority / 100.0 AS score FROM hits),
m AS (SELECT source_id, chunk_id, sum(score) AS aggregate, count(*) AS evidences,
             max(CASE name WHEN 'raw_hash' THEN 0.99 WHEN 'normalized_hash' THEN 0.95 ELSE 0.92 END) AS base FROM s GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY aggregate DESC, chunk_id) AS place FROM m)
SELECT source_id, chunk_id, CAST(place AS INTEGER) AS place, CAST(evidences AS INTEGER) AS evidences, round(aggregate, 4) AS aggregate,
       CASE base WHEN 0.99 THEN 'raw_hash_match' WHEN 0.95 THEN 'normalized_hash_match' ELSE 'anonymized_hash_match' END AS evidence_type
FROM r WHERE place <= 20""")  # fmt: skip
def hash_match_topk(spark, sf):
    """The flagship: similar chunks by three hashes, scored, best twenty per source."""
    c = chunks(spark, sf)
    merged = retrieval.merge_variants(retrieval.hash_hits(c, c))
    top = search.top_k(merged, ["source_id"], [F.desc(F.round("aggregate", 9)), F.asc("chunk_id")], 20, "place")
    return top.select("source_id", "chunk_id", F.col("place").cast("int").alias("place"), F.col("evidences").cast("int").alias("evidences"), F.round("aggregate", 4).alias("aggregate"), F.col("strongest.type").alias("evidence_type"))


@register("variant_explode", f"""WITH {CHUNKS_SQL},
v AS (SELECT chunk_id, 'exact' AS family, 'raw_hash' AS name, 100 AS priority, raw_hash AS text FROM chunk UNION ALL SELECT chunk_id, 'exact', 'raw_code', 90, regexp_replace(raw_code, '^\\s+|\\s+$', '', 'g') FROM chunk
      UNION ALL SELECT chunk_id, 'normalized', 'normalized_hash', 85, normalized_hash FROM chunk UNION ALL SELECT chunk_id, 'normalized', 'anonymized_hash', 85, anonymized_hash FROM chunk)
SELECT chunk_id, family, name, priority, chunk_id || ':' || family || ':' || name AS variant_id, md5(text) AS digest FROM v WHERE text <> ''""")  # fmt: skip
def variant_explode(spark, sf):
    v = retrieval.variants_of(chunks(spark, sf))
    return v.select("chunk_id", "family", "name", "priority", "variant_id", F.md5("text").alias("digest"))


@register("variant_score_norm", f"""{_HITS_SQL}
SELECT source_id, chunk_id, name, CAST(rank AS INTEGER) AS rank, round((0.7 + 0.3 / (rank + 1)) * priority / 100.0, 6) AS score FROM hits""")
def variant_score_norm(spark, sf):
    c = chunks(spark, sf)
    h = retrieval.hash_hits(c, c)
    return h.select("source_id", "chunk_id", "name", F.col("rank").cast("int").alias("rank"), F.round(review.variant_score(F.col("raw_score"), F.lit(1.0), F.col("rank"), F.col("priority")), 6).alias("score"))


_WORDS = r"regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}_]+')"
_BM25_SQL = f"""
d AS (SELECT doc_id, {_WORDS.format("text")} AS ws FROM documents),
st AS (SELECT count(*) AS docs, avg(len(ws)) AS mean FROM d),
post AS (SELECT doc_id, word, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS word FROM d) GROUP BY doc_id, word),
df AS (SELECT word, count(*) AS df FROM post GROUP BY word),
q AS (SELECT item_id, list_distinct({_WORDS.format("text")}) AS qs FROM benchmark),
qw AS (SELECT item_id, len(qs) AS asked, unnest(qs) AS word FROM q),
hit AS (SELECT item_id, doc_id, any_value(asked) AS asked, count(*) AS matched,
               sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))) AS score
        FROM qw JOIN df USING (word) JOIN post USING (word) CROSS JOIN st GROUP BY item_id, doc_id)"""


@register("bm25_match_topk", f"""WITH {_BM25_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM hit)
SELECT item_id, doc_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM r WHERE rank <= 10""")
def bm25_match_topk(spark, sf):
    top = search.bm25(table(spark, sf, "benchmark"), table(spark, sf, "documents"), "item_id", "doc_id", F.col("text"), F.col("text"), k=10)
    return top.select(F.col("query").alias("item_id"), F.col("doc").alias("doc_id"), F.col("rank").cast("int").alias("rank"), F.round("score", 4).alias("score"))


@register("msm_match", f"""WITH {_BM25_SQL} SELECT item_id, doc_id, CAST(matched AS BIGINT) AS matched FROM hit WHERE matched >= greatest(1, floor(asked * 60 / 100))""")
def msm_match(spark, sf):
    hits = search.bm25(table(spark, sf, "benchmark"), table(spark, sf, "documents"), "item_id", "doc_id", F.col("text"), F.col("text"), least_percent=60)
    return hits.select(F.col("query").alias("item_id"), F.col("doc").alias("doc_id"), "matched")


@register("phrase_match", f"""
WITH q AS (SELECT item_id, ' ' || array_to_string({_WORDS.format("text")}, ' ') || ' ' AS p FROM benchmark), d AS (SELECT doc_id, ' ' || array_to_string({_WORDS.format("text")}, ' ') || ' ' AS b FROM documents)
SELECT item_id, doc_id FROM q JOIN d ON contains(b, p) WHERE length(p) > 2""")
def phrase_match(spark, sf):
    hits = search.phrase(table(spark, sf, "benchmark"), table(spark, sf, "documents"), "item_id", "doc_id", F.col("text"), F.col("text"))
    return hits.select(F.col("query").alias("item_id"), F.col("doc").alias("doc_id"))


@register("structural_overlap_topk", """
WITH t AS (SELECT doc_id, unnest([{'f': 'chunk_type', 'v': lang, 'b': 1.0}, {'f': 'structure_signature', 'v': lang || '|' || CAST(n_chars // 500 AS VARCHAR), 'b': 4.0}, {'f': 'symbol_type', 'v': source, 'b': 1.0}]) AS x FROM documents),
n AS (SELECT count(*) AS n FROM documents), df AS (SELECT x.f AS f, x.v AS v, count(*) AS df FROM t GROUP BY 1, 2),
s AS (SELECT a.doc_id AS query, b.doc_id AS doc, sum(a.x.b * ln(1 + (n - df + 0.5) / (df + 0.5))) AS score
      FROM t a JOIN df ON a.x.f = df.f AND a.x.v = df.v JOIN t b ON b.x.f = df.f AND b.x.v = df.v CROSS JOIN n GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 6) DESC, doc) AS rank FROM s WHERE query <> doc)
SELECT query, doc, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM r WHERE rank <= 10""")  # fmt: skip
def structural_overlap_topk(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("chunk_type"), F.concat("lang", F.lit("|"), F.floor(F.col("n_chars") / 500)).alias("structure_signature"), F.col("source").alias("symbol_type"))
    top = search.structural(d, d, "doc_id", "doc_id", 10)
    return top.select("query", "doc", F.col("rank").cast("int").alias("rank"), F.round("score", 4).alias("score"))


_KNN_SQL = """
p AS (SELECT a.vec_id AS query, b.vec_id AS doc, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.label = b.label WHERE a.vec_id % 20 = 0),
knn AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM p)"""


def _knn(spark, sf, k=10):
    e = table(spark, sf, "embeddings")
    return search.knn(e.where("vec_id % 20 = 0"), e, "vec_id", "vec_id", "embedding", "embedding", k, ("label",), ("vec_id",))


@register("knn_cosine_topk", f"WITH {_KNN_SQL} SELECT query, doc, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM knn WHERE rank <= 10")
def knn_cosine_topk(spark, sf):
    return _knn(spark, sf).select("query", "doc", F.col("rank").cast("int").alias("rank"), F.round("score", 4).alias("score"))


_SCALE_SQL = """CASE WHEN max(score) OVER g > min(score) OVER g THEN (score - min(score) OVER g) / (max(score) OVER g - min(score) OVER g)
     WHEN count(*) OVER g = 1 THEN 1.0 ELSE 1.0 - (row_number() OVER (PARTITION BY source_id ORDER BY score DESC, chunk_id) - 1) / (count(*) OVER g - 1) END"""


@register("minmax_fusion", f"WITH {_KNN_SQL}, a AS (SELECT query AS source_id, doc AS chunk_id, score FROM knn WHERE rank <= 10) SELECT source_id, chunk_id, round(round({_SCALE_SQL}, 6), 4) AS scaled FROM a WINDOW g AS (PARTITION BY source_id)")
def minmax_fusion(spark, sf):
    a = _knn(spark, sf).select(F.col("query").alias("source_id"), F.col("doc").alias("chunk_id"), "score")
    return retrieval.scale(a, ["source_id"], "score", [F.desc("score"), F.asc("chunk_id")]).select("source_id", "chunk_id", retrieval.rounded(F.col("scaled"), 4).alias("scaled"))


@register("hybrid_fuse_rank", f"""WITH {_KNN_SQL},
b AS (SELECT query AS source_id, doc AS chunk_id, score FROM knn WHERE rank <= 10),
a AS (SELECT vec_id AS source_id, (vec_id + k * 7) % (SELECT count(*) FROM embeddings) AS chunk_id, CAST(100 - k * k AS DOUBLE) AS score FROM embeddings, unnest(range(1, 9)) AS u(k) WHERE vec_id % 20 = 0),
sa AS (SELECT source_id, chunk_id, round({_SCALE_SQL}, 6) AS rs FROM a WINDOW g AS (PARTITION BY source_id)), sb AS (SELECT source_id, chunk_id, round({_SCALE_SQL}, 6) AS ks FROM b WINDOW g AS (PARTITION BY source_id)),
f AS (SELECT coalesce(sa.source_id, sb.source_id) AS source_id, coalesce(sa.chunk_id, sb.chunk_id) AS chunk_id, rs, ks, CAST(rs IS NOT NULL AS INTEGER) + CAST(ks IS NOT NULL AS INTEGER) AS n, round(coalesce(rs, 0) + coalesce(ks, 0), 6) AS fused
      FROM sa FULL JOIN sb ON sa.source_id = sb.source_id AND sa.chunk_id = sb.chunk_id),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fused DESC, n DESC, coalesce(ks, 0) DESC, coalesce(rs, 0) DESC, chunk_id) AS rank FROM f)
SELECT source_id, chunk_id, n AS source_count, round(fused, 4) AS fused, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 15""")  # fmt: skip
def hybrid_fuse_rank(spark, sf):
    e = table(spark, sf, "embeddings")
    total = e.agg(F.count(F.lit(1)).alias("total"))
    rule = e.where("vec_id % 20 = 0").crossJoin(F.broadcast(total)).select(F.col("vec_id").alias("source_id"), "total", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("k"))
    rule = rule.select("source_id", ((F.col("source_id") + F.col("k") * 7) % F.col("total")).alias("chunk_id"), (100 - F.col("k") * F.col("k")).cast("double").alias("score"))
    knn = _knn(spark, sf).select(F.col("query").alias("source_id"), F.col("doc").alias("chunk_id"), "score")
    return retrieval.fuse(rule, knn, 15).select("source_id", "chunk_id", "source_count", retrieval.rounded(F.col("fused"), 4).alias("fused"), F.col("rank").cast("int").alias("rank"))


@register("hybrid_by_repo", f"""{_HITS_SQL},
m AS (SELECT source_id, chunk_id, round(sum((0.7 + 0.3 / (rank + 1)) * priority / 100.0), 9) AS score FROM hits WHERE source_id IN (SELECT chunk_id FROM chunk WHERE repo_id = 'github:src0/corpus') GROUP BY 1, 2),
a AS (SELECT source_id, chunk_id, score FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, chunk_id) AS place FROM m) WHERE place <= 20),
v AS (SELECT c.chunk_id, c.repo_id, c.language, e.embedding FROM chunk c LEFT JOIN embeddings e ON c.chunk_id = CAST(e.vec_id AS VARCHAR)),
p2 AS (SELECT x.chunk_id AS source_id, y.chunk_id, round(list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])), 6) AS score
       FROM v x JOIN v y ON x.language = y.language AND x.repo_id <> y.repo_id WHERE x.repo_id = 'github:src0/corpus' AND x.embedding IS NOT NULL AND y.embedding IS NOT NULL),
b AS (SELECT source_id, chunk_id, score FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, chunk_id) AS place FROM p2) WHERE place <= 50),
sa AS (SELECT source_id, chunk_id, round({_SCALE_SQL}, 6) AS rs FROM a WINDOW g AS (PARTITION BY source_id)), sb AS (SELECT source_id, chunk_id, round({_SCALE_SQL}, 6) AS ks FROM b WINDOW g AS (PARTITION BY source_id)),
f AS (SELECT coalesce(sa.source_id, sb.source_id) AS source_id, coalesce(sa.chunk_id, sb.chunk_id) AS chunk_id, rs, ks, CAST(rs IS NOT NULL AS INTEGER) + CAST(ks IS NOT NULL AS INTEGER) AS n, round(coalesce(rs, 0) + coalesce(ks, 0), 6) AS fused
      FROM sa FULL JOIN sb ON sa.source_id = sb.source_id AND sa.chunk_id = sb.chunk_id),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fused DESC, n DESC, coalesce(ks, 0) DESC, coalesce(rs, 0) DESC, chunk_id) AS rank FROM f)
SELECT r.source_id, r.chunk_id, CAST(rank AS INTEGER) AS rank, n AS source_count, round(fused, 4) AS fused, CASE WHEN v.embedding IS NULL THEN 'skipped' ELSE 'ok' END AS knn_status
FROM r JOIN v ON r.source_id = v.chunk_id WHERE rank <= 100""")  # fmt: skip
def hybrid_by_repo(spark, sf):
    """The composed query: a repository's chunks through both arms and their fusion."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding")
    corpus = chunks(spark, sf).drop("raw_code").join(vectors, "chunk_id", "left")
    out = hybrid.by_repo(corpus, "github:src0/corpus")
    return out.select("source_id", "chunk_id", F.col("rank").cast("int").alias("rank"), "source_count", retrieval.rounded(F.col("fused"), 4).alias("fused"), "knn_status")


_SPDX = ["", "AGPL-3.0", "GPL-2.0", "LGPL-2.1", "MPL-2.0", "Apache-2.0", "MIT", "0BSD", "CC0-1.0", "Unlicense", "Custom"]
_SPDX_SQL = "list_extract([" + ", ".join(f"'{x}'" for x in _SPDX) + "], CAST(s_suppkey % 11 + 1 AS BIGINT))"
_FAMILY_SQL = """CASE WHEN spdx = '' THEN 'unknown' WHEN regexp_matches(upper(spdx), 'AGPL|GPL|SSPL|BUSL|CPAL') THEN 'strong_copyleft' WHEN regexp_matches(upper(spdx), 'LGPL|MPL|EPL|CDDL') THEN 'weak_copyleft'
     WHEN regexp_matches(upper(spdx), 'APACHE|MIT|BSD|ISC|ARTISTIC|ZLIB') THEN 'notice' WHEN regexp_matches(upper(spdx), 'UNLICENSE|CC0|0BSD') THEN 'public_domain' ELSE 'other' END"""


def _registry(spark, sf):
    spdx = F.get(F.array(*[F.lit(x) for x in _SPDX]), (F.col("s_suppkey") % 11).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", spdx.alias("spdx"))


@register("license_family", f"WITH r AS (SELECT s_suppkey, {_SPDX_SQL} AS spdx FROM supplier) SELECT s_suppkey, spdx, {_FAMILY_SQL} AS family FROM r")
def license_family(spark, sf):
    return _registry(spark, sf).select("s_suppkey", "spdx", classify.licence_family(F.col("spdx"))["family"].alias("family"))


_BONUS_SQL = f"CASE {_FAMILY_SQL.replace('CASE ', '', 1).replace(chr(10), ' ')}"


@register("license_risk_levels", f"""WITH r AS (SELECT s_suppkey, {_SPDX_SQL} AS spdx, (abs(s_acctbal) % 1000) / 1000.0 AS base FROM supplier), f AS (SELECT *, {_FAMILY_SQL} AS family FROM r),
s AS (SELECT *, least(1.0, base + CASE family WHEN 'unknown' THEN 0.05 WHEN 'strong_copyleft' THEN 0.18 WHEN 'weak_copyleft' THEN 0.12 WHEN 'notice' THEN 0.08 WHEN 'public_domain' THEN 0.02 ELSE 0.06 END) AS score FROM f)
SELECT s_suppkey, family, round(score, 6) AS score, CASE WHEN score >= 0.95 THEN 'critical' WHEN score >= 0.8 THEN 'high' WHEN score >= 0.6 THEN 'medium' ELSE 'low' END AS level FROM s""")
def license_risk_levels(spark, sf):
    r = _registry(spark, sf).withColumn("l", classify.licence_family(F.col("spdx")))
    score = review.Cascade((F.abs("s_acctbal") % 1000) / 1000.0).add(F.col("l.bonus")).column()
    return r.withColumn("score", score).select("s_suppkey", F.col("l.family").alias("family"), F.round("score", 6).alias("score"), review.level(F.col("score")).alias("level"))


@register("cluster_dedupe", f"""WITH {CHUNKS_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY raw_hash ORDER BY length(raw_code) DESC, chunk_id) AS n, count(*) OVER (PARTITION BY raw_hash) AS size FROM chunk)
SELECT chunk_id, 'raw_hash:' || raw_hash AS cluster_key, CAST(size AS BIGINT) AS cluster_size FROM k WHERE n = 1""")
def cluster_dedupe(spark, sf):
    c = chunks(spark, sf).withColumn("cluster_key", review.cluster_key(F.col("raw_hash"), F.col("normalized_hash"), F.col("anonymized_hash"), F.col("chunk_id"))).withColumn("all", F.lit(1))
    return retrieval.dedupe_clusters(c, ["all"], "cluster_key", [F.desc(F.length("raw_code")), F.asc("chunk_id")]).select("chunk_id", "cluster_key", "cluster_size")


@register("source_chunk_rank", """
WITH c AS (SELECT doc_id, source, lang, len(string_split(regexp_replace(text, '\n$', ''), chr(10))) AS lines FROM documents WHERE text <> ''),
e AS (SELECT *, CASE WHEN lang = 'en' THEN 100 ELSE 20 END + 30 + 10 + least(lines, 120) AS score FROM c WHERE lines >= 10)
SELECT doc_id, CAST(score AS INTEGER) AS score, CAST(lines AS INTEGER) AS span, CAST(row_number() OVER (PARTITION BY source ORDER BY score DESC, lines DESC, doc_id) AS INTEGER) AS rank FROM e""")
def source_chunk_rank(spark, sf):
    d = table(spark, sf, "documents").where("text <> ''").withColumn("lines", F.size(T.lines(F.col("text")))).withColumn("kind", F.when(F.col("lang") == "en", "function").otherwise("class"))
    none = F.array().cast("array<string>")
    d = d.where(classify.is_source_chunk(F.col("kind"), F.lit(1), F.col("lines"))).withColumn("score", classify.source_chunk_score(F.col("kind"), F.col("source"), F.lit("valid"), none, none, none, F.lit(1), F.col("lines")))
    rank = F.row_number().over(W.partitionBy("source").orderBy(F.desc("score"), F.desc("lines"), "doc_id"))
    return d.select("doc_id", F.col("score").cast("int").alias("score"), F.col("lines").cast("int").alias("span"), rank.cast("int").alias("rank"))


@register("match_overlap_counts", f"""
WITH w AS (SELECT item_id, list_distinct({_WORDS.format("text")}) AS ws FROM benchmark),
p AS (SELECT a.item_id AS a, b.item_id AS b, len(list_intersect(a.ws, b.ws)) AS shared, len(a.ws) AS na, len(b.ws) AS nb FROM w a JOIN w b ON b.item_id = a.item_id + 1)
SELECT a, b, CAST(shared AS INTEGER) AS shared, CAST(na + nb - shared AS INTEGER) AS "union" FROM p""")
def match_overlap_counts(spark, sf):
    w = table(spark, sf, "benchmark").select("item_id", F.array_distinct(search.words(F.col("text"))).alias("ws"))
    b = w.select(F.col("item_id").alias("b"), F.col("ws").alias("wb"))
    p = w.select(F.col("item_id").alias("a"), F.col("ws").alias("wa")).join(b, F.col("b") == F.col("a") + 1)
    return p.select("a", "b", F.size(F.array_intersect("wa", "wb")).alias("shared"), F.size(F.array_union("wa", "wb")).alias("union"))


_REVIEW_SQL = "SELECT l_orderkey AS k, l_linenumber, l_suppkey, CASE WHEN l_discount >= 0.09 THEN 'critical' WHEN l_discount >= 0.07 THEN 'high' WHEN l_discount >= 0.04 THEN 'medium' WHEN l_tax > 0.07 THEN 'same_repo' ELSE 'low' END AS risk_level, l_discount + l_tax AS risk_score FROM lineitem"


def _reviews(spark, sf):
    d, t = F.col("l_discount"), F.col("l_tax")
    lv = F.when(d >= 0.09, "critical").when(d >= 0.07, "high").when(d >= 0.04, "medium").when(t > 0.07, "same_repo").otherwise("low")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", lv.alias("risk_level"), (d + t).alias("risk_score"))


@register("report_summary", f"WITH r AS ({_REVIEW_SQL}) SELECT l_suppkey, count(*) FILTER (risk_level = 'critical') AS critical, count(*) FILTER (risk_level = 'high') AS high, count(*) FILTER (risk_level = 'medium') AS medium, count(*) FILTER (risk_level = 'low') AS low, count(*) FILTER (risk_level = 'same_repo') AS same_repo FROM r GROUP BY 1")
def report_summary(spark, sf):
    return retrieval.level_counts(_reviews(spark, sf), ["l_suppkey"])


@register("report_findings", f"""WITH r AS ({_REVIEW_SQL}), v AS (SELECT l_suppkey, k * 10 + l_linenumber AS chunk_id, risk_level, risk_score, CASE risk_level WHEN 'critical' THEN 0 WHEN 'high' THEN 1 ELSE 2 END AS lr FROM r WHERE risk_level IN ('critical', 'high', 'medium') QUALIFY row_number() OVER (PARTITION BY l_suppkey, k * 10 + l_linenumber ORDER BY lr, risk_score DESC) = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY lr, risk_score DESC, lpad(CAST(chunk_id AS VARCHAR), 12, '0')) AS place FROM v)
SELECT CAST(l_suppkey AS VARCHAR) AS source_path, count(*) AS candidates, greatest(count(*) - 5, 0) AS more, min_by(risk_level, place) AS top_level, round(min_by(risk_score, place), 4) AS top_score FROM p GROUP BY 1""")
def report_findings(spark, sf):
    r = _reviews(spark, sf)
    c = r.select(F.col("l_suppkey").cast("string").alias("source_path"), F.lit("").alias("source_symbol"), F.lpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 12, "0").alias("chunk_id"), F.lit("").alias("repo_id"), F.lit("").alias("file_path"), F.lit("").alias("symbol_name"), "risk_level", "risk_score", F.lit(1).alias("source_count"), F.lit(0).alias("seen"))
    return retrieval.report(c).select("source_path", "candidates", "more", "top_level", F.round("top_score", 4).alias("top_score"))


@register("href_extract", r"""SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, '(?i)href\s*=\s*["'']([^"''#]+)["'']', 1))), ' ') AS links FROM pages""")
def href_extract(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.array_join(F.array_sort(urls.links(F.col("html"))), " ").alias("links"))


_URL_CASE = """CASE page_id % 8 WHEN 0 THEN 'git@github.com:Own' || page_id || '/Repo.git' WHEN 1 THEN 'git+https://github.com/o' || page_id || '/r.git' WHEN 2 THEN 'github:o' || page_id || '/r' WHEN 3 THEN 'https://www.github.com/o' || page_id || '/r/tree/main'
     WHEN 4 THEN 'ssh://git@github.com/o' || page_id || '/r' WHEN 5 THEN 'ftp://github.com/o' || page_id || '/r' WHEN 6 THEN 'https://github.com/o' || page_id ELSE url END"""
_CANON_SQL = rf"""
u AS (SELECT page_id, {_URL_CASE} AS raw FROM pages),
h AS (SELECT page_id, raw, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '^github:', 'https://github.com/'), '^git\+', ''), '^git@github.com:', 'https://github.com/'), '^ssh://git@github.com/', 'https://github.com/'), '^git://github.com/', 'https://github.com/') AS x FROM u),
p AS (SELECT page_id, raw, regexp_extract(x, '^https?://(?:www\.)?github\.com/([A-Za-z0-9][A-Za-z0-9-]{{0,38}})/([A-Za-z0-9._-]{{1,100}})(?:/|$)', 1) AS owner,
             regexp_replace(regexp_extract(x, '^https?://(?:www\.)?github\.com/([A-Za-z0-9][A-Za-z0-9-]{{0,38}})/([A-Za-z0-9._-]{{1,100}})(?:/|$)', 2), '\.git$', '') AS repo FROM h)"""


def _seed_urls(spark, sf):
    p = F.col("page_id")
    k = p % 8
    raw = (
        F.when(k == 0, F.concat(F.lit("git@github.com:Own"), p, F.lit("/Repo.git"))).when(k == 1, F.concat(F.lit("git+https://github.com/o"), p, F.lit("/r.git"))).when(k == 2, F.concat(F.lit("github:o"), p, F.lit("/r")))
        .when(k == 3, F.concat(F.lit("https://www.github.com/o"), p, F.lit("/r/tree/main"))).when(k == 4, F.concat(F.lit("ssh://git@github.com/o"), p, F.lit("/r"))).when(k == 5, F.concat(F.lit("ftp://github.com/o"), p, F.lit("/r")))
        .when(k == 6, F.concat(F.lit("https://github.com/o"), p)).otherwise(F.col("url"))
    )
    return table(spark, sf, "pages").select("page_id", raw.alias("raw"))


@register("url_canonicalize", f"WITH {_CANON_SQL} SELECT page_id, raw, CASE WHEN owner <> '' THEN 'https://github.com/' || owner || '/' || repo END AS url, CASE WHEN owner <> '' THEN 'github:' || lower(owner) || '/' || lower(repo) END AS repo_id FROM p")
def url_canonicalize(spark, sf):
    c = _seed_urls(spark, sf).withColumn("c", urls.canonical(F.col("raw")))
    return c.select("page_id", "raw", F.col("c.url").alias("url"), urls.repo_id(F.col("c.owner"), F.col("c.repo")).alias("repo_id"))


@register("repo_reference_extract", r"""WITH t AS (SELECT page_id, 'see https://github.com/o' || page_id || '/r.git, or git@github.com:o' || page_id || '/q and (github.com/x/y).' AS t FROM pages)
SELECT page_id, 'https://github.com/o' || page_id || '/r.git git@github.com:o' || page_id || '/q https://github.com/o' || page_id || '/r.git https://github.com/x/y' AS refs FROM t""".replace("/q https://github.com/o' || page_id || '/r.git https", "/q https"))
def repo_reference_extract(spark, sf):
    p = F.col("page_id")
    text = F.concat(F.lit("see https://github.com/o"), p, F.lit("/r.git, or git@github.com:o"), p, F.lit("/q and (github.com/x/y)."))
    return table(spark, sf, "pages").select("page_id", F.array_join(urls.references(text), " ").alias("refs"))


@register("registry_payload_urls", """SELECT page_id, 'https://a/' || page_id || ' https://b/' || page_id || ' https://h/' || page_id AS pypi, 'https://g/' || page_id || ' https://h/' || page_id AS npm, 'https://go.example/o' || page_id || '/r https://pkg.go.dev/go.example/o' || page_id || '/r/v2' AS gomod FROM pages""")
def registry_payload_urls(spark, sf):
    p = F.col("page_id")
    j = lambda template: F.replace(F.lit(template), F.lit("@"), p.cast("string"))
    pypi = j('{"info": {"project_urls": {"a": "https://a/@", "b": " https://b/@ "}, "home_page": "https://h/@"}}')
    npm = j('{"dist-tags": {"latest": "2"}, "versions": {"2": {"repository": {"url": "https://g/@"}, "homepage": "https://h/@"}}, "repository": "https://g/@"}')
    gomod = j('{"module_path": "go.example/o@/r/v2"}')
    return table(spark, sf, "pages").select("page_id", *[F.array_join(registries.candidate_urls(n, c), " ").alias(n) for n, c in (("pypi", pypi), ("npm", npm), ("gomod", gomod))])


def _seed_tables(spark, sf):
    """Whole tables; the incoming ids are shifted by 100, so that some are new and some are named by no ingest."""
    c = table(spark, sf, "customer")
    u = lambda *xs: F.array(*xs)

    def base(key, item):
        return [key.cast("string").alias("_id"), F.lit("t").alias("source_type"), F.lit("n").alias("source_name"), F.concat(item, key).alias("source_item_id")]

    key = F.col("c_custkey")
    old = c.select(*base(key, F.lit("i")), u(F.lit("b"), F.lit("a")).alias("candidate_repo_urls"), F.when(key % 2 == 0, "registered").otherwise("").alias("status"), *[F.to_timestamp(F.lit("1997-01-01")).alias(n) for n in ("first_seen_at", "last_seen_at", "last_ingested_at")])
    key = F.col("c_custkey") + 100
    new = c.select(*base(key, F.when(key % 7 == 0, "j").otherwise("i")), F.when(key % 5 == 0, u(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(u(F.lit("a"), F.lit(" b "), F.lit("a"))).alias("candidate_repo_urls"))
    return old, new


@register("seed_upsert_changed", f"""WITH s AS (SELECT coalesce(o.k, n.k) AS k, o.k IS NULL AS fresh, n.k IS NULL AS unnamed FROM (SELECT c_custkey AS k FROM customer) o FULL JOIN (SELECT c_custkey + 100 AS k FROM customer) n ON o.k = n.k),
c AS (SELECT *, NOT unnamed AND (fresh OR k % 5 = 0 OR k % 7 = 0) AS changed FROM s)
SELECT CAST(k AS VARCHAR) AS _id,
  CASE WHEN changed THEN 'ingested' WHEN k % 2 = 0 THEN 'registered' WHEN unnamed THEN '' ELSE 'ingested' END AS status,
  CASE WHEN fresh THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '1997-01-01' END AS first_seen_at,
  CASE WHEN unnamed THEN TIMESTAMP '1997-01-01' ELSE TIMESTAMP '{NOW}' END AS last_seen_at,
  CASE WHEN changed THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '1997-01-01' END AS last_ingested_at
FROM c""")  # fmt: skip
def seed_upsert_changed(spark, sf):
    old, new = _seed_tables(spark, sf)
    return seeds.seed_upsert(old, new, now()).select("_id", "status", "first_seen_at", "last_seen_at", "last_ingested_at")


@register("seed_antijoin_registry", f"WITH {_CANON_SQL}, n AS (SELECT page_id, CASE WHEN owner <> '' THEN 'github:' || lower(owner) || '/' || lower(repo) END AS repo_id FROM p) SELECT page_id, repo_id, CASE WHEN repo_id IS NULL THEN 'invalid' WHEN page_id % 3 = 0 THEN 'already_registered' ELSE 'normalized' END AS status FROM n")
def seed_antijoin_registry(spark, sf):
    s = _seed_urls(spark, sf).select("page_id", F.array("raw").alias("candidate_repo_urls"))
    c = urls.canonical(F.col("raw"))
    registry = _seed_urls(spark, sf).where("page_id % 3 = 0").select(urls.repo_id(c["owner"], c["repo"]).alias("repo_id")).where("repo_id IS NOT NULL")
    return seeds.normalize(s, registry).select("page_id", "repo_id", "status")


@register("repo_group_register", """SELECT 'github:n' || c_nationkey || '/r' AS repo_id, count(*) AS discovery_source_count, array_to_string(list_sort(list_distinct(list(c_mktsegment))), ',') AS source_types, min(CAST(c_custkey AS VARCHAR)) AS first_seed FROM customer GROUP BY c_nationkey""")
def repo_group_register(spark, sf):
    s = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("_id"), F.concat(F.lit("github:n"), "c_nationkey", F.lit("/r")).alias("repo_id"), F.col("c_mktsegment").alias("source_type"))
    return seeds.group_by_repo(s).select("repo_id", "discovery_source_count", F.array_join("source_types", ",").alias("source_types"), "first_seed")


@register("qualify_score", f"""WITH r AS (SELECT s_suppkey, {_SPDX_SQL} AS spdx, s_suppkey % 7 = 0 AS private, s_suppkey % 11 = 0 AS archived, s_suppkey % 4 = 0 AS fork, CAST(abs(s_acctbal) AS BIGINT) AS stars FROM supplier)
SELECT s_suppkey, CASE WHEN private THEN 'private_repo' WHEN archived THEN 'archived_repo' ELSE 'qualified' END AS reason,
  CAST(CASE WHEN private OR archived THEN 0.0 ELSE round(CASE WHEN spdx <> '' THEN 0.35 ELSE 0 END + CASE WHEN fork THEN 0 ELSE 0.20 END + 0.15 + CASE WHEN stars >= 1000 THEN 0.20 WHEN stars >= 100 THEN 0.10 WHEN stars >= 10 THEN 0.05 ELSE 0 END + 0.10, 4) END AS DOUBLE) AS score FROM r""")
def qualify_score(spark, sf):
    k = F.col("s_suppkey")
    q = classify.qualification(F.lit(False), k % 7 == 0, k % 11 == 0, F.col("spdx"), k % 4 == 0, F.lit("main"), F.round(F.abs("s_acctbal")).cast("bigint"), F.lit("x"))
    return _registry(spark, sf).withColumn("q", q).select("s_suppkey", F.col("q.reason").alias("reason"), F.col("q.score").alias("score"))


@register("cursor_watermark", "SELECT event_type, max(ts) AS last_max, strftime(CAST(max(ts) AS DATE) - 2, '%Y-%m-%d') AS since FROM events GROUP BY 1")
def cursor_watermark(spark, sf):
    none = F.lit(None).cast("timestamp")
    return table(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("last_max")).withColumn("since", classify.incremental_since(none, F.col("last_max").cast("timestamp"), none, 2))


@register("cursor_upsert", f"""WITH e AS (SELECT event_type AS _id, max_by(CASE WHEN value > 50 THEN 'success' ELSE 'error' END, (ts, event_id)) AS st, count(*) AS n, max(ts) AS mx FROM events GROUP BY 1)
SELECT _id, st AS last_status, n AS last_emitted, CASE WHEN st = 'success' THEN mx END AS last_max_pushed_at FROM e""")
def cursor_upsert(spark, sf):
    e = table(spark, sf, "events").groupBy(F.col("event_type").alias("_id")).agg(F.max_by(F.when(F.col("value") > 50, "success").otherwise("error"), F.struct("ts", "event_id")).alias("status"), F.count(F.lit(1)).alias("emitted"), F.max("ts").alias("max_pushed"))
    attempts = e.withColumn("error", F.lit(None).cast("string")).withColumn("max_updated", F.col("max_pushed"))
    empty = attempts.limit(0).select("_id", F.col("emitted").alias("last_emitted"), F.col("status").alias("last_status"), F.col("error").alias("last_error"), *[F.col("max_pushed").alias(n) for n in ("last_max_pushed_at", "last_max_updated_at")], *[F.lit(None).cast("timestamp").alias(n) for n in ("last_attempt_at", "last_success_at")])
    return seeds.cursor_upsert(empty, attempts, now()).select("_id", "last_status", "last_emitted", "last_max_pushed_at")


@register("expansion_cap", """WITH l AS (SELECT o_custkey, 'https://github.com/c' || o_orderkey % 50 || '/r' AS url, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS kind, o_orderkey AS place FROM orders WHERE o_orderkey % 50 <> o_custkey % 50),
m AS (SELECT o_custkey, url, min((kind, place)) AS seen FROM l GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY seen, url) AS rank FROM m)
SELECT CAST(o_custkey AS VARCHAR) AS repo_id, url, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def expansion_cap(spark, sf):
    o = table(spark, sf, "orders")
    name = lambda c: F.concat(F.lit("https://github.com/c"), c % 50, F.lit("/r"))
    links = o.select(F.col("o_custkey").cast("string").alias("repo_id"), name(F.col("o_custkey")).alias("repo_url"), F.when(F.col("o_orderstatus") == "O", "readme").otherwise("manifest").alias("origin"), F.col("o_orderkey").alias("place"), name(F.col("o_orderkey")).alias("url"))
    return seeds.expand(links, 5).select("repo_id", "url", F.col("rank").cast("int").alias("rank"))


_PATH_SQL = "list_extract(['src/a.py', 'LICENSE', 'docs/readme.md', 'app/main.ts', 'Makefile', 'conf/x.yaml', 'tests/test_a.py', 'b.spec.js', 'bin/data', 'package.json', 'vendor/x/go.mod', 'src/lib_test.go'], CAST(p_partkey % 12 + 1 AS BIGINT))"
_PATHS = ["src/a.py", "LICENSE", "docs/readme.md", "app/main.ts", "Makefile", "conf/x.yaml", "tests/test_a.py", "b.spec.js", "bin/data", "package.json", "vendor/x/go.mod", "src/lib_test.go"]


def _paths(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", F.get(F.array(*[F.lit(x) for x in _PATHS]), (F.col("p_partkey") % 12).cast("int")).alias("path"))


@register("file_classify", f"""WITH f AS (SELECT p_partkey, {_PATH_SQL} AS path FROM part)
SELECT p_partkey, path, CASE path WHEN 'LICENSE' THEN 'license' WHEN 'Makefile' THEN 'makefile' ELSE CASE regexp_extract(path, '\\.[a-z]+$') WHEN '.py' THEN 'python' WHEN '.md' THEN 'document' WHEN '.ts' THEN 'typescript' WHEN '.yaml' THEN 'config' WHEN '.json' THEN 'config' WHEN '.js' THEN 'javascript' WHEN '.go' THEN 'go' ELSE 'unknown' END END AS language,
  regexp_matches(path, '\\.(py|ts|js|go)$') OR path = 'Makefile' AS is_code, path = 'LICENSE' AS is_license FROM f""")  # fmt: skip
def file_classify(spark, sf):
    return _paths(spark, sf).withColumn("c", classify.file_class(F.col("path"))).select("p_partkey", "path", F.col("c.language").alias("language"), F.col("c.is_code").alias("is_code"), F.col("c.is_license").alias("is_license"))


@register("test_path_filter", f"WITH f AS (SELECT p_partkey, {_PATH_SQL} AS path FROM part) SELECT p_partkey, path FROM f WHERE path NOT IN ('tests/test_a.py', 'b.spec.js', 'src/lib_test.go')")
def test_path_filter(spark, sf):
    return _paths(spark, sf).where(~classify.is_test_path(F.col("path"))).select("p_partkey", "path")


@register("manifest_topn", f"WITH f AS (SELECT DISTINCT p_brand, {_PATH_SQL} AS path FROM part) SELECT p_brand, path, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY CASE path WHEN 'package.json' THEN 0 ELSE 6 END, length(path), path) AS INTEGER) AS rank FROM f WHERE path IN ('package.json', 'vendor/x/go.mod')")
def manifest_topn(spark, sf):
    return seeds.best_manifests(_paths(spark, sf).withColumnRenamed("p_brand", "repo_id"), 5).select(F.col("repo_id").alias("p_brand"), "path", F.col("rank").cast("int").alias("rank"))


@register("size_tier", "SELECT p_partkey, CASE WHEN CAST(p_retailprice * 100 AS BIGINT) >= 200000 THEN 'giant_hint' WHEN CAST(p_retailprice * 100 AS BIGINT) >= 50000 THEN 'whale_hint' ELSE 'normal' END AS tier FROM part")
def size_tier(spark, sf):
    return table(spark, sf, "part").select("p_partkey", classify.size_tier(F.round(F.col("p_retailprice") * 100).cast("bigint")).alias("tier"))


@register("sha1_shard", "SELECT c_custkey, CAST(CAST('0x' || substr(sha1('github:o' || c_custkey || '/r'), 1, 8) AS BIGINT) % 36 AS INTEGER) AS shard FROM customer")
def sha1_shard(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", T.shard_of(F.concat(F.lit("github:o"), "c_custkey", F.lit("/r")), 36).alias("shard"))


@register("lpt_shard_plan", """WITH RECURSIVE w AS (SELECT CAST(l_suppkey AS VARCHAR) AS repo_id, CAST(sum(l_quantity) AS BIGINT) AS weight FROM lineitem GROUP BY 1), e AS (SELECT *, row_number() OVER (ORDER BY weight DESC, repo_id) AS i FROM w),
s AS (SELECT CAST(0 AS BIGINT) AS i, '' AS repo_id, CAST(0 AS BIGINT) AS weight, [CAST(0 AS BIGINT) FOR j IN range(8)] AS held, [CAST(0 AS BIGINT) FOR j IN range(8)] AS n, CAST(-1 AS BIGINT) AS shard
  UNION ALL SELECT i, repo_id, weight, [CASE WHEN j = shard THEN held[j + 1] + weight ELSE held[j + 1] END FOR j IN range(8)], [CASE WHEN j = shard THEN n[j + 1] + 1 ELSE n[j + 1] END FOR j IN range(8)], shard
  FROM (SELECT e.i, e.repo_id, e.weight, s.held, s.n, list_min([(s.held[j + 1] * 1000000 + s.n[j + 1]) * 8 + j FOR j IN range(8)]) % 8 AS shard FROM s JOIN e ON e.i = s.i + 1))
SELECT repo_id, weight, 'light' AS phase, CAST(shard AS INTEGER) AS shard FROM s WHERE i > 0""")
def lpt_shard_plan(spark, sf):
    w = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").cast("bigint").alias("weight")).select(F.col("l_suppkey").cast("string").alias("repo_id"), "weight", F.lit("light").alias("phase"))
    return stages.plan_shards(w, 8)


def _repo_state(spark, sf):
    o = table(spark, sf, "orders")
    s = F.col("o_orderstatus")
    ts = F.col("o_orderdate").cast("timestamp")
    none = F.lit(None).cast("string")
    return o.select(
        F.col("o_orderkey").cast("string").alias("repo_id"), F.when(F.col("o_custkey") % 5 == 0, "crawl_failed").otherwise("downloaded").alias("crawl_status"), F.when(s == "P", "extracting").when(s == "F", "extracted").otherwise(none).alias("file_extract_status"),
        F.when((s == "F") & (F.col("o_custkey") % 3 == 0), "chunked").when((s == "F") & (F.col("o_custkey") % 3 == 1), "chunking").otherwise(none).alias("chunk_status"), ts.alias("crawl_started_at"), ts.alias("file_extract_started_at"), ts.alias("chunk_started_at"),
        none.alias("processing_retry_state"), F.when(F.col("o_custkey") % 2 == 0, "pruned").otherwise(none).alias("cleanup_status"),
    )


_STATE_SQL = """st AS (SELECT CAST(o_orderkey AS VARCHAR) AS repo_id, CASE WHEN o_custkey % 5 = 0 THEN 'crawl_failed' ELSE 'downloaded' END AS crawl, CASE o_orderstatus WHEN 'P' THEN 'extracting' WHEN 'F' THEN 'extracted' END AS ex,
  CASE WHEN o_orderstatus = 'F' AND o_custkey % 3 = 0 THEN 'chunked' WHEN o_orderstatus = 'F' AND o_custkey % 3 = 1 THEN 'chunking' END AS ch, o_orderdate AS began, CASE WHEN o_custkey % 2 = 0 THEN 'pruned' END AS cl FROM orders)"""


@register("stale_leases", f"WITH {_STATE_SQL} SELECT repo_id FROM st WHERE ex = 'extracting' AND epoch(TIMESTAMP '{NOW}') - epoch(began) >= 1800")
def stale_leases(spark, sf):
    r = _repo_state(spark, sf)
    return r.where((F.col("file_extract_status") == "extracting") & classify.is_stale(F.col("file_extract_started_at"), now(), 1800)).select("repo_id")


@register("retry_candidates", f"WITH {_STATE_SQL} SELECT repo_id, CASE WHEN crawl = 'crawl_failed' THEN 'crawl' ELSE 'extract' END AS stage, CASE WHEN crawl = 'crawl_failed' THEN 'crawl_failed' ELSE 'stale_extract' END AS reason FROM st WHERE crawl = 'crawl_failed' OR (ex = 'extracting' AND epoch(TIMESTAMP '{NOW}') - epoch(began) >= 1800)")
def retry_candidates(spark, sf):
    return stages.retry_candidates(_repo_state(spark, sf), now())


@register("backlog_gauges", f"WITH {_STATE_SQL}, g AS (SELECT count(*) FILTER (crawl = 'downloaded' AND coalesce(ex <> 'extracted', true)) AS downloaded_pending, count(*) FILTER (ex = 'extracted' AND ch IS NULL) AS extracted_pending FROM st) SELECT *, downloaded_pending >= 2000 OR extracted_pending >= 5000 AS pause FROM g")
def backlog_gauges(spark, sf):
    return stages.backlog(_repo_state(spark, sf))


@register("stage_union_pending", f"WITH {_STATE_SQL} SELECT repo_id FROM st WHERE (ex = 'extracted' AND ch IS NULL) OR (ch = 'chunked' AND cl IS NULL) OR (ch = 'chunking' AND epoch(TIMESTAMP '{NOW}') - epoch(began) >= 1800)")
def stage_union_pending(spark, sf):
    return stages.pending_chunking(_repo_state(spark, sf), now()).select("repo_id")


@register("validation_rules", """
WITH f AS (SELECT l_orderkey % 500 AS k, count(*) AS files, count(*) FILTER (l_linestatus = 'F') AS code FROM lineitem WHERE l_orderkey % 500 < 450 GROUP BY 1), r AS (SELECT DISTINCT o_orderkey % 500 AS k FROM orders)
SELECT CAST(r.k AS VARCHAR) AS repo_id, CASE WHEN files IS NULL OR code = 0 THEN 'validation_failed' ELSE 'validated' END AS status, CASE WHEN files IS NULL THEN 'no_extracted_file_docs,no_extracted_code_file_docs,no_chunk_docs' ELSE CASE WHEN code = 0 THEN 'no_extracted_code_file_docs' ELSE '' END END AS failed
FROM r LEFT JOIN f ON r.k = f.k""")
def validation_rules(spark, sf):
    r = table(spark, sf, "orders").select((F.col("o_orderkey") % 500).alias("k")).distinct()
    big = lambda n: F.lit(None).cast("bigint").alias(n)
    repos = r.select(F.col("k").cast("string").alias("repo_id"), F.lit("chunked").alias("chunk_status"), F.lit("extracted").alias("file_extract_status"), *[big(f"expected_{n}") for n in ("files", "code_files", "chunks", "functions", "classes")], F.lit("").alias("chunk_strategy"))
    lines = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 500).alias("k"), "l_linestatus").where("k < 450")
    files = lines.select(F.col("k").cast("string").alias("repo_id"), (F.col("l_linestatus") == "F").alias("is_code_file"))
    one = lambda n: F.lit("x").alias(n)
    ch = lines.select(F.col("k").cast("string").alias("repo_id"), F.lit("valid").alias("validation_status"), F.lit("function").alias("chunk_type"), *[one(n) for n in ("symbol_name", "structure_signature", "ast_node_sequence", "raw_hash", "normalized_hash", "anonymized_hash", "ast_root_node_type")])
    return stages.validate(repos, files, ch).select("repo_id", "status", F.array_join("failed_rules", ",").alias("failed"))


@register("pending_embedding_antijoin", "SELECT lang AS language, count(*) AS eligible, count(*) FILTER (vec_id IS NULL) AS pending FROM documents LEFT JOIN embeddings ON doc_id = vec_id GROUP BY 1")
def pending_embedding_antijoin(spark, sf):
    c = table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("lang").alias("language"), F.lit("valid").alias("validation_status"))
    return stages.pending_embeddings(c, table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id")))


@register("embedding_requests", "SELECT CAST(item_id * 30 AS VARCHAR) AS chunk_id, CASE WHEN doc_id IS NULL THEN 'missing' WHEN vec_id IS NOT NULL THEN 'done' ELSE 'to_process' END AS state FROM benchmark LEFT JOIN documents ON doc_id = item_id * 30 LEFT JOIN embeddings ON vec_id = item_id * 30")
def embedding_requests(spark, sf):
    ids = table(spark, sf, "benchmark").select((F.col("item_id") * 30).cast("string").alias("chunk_id"))
    c = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.lit("valid").alias("validation_status"))
    return stages.requested(ids, c, table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id")))


@register("embedding_text_groups", "SELECT lang AS language, sha1(text) AS text_hash, count(*) AS chunks, min(CAST(doc_id AS VARCHAR)) AS chunk_id FROM documents GROUP BY 1, 2")
def embedding_text_groups(spark, sf):
    return stages.text_groups(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("lang").alias("language"), "text"), "text")


@register("line_windows", """
WITH l AS (SELECT doc_id, string_split(regexp_replace(text, '\n$', ''), chr(10)) AS ls FROM documents WHERE text <> ''), w AS (SELECT doc_id, ls, unnest(range(0, CAST(greatest(1, ceil((len(ls) - 8) / 6.0) + 1) AS BIGINT))) AS k FROM l)
SELECT doc_id, CAST(k * 6 + 1 AS INTEGER) AS start_line, CAST(least(k * 6 + 8, len(ls)) AS INTEGER) AS end_line, md5(array_to_string(ls[k * 6 + 1:k * 6 + 8], chr(10))) AS digest FROM w""")
def line_windows(spark, sf):
    d = table(spark, sf, "documents").where("text <> ''").select("doc_id", F.explode(T.line_windows(F.col("text"), 8, 2)).alias("w"))
    return d.select("doc_id", "w.start_line", "w.end_line", F.md5("w.text").alias("digest"))


@register("ordered_distinct_cap", f"""
WITH w AS (SELECT conv_id, turn, {_WORDS.format("text")} AS ws FROM conversations), f AS (SELECT conv_id, turn, word, min(i) AS i FROM (SELECT conv_id, turn, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w) GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) AS n FROM f)
SELECT conv_id, turn, string_agg(word, ' ' ORDER BY n) AS terms FROM r WHERE n <= 16 GROUP BY 1, 2""")
def ordered_distinct_cap(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", T.ordered_distinct(search.words(F.col("text")), 16).alias("ws")).where(F.size("ws") > 0)
    return c.select("conv_id", "turn", F.array_join("ws", " ").alias("terms"))


@register("rate_limit_sliding", """WITH RECURSIVE e AS (SELECT coalesce(trim(CAST(user_id AS VARCHAR)), 'unknown') AS key, epoch_us(ts) / 1e6 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
s AS (SELECT DISTINCT key, CAST(0 AS DOUBLE) AS t, CAST(0 AS BIGINT) AS i, CAST([] AS DOUBLE[]) AS times, false AS allowed, CAST(0 AS BIGINT) AS remaining, CAST(0 AS BIGINT) AS retry FROM e
  UNION ALL SELECT key, t, i, CASE WHEN len(kept) < 3 THEN list_append(kept, t) ELSE kept END, len(kept) < 3, CASE WHEN len(kept) < 3 THEN 2 - len(kept) ELSE 0 END, CASE WHEN len(kept) < 3 THEN 0 ELSE greatest(1, CAST(trunc(kept[1] + 86400 - t) AS BIGINT)) END
  FROM (SELECT e.key, e.t, e.i, [x FOR x IN s.times IF x > e.t - 86400] AS kept FROM s JOIN e ON e.key = s.key AND e.i = s.i + 1))
SELECT key, t AS "at", allowed, CAST(remaining AS INTEGER) AS remaining, CAST(retry AS INTEGER) AS retry_after FROM s WHERE i > 0""")
def rate_limit_sliding(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).withColumn("at", F.col("us") / 1e6)
    return streams.rate_limit(e, "user_id", "at", 3, 86400)


@register("concurrency_in_flight", "WITH e AS (SELECT event_id, user_id % 5 AS pool, ts, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN -1 ELSE 0 END AS d FROM events) SELECT event_id, CAST(sum(d) OVER (PARTITION BY pool ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS in_flight FROM e")
def concurrency_in_flight(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.col("user_id") % 5).alias("pool"), F.col("ts").alias("at"), F.when(F.col("event_type") == "signup", "acquire").when(F.col("event_type") == "purchase", "release").otherwise("none").alias("kind"))
    return streams.concurrency(e, 100).select("event_id", F.col("in_flight").cast("bigint").alias("in_flight"))


@register("windowed_event_counts", "SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def windowed_event_counts(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.windowed_counts(e, "ts", ["event_type"]).select("event_type", F.col("window.start").alias("hour"), "n", F.round("total", 2).alias("total"))


@register("lease_state", f"SELECT user_id, max_by(event_type, (ts, event_id)) AS last_event, epoch(TIMESTAMP '{NOW}') - epoch(max(ts)) >= 1800 AS stale FROM events GROUP BY 1")
def lease_state(spark, sf):
    return streams.lease_state(table(spark, sf, "events"), "user_id", "ts", now(), 1800).select("user_id", "last_event", "stale")


@register("stale_delete_antijoin", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def stale_delete_antijoin(spark, sf):
    return stale(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@register("partial_upsert", "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, lang, CASE WHEN l.doc_id IS NOT NULL THEN 'labelled' ELSE source END AS source, quality FROM documents d FULL JOIN (SELECT doc_id + 100 AS doc_id, quality FROM labels) l ON d.doc_id = l.doc_id")
def partial_upsert(spark, sf):
    """Whole tables; labels are shifted by 100 ids, so that some are of no document."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return upsert(d, table(spark, sf, "labels").select((F.col("doc_id") + 100).alias("doc_id"), F.lit("labelled").alias("source"), "quality"), "doc_id")


@register("identity_digests", "SELECT doc_id, 'github:' || source || '/corpus:file:' || sha1(source || '/' || doc_id) AS file_id, sha1(source || '|' || doc_id || '|function|1|2||v1') AS chunk_id, substr(sha1(source), 1, 12) AS digest, 'cursor:t:' || lang || ':' || substr(sha1(source), 1, 12) AS cursor_id FROM documents")
def identity_digests(spark, sf):
    d = table(spark, sf, "documents")
    s, i = F.col("source"), F.col("doc_id")
    return d.select("doc_id", urls.file_id(F.concat(F.lit("github:"), s, F.lit("/corpus")), F.concat_ws("/", s, i)).alias("file_id"), urls.chunk_id(s, i, F.lit("function"), F.lit(1), F.lit(2), F.lit(""), F.lit("v1")).alias("chunk_id"), T.stable_digest(s).alias("digest"), urls.cursor_id(F.lit("t"), F.col("lang"), s).alias("cursor_id"))


@register("keyset_page", "SELECT doc_id, source FROM documents WHERE doc_id > 100 AND lang = 'en' ORDER BY doc_id LIMIT 25")
def keyset_page(spark, sf):
    d = table(spark, sf, "documents")
    return d.where(search.term("lang", "en") & (F.col("doc_id") > 100)).orderBy("doc_id").limit(25).select("doc_id", "source")


@register("bool_filter_counts", "SELECT source, count(*) AS n, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang IN ('fr', 'de')) AS fr_de, count(*) FILTER (lang <> 'en' AND n_chars > 1000) AS long_other FROM documents GROUP BY 1")
def bool_filter_counts(spark, sf):
    d = table(spark, sf, "documents")
    return d.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(search.term("lang", "en")).alias("en"), F.count_if(search.terms("lang", ["fr", "de"])).alias("fr_de"),
        F.count_if(search.bool_query(must=[F.col("n_chars") > 1000], must_not=[search.term("lang", "en")])).alias("long_other"),
    )


@register("domain_families", f"""WITH s AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'schema enum nullable' WHEN 1 THEN 'openai stream config session' WHEN 2 THEN 'query' ELSE 'column relation pk protobuf proto' END AS t FROM documents)
SELECT doc_id, CASE t WHEN 'schema enum nullable' THEN 'schema_generation' WHEN 'query' THEN '' WHEN 'openai stream config session' THEN 'config_setter,openai_chat_wrapper' ELSE 'orm_metadata,protobuf_query_parsing' END AS active,
  CASE t WHEN 'schema enum nullable' THEN 'schema_generation' WHEN 'query' THEN '' WHEN 'openai stream config session' THEN 'openai_chat_wrapper' ELSE 'orm_metadata' END AS "primary" FROM s""")  # fmt: skip
def domain_families(spark, sf):
    t = F.get(F.array(*[F.lit(x) for x in ("schema enum nullable", "openai stream config session", "query", "column relation pk protobuf proto")]), (F.col("doc_id") % 4).cast("int"))
    d = table(spark, sf, "documents").select("doc_id", tokens.families(F.split(t, " "), tokens.DOMAIN_FAMILIES).alias("f"))
    return d.select("doc_id", F.array_join("f.active", ",").alias("active"), F.col("f.primary").alias("primary"))


@register("identifier_terms", rf"""WITH n AS (SELECT p_partkey, 'get' || array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(regexp_replace(p_name, '[^A-Za-z ]', '', 'g'), ' ')], ' ') || 'HTTPServer' || p_size AS name FROM part),
t AS (SELECT p_partkey, name, [lower(x) FOR x IN regexp_extract_all(regexp_replace(regexp_replace(name, '[.-]', '_', 'g'), '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '[A-Z]?[a-z]+|[A-Z]+|[0-9]+') IF lower(x) NOT IN ({", ".join(f"'{x}'" for x in tokens.GENERIC_TERMS)})] AS terms FROM n)
SELECT p_partkey, array_to_string(list_sort(list_distinct(terms)), ' ') AS terms, array_to_string(list_sort(list_distinct(list_append(terms, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g')))), ' ') AS variants FROM t""")
def identifier_terms(spark, sf):
    p = table(spark, sf, "part")
    name = F.concat(F.lit("get"), F.initcap(F.regexp_replace("p_name", "[^A-Za-z ]", "")), F.lit("HTTPServer"), F.col("p_size"))
    return p.select("p_partkey", F.array_join(F.array_sort(tokens.identifier_terms(name)), " ").alias("terms"), F.array_join(F.array_sort(tokens.term_variants(name)), " ").alias("variants"))


def _chunk_features(spark, sf, prefix):
    """Documents as chunks with token columns: their words as identifiers, numbers of characters as calls."""
    ws = T.ordered_distinct(search.words(F.col("text")), 64)
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", ws.alias("ws"), F.array(F.concat(F.lit("f"), F.col("n_chars") % 9)).alias("calls"), F.array(F.lit("+")).alias("ops"))
    found = review.features(prefix, identifiers=F.col("ws"), calls=F.col("calls"), operators=F.col("ops"), symbol=F.lit(""), path=F.lit(""), code=F.lit(""))
    return d.select(F.col("doc_id").cast("string").alias(f"{prefix}id"), F.col("source").alias(f"{prefix}repo"), *found)


def _hash_pairs(spark, sf):
    c = chunks(spark, sf)
    merged = retrieval.merge_variants(retrieval.hash_hits(c, c))
    of_source = merged.withColumnRenamed("source_id", "sid").join(_chunk_features(spark, sf, "source_"), F.col("sid") == F.col("source_id"))
    return of_source.join(_chunk_features(spark, sf, "candidate_"), F.col("chunk_id") == F.col("candidate_id"))


@register("rule_review")
def rule_review(spark, sf):
    """Reviews of hash matches: overlap, ranking score, risk, what isn't shown left out."""
    p = _hash_pairs(spark, sf).withColumns({"same_repo": F.col("source_repo") == F.col("candidate_repo"), "file_path": F.col("candidate_id"), "symbol_name": F.lit("s"), "language": F.lit("en")})
    return retrieval.reviewed(p).select("sid", "chunk_id", "ranking_score", "risk_score", "risk_level", F.col("o.identifiers").alias("identifiers"))


@register("hybrid_review")
def hybrid_review(spark, sf):
    """Reviews of the same matches as if a vector arm had found every other one too."""
    p = _hash_pairs(spark, sf).withColumn("o", review.overlap("source_", "candidate_"))
    by_knn = F.col("candidate_id").cast("bigint") % 2 == 0
    r = review.hybrid_review(F.lit(1.5), F.lit(True), by_knn, F.col("strongest.type"), F.col("strongest.base"), F.col("evidences"), F.col("o"), review.ranking_score(F.col("o"), F.col("strongest.type"), F.lit(0.75)), F.lit("MIT"))
    return p.select("sid", "chunk_id", r.alias("r")).select("sid", "chunk_id", "r.*")


@register("python_chunks")
def python_chunks(spark, sf):
    """The chunker over files made of the tables: a function per document of a few lines, line windows for the rest."""
    from graniteloom.operators import chunker

    d = table(spark, sf, "documents")
    name = F.concat(F.lit("f_"), "doc_id")
    code = F.concat(F.lit("def "), name, F.lit("(a, b):\n    # made\n    c = a + b\n    return "), name, F.lit("(c, 'x')\n"))
    files = d.select("source", F.concat_ws("/", "source", "doc_id").alias("file_path"), F.when(F.col("doc_id") % 2 == 0, "python").otherwise("unknown").alias("language"), F.when(F.col("doc_id") % 2 == 0, code).otherwise(F.col("text")).alias("text")).withColumnRenamed("source", "repo_id")
    return chunker.chunk_files(files).select("chunk_id", "file_path", "chunk_type", "symbol_name", "start_line", "end_line", "anonymized_hash", "structure_signature")
