"""Retrieval of similar chunks: variants in one job, fusion of arms, clusters, reviews, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from graniteloom.functions import review
from graniteloom.functions.text import clean
from graniteloom.functions.tokens import query_variants
from graniteloom.operators.search import top_k

MOST_EVIDENCE = 8


def hash_hits(sources: DataFrame, chunks: DataFrame, per_variant: int = 10, include_same_repo: bool = False) -> DataFrame:
    """(source_id, chunk_id, name, family, priority, raw_score, rank) of equal hashes: an equi-join per kind of hash in one pass.

    Both tables have chunk_id, repo_id, raw_hash, normalized_hash, anonymized_hash. Ranks are from 0, by chunk.
    """
    kinds = ("raw_hash", "normalized_hash", "anonymized_hash")

    def exploded(df: DataFrame, key: str, repo: str) -> DataFrame:
        each = F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("value")) for k in kinds])
        return df.select(F.col("chunk_id").alias(key), F.col("repo_id").alias(repo), F.explode(each).alias("h")).select(key, repo, "h.name", "h.value").where("value IS NOT NULL AND value <> ''")

    pairs = exploded(sources, "source_id", "source_repo").join(exploded(chunks, "chunk_id", "repo"), ["name", "value"]).where("source_id <> chunk_id")
    if not include_same_repo:
        pairs = pairs.where("source_repo <> repo")
    hits = top_k(pairs, ["source_id", "name"], [F.asc("chunk_id")], per_variant)
    family = F.when(F.col("name") == "raw_hash", "exact").otherwise("normalized")
    priority = F.when(F.col("name") == "raw_hash", 100).otherwise(85)
    return hits.select("source_id", "chunk_id", "name", family.alias("family"), priority.alias("priority"), F.lit(1.0).alias("raw_score"), (F.col("rank") - 1).alias("rank"))


def merge_variants(hits: DataFrame) -> DataFrame:
    """(source_id, chunk_id, aggregate, evidences, names, strongest): scores of a chunk's variants added up.

    A variant's scores are divided by its best; all count for the aggregate, eight at most are listed, best first.
    """
    best = F.max("raw_score").over(W.partitionBy("source_id", "name"))
    scored = hits.withColumn("score", review.variant_score(F.col("raw_score"), best, F.col("rank"), F.col("priority"))).where("score > 0")
    one = F.struct((-F.col("score")).alias("minus"), F.col("rank"), F.col("name"), F.col("score"))
    per = scored.groupBy("source_id", "chunk_id").agg(F.sum("score").alias("aggregate"), F.slice(F.array_sort(F.collect_list(one)), 1, MOST_EVIDENCE).alias("found"))
    names = F.transform("found", lambda x: x["name"])
    return per.select("source_id", "chunk_id", "aggregate", F.size("found").alias("evidences"), names.alias("names"), review.strongest(names).alias("strongest"))


def dedupe_clusters(candidates: DataFrame, by: list[str], key: str, order: list[Column]) -> DataFrame:
    """The best of each cluster within ``by``, with ``cluster_size``."""
    out = candidates.withColumn("cluster_size", F.count(F.lit(1)).over(W.partitionBy(*by, key)))
    return out.withColumn("_n", F.row_number().over(W.partitionBy(*by, key).orderBy(*order))).where("_n = 1").drop("_n")


def review_order() -> list[Column]:
    """Critical, high, medium first, then ranking score, evidence, chunk."""
    return [F.least(review.level_rank(F.col("risk_level")), F.lit(3)), F.desc("ranking_score"), F.desc("evidences"), F.asc("chunk_id")]


def rounded(value: Column, places: int) -> Column:
    """Rounded in doubles as DuckDB does, half away from zero after scaling; ``round`` alone goes by the decimal digits, which differs on ties such as 0.15335."""
    return F.round(value * float(10**places)) / float(10**places)


def scale(df: DataFrame, by: list[str], score: str, order: list[Column], out: str = "scaled") -> DataFrame:
    """Scores scaled to [0, 1] within groups, to six places; one alone is 1; equal ones fall evenly in the given order."""
    g = W.partitionBy(*by)
    least, most, n = F.min(score).over(g), F.max(score).over(g), F.count(F.lit(1)).over(g)
    place = F.row_number().over(g.orderBy(*order)) - 1
    value = F.when(most > least, (F.col(score) - least) / (most - least)).when(n == 1, F.lit(1.0)).otherwise(1.0 - place / (n - 1))
    return df.withColumn(out, rounded(value, 6))


def fuse(rule: DataFrame, knn: DataFrame, k: int = 100) -> DataFrame:
    """Full outer join of two arms, (source_id, chunk_id, score) each: scaled, added up, ranked.

    Order: fused score, number of arms, vector score, rule score, chunk.
    """
    order = [F.desc("score"), F.asc("chunk_id")]
    a = scale(rule, ["source_id"], "score", order, "rule_scaled").select("source_id", "chunk_id", "rule_scaled")
    b = scale(knn, ["source_id"], "score", order, "knn_scaled").select("source_id", "chunk_id", "knn_scaled")
    both = a.join(b, ["source_id", "chunk_id"], "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    both = both.withColumn("source_count", F.col("rule_scaled").isNotNull().cast("int") + F.col("knn_scaled").isNotNull().cast("int")).withColumn("fused", rounded(zero("rule_scaled") + zero("knn_scaled"), 6))
    return top_k(both, ["source_id"], [F.desc("fused"), F.desc("source_count"), zero("knn_scaled").desc(), zero("rule_scaled").desc(), F.asc("chunk_id")], k)


def retrieval_sources(rule: Column, knn: Column) -> Column:
    return F.array_compact(F.array(F.when(rule.isNotNull(), F.lit("rule_based")), F.when(knn.isNotNull(), F.lit("knn"))))


def best_per_key(candidates: DataFrame, by: list[str]) -> DataFrame:
    """One candidate per chunk (or repository, path and symbol): level, score, number of arms, then first seen (``seen``)."""
    key = F.when(clean(F.col("chunk_id")) != "", F.concat(F.lit("chunk:"), clean(F.col("chunk_id")))).otherwise(F.concat_ws(":", F.lit("fallback"), clean(F.col("repo_id")), clean(F.col("file_path")), clean(F.col("symbol_name"))))
    order = [review.level_rank(F.col("risk_level")), F.desc("risk_score"), F.desc("source_count"), F.asc("seen")]
    keyed = candidates.withColumn("dedupe_key", key)
    return keyed.withColumn("_n", F.row_number().over(W.partitionBy(*by, "dedupe_key").orderBy(*order))).where("_n = 1").drop("_n")


def level_counts(candidates: DataFrame, by: list[str]) -> DataFrame:
    """Candidates per risk level, levels without any as 0."""
    return candidates.groupBy(*by).agg(*[F.count_if(F.col("risk_level") == n).alias(n) for n in review.LEVEL_RANK])


def report(candidates: DataFrame, per_source: int = 5) -> DataFrame:
    """One finding per source (path and symbol): its visible candidates, best first, the rest counted.

    Findings come in order of level, score, number of candidates, path, symbol (column ``finding_rank``).
    """
    visible = best_per_key(candidates.where(F.col("risk_level").isin(list(review.VISIBLE_LEVELS))), ["source_path", "source_symbol"])
    order = [review.level_rank(F.col("risk_level")), F.desc("risk_score"), F.asc("chunk_id")]
    ranked = visible.withColumn("place", F.row_number().over(W.partitionBy("source_path", "source_symbol").orderBy(*order)))
    shown = F.array_sort(F.collect_list(F.when(F.col("place") <= per_source, F.struct("place", "chunk_id", "risk_level", "risk_score"))))
    found = ranked.groupBy("source_path", "source_symbol").agg(
        F.count(F.lit(1)).alias("candidates"), F.greatest(F.count(F.lit(1)) - per_source, F.lit(0)).alias("more"), shown.alias("shown"),
        F.min_by("risk_level", "place").alias("top_level"), F.min_by("risk_score", "place").alias("top_score"),
    )
    place = W.orderBy(review.level_rank(F.col("top_level")), F.desc("top_score"), F.desc("candidates"), "source_path", "source_symbol")
    return found.withColumn("finding_rank", F.row_number().over(place))


def timings(chunks: DataFrame, by: list[str]) -> DataFrame:
    """Sum, mean and slowest of per-chunk seconds."""
    return chunks.groupBy(*by).agg(F.sum("seconds").alias("total"), F.avg("seconds").alias("mean"), F.max("seconds").alias("slowest"), F.max_by("chunk_id", "seconds").alias("slowest_chunk"))


def limitations(results: DataFrame) -> DataFrame:
    """Skipped vector arms and why."""
    return results.where("knn_status = 'skipped'").agg(F.count(F.lit(1)).alias("skipped"), F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("reasons"))


def variants_of(chunks: DataFrame) -> DataFrame:
    """One row per query variant of a chunk; chunks have the hash and code columns and ``summary``."""
    names = ("raw_hash", "raw_code", "normalized_hash", "anonymized_hash", "normalized_code", "anonymized_code", "summary")
    found = query_variants(F.col("chunk_id"), **{n: F.col(n) for n in names if n in chunks.columns})
    return chunks.select("chunk_id", "repo_id", "language", F.explode(found).alias("v")).select("chunk_id", "repo_id", "language", "v.*")


def reviewed(pairs: DataFrame, include_same_repo: bool = False, include_low: bool = False) -> DataFrame:
    """Rule-based matches with overlap, ranking score, review, and what isn't worth showing left out.

    ``pairs`` has source_ and candidate-prefixed features (``review.features``), strongest, evidences, aggregate, same_repo, file_path, symbol_name, language.
    """
    out = pairs.withColumn("o", review.overlap("source_", "candidate_"))
    out = out.withColumn("ranking_score", review.ranking_score(F.col("o"), F.col("strongest.type"), F.col("aggregate")))
    out = out.withColumn("r", review.rule_review(F.col("strongest.type"), F.col("strongest.base"), F.col("evidences"), F.col("aggregate"), F.col("o"), F.col("ranking_score"), F.col("same_repo")))
    out = out.withColumns({"risk_score": F.col("r.risk_score"), "risk_level": F.col("r.risk_level")}).drop("r")
    return out.where(review.keeps(F.col("risk_level"), F.col("strongest.type"), F.col("o"), F.col("file_path"), F.col("symbol_name"), F.col("language"), F.col("same_repo"), include_same_repo, include_low))
