"""The composed retrieval: source chunks -> rule arm and vector arm -> fusion, for many sources in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from graniteloom.operators import retrieval, search

#: Candidates of the rule arm, of a variant, of the vector arm, and of both. Fixed values.
RULE_K, PER_VARIANT, KNN_K, MERGED_K = 20, 10, 50, 100


def has_vector(column: str = "embedding"):
    return F.coalesce(F.size(column) > 0, F.lit(False))


def rule_arm(sources: DataFrame, corpus: DataFrame, k: int = RULE_K, per_variant: int = PER_VARIANT, include_same_repo: bool = False) -> DataFrame:
    """(source_id, chunk_id, score): the best ``k`` of each source by its variants."""
    merged = retrieval.merge_variants(retrieval.hash_hits(sources, corpus, per_variant, include_same_repo))
    scored = merged.select("source_id", "chunk_id", F.round("aggregate", 9).alias("score"))
    return search.top_k(scored, ["source_id"], [F.desc("score"), F.asc("chunk_id")], k).drop("rank")


def vector_arm(sources: DataFrame, corpus: DataFrame, k: int = KNN_K, include_same_repo: bool = False) -> DataFrame:
    """(source_id, chunk_id, score): the nearest ``k`` of each source that has a vector, of its language and other repositories."""
    need = ["chunk_id", "repo_id", "language", "embedding"]
    apart = ("chunk_id",) if include_same_repo else ("chunk_id", "repo_id")
    near = search.knn(sources.where(has_vector()).select(*need), corpus.where(has_vector()).select(*need), "chunk_id", "chunk_id", "embedding", "embedding", k, ("language",), apart)
    return near.select(F.col("query").alias("source_id"), F.col("doc").alias("chunk_id"), "score")


def hybrid(sources: DataFrame, corpus: DataFrame, merged_k: int = MERGED_K, rule_k: int = RULE_K, per_variant: int = PER_VARIANT, knn_k: int = KNN_K, include_same_repo: bool = False) -> DataFrame:
    """(source_id, chunk_id, rank, fused, source_count, retrieval_sources, knn_status, ...): fused candidates of every source.

    A source without a vector has the rule arm alone, and its ``knn_status`` is ``skipped``.
    """
    fused = retrieval.fuse(rule_arm(sources, corpus, rule_k, per_variant, include_same_repo), vector_arm(sources, corpus, knn_k, include_same_repo), merged_k)
    status = sources.select(F.col("chunk_id").alias("_id"), F.when(has_vector(), "ok").otherwise("skipped").alias("knn_status"))
    out = fused.join(status, F.col("source_id") == F.col("_id")).drop("_id")
    return out.withColumn("retrieval_sources", retrieval.retrieval_sources(F.col("rule_scaled"), F.col("knn_scaled")))


def by_chunk(corpus: DataFrame, chunk_id: str, **how) -> DataFrame:
    """Candidates of one chunk of the corpus."""
    return hybrid(corpus.where(F.col("chunk_id") == chunk_id), corpus, **how)


def by_repo(corpus: DataFrame, repo_id: str, most: int | None = None, order: str = "chunk_id", **how) -> DataFrame:
    """Candidates of a repository's chunks; of the first ``most`` of them where that is asked for."""
    sources = corpus.where(F.col("repo_id") == repo_id)
    return hybrid(sources if most is None else sources.orderBy(order).limit(most), corpus, **how)
