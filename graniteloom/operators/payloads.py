"""Shapes of results for readers: repository summaries, evidence, candidates for people and for rerankers, ranked listings.

All are projections of struct columns: fields that are absent are null, and ``None`` in a struct is told as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from graniteloom.functions.text import clean

#: Reasons with this start are for operators, not for readers, and so many reasons are shown. Fixed values.
INTERNAL_REASON = "Hybrid similarity score after scaling:"
SHOWN_REASONS = 3


def _first(*values: Column) -> Column:
    """The first text that isn't blank, else an empty one."""
    return F.coalesce(*[F.when(clean(v) != "", clean(v)) for v in values], F.lit(""))


def source_repo(candidate: str, registry: str) -> Column:
    """A candidate's repository: what the chunk says, else what the registry says (struct columns of these names; the registry's may be null)."""
    c, r = F.col(candidate), F.col(registry)
    return F.struct(
        clean(c["repo_id"]).alias("repo_id"), _first(c["repo_url"], r["canonical_repo_url"]).alias("repo_url"), _first(c["owner"], r["owner"]).alias("owner"),
        _first(c["repo_name"], r["repo_name"]).alias("repo_name"), clean(r["repo_license_spdx"]).alias("license_spdx"), clean(r["repo_license_name"]).alias("license_name"),
        clean(r["repo_visibility"]).alias("visibility"), F.coalesce(r["repo_is_fork"], F.lit(False)).alias("is_fork"),
    )


def with_source_repo(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Candidates (repo_id, ...) with ``source_repo``; one row of the registry per repository, none is no loss."""
    known = registry.select(F.struct(*registry.columns).alias("_registry"))
    row = candidates.select("*", F.struct(*[F.col(n) if n in candidates.columns else F.lit(None).cast("string").alias(n) for n in ("repo_id", "repo_url", "owner", "repo_name")]).alias("_chunk"))
    return row.join(known, F.col("_chunk.repo_id") == F.col("_registry.repo_id"), "left").withColumn("source_repo", source_repo("_chunk", "_registry")).drop("_chunk", "_registry")


def evidence(found: Column) -> Column:
    """Evidence structs of any origin with all fields typed and none missing."""
    def one(e: Column) -> Column:
        number = lambda n: F.coalesce(e[n].cast("double"), F.lit(0.0)).alias(n)
        return F.struct(*[clean(e[n]).alias(n) for n in ("variant_id", "variant_name", "family")], number("raw_score"), number("normalized_score"), F.coalesce(e["rank"].cast("int"), F.lit(0)).alias("rank"))

    return F.transform(F.coalesce(found, F.array().cast("array<struct<variant_id:string,variant_name:string,family:string,raw_score:double,normalized_score:double,rank:int>>")), one)


def shown_reasons(reasons: Column, most: int = SHOWN_REASONS) -> Column:
    """The first reasons that are for readers."""
    told = F.filter(F.transform(F.coalesce(reasons, F.array().cast("array<string>")), clean), lambda r: (r != "") & ~r.startswith(INTERNAL_REASON))
    return F.slice(told, 1, most)


def for_reader(repo: Column, review: Column, file_path: Column, symbol_name: Column, raw_code: Column, retrieval_sources: Column) -> Column:
    """A candidate as a report shows it; blank texts are null, so that a JSON writer leaves them out."""
    told = lambda v: F.when(clean(v) != "", clean(v))
    return F.struct(
        F.struct(told(repo["repo_url"]).alias("repo_url"), told(repo["license_spdx"]).alias("license_spdx"), told(repo["license_name"]).alias("license_name")).alias("repository"),
        F.struct(told(file_path).alias("file_path"), told(symbol_name).alias("symbol_name")).alias("location"),
        F.struct(told(review["risk_level"]).alias("level"), review["risk_score"].alias("score")).alias("review_priority"),
        F.struct(told(raw_code).alias("raw_code")).alias("matched_chunk"),
        F.coalesce(retrieval_sources, F.array().cast("array<string>")).alias("matched_by"),
        clean(review["strongest_evidence_type"]).alias("primary_match_signal"),
        shown_reasons(review["reasons"]).alias("review_reasons"),
    )


def chunk_for_rerank(chunk: Column) -> Column:
    return F.struct(*[chunk[n].alias(n) for n in ("chunk_id", "repo_id", "language", "file_path", "chunk_type", "symbol_name", "anonymized_code")])


def for_rerank(candidate: Column, chunk: Column, repo: Column, fused: Column, review: Column, retrieval_sources: Column) -> Column:
    """A candidate as a reranker reads it."""
    return F.struct(
        *[candidate[n].alias(n) for n in ("chunk_id", "repo_id", "file_path", "symbol_name")], retrieval_sources.alias("retrieval_sources"), chunk_for_rerank(chunk).alias("candidate_chunk"),
        F.struct(*[repo[n].alias(n) for n in ("repo_url", "license_spdx", "license_name")]).alias("candidate_repo"),
        F.struct(*[fused[n].alias(n) for n in ("score", "source_count", "rule_based_scaled_score", "knn_scaled_score")]).alias("hybrid"),
        F.struct(*[review[n].alias(n) for n in ("risk_score", "risk_level", "strongest_evidence_type", "license_spdx")]).alias("license_review"),
    )


def listing(candidates: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row per source: how many candidates, how many of each level, and the candidates with their rank from 1."""
    ranked = candidates.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).withColumn("aggregate_score", F.round("aggregate_score", 6))
    shown = [c for c in ranked.columns if c not in (*by, "rank")]
    counts = [F.count_if(F.col("risk_level") == level).alias(level) for level in ("critical", "high", "medium", "low", "same_repo")]
    return ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("candidate_count"), *counts, F.array_sort(F.collect_list(F.struct("rank", *shown))).alias("candidates"))
