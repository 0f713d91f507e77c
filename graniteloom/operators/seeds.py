"""Seeds to registry: ingest, change detection, normalisation, qualification, expansion, cursors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from graniteloom.functions.classify import is_manifest, manifest_score, qualification, size_kb, size_tier
from graniteloom.functions.text import clean, shard_of, sorted_distinct
from graniteloom.functions.urls import canonical, repo_id

IDENTITY = ("source_type", "source_name", "source_item_id")


def seed_upsert(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Seeds after an ingest: a seed is ``ingested`` anew if it is new, or its identity or its set of URLs changed.

    Both tables: _id, source_type, source_name, source_item_id, candidate_repo_urls; ``current`` also status, first_seen_at,
    last_seen_at, last_ingested_at. Seeds that the ingest doesn't name stay as they are.
    """
    old = current.select(F.col("_id").alias("_k"), *[F.col(c).alias(f"old_{c}") for c in current.columns if c != "_id"])
    both = incoming.join(old, F.col("_id") == F.col("_k"), "left")
    changed = F.col("_k").isNull() | (sorted_distinct(F.col("candidate_repo_urls")) != sorted_distinct(F.col("old_candidate_repo_urls")))
    for c in IDENTITY:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"old_{c}"))
    status = F.when(clean(F.col("old_status")) != "", clean(F.col("old_status"))).otherwise("ingested")
    named = both.select(
        "_id", *IDENTITY, "candidate_repo_urls", F.when(changed, "ingested").otherwise(status).alias("status"),
        F.coalesce("old_first_seen_at", now).alias("first_seen_at"), now.alias("last_seen_at"), F.when(changed, now).otherwise(F.col("old_last_ingested_at")).alias("last_ingested_at"),
    )
    rest = current.join(incoming.select("_id"), "_id", "left_anti").select(named.columns)
    return named.unionByName(rest)


def normalize(seeds: DataFrame, registry: DataFrame) -> DataFrame:
    """Seeds with the first canonical reference among their URLs and a status: invalid, already_registered or normalized."""
    found = F.filter(F.transform("candidate_repo_urls", lambda u: canonical(u)), lambda x: x.isNotNull())
    named = seeds.withColumn("repo", F.get(found, F.lit(0))).withColumn("repo_id", F.when(F.col("repo").isNotNull(), repo_id(F.col("repo.owner"), F.col("repo.repo"))))
    known = registry.select(F.col("repo_id").alias("_known")).distinct()
    out = named.join(known, F.col("repo_id") == F.col("_known"), "left")
    status = F.when(F.col("repo_id").isNull(), "invalid").when(F.col("_known").isNotNull(), "already_registered").otherwise("normalized")
    return out.withColumn("status", status).drop("_known")


def group_by_repo(seeds: DataFrame, shard: int = 0, shards: int = 1) -> DataFrame:
    """One row per repository of normalised seeds: members, sorted distinct source types, first seed."""
    mine = seeds.where(F.col("repo_id").isNotNull() & (shard_of(F.col("repo_id"), shards) == shard))
    return mine.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("discovery_source_count"), F.array_sort(F.collect_set(F.when(clean(F.col("source_type")) != "", clean(F.col("source_type"))))).alias("source_types"),
        F.min("_id").alias("first_seed"),
    )


def qualify(groups: DataFrame, registry: DataFrame, metadata: DataFrame) -> DataFrame:
    """Groups with an outcome: already_registered, rejected (why) or registered, and a score.

    ``metadata``: repo_id, private, archived, license, fork, default_branch, stars, updated_at, size_kb.
    """
    known = registry.select("repo_id").distinct().withColumn("known", F.lit(True))
    all_ = groups.join(known, "repo_id", "left").join(metadata.withColumn("found", F.lit(True)), "repo_id", "left")
    q = qualification(F.col("found").isNull(), F.col("private"), F.col("archived"), F.col("license"), F.col("fork"), F.col("default_branch"), F.col("stars"), F.col("updated_at"))
    out = all_.withColumn("q", q)
    outcome = F.when(F.col("known"), "already_registered").when(F.col("q.qualified"), "registered").otherwise("rejected")
    return out.select("repo_id", "discovery_source_count", "source_types", outcome.alias("outcome"), F.col("q.reason").alias("reason"), F.col("q.score").alias("score"), size_kb(F.col("size_kb")).alias("repo_size_kb"), size_tier(F.col("size_kb")).alias("repo_size_tier"))


def spread_outcome(seeds: DataFrame, outcomes: DataFrame) -> DataFrame:
    """A group's outcome for each of its seeds."""
    return seeds.join(outcomes.select("repo_id", F.col("outcome").alias("_o"), "reason"), "repo_id", "left").withColumn("status", F.coalesce("_o", "status")).drop("_o")


def best_manifests(paths: DataFrame, most: int = 30) -> DataFrame:
    """Per repository the manifests nearest to the root, ``most`` at most (rank from 1)."""
    m = paths.where(is_manifest(F.col("path"))).select("repo_id", manifest_score(F.col("path")).alias("s")).distinct()
    ranked = m.withColumn("rank", F.row_number().over(W.partitionBy("repo_id").orderBy("s.score", "s.length", "s.path")))
    return ranked.where(F.col("rank") <= most).select("repo_id", F.col("s.path").alias("path"), "rank")


def expand(links: DataFrame, most_children: int = 50) -> DataFrame:
    """Child seeds of repositories' contents: ordered distinct, without the repository itself, README before manifests.

    ``links``: repo_id, repo_url, origin (readme or manifest), place, url. Children keep their first place.
    """
    child = canonical(F.col("url"))
    c = links.withColumn("child", child).where("child IS NOT NULL AND child.url <> repo_url")
    c = c.withColumn("kind", F.when(F.col("origin") == "readme", 0).otherwise(1)).groupBy("repo_id", "child.url").agg(F.min(F.struct("kind", "place")).alias("at"))
    ranked = c.withColumn("rank", F.row_number().over(W.partitionBy("repo_id").orderBy("at.kind", "at.place", "url")))
    return ranked.where(F.col("rank") <= most_children).select("repo_id", "url", "rank")


def targets(registry: DataFrame, rule: str, version: str, most: int) -> DataFrame:
    """Repositories that a rule hasn't expanded at this version, most discovered first."""
    at = lambda name: F.col("rules")[F.lit(f"{rule}_{name}")]
    todo = registry.where(~(F.coalesce(at("status"), F.lit("")) == "done") | (F.coalesce(at("version"), F.lit("")) != version))
    return todo.orderBy(F.desc("discovery_source_count"), "owner", "repo_name").limit(most)


def cursor_upsert(current: DataFrame, attempts: DataFrame, now: Column) -> DataFrame:
    """Cursors after attempts: success-only fields move on success alone.

    ``attempts``: _id, emitted, status, error, max_pushed, max_updated. ``current``: _id, last_emitted, last_status, last_error, last_attempt_at, last_success_at, last_max_pushed_at, last_max_updated_at.
    """
    ok = F.col("status") == "success"
    both = current.join(attempts, "_id", "full")
    tried = F.col("status").isNotNull()
    move = lambda when, new, old: F.when(when, new).otherwise(F.col(old)).alias(old)
    return both.select(
        "_id", move(tried, F.col("emitted"), "last_emitted"), move(tried, F.col("status"), "last_status"), move(tried, F.col("error"), "last_error"), move(tried, now, "last_attempt_at"),
        move(ok, now, "last_success_at"), move(ok, F.col("max_pushed"), "last_max_pushed_at"), move(ok, F.col("max_updated"), "last_max_updated_at"),
    )


def fetch_summary(results: DataFrame) -> DataFrame:
    """Share of fetches that worked and a verdict: failed if none did, degraded below nine tenths."""
    out = results.groupBy("batch").agg(F.count(F.lit(1)).alias("fetches"), F.count_if("ok").alias("worked"))
    share = F.col("worked") / F.col("fetches")
    return out.withColumn("verdict", F.when(F.col("worked") == 0, "failed").when(share < 0.9, "degraded").otherwise("ok"))
