"""Pipeline stages as tables: pending work, leases, retries, shards, validation, gauges."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from graniteloom.functions.classify import is_newer, is_stale, is_whale, size_kb, size_tier_rank
from graniteloom.functions.text import clean, shard_of

LEASE_SECONDS = 1800
PAUSE_DOWNLOADED, PAUSE_EXTRACTED = 2000, 5000
VALID = ("valid", "fallback_conservative", "fallback_normalized")
#: Root types of chunks that are too small to be one. Fixed values.
TRIVIAL_ROOTS = ("formal_parameters", "function_call_expression", "function_declarator", "member_call_expression", "method_parameters", "parameter_list", "struct_type")
RETRY_FIELDS = ("processing_retry_state", "processing_retry_stage", "processing_retry_reason", "processing_retry_marked_at", "processing_retry_started_at", "processing_retry_last_at", "processing_retry_attempt_count")
LOCAL_FIELDS = ("snapshot_local_root", "snapshot_download_path", "snapshot_extract_dir")
FINAL_CLEANUP = ("pruned", "skipped", "missing_confirmed")


def pending_chunking(registry: DataFrame, now: Column) -> DataFrame:
    """Extracted and not chunked, or cleanup to retry, or a chunk lease that ran out; each once."""
    retry = F.col("chunk_status").isin("chunked", "chunk_failed") & ~F.coalesce(F.col("cleanup_status").isin(list(FINAL_CLEANUP)), F.lit(False))
    fresh = (F.col("file_extract_status") == "extracted") & F.col("chunk_status").isNull()
    expired = (F.col("chunk_status") == "chunking") & is_stale(F.col("chunk_started_at"), now, LEASE_SECONDS)
    managed = F.coalesce(F.col("processing_retry_state").isin("retry_pending", "retrying"), F.lit(False))
    return registry.where((F.coalesce(fresh, F.lit(False)) | F.coalesce(retry, F.lit(False)) | F.coalesce(expired, F.lit(False))) & ~managed)


def pending_validation(registry: DataFrame, now: Column) -> DataFrame:
    """Chunked or failed chunks, or a validation lease that ran out; not what was validated after it was chunked."""
    done = F.col("chunk_status").isin("chunked", "chunk_failed")
    expired = (F.col("validation_status") == "validating") & is_stale(F.col("validation_started_at"), now, LEASE_SECONDS)
    current = F.col("validation_status").isin("validated", "validation_failed") & ~is_newer(F.col("chunk_finished_at"), F.col("validation_finished_at"))
    leased = (F.col("validation_status") == "validating") & ~expired
    return registry.where((F.coalesce(done, F.lit(False)) | F.coalesce(expired, F.lit(False))) & ~F.coalesce(current, F.lit(False)) & ~F.coalesce(leased, F.lit(False)))


def pending_extraction(registry: DataFrame) -> DataFrame:
    """Downloaded and not extracted."""
    return registry.where((F.col("crawl_status") == "downloaded") & F.coalesce(~F.col("file_extract_status").isin("extracted", "extracting"), F.lit(True)))


def crawl_order(registry: DataFrame, limit: int | None = None) -> DataFrame:
    """Scheduled repositories by tier, size, id: small ones first."""
    out = registry.where("crawl_status = 'scheduled'").orderBy(size_tier_rank(F.col("repo_size_tier")), size_kb(F.col("repo_size_kb")), "repo_id")
    return out if limit is None else out.limit(limit)


def crawl_phases(registry: DataFrame) -> DataFrame:
    """Place in the crawl: normal ones by size up, then large ones by tier and size down."""
    rank = size_tier_rank(F.col("repo_size_tier"))
    phase = F.when(rank == 0, "normal").otherwise("whale")
    size = size_kb(F.col("repo_size_kb"))
    order = [F.when(rank == 0, size).otherwise(-rank * F.lit(1 << 50) - size), F.asc("repo_id")]
    return registry.withColumn("phase", phase).withColumn("place", F.row_number().over(W.partitionBy("phase").orderBy(*order)))


def claim(repos: DataFrame, stage: str, now: Column) -> DataFrame:
    """A lease: status, start, one more attempt."""
    status = {"chunk": "chunking", "file_extract": "extracting", "validation": "validating", "crawl": "downloading"}[stage]
    attempts = f"{stage}_attempt_count"
    have = F.coalesce(F.col(attempts), F.lit(0)) if attempts in repos.columns else F.lit(0)
    return repos.withColumns({f"{stage}_status": F.lit(status), f"{stage}_started_at": now, attempts: (have + 1).cast("int")})


def mark_retry(repos: DataFrame, stage: str, reason: Column, now: Column) -> DataFrame:
    count = F.coalesce(F.col("processing_retry_attempt_count"), F.lit(0)) if "processing_retry_attempt_count" in repos.columns else F.lit(0)
    fields = {"processing_retry_state": F.lit("retry_pending"), "processing_retry_stage": F.lit(stage), "processing_retry_reason": reason, "processing_retry_marked_at": now, "processing_retry_last_at": now, "processing_retry_started_at": F.lit(None).cast("timestamp"), "processing_retry_attempt_count": count.cast("int")}
    return strip_local(repos).withColumns(fields)


def start_retry(repos: DataFrame, now: Column) -> DataFrame:
    return repos.withColumns({"processing_retry_state": F.lit("retrying"), "processing_retry_started_at": now, "processing_retry_last_at": now, "processing_retry_attempt_count": (F.coalesce("processing_retry_attempt_count", F.lit(0)) + 1).cast("int")})


def clear_retry(repos: DataFrame) -> DataFrame:
    return strip_local(repos).drop(*RETRY_FIELDS)


def strip_local(repos: DataFrame) -> DataFrame:
    return repos.drop(*LOCAL_FIELDS)


def reset_downstream(repos: DataFrame, prefixes: tuple[str, ...] = ("file_extract_", "chunk_", "validation_")) -> DataFrame:
    """Without the columns of later stages."""
    return repos.drop(*[c for c in repos.columns if c.startswith(prefixes)])


def retry_candidates(registry: DataFrame, now: Column) -> DataFrame:
    """What should be marked for a retry, with stage and reason: failed or expired, each repository once, earliest stage first."""
    rules = (
        ("crawl", "crawl_failed", F.col("crawl_status") == "crawl_failed"),
        ("crawl", "stale_crawl", (F.col("crawl_status") == "downloading") & is_stale(F.col("crawl_started_at"), now, LEASE_SECONDS)),
        ("extract", "extract_failed", F.col("file_extract_status") == "extract_failed"),
        ("extract", "stale_extract", (F.col("file_extract_status") == "extracting") & is_stale(F.col("file_extract_started_at"), now, LEASE_SECONDS)),
        ("chunk", "chunk_failed", F.col("chunk_status") == "chunk_failed"),
    )
    out = None
    for stage, reason, when in rules:
        row = F.struct(F.lit(stage).alias("stage"), F.lit(reason).alias("reason"))
        out = F.when(F.coalesce(when, F.lit(False)), row) if out is None else out.when(F.coalesce(when, F.lit(False)), row)
    managed = F.coalesce(F.col("processing_retry_state").isin("retry_pending", "retrying"), F.lit(False))
    return registry.where(~managed).withColumn("r", out).where("r IS NOT NULL").select("repo_id", "r.stage", "r.reason")


def backlog(registry: DataFrame, downloaded: int = PAUSE_DOWNLOADED, extracted: int = PAUSE_EXTRACTED) -> DataFrame:
    """Gauges of what waits for extraction and chunking, and whether crawling should pause."""
    waits = registry.agg(
        F.count_if((F.col("crawl_status") == "downloaded") & F.coalesce(F.col("file_extract_status") != "extracted", F.lit(True))).alias("downloaded_pending"),
        F.count_if((F.col("file_extract_status") == "extracted") & F.col("chunk_status").isNull()).alias("extracted_pending"),
    )
    return waits.withColumn("pause", (F.col("downloaded_pending") >= downloaded) | (F.col("extracted_pending") >= extracted))


def tier_counts(registry: DataFrame) -> DataFrame:
    return registry.agg(*[F.count_if(F.col("repo_size_tier") == t).alias(t) for t in ("normal", "whale_hint", "giant_hint")])


def plan_shards(entries: DataFrame, shards: int) -> DataFrame:
    """Greedy longest-first packing: each entry, heaviest first, to the shard with least weight, then fewest entries, then lowest number.

    ``entries``: repo_id, weight, phase. Packing one phase is a sequential fold over one row per repository (a few numbers each).
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "repo_id"], ascending=[False, True], kind="stable")
        heap = [(0, 0, i) for i in range(shards)]
        out = []
        for w in pdf["weight"]:
            weight, n, i = heapq.heappop(heap)
            out.append(i)
            heapq.heappush(heap, (weight + max(0, int(w)), n + 1, i))
        return pdf.assign(shard=out)[["repo_id", "weight", "phase", "shard"]]

    return entries.select("repo_id", F.col("weight").cast("bigint").alias("weight"), "phase").groupBy("phase").applyInPandas(pack, "repo_id string, weight bigint, phase string, shard int")


def chunk_plan(entries: DataFrame, shards: int, whale_shards: int) -> DataFrame:
    """Shards of light and of whale repositories, packed each by itself, with how each is to be run."""
    phased = entries.withColumn("phase", F.when(is_whale(F.col("code_bytes"), F.col("code_files")), "whale").otherwise("light")).withColumn("weight", size_kb(F.col("code_bytes")))
    light = plan_shards(phased.where("phase = 'light'"), shards)
    whale = plan_shards(phased.where("phase = 'whale'"), whale_shards)
    return light.unionByName(whale).withColumn("mode", F.when(F.col("phase") == "whale", "file_parallel_whale").otherwise("repo_sequential"))


def in_shard(ids: DataFrame, column: str, shard: int, shards: int, limit: int | None = None) -> DataFrame:
    """Distinct ids of a shard in order, ``limit`` at most."""
    out = ids.select(clean(F.col(column)).alias(column)).where((F.col(column) != "") & (shard_of(F.col(column), shards) == shard)).distinct().orderBy(column)
    return out if limit is None else out.limit(limit)


def validate(repos: DataFrame, files: DataFrame, chunks: DataFrame) -> DataFrame:
    """Status, failed rules and warnings per repository: one aggregation of files and one of chunks instead of a count per rule."""
    f = files.groupBy("repo_id").agg(F.count(F.lit(1)).alias("files"), F.count_if("is_code_file").alias("code_files"))
    no = lambda *cs: F.count_if(F.array_contains(F.array(*[F.col(c).isNull() for c in cs]), True))
    trivial = F.coalesce(F.col("structure_signature") == "function|params", F.lit(False)) | F.coalesce(F.col("ast_root_node_type").isin(list(TRIVIAL_ROOTS)), F.lit(False))
    c = chunks.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("validation_status").isin(list(VALID))).alias("valid"), F.count_if(F.col("chunk_type") == "function").alias("functions"), F.count_if(F.col("chunk_type") == "class").alias("classes"),
        no("symbol_name").alias("no_symbol"), no("structure_signature").alias("no_signature"), no("ast_node_sequence").alias("no_sequence"), no("raw_hash", "normalized_hash", "anonymized_hash").alias("no_hash"), F.count_if(trivial).alias("trivial"),
    )
    all_ = repos.join(f, "repo_id", "left").join(c, "repo_id", "left").fillna(0, ["files", "code_files", "chunks", "valid", "functions", "classes", "no_symbol", "no_signature", "no_sequence", "no_hash", "trivial"])
    chunked = F.coalesce(F.col("chunk_status") == "chunked", F.lit(False))
    failed = [
        ("file_extract_not_extracted", F.coalesce(F.col("file_extract_status") != "extracted", F.lit(True))), ("chunk_not_chunked", ~chunked), ("no_extracted_file_docs", F.col("files") == 0), ("no_extracted_code_file_docs", F.col("code_files") == 0),
        ("no_chunk_docs", F.col("chunks") == 0), ("chunk_docs_not_all_valid", chunked & (F.col("valid") != F.col("chunks"))), ("chunk_docs_missing_symbol_name", chunked & (F.col("no_symbol") > 0)),
        ("chunk_docs_missing_structure_signature", chunked & (F.col("no_signature") > 0)), ("chunk_docs_missing_ast_sequence", chunked & (F.col("no_sequence") > 0)), ("chunk_docs_missing_hash", chunked & (F.col("no_hash") > 0)), ("trivial_chunk_docs_present", chunked & (F.col("trivial") > 0)),
    ]
    warned = [
        ("text_file_count_mismatch", (F.col("expected_files") > 0) & (F.col("files") != F.col("expected_files"))), ("code_file_count_mismatch", (F.col("expected_code_files") > 0) & (F.col("code_files") != F.col("expected_code_files"))),
        ("chunk_count_mismatch", (F.col("expected_chunks") > 0) & (F.col("chunks") != F.col("expected_chunks"))), ("function_chunk_count_mismatch", (F.col("expected_functions") >= 0) & (F.col("functions") != F.col("expected_functions"))),
        ("class_chunk_count_mismatch", (F.col("expected_classes") >= 0) & (F.col("classes") != F.col("expected_classes"))), ("unexpected_repo_chunk_strategy", (clean(F.col("chunk_strategy")) != "") & (F.col("chunk_strategy") != "tree_sitter_symbol_only")),
    ]
    told = lambda rules: F.array_compact(F.array(*[F.when(F.coalesce(w, F.lit(False)), F.lit(n)) for n, w in rules]))
    out = all_.withColumns({"failed_rules": told(failed), "warning_rules": told(warned)})
    return out.withColumn("status", F.when(F.size("failed_rules") == 0, "validated").otherwise("validation_failed"))


def missing_embeddings(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Valid chunks without a vector."""
    return chunks.where(F.col("validation_status").isin(list(VALID))).join(embeddings.select("chunk_id"), "chunk_id", "left_anti")


def pending_embeddings(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Per language: eligible chunks and those still without a vector."""
    have = embeddings.select("chunk_id").distinct().withColumn("have", F.lit(True))
    j = chunks.where(F.col("validation_status").isin(list(VALID))).join(have, "chunk_id", "left")
    return j.groupBy("language").agg(F.count(F.lit(1)).alias("eligible"), F.count_if(F.col("have").isNull()).alias("pending"))


def requested(chunk_ids: DataFrame, chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Requested ids with what becomes of them: missing, ineligible, done or to_process."""
    ids = chunk_ids.select(clean(F.col("chunk_id")).alias("chunk_id")).where("chunk_id <> ''").distinct()
    j = ids.join(chunks.select("chunk_id", "validation_status", F.lit(True).alias("found")), "chunk_id", "left").join(embeddings.select("chunk_id", F.lit(True).alias("have")).distinct(), "chunk_id", "left")
    state = F.when(F.col("found").isNull(), "missing").when(~F.coalesce(F.col("validation_status").isin(list(VALID)), F.lit(False)), "ineligible").when(F.col("have"), "done").otherwise("to_process")
    return j.select("chunk_id", state.alias("state"))


def text_groups(chunks: DataFrame, text: str = "anonymized_code") -> DataFrame:
    """Distinct (language, text hash) with one chunk to embed; others take its vector by the same key."""
    return chunks.groupBy("language", F.sha1(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_hash")).agg(F.count(F.lit(1)).alias("chunks"), F.min("chunk_id").alias("chunk_id"))


def execution_mode(code_bytes: Column, files: Column, safe: bool = False) -> Column:
    """How a repository is chunked: large ones by file in parallel, unless in safe mode."""
    return F.lit("repo_sequential") if safe else F.when(is_whale(code_bytes, files), "file_parallel_whale").otherwise("repo_sequential")
