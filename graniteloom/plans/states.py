"""Registered queries of collections, stage states and field rules, each with the SQL that it is held against.

Every query reads its whole tables; a limit stands only where it is the operator's feature (a queue's first rows).
"""

from __future__ import annotations

import atexit
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from graniteloom.functions import classify, registries, text as T, urls
from graniteloom.operators import search, seeds, stages
from graniteloom.operators.store import Collection
from graniteloom.plans.catalog import NOW, _STATE_SQL, _repo_state, chunks, now
from graniteloom.plans.registry import register
from graniteloom.session import shared_folder, table


def _collection(spark: SparkSession, sf: str) -> Collection:
    """The documents as a collection in the shared folder."""
    held = Collection(spark, f"{shared_folder(spark)}/collection-{uuid.uuid4().hex}", "doc_id")
    atexit.register(_drop, held)
    return held.write(table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"))


def _drop(held: Collection) -> None:
    """Scratch goes when the driver ends, unless its JVM is gone by then."""
    if held.spark.sparkContext._jsc is not None:
        fs, p = held._fs("")
        fs.delete(p, True)


@register("collection_scan", "SELECT doc_id, source, n_chars FROM documents WHERE lang <> 'en' AND n_chars IS NOT NULL AND (n_chars < 1500 OR n_chars = 1500 AND doc_id > 40)")
def collection_scan(spark, sf):
    """All pages after a place, in order of two fields."""
    after = (F.col("n_chars") < 1500) | ((F.col("n_chars") == 1500) & (F.col("doc_id") > 40))
    return _collection(spark, sf).scan((F.col("lang") != "en") & F.col("n_chars").isNotNull(), ["doc_id", "source", "n_chars"], [F.desc("n_chars"), F.asc("doc_id")], after)


@register("collection_lookup", "SELECT k.doc_id, d.lang, d.doc_id IS NOT NULL AS known FROM (SELECT DISTINCT doc_id + 100 AS doc_id FROM labels) k LEFT JOIN documents d USING (doc_id)")
def collection_lookup(spark, sf):
    """Many keys at once, missing ones told."""
    held, keys = _collection(spark, sf), table(spark, sf, "labels").select((F.col("doc_id") + 100).alias("doc_id"))
    return held.get_many(keys, ["lang"], keep_missing=True).join(held.existing(keys).withColumn("known", F.lit(True)), "doc_id", "left").select("doc_id", "lang", F.coalesce("known", F.lit(False)).alias("known"))


@register("collection_writes", """WITH l AS (SELECT doc_id + 100 AS doc_id, quality, toxic FROM labels),
r AS (SELECT doc_id, lang, source, n_chars FROM documents ANTI JOIN l USING (doc_id) UNION ALL SELECT doc_id, 'xx', NULL, quality FROM l)
SELECT doc_id, lang, source, n_chars FROM r WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND NOT coalesce(source = 'src6', false)""")
def collection_writes(spark, sf):
    """Rows replaced whole, keys deleted, rows deleted by a field; each step is a version of its own."""
    held, labels = _collection(spark, sf), table(spark, sf, "labels")
    rows = labels.select((F.col("doc_id") + 100).alias("doc_id"), F.lit("xx").alias("lang"), F.lit(None).cast("string").alias("source"), F.col("quality").cast("bigint").alias("n_chars"))
    held.replace(rows).delete(labels.where("toxic = 1").select("doc_id")).delete_where(F.col("source") == "src6")
    held.vacuum()
    return held.read()


@register("clause_counts", """SELECT source, count(text) AS held, count(*) FILTER (lang = 'en' OR lang = 'EN') AS english, count(*) FILTER (lang = 'en' OR n_chars > 900) AS either,
  count(*) FILTER ((lang = 'en')::INT + (n_chars > 900)::INT + (doc_id > 50)::INT >= 2) AS two_of_three, count(*) FILTER (lang = 'de') AS optional, CAST(0 AS BIGINT) AS nothing, count(*) AS everything FROM documents GROUP BY 1""")
def clause_counts(spark, sf):
    """exists, keyword or raw, should with and without a minimum, none and all."""
    d = table(spark, sf, "documents").withColumn("lang.keyword", F.col("lang"))
    en, long_, late = search.term("lang", "en"), F.col("n_chars") > 900, F.col("doc_id") > 50
    wanted = {
        "held": search.exists("text"), "english": search.keyword_or_raw(d, "lang", "en"), "either": search.bool_query(should=[en, long_]), "two_of_three": search.bool_query(should=[en, long_, late], at_least=2),
        "optional": search.bool_query(filter=[search.term("lang", "de")], should=[long_]), "nothing": F.lit(False), "everything": search.bool_query(),
    }
    return d.groupBy("source").agg(*[F.count_if(c).alias(n) for n, c in wanted.items()])


@register("variant_candidates", "SELECT 'github:' || source || '/corpus' AS repo_id, count(*) AS candidates FROM documents WHERE lang = 'en' AND source <> 'src3' AND doc_id <> 7 GROUP BY 1")
def variant_candidates(spark, sf):
    """What the predicate around a variant leaves of every repository, for one stated source chunk."""
    c = chunks(spark, sf)
    return c.where(search.variant_filters(F.lit("en"), F.lit("7"), F.lit("github:src3/corpus"))).groupBy("repo_id").agg(F.count(F.lit(1)).alias("candidates"))


@register("fetch_verdicts", """SELECT l_suppkey AS batch, count(*) AS fetches, count(*) FILTER (l_returnflag <> 'R') AS worked,
  CASE WHEN count(*) FILTER (l_returnflag <> 'R') = 0 THEN 'failed' WHEN count(*) FILTER (l_returnflag <> 'R') < 0.9 * count(*) THEN 'degraded' ELSE 'ok' END AS verdict FROM lineitem GROUP BY 1""")
def fetch_verdicts(spark, sf):
    return seeds.fetch_summary(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("batch"), (F.col("l_returnflag") != "R").alias("ok")))


def _sized(spark, sf) -> DataFrame:
    kb = F.round(F.col("p_retailprice") * 100).cast("bigint")
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").cast("string").alias("repo_id"), kb.alias("repo_size_kb"), classify.size_tier(kb).alias("repo_size_tier"), F.when(F.col("p_size") < 25, "scheduled").otherwise("downloaded").alias("crawl_status"))


_SIZED_SQL = """p AS (SELECT CAST(p_partkey AS VARCHAR) AS repo_id, CAST(round(p_retailprice * 100) AS BIGINT) AS kb, CASE WHEN round(p_retailprice * 100) >= 200000 THEN 2 WHEN round(p_retailprice * 100) >= 50000 THEN 1 ELSE 0 END AS tier, p_size < 25 AS scheduled FROM part)"""


@register("crawl_phases", f"WITH {_SIZED_SQL} SELECT repo_id, CASE tier WHEN 0 THEN 'normal' ELSE 'whale' END AS phase, CAST(row_number() OVER (PARTITION BY tier = 0 ORDER BY CASE tier WHEN 0 THEN 0 ELSE -tier END, CASE tier WHEN 0 THEN kb ELSE -kb END, repo_id) AS INTEGER) AS place FROM p")
def crawl_phases(spark, sf):
    return stages.crawl_phases(_sized(spark, sf)).select("repo_id", "phase", F.col("place").cast("int").alias("place"))


@register("crawl_queue", f"WITH {_SIZED_SQL} SELECT repo_id, kb AS repo_size_kb FROM p WHERE scheduled ORDER BY tier, kb, repo_id LIMIT 40")
def crawl_queue(spark, sf):
    """The first forty to crawl; the limit is the queue's."""
    return stages.crawl_order(_sized(spark, sf), 40).select("repo_id", "repo_size_kb")


@register("tier_gauges", f"WITH {_SIZED_SQL} SELECT count(*) FILTER (tier = 0) AS normal, count(*) FILTER (tier = 1) AS whale_hint, count(*) FILTER (tier = 2) AS giant_hint FROM p")
def tier_gauges(spark, sf):
    return stages.tier_counts(_sized(spark, sf))


@register("extraction_queue", f"WITH {_STATE_SQL} SELECT repo_id FROM st WHERE crawl = 'downloaded' AND ex IS NULL")
def extraction_queue(spark, sf):
    return stages.pending_extraction(_repo_state(spark, sf)).select("repo_id")


@register("validation_queue", f"""WITH o AS (SELECT o_orderkey, o_custkey % 4 AS c, o_custkey % 3 AS v, (o_custkey % 5) - 2 AS later, epoch(TIMESTAMP '{NOW}') - epoch(o_orderdate) >= 1800 AS expired FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS repo_id FROM o WHERE (c IN (0, 1) OR (v = 1 AND expired)) AND NOT (v = 0 AND later >= 0) AND NOT (v = 1 AND NOT expired)""")
def validation_queue(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_custkey")
    at = F.col("o_orderdate").cast("timestamp")
    state = o.select(
        F.col("o_orderkey").cast("string").alias("repo_id"), F.when(k % 4 == 0, "chunked").when(k % 4 == 1, "chunk_failed").when(k % 4 == 2, "chunking").alias("chunk_status"), F.when(k % 3 == 0, "validated").when(k % 3 == 1, "validating").alias("validation_status"),
        at.alias("validation_started_at"), at.alias("chunk_finished_at"), F.timestamp_seconds(F.unix_timestamp(at) + ((k % 5) - 2) * 86400).alias("validation_finished_at"),
    )
    return stages.pending_validation(state, now()).select("repo_id")


@register("reset_states", f"WITH {_STATE_SQL} SELECT repo_id, crawl AS crawl_status, CASE WHEN ex = 'extracting' THEN 1 ELSE 0 END AS leased FROM st")
def reset_states(spark, sf):
    """Local fields and those of later stages taken off; what is left, and who held a lease."""
    s = _repo_state(spark, sf)
    leased = F.when(F.coalesce(F.col("file_extract_status"), F.lit("")) == "extracting", 1).otherwise(0)
    return stages.reset_downstream(stages.strip_local(s.withColumn("leased", leased))).select("repo_id", "crawl_status", "leased")


@register("shard_members", "SELECT DISTINCT c_name FROM customer WHERE CAST('0x' || substr(sha1(c_name), 1, 8) AS BIGINT) % 8 = 3")
def shard_members(spark, sf):
    return stages.in_shard(table(spark, sf, "customer"), "c_name", 3, 8)


@register("seed_outcomes", """WITH m AS (SELECT 'github:o/' || p_partkey AS repo_id, p_size % 7 = 0 AS private, p_size % 5 = 0 AS archived, p_size % 3 = 0 AS free, p_size % 2 = 0 AS fork, CAST(p_retailprice AS BIGINT) AS stars, CAST(round(p_retailprice * 100) AS BIGINT) AS kb FROM part),
g AS (SELECT c.c_custkey, 'github:o/' || c.c_custkey AS repo_id, s.s_suppkey IS NOT NULL AS known FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey),
r AS (SELECT g.*, m.*, CASE WHEN m.repo_id IS NULL THEN 'repo_not_found' WHEN private THEN 'private_repo' WHEN archived THEN 'archived_repo' ELSE 'qualified' END AS reason FROM g LEFT JOIN m ON m.repo_id = g.repo_id)
SELECT 'github:o/' || c_custkey AS repo_id, CASE WHEN known THEN 'already_registered' WHEN reason = 'qualified' THEN 'registered' ELSE 'rejected' END AS outcome, reason,
  CAST(CASE WHEN reason = 'qualified' THEN round(CASE WHEN free THEN 0 ELSE 0.35 END + CASE WHEN fork THEN 0 ELSE 0.20 END + 0.15 + CASE WHEN stars >= 1000 THEN 0.20 WHEN stars >= 100 THEN 0.10 WHEN stars >= 10 THEN 0.05 ELSE 0 END + 0.10, 4) ELSE 0 END AS DOUBLE) AS score,
  coalesce(kb, 0) AS repo_size_kb FROM r""")  # fmt: skip
def seed_outcomes(spark, sf):
    """Groups of seeds qualified against the registry and what is told of each repository."""
    name = lambda c: F.concat(F.lit("github:o/"), c)
    groups = table(spark, sf, "customer").select(name("c_custkey").alias("repo_id"), F.lit(1).cast("bigint").alias("discovery_source_count"), F.array(F.lit("t")).alias("source_types"))
    n = F.col("p_size")
    told = table(spark, sf, "part").select(
        name("p_partkey").alias("repo_id"), (n % 7 == 0).alias("private"), (n % 5 == 0).alias("archived"), F.when(n % 3 != 0, "MIT").alias("license"), (n % 2 == 0).alias("fork"), F.lit("main").alias("default_branch"),
        F.round(F.col("p_retailprice")).cast("bigint").alias("stars"), F.col("p_brand").alias("updated_at"), F.round(F.col("p_retailprice") * 100).cast("bigint").alias("size_kb"),
    )
    return seeds.qualify(groups, table(spark, sf, "supplier").select(name("s_suppkey").alias("repo_id")), told).select("repo_id", "outcome", "reason", "score", "repo_size_kb")


@register("expansion_targets", "SELECT c_name AS repo_name, c_nationkey AS discovery_source_count FROM customer WHERE NOT (c_nationkey % 3 = 0 AND c_nationkey % 2 = 0) ORDER BY c_nationkey DESC, c_mktsegment, c_name LIMIT 50")
def expansion_targets(spark, sf):
    """The fifty most discovered that a rule hasn't done at this version; the limit is the queue's."""
    k = F.col("c_nationkey")
    rules = F.create_map(F.lit("r_status"), F.when(k % 3 == 0, "done").otherwise("failed"), F.lit("r_version"), F.when(k % 2 == 0, "v2").otherwise("v1"))
    registry = table(spark, sf, "customer").select(F.col("c_name").alias("repo_name"), F.col("c_mktsegment").alias("owner"), k.alias("discovery_source_count"), rules.alias("rules"))
    return seeds.targets(registry, "r", "v2", 50).select("repo_name", "discovery_source_count")


@register("generated_markers", """WITH d AS (SELECT doc_id, repeat('x' || chr(10), CAST(doc_id % 8 AS INTEGER)) || CASE doc_id % 3 WHEN 0 THEN '// Code Generated BY tool' WHEN 1 THEN '# DO NOT EDIT' ELSE 'plain' END || chr(10) || coalesce(text, '') AS code FROM documents)
SELECT doc_id, regexp_matches(lower(array_to_string(list_slice(string_split(code, chr(10)), 1, 5), chr(10))), 'auto-generated|autogenerated|generated by|generated file|do not edit') AS generated FROM d""")
def generated_markers(spark, sf):
    i = F.col("doc_id")
    head = F.expr("repeat('x\\n', CAST(doc_id % 8 AS INT))")
    code = F.concat(head, F.when(i % 3 == 0, "// Code Generated BY tool").when(i % 3 == 1, "# DO NOT EDIT").otherwise("plain"), F.lit("\n"), F.coalesce("text", F.lit("")))
    return table(spark, sf, "documents").select("doc_id", classify.is_generated(code).alias("generated"))


@register("chunk_rules", """SELECT p_partkey, p_size >= 10 AND p_type <> 'ECONOMY' AS is_source, CAST(p_retailprice * 20000 AS BIGINT) >= 26214400 OR p_size * 12 >= 500 AS is_whale, CASE WHEN p_type = 'ECONOMY' THEN 'whale' ELSE 'light' END AS phase,
  CASE WHEN p_size - 1 >= 1 THEN CAST(p_size AS INTEGER) ELSE CASE WHEN p_size = 1 THEN 1 ELSE 0 END END AS span FROM part""")
def chunk_rules(spark, sf):
    """Which chunks can be asked about, which repositories are large, and the phase a text names."""
    kind = F.when(F.col("p_type") == "ECONOMY", " Whale ").otherwise("Function")
    n = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", classify.is_source_chunk(kind, F.lit(1), n).alias("is_source"), classify.is_whale(F.col("p_retailprice") * 20000, n * 12).alias("is_whale"), classify.chunk_phase(kind).alias("phase"), classify.line_span(F.lit(1), n).alias("span"),
    )


@register("time_rules", f"""SELECT o_orderkey, CASE WHEN o_custkey % 4 = 3 THEN NULL ELSE CAST(epoch(o_orderdate) AS BIGINT) - CASE o_custkey % 4 WHEN 2 THEN 7200 ELSE 0 END END AS seconds,
  CASE WHEN o_custkey % 4 = 3 THEN false ELSE epoch(o_orderdate) - CASE o_custkey % 4 WHEN 2 THEN 7200 ELSE 0 END > epoch(TIMESTAMP '1995-06-01') END AS newer,
  CASE WHEN o_custkey % 4 = 3 THEN false ELSE epoch(TIMESTAMP '{NOW}') - epoch(o_orderdate) + CASE o_custkey % 4 WHEN 2 THEN 7200 ELSE 0 END < 60 * 525600 END AS skipped,
  CASE WHEN o_custkey % 2 = 0 THEN 'topic:x Pushed:>2020' ELSE 'topic:x pushed:>=' || strftime(o_orderdate - INTERVAL 2 DAY, '%Y-%m-%d') END AS query FROM orders""")
def time_rules(spark, sf):
    """ISO texts read with and without a zone, compared, and put into a query that has no date yet."""
    o, k = table(spark, sf, "orders"), F.col("o_custkey") % 4
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    at = classify.utc(F.when(k == 0, day).when(k == 1, F.concat(day, F.lit("Z"))).when(k == 2, F.concat(day, F.lit("+02:00"))).otherwise("no time"))
    since = classify.incremental_since(F.lit(None).cast("timestamp"), F.col("o_orderdate"), now(), 2)
    query = classify.with_since(F.when(F.col("o_custkey") % 2 == 0, "topic:x Pushed:>2020").otherwise("topic:x"), since)
    return o.select("o_orderkey", F.unix_timestamp(at).alias("seconds"), classify.is_newer(at, F.to_timestamp(F.lit("1995-06-01"))).alias("newer"), classify.skip_by_interval(at, now(), 525600).alias("skipped"), query.alias("query"))


@register("snapshot_names", """WITH c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'refs/heads/dev' || c_nationkey WHEN 1 THEN 'master' ELSE '' END AS branch, c_name, c_mktsegment FROM customer)
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN substr(branch, 12) || ' main master' WHEN 1 THEN 'master main' ELSE 'main master' END AS refs, regexp_replace(regexp_replace('/' || c_name || ' ' || c_mktsegment || '/', '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS fragment,
  substr(sha1(c_mktsegment || '|stars|desc'), 1, 12) AS request, 'https://codeload.github.com/' || c_mktsegment || '/r/tar.gz/' || c_custkey AS archive FROM c""")
def snapshot_names(spark, sf):
    k = F.col("c_custkey")
    branch = F.when(k % 3 == 0, F.concat(F.lit(" refs/heads/dev"), "c_nationkey")).when(k % 3 == 1, "master").otherwise("")
    fragment = T.safe_path_fragment(F.concat(F.lit("/"), "c_name", F.lit(" "), "c_mktsegment", F.lit("/")))
    request = urls.request_key(F.col("c_mktsegment"), F.lit("stars "), F.lit("desc"))
    return table(spark, sf, "customer").select("c_custkey", F.array_join(urls.ref_candidates(branch), " ").alias("refs"), fragment.alias("fragment"), request.alias("request"), urls.archive_url(F.col("c_mktsegment"), F.lit("r"), k.cast("string")).alias("archive"))


@register("page_link_lists", r"""WITH l AS (SELECT page_id, [x FOR x IN [trim(y) FOR y IN regexp_extract_all(coalesce(html, ''), 'href\s*=\s*["'']([^"''#]+)["'']', 1, 'i')] IF x <> ''] AS u FROM pages)
SELECT page_id, array_to_string(list_sort(list_distinct(u)), ' ') AS urls, CAST(len(list_distinct(u)) AS INTEGER) AS n FROM l""")
def page_link_lists(spark, sf):
    found = table(spark, sf, "pages").select("page_id", T.sorted_distinct(urls.links(F.col("html"))).alias("u"))
    return found.select("page_id", F.array_join("u", " ").alias("urls"), F.size("u").alias("n"))


def _payloads() -> dict[str, str]:
    """A payload per registry that is read by paths: a text at every path, some blank, some repeated; @ stands for a row's id."""
    found = {}
    for name, paths in registries.PATHS.items():
        root: dict = {}
        for i, path in enumerate(paths):
            *parents, leaf = path.strip("{}").removeprefix("$.").split(".")
            at = root
            for p in parents:
                at = at.setdefault(p, {})
            value = "  " if i % 4 == 3 else f" https://{name}{i % 2}.example/@ "
            at[leaf] = {"a": value, "b": f"https://{name}.example/b/@"} if path[0] == "{" else value
        found[name] = json.dumps(root)
    return found


def _payload_sql() -> str:
    """Each payload read by DuckDB's JSON functions: trimmed, not empty, each once in the order of the paths."""
    parts = []
    for name, payload in _payloads().items():
        texts = [f"coalesce(json_extract_string(j, '{p.strip('{}')}.*'), [])" if p[0] == "{" else f"[json_extract_string(j, '{p}')]" for p in registries.PATHS[name]]
        trimmed = f"[trim(x) FOR x IN list_concat({', '.join([*texts, '[]'])}) IF trim(x) <> '']"
        parts.append(f"SELECT page_id, '{name}' AS registry, {trimmed} AS u FROM (SELECT page_id, CAST(replace('{payload}', '@', CAST(page_id AS VARCHAR)) AS JSON) AS j FROM pages)")
    return f"WITH f AS ({' UNION ALL '.join(parts)}) SELECT page_id, registry, array_to_string([x FOR x, i IN u IF list_position(u, x) = i], ' ') AS urls FROM f"


@register("registry_fields", _payload_sql())
def registry_fields(spark, sf):
    """References in the payloads of every registry whose fields are read by path."""
    pages = table(spark, sf, "pages").select("page_id")
    read = [F.struct(F.lit(n).alias("registry"), F.array_join(registries.candidate_urls(n, F.replace(F.lit(p), F.lit("@"), F.col("page_id").cast("string"))), " ").alias("urls")) for n, p in _payloads().items()]
    return pages.select("page_id", F.explode(F.array(*read)).alias("r")).select("page_id", "r.registry", "r.urls")
