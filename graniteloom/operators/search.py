"""Query clauses over a collection: filters, scored terms, BM25 matches, phrases, structure, vectors.

A collection is a DataFrame. Filters are plain predicates that reach the scan. Scored clauses work set-at-a-time: a table of
queries against a table of documents joined on terms, never a loop over queries. Scores of one clause compare with each other,
not with those of a search server (whose statistics are per shard and whose norms are rounded).
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from graniteloom.functions.text import clean
from graniteloom.operators import matrices
from graniteloom.session import shared_folder

# Its functions travel with the plan, so that searches ask nothing of the executors' path.
cloudpickle.register_pickle_by_value(matrices)

#: Boosts of the structural clause by field. Fixed values.
STRUCTURE_BOOSTS = {
    "chunk_type": 1.0,
    "symbol_type": 1.0,
    "structure_signature": 4.0,
    "control_flow_tags": 1.0,
    "call_tokens": 2.0,
    "identifier_tokens": 1.5,
    "operator_tokens": 0.75,
    "ast_node_sequence": 0.5,
}
#: Boosts of phrases and matches and the share of words a match needs, by field. Fixed values.
TEXT_CLAUSES = {"raw_code": (4.0, 1.5, 60), "normalized_code": (3.5, 1.5, 55), "anonymized_code": (3.5, 1.5, 55)}
VALID_STATUSES = ("valid", "fallback_conservative", "fallback_normalized")


def term(field: str, value) -> Column:
    """Exact equality on a keyword; on an array, membership is ``contains``."""
    return F.col(field) == F.lit(value)


def contains(field: str, value) -> Column:
    return F.array_contains(F.col(field), F.lit(value))


def terms(field: str, values) -> Column:
    return F.col(field).isin(list(values))


def keyword_or_raw(df: DataFrame, field: str, value) -> Column:
    """Equality on a field's keyword form if there is one, or on the field."""
    out = F.col(field) == F.lit(value)
    return (F.col(f"`{field}.keyword`") == F.lit(value)) | out if f"{field}.keyword" in df.columns else out


def exists(field: str) -> Column:
    return F.col(field).isNotNull()


def bool_query(filter: list[Column] = (), must: list[Column] = (), must_not: list[Column] = (), should: list[Column] = (), at_least: int | None = None) -> Column:
    """All of ``filter`` and ``must``, none of ``must_not``, and ``at_least`` of ``should`` (one, if nothing else is asked)."""
    out = F.lit(True)
    for c in (*filter, *must):
        out = out & F.coalesce(c, F.lit(False))
    for c in must_not:
        out = out & ~F.coalesce(c, F.lit(False))
    if should:
        n = at_least if at_least is not None else int(not filter and not must)
        if n:
            out = out & (sum((F.coalesce(c, F.lit(False)).cast("int") for c in should), F.lit(0)) >= n)
    return out


def variant_filters(language: Column | None, source_chunk: Column, source_repo: Column, include_same_repo: bool = False, status: str = "validation_status") -> Column:
    """The predicate around every variant: valid, same language, not the chunk itself, not its repository."""
    out = F.col(status).isin(list(VALID_STATUSES)) & (F.col("chunk_id") != source_chunk)
    if language is not None:
        out = out & (F.col("language") == language)
    return out if include_same_repo else out & (F.col("repo_id") != source_repo)


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


#: Distinct words that are broadcast at most, counted before.
BROADCAST_WORDS = 1_000_000


def postings(docs: DataFrame, id_col: str, text: Column, only: DataFrame | None = None) -> DataFrame:
    """(doc, word, tf, length): one row per document and word, added up before any shuffle of whole texts.

    ``only`` (word) drops other words first, in the task that reads the text if these are few enough to broadcast.
    """
    w = docs.select(F.col(id_col).alias("doc"), words(text).alias("ws"))
    w = w.select("doc", F.size("ws").alias("length"), F.explode("ws").alias("word"))
    if only is not None:
        w = w.join(F.broadcast(only) if only.count() <= BROADCAST_WORDS else only, "word", "left_semi")
    return w.groupBy("doc", "word").agg(F.count(F.lit(1)).alias("tf"), F.first("length").alias("length"))


def bm25(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, query_text: Column, doc_text: Column, k1: float = 1.2, b: float = 0.75, least_percent: int = 0, boost: float = 1.0, k: int | None = None) -> DataFrame:
    """(query, doc, score, matched): BM25 over distinct query words; at least floor(percent * words) must match.

    With ``k`` the k best per query, ``rank`` from 1, by score to six places, then document. Texts are read once, to a table of the asked words that
    each has; where these are few (``BROADCAST_WORDS``, counted) that table meets the queries in the tasks that read it, so that no pair is shuffled
    but what is found. More are joined by word.
    """
    asked = queries.select(F.col(query_id).alias("query"), F.array_distinct(words(query_text)).alias("qs"))
    asked = asked.select("query", F.size("qs").alias("asked"), F.explode("qs").alias("word"))
    few = asked.limit(BROADCAST_WORDS + 1).toArrow()
    if few.num_rows <= BROADCAST_WORDS:
        schema = T.StructType([T.StructField("query", queries.schema[query_id].dataType), T.StructField("doc", docs.schema[doc_id].dataType), T.StructField("score", T.DoubleType()), T.StructField("matched", T.LongType())])
        out = _bm25_few(few, docs, doc_id, doc_text, k1, b, least_percent, boost, k, schema)
    else:
        out = _bm25_join(asked, docs, doc_id, doc_text, k1, b, least_percent, boost)
    return out if k is None else top_k(out, ["query"], [F.desc(F.round("score", 6)), F.asc("doc")], k)


@contextmanager
def _rows(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """So many rows of texts at a time, read and handed to Python; the settings come back after."""
    names = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, str(rows))
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may be gone at exit; the folder is scratch
        pass


def _bm25_few(asked: pa.Table, docs: DataFrame, doc_id: str, doc_text: Column, k1: float, b: float, least_percent: int, boost: float, k: int | None, schema: T.StructType) -> DataFrame:
    spark = docs.sparkSession
    ids, known = (asked[c].combine_chunks().dictionary_encode("encode") for c in ("query", "word"))
    ids, known = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (ids, known))
    query, word, vocabulary = ids.indices.to_numpy(zero_copy_only=False), known.indices.to_numpy(zero_copy_only=False), known.dictionary.to_pylist()
    sizes = np.zeros(len(ids.dictionary))
    sizes[query] = asked["asked"].to_numpy()
    least = np.maximum(1, np.floor(sizes * least_percent / 100))
    path = f"{shared_folder(spark)}/postings-{uuid.uuid4().hex}"
    atexit.register(_drop, spark, path)
    form = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), *T._parse_datatype_string("length int, word array<int>, times array<int>").fields])
    with _rows(spark):
        docs.select(F.col(doc_id).alias("doc"), words(doc_text).alias("ws")).mapInArrow(matrices.counted(vocabulary), form).write.parquet(path)
    post = spark.read.schema(form).parquet(path)
    n, mean = post.agg(F.count(F.lit(1)), F.avg("length")).first()
    again = post.groupBy("doc").count().where("count > 1").select(F.col("doc").alias("again"))
    if not again.isEmpty():  # rows that repeat an id are one document
        same = F.col("doc").eqNullSafe(F.col("again"))
        each = post.join(again, same).select("doc", "length", F.explode(F.arrays_zip("word", "times")).alias("x")).groupBy("doc", F.col("x.word").alias("word")).agg(F.first("length").alias("length"), F.sum("x.times").cast("int").alias("times"))
        each = each.groupBy("doc").agg(F.first("length").alias("length"), F.array_sort(F.collect_list(F.struct("word", "times"))).alias("x"))
        post = post.join(again, same, "left_anti").unionByName(each.select("doc", "length", F.col("x.word").alias("word"), F.col("x.times").alias("times")))
    df = post.select(F.explode("word").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df")).toArrow()  # a row a word
    count = np.zeros(len(vocabulary))
    count[df["word"].to_numpy()] = df["df"].to_numpy()
    idf = np.log1p((n - count + 0.5) / (count + 0.5))
    run = matrices.bm25(query, word, least, ids.dictionary, idf, mean or 1.0, k1, b, boost, k)
    return post.where(F.size("word") > 0).mapInArrow(run, schema)


def _bm25_join(asked: DataFrame, docs: DataFrame, doc_id: str, doc_text: Column, k1: float, b: float, least_percent: int, boost: float) -> DataFrame:
    post = postings(docs, doc_id, doc_text, asked.select("word").distinct())
    stats = docs.select(F.size(words(doc_text)).alias("n")).agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean"))
    df = post.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    hit = asked.join(df, "word").join(post, "word").join(F.broadcast(stats))  # one row of statistics
    idf = F.log1p((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    out = hit.groupBy("query", "doc").agg((F.sum(part) * boost).alias("score"), F.count(F.lit(1)).alias("matched"), F.first("asked").alias("asked"))
    return out.where(F.col("matched") >= F.greatest(F.lit(1), F.floor(F.col("asked") * least_percent / 100))).select("query", "doc", "score", "matched")


def phrase(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, query_text: Column, doc_text: Column, width: int = 4) -> DataFrame:
    """(query, doc) where the query's words stand in a row in the document.

    Candidates share the query's first ``width`` words in a row (an equi-join on a hash); the whole phrase is then checked as a string.
    """
    q = queries.select(F.col(query_id).alias("query"), words(query_text).alias("qs")).where(F.size("qs") > 0)
    q = q.select("query", F.array_join("qs", " ").alias("phrase"), F.least(F.size("qs"), F.lit(width)).alias("w"), F.xxhash64(F.array_join(F.slice("qs", 1, width), " ")).alias("key"))
    d = docs.select(F.col(doc_id).alias("doc"), words(doc_text).alias("ws"))

    def runs(k: int) -> Column:
        starts = F.when(F.size("ws") >= k, F.sequence(F.lit(1), F.size("ws") - k + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.lit(k).alias("w"), F.xxhash64(F.array_join(F.slice("ws", i, F.lit(k)), " ")).alias("key")))

    lengths = sorted(r["w"] for r in q.select("w").distinct().collect())  # at most ``width`` numbers
    if not lengths:
        return q.join(d, F.lit(False)).select("query", "doc")
    shingles = d.select("doc", F.explode(F.concat(*[runs(k) for k in lengths])).alias("s")).select("doc", "s.w", "s.key")
    pairs = q.join(shingles, ["w", "key"]).select("query", "phrase", "doc").distinct()
    text = d.select("doc", F.concat(F.lit(" "), F.array_join("ws", " "), F.lit(" ")).alias("body"))
    return pairs.join(text, "doc").where(F.col("body").contains(F.concat(F.lit(" "), F.col("phrase"), F.lit(" ")))).select("query", "doc")


def _structure(df: DataFrame, boosts: dict[str, float]) -> Column:
    """A row's tokens (field, value), each once, of keyword fields that are texts or lists."""

    def of(f: str) -> Column:
        values = F.col(f) if dict(df.dtypes)[f].startswith("array") else F.array(F.col(f))
        distinct = F.array_distinct(F.filter(F.transform(values, clean), lambda v: v != ""))
        return F.transform(distinct, lambda v: F.struct(F.lit(f).alias("field"), v.alias("value")))

    return F.concat(*[of(f) for f in boosts])


def structural(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, k: int, fields: dict[str, float] | None = None) -> DataFrame:
    """(query, doc, score, rank): the k best other documents by boosted, idf-weighted overlap of keyword fields (texts or lists) that both tables have.

    Documents of the same tokens score alike, so groups of them are paired instead: a group shows its k + 1 smallest ids (one may be the
    query's own), a group of queries the k + 1 best groups by score and smallest id, which hold its k + 1 best documents.
    Rows that repeat an id are one document that has their tokens as often.
    """
    boosts = {f: w for f, w in (fields or STRUCTURE_BOOSTS).items() if f in docs.columns and f in queries.columns}
    has = docs.select(F.col(doc_id).alias("doc"), _structure(docs, boosts).alias("tokens"))
    boost = F.create_map(*[F.lit(x) for f, w in boosts.items() for x in (f, float(w))])
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    df = has.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    weight = F.element_at(boost, F.col("t.field")) * F.log1p((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    df = df.join(F.broadcast(n)).select("t", weight.alias("weight"))  # one row

    def same(df: DataFrame, name: str) -> DataFrame:
        """(id, tokens): one row per id, tokens in order."""
        return df.where(f"{name} IS NOT NULL").groupBy(name).agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens")).where(F.size("tokens") > 0)

    def spread(groups: DataFrame, name: str) -> DataFrame:
        return groups.select(name, F.explode("tokens").alias("t")).groupBy(name, "t").agg(F.count(F.lit(1)).alias(f"{name}_times"))

    first = top_k(same(has, "doc"), ["tokens"], [F.asc("doc")], k + 1, "place")
    firsts = first.where("place = 1").select(F.col("doc").alias("group"), "tokens")
    members = first.join(firsts, "tokens").select("group", "doc")
    asks = same(queries.select(F.col(query_id).alias("query"), _structure(queries, boosts).alias("tokens")), "query")
    asked = asks.groupBy("tokens").agg(F.min("query").alias("asked"))
    pairs = spread(asked, "asked").join(df, "t").join(spread(firsts, "group"), "t")
    pairs = pairs.groupBy("asked", "group").agg(F.sum(F.col("weight") * F.col("asked_times") * F.col("group_times")).alias("score"))
    by_score = F.desc(F.round("score", 6))
    best = top_k(pairs, ["asked"], [by_score, F.asc("group")], k + 1).drop("rank")
    best = top_k(best.join(members, "group"), ["asked"], [by_score, F.asc("doc")], k + 1)
    # k + 1 at most of a group of queries
    best = best.groupBy("asked").agg(F.array_sort(F.collect_list(F.struct("rank", "doc", "score"))).alias("best"))
    found = asks.join(asked, "tokens").select("query", "asked").join(best, "asked")
    others = F.slice(F.filter("best", lambda b: b["doc"] != F.col("query")), 1, k)
    return found.select("query", F.posexplode(others).alias("rank", "b")).select("query", "b.doc", "b.score", (F.col("rank") + 1).alias("rank"))


#: Numbers in the vectors of a block of documents, and of queries, at most.
DOC_NUMBERS, QUERY_NUMBERS = 1 << 22, 1 << 20


def knn(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, query_vector: str, doc_vector: str, k: int, same: tuple[str, ...] = (), apart: tuple[str, ...] = ()) -> DataFrame:
    """(query, doc, score, rank): the exact k nearest by cosine, of documents equal in all columns ``same`` and different in all of ``apart``.

    Blocks of queries meet blocks of documents, both of bounded size, one pair at a time in a task as a matrix product; k rows per query and
    block are shuffled and merged. The pairs are still as many as queries times documents.
    """

    def picked(df: DataFrame, key: str, vector: str) -> DataFrame:
        whole = F.when(F.forall(vector, lambda x: x.isNotNull()), F.col(vector))
        out = df.select(*[F.col(c).alias(f"same{i}") for i, c in enumerate(same)], F.col(key).alias("id"), whole.alias("vec"), *[F.col(c).alias(f"other{i}") for i, c in enumerate(apart)])
        return out.dropna(subset=[c for c in out.columns if c not in ("id", "vec")]) if same or apart else out

    q, d = picked(queries, query_id, query_vector), picked(docs, doc_id, doc_vector)
    asked, (n, longest) = q.count(), d.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    longest = max(longest or 1, 1)
    q_blocks, d_blocks = (max(1, -(-rows // max(1, most // longest))) for rows, most in ((asked, QUERY_NUMBERS), (n, DOC_NUMBERS)))
    block, every = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int"), lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    keys, tasks = [*[f"same{i}" for i in range(len(same))], "qb", "db"], max(queries.sparkSession.sparkContext.defaultParallelism * 4, q_blocks * d_blocks)
    q = q.withColumn("qb", block(q_blocks)).withColumn("db", every(d_blocks)).repartition(tasks, *keys)
    d = d.withColumn("db", block(d_blocks)).withColumn("qb", every(q_blocks)).repartition(tasks, *keys)
    schema = T.StructType([T.StructField("query", queries.schema[query_id].dataType), T.StructField("doc", docs.schema[doc_id].dataType), T.StructField("score", T.DoubleType())])
    near = q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInArrow(matrices.nearest(k, len(apart)), schema)
    return top_k(near, ["query"], [F.desc("score"), F.asc("doc")], k).select("query", "doc", "score", "rank")


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group, ranked from 1."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)
