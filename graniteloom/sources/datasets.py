"""Datasets and manifests as sources: JSON in its several wrappings, JSON lines, Parquet, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graniteloom.functions.classify import file_class, in_ignored_directory, is_binary
from graniteloom.functions.text import clean, lines, ordered_distinct, safe_path_fragment
from graniteloom.functions.urls import file_id, owner_repo_url
from graniteloom.operators.store import last_per_key

#: Keys under which a JSON document may hold its records, in the order in which they are tried; default fields. Fixed values.
WRAPPERS = ("instances", "records", "examples", "items", "data", "rows")
REPO_FIELDS = {"default": ("repo", "repository", "repo_url", "metadata.repo")}
ID_FIELDS = {"default": ("id", "idx", "identifier"), "coir": ("id", "doc_id", "identifier"), "swe_bench": ("instance_id",), "codesearchnet": ("sha", "url")}
LARGEST_FILE = 1 << 20


def read_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(record, file, place): each record as JSON text. ``kind``: json (list, wrapped or single object), jsonl, parquet.

    ``place`` is the record's number in its file, or a digest of its text where lines aren't numbered.
    """
    if kind == "parquet":
        df = spark.read.parquet(path)
        return df.select(F.to_json(F.struct(*df.columns)).alias("record"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").cast("string").alias("place"))
    if kind == "jsonl":
        return spark.read.text(path).select(F.col("value").alias("record"), F.col("_metadata.file_name").alias("file"), F.substring(F.sha1("value"), 1, 12).alias("place")).where("trim(record) <> ''")
    whole = spark.read.text(path, wholetext=True).select(F.trim("value").alias("doc"), F.col("_metadata.file_name").alias("file"))
    as_list = lambda c: F.from_json(c, "array<string>")
    wrapped = F.coalesce(*[F.when(F.get_json_object("doc", f"$.{w}").startswith("["), as_list(F.get_json_object("doc", f"$.{w}"))) for w in WRAPPERS])
    records = F.when(F.col("doc").startswith("["), as_list(F.col("doc"))).otherwise(F.coalesce(wrapped, F.array("doc")))
    return whole.select("file", F.posexplode(records).alias("place", "record")).select("record", "file", F.col("place").cast("string").alias("place"))


def field(record: Column, paths: tuple[str, ...]) -> Column:
    """The first dotted path that a record has."""
    return F.coalesce(*[F.when(F.trim(F.get_json_object(record, f"$.{p}")) != "", F.get_json_object(record, f"$.{p}")) for p in paths])


def fields(record: Column, paths: tuple[str, ...]) -> Column:
    """All values at dotted paths: texts, or the texts of lists."""
    one = lambda p: F.when(F.get_json_object(record, f"$.{p}").startswith("["), F.from_json(F.get_json_object(record, f"$.{p}"), "array<string>")).otherwise(F.array(F.get_json_object(record, f"$.{p}")))
    return ordered_distinct(F.flatten(F.array(*[F.coalesce(one(p), F.array().cast("array<string>")) for p in paths])))


def benchmark_seeds(records: DataFrame, dataset: str, kind: str = "default", repo_fields: tuple[str, ...] | None = None, id_fields: tuple[str, ...] | None = None) -> DataFrame:
    """Seeds of a dataset's records; those without a repository reference give none; an id falls back to file and place."""
    urls = F.array_compact(F.transform(fields(F.col("record"), repo_fields or REPO_FIELDS["default"]), owner_repo_url))
    item = field(F.col("record"), id_fields or ID_FIELDS.get(kind, ID_FIELDS["default"]))
    number = F.col("place") if "place" in records.columns else F.substring(F.sha1("record"), 1, 12)
    place = F.concat(F.regexp_replace("file", r"\.[^.]*$", ""), F.lit(":"), number)
    out = records.select(F.lit("benchmark_dataset").alias("source_type"), F.lit(dataset).alias("source_name"), F.coalesce(item, place).alias("source_item_id"), urls.alias("candidate_repo_urls"))
    return out.where(F.size("candidate_repo_urls") > 0)


def curated_seeds(entries: DataFrame, name: str) -> DataFrame:
    """Seeds of a curated list whose entries are texts or objects (repo_url, repo_label, tags, source_item_id) as JSON."""
    is_object = F.col("entry").startswith("{")
    url = F.when(is_object, F.get_json_object("entry", "$.repo_url")).otherwise(F.col("entry"))
    item = F.coalesce(F.when(is_object, F.get_json_object("entry", "$.source_item_id")), url)
    return entries.select(F.lit("curated_repo_list").alias("source_type"), F.lit(name).alias("source_name"), item.alias("source_item_id"), F.array_compact(F.array(owner_repo_url(url))).alias("candidate_repo_urls")).where(F.size("candidate_repo_urls") > 0)


def write_manifest(df: DataFrame, base: str, batch: str, stage: str) -> str:
    """JSON lines by shard under (batch, stage); the writer's commit makes each shard appear whole."""
    path = f"{base}/{batch}/{stage}"
    df.write.mode("overwrite").partitionBy("shard_index").json(path)
    return path


def read_manifest(spark: SparkSession, base: str, batch: str, stage: str, schema: str, shard: int | None = None) -> DataFrame:
    """A stage's manifest, or one shard of it; the last entry of a repository wins (``recorded_at``)."""
    df = spark.read.schema(schema).json(f"{base}/{batch}/{stage}")
    df = df if shard is None else df.where(F.col("shard_index") == shard)
    return last_per_key(df, ["repo_id"], [F.desc_nulls_last("recorded_at")]) if {"repo_id", "recorded_at"} <= set(df.columns) else df


def enabled(config: dict, rule_type: str | None = None) -> dict:
    """The named entries of a configuration that are enabled, of one rule type where that is asked for."""
    return {k: v for k, v in config.items() if isinstance(k, str) and isinstance(v, dict) and v.get("enabled") is True and (rule_type is None or v.get("rule_type") == rule_type)}


def dataset_paths(spark: SparkSession, config: dict, base: str) -> list[str]:
    """Paths that a dataset's globs match, relative ones under ``base``, each once, in any file system that Spark knows."""
    raw, found = config.get("dataset_paths") or [], {}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in [raw] if isinstance(raw, str) else raw:
        if isinstance(p, str) and p.strip():
            p = p.strip() if p.strip().startswith("/") or "://" in p else f"{base.rstrip('/')}/{p.strip()}"
            where = jvm.org.apache.hadoop.fs.Path(p)
            told = where.getFileSystem(conf).globStatus(where)
            found |= dict.fromkeys(sorted(s.getPath().toString() for s in told or []))
    return list(found)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, file_path, content) of the files in tar archives (plain or compressed), one archive per task at a time.

    Links and entries that point outside are left out; where all share one top folder it is the root.
    """

    def unpack(batches):
        import io
        import tarfile
        from pathlib import PurePosixPath

        import pyarrow as pa

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with tarfile.open(fileobj=io.BytesIO(data.as_py())) as tar:
                    members = [m for m in tar if m.isfile() and not PurePosixPath(m.name).is_absolute() and ".." not in PurePosixPath(m.name).parts]
                    parts = [PurePosixPath(m.name).parts for m in members]
                    cut = int(len({p[0] for p in parts}) == 1 and all(len(p) > 1 for p in parts))
                    for m, p in zip(members, parts, strict=True):
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array(["/".join(p[cut:])]), pa.array([tar.extractfile(m).read()], type=pa.binary())], names=["archive", "file_path", "content"])

    archives = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("archive"), "content")
    return archives.mapInArrow(unpack, "archive string, file_path string, content binary")


def manifest_path(base: Column, batch: Column, stage: Column) -> Column:
    return F.concat_ws("/", base, safe_path_fragment(batch), safe_path_fragment(stage))


def read_snapshot(spark: SparkSession, root: str, repo: str, largest: int = LARGEST_FILE) -> DataFrame:
    """Text files of an unpacked snapshot with class, size, lines and SHA-1; ignored directories, binaries and large files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.regexp_replace(F.col("path"), f"^(?:file:)?/*{root.strip('/')}/", "")
    rows = files.select(path.alias("file_path"), F.col("length").alias("file_size_bytes"), "content").where(~in_ignored_directory(F.col("file_path")) & (F.col("file_size_bytes") <= largest))
    rows = rows.where(~is_binary(F.col("content"))).withColumn("text", F.try_validate_utf8(F.col("content").cast("string"))).where("text IS NOT NULL")
    c = file_class(F.col("file_path"))
    return rows.select(
        F.lit(repo).alias("repo_id"), file_id(F.lit(repo), F.col("file_path")).alias("_id"), "file_path", c["language"].alias("language"), c["category"].alias("file_category"), c["is_code"].alias("is_code_file"), c["is_license"].alias("is_license_file"),
        "file_size_bytes", (F.regexp_count("text", F.lit("\n")) + F.when(F.col("text") != "", 1).otherwise(0)).alias("line_count"), F.sha1("content").alias("content_sha1"), "text",
    )


def csv_list(value: Column) -> Column:
    """Items of a comma or line separated setting."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), "[,\n]"), clean), lambda x: x != "")


def text_line_count(text: Column) -> Column:
    return F.size(lines(text))
