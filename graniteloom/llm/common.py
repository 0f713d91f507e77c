"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

#: The words of a text: runs of anything but space and the five controls from tab to return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_totals(lengths: Column, block: int = 256) -> Column:
    """For each place of an array of numbers, the sum of all before it.

    Two levels of blocks, as appending to one array for every place would copy it each time.
    An empty array gives an empty array.
    """

    def totals(a: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / block).cast("int")), lambda b: F.slice(a, b * block + 1, F.lit(block)))

        def of_blocks(bs: Column) -> Column:
            zero = F.lit(0).cast("long")
            sums = F.transform(bs, lambda s: F.aggregate(s, zero, lambda t, x: t + x))

            def with_sums(ss: Column) -> Column:
                def one(s: Column, k: Column) -> Column:
                    before = F.aggregate(F.slice(ss, F.lit(1), k), zero, lambda t, x: t + x)
                    start = F.struct(before.alias("t"), F.array().cast("array<bigint>").alias("out"))
                    return F.aggregate(s, start, lambda st, x: F.struct((st["t"] + x).alias("t"), F.concat(st["out"], F.array(st["t"])).alias("out")))["out"]

                return F.flatten(F.transform(bs, one))

            return let(sums, with_sums)

        return F.when(F.size(a) > 0, let(blocks, of_blocks)).otherwise(F.array().cast("array<bigint>"))

    return let(lengths, totals)


def pieces(text: Column, size: int = 1024) -> Column:
    """A text in pieces of so many code points, for ``cut``; an empty text has none."""
    return F.regexp_extract_all(text, F.lit("(?s)(.{1,%d})" % size), F.lit(1))


def cut(parts: Column, start: Column, end: Column, size: int = 1024) -> Column:
    """The text from ``start`` to ``end`` out of its ``pieces``, without walking through what stands before."""
    first = F.floor(start / size).cast("int")
    n = F.when(end > start, F.floor((end - 1) / size).cast("int") - first + 1).otherwise(0)
    return F.substring(F.array_join(F.slice(parts, first + 1, n), ""), (start - first * size + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most so many rows, as rows here are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))


def release() -> None:
    """Give what a finished task has freed back to the system, as its Python process lives on beside others."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass


def release_driver(spark: SparkSession) -> bool:
    """``release`` for the driver's JVM; whether it could be asked to.

    Its threads (those that clean up after finished queries alone are over a hundred) allocate from dozens of malloc arenas,
    which keep what was freed: beside 130 MB in use they held 300 MB in the middle of a join.
    """
    context = spark.sparkContext
    jvm, array = context._jvm, context._gateway.new_array
    try:
        kinds, given = array(jvm.Class, 4), array(jvm.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = jvm.Class.forName(kind)
        given[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        given[1], given[2], given[3] = "systemTrimNativeHeap", array(jvm.Object, 0), array(jvm.String, 0)
        # By the interface, as the server's class is closed to calls from outside.
        jvm.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:  # a Java without the command
        return False
    return True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Only where the setting is absent on a single machine (tests) a temporary folder is made; a cluster must name one.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="graniteloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is not None:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Tables written to the shared folder to cut lineage; each is named anew.

    ``drop`` removes a table that nothing reads any more; the rest goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._end)
        small_batches(spark)

    def _end(self) -> None:
        try:
            _delete(self.spark, self.root)
        except Exception:  # the JVM may be gone at exit; the folder is scratch
            pass

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; the driver gives back what the write needed."""
        df.write.mode("overwrite").parquet(self.path(name))
        release_driver(self.spark)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def counted(self, df: DataFrame, name: str, *more: Column) -> tuple[DataFrame, tuple]:
        """``keep``, with the number of rows (and further aggregates) that the write itself observed."""
        seen = Observation()
        kept = self.keep(df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(f"x{i}") for i, c in enumerate(more)]), name)
        return kept, (seen.get["n"], *[seen.get[f"x{i}"] for i in range(len(more))])

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, self.path(name))
