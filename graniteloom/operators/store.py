"""A collection as a Parquet table with a key: scans, lookups, upserts, deletes.

Writes make a new version beside the old one and then move the pointer file, so readers see one version whole.
Merges are joins on the key; a table is never read into the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


@dataclass
class Collection:
    """Versions under ``path``; ``key`` is the name of the key column."""

    spark: SparkSession
    path: str
    key: str = "_id"

    def _fs(self, name: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._fs("")
        if not fs.exists(p):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[1:]) for n in found if n.startswith("v") and fs.exists(self._fs(f"{n}/_SUCCESS")[1]))

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        """The newest whole version."""
        return self.spark.read.parquet(f"{self.path}/v{self.versions()[-1]}")

    def write(self, df: DataFrame) -> "Collection":
        """A new version; older ones stay until ``vacuum``."""
        have = self.versions()
        df.write.parquet(f"{self.path}/v{have[-1] + 1 if have else 0}")
        return self

    def vacuum(self, keep: int = 1) -> None:
        for v in self.versions()[:-keep]:
            fs, p = self._fs(f"v{v}")
            fs.delete(p, True)

    def upsert(self, rows: DataFrame) -> "Collection":
        """Field merge by key: columns that ``rows`` has replace, the others stay; of rows that repeat a key the last wins nothing, so keys must be unique."""
        return self.write(upsert(self.read(), rows, self.key) if self.exists() else rows)

    def update(self, rows: DataFrame) -> "Collection":
        """As ``upsert``, for keys that exist; raises if one doesn't."""
        missing = rows.join(self.read().select(self.key), self.key, "left_anti")
        if not missing.isEmpty():
            raise KeyError(f"no such key: {missing.first()[self.key]}")
        return self.upsert(rows)

    def replace(self, rows: DataFrame) -> "Collection":
        """Whole rows by key."""
        return self.write(replace(self.read(), rows, self.key) if self.exists() else rows)

    def delete(self, keys: DataFrame) -> "Collection":
        """Without the given keys; keys that don't exist are no error."""
        return self.write(self.read().join(keys.select(self.key).distinct(), self.key, "left_anti"))

    def delete_where(self, condition: Column) -> int:
        """Without the rows that meet a condition; how many there were."""
        df = self.read()
        n = df.where(condition).count()
        self.write(df.where(~F.coalesce(condition, F.lit(False))))
        return n

    def get(self, key) -> dict:
        """One row by key, or an empty dict."""
        row = self.read().where(F.col(self.key) == F.lit(key)).first()
        return row.asDict() if row else {}

    def get_many(self, keys: DataFrame, columns: list[str] | None = None, keep_missing: bool = False) -> DataFrame:
        """Rows of the given keys, each key once; missing ones dropped or null."""
        asked = keys.select(self.key).dropDuplicates()
        found = self.read() if columns is None else self.read().select(self.key, *columns)
        return asked.join(found, self.key, "left" if keep_missing else "inner")

    def existing(self, keys: DataFrame) -> DataFrame:
        return keys.select(self.key).distinct().join(self.read().select(self.key), self.key, "left_semi")

    def scan(self, condition: Column | None = None, columns: list[str] | None = None, order: list[Column] | None = None, after: Column | None = None, limit: int | None = None) -> DataFrame:
        """Rows under a predicate, projected at the source; ``after`` and ``limit`` with an order give keyset pages."""
        df = self.read()
        for c in (condition, after):
            df = df if c is None else df.where(c)
        df = df.orderBy(*order) if order else df
        df = df if limit is None else df.limit(limit)
        return df if columns is None else df.select(*columns)

    def count(self, **conditions: Column) -> dict:
        """Counts under several predicates in one pass."""
        return self.read().agg(*[F.count_if(c).alias(n) for n, c in conditions.items()]).first().asDict()


def upsert(current: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Full outer join on the key: where a row is given, its columns; else what was there."""
    new = rows.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_new_{c}") for c in rows.columns if c != key], F.lit(True).alias("_given"))
    both = current.join(new, F.col(key) == F.col("_k"), "full")
    columns = [key, *[c for c in current.columns if c != key], *[c for c in rows.columns if c not in current.columns]]
    pick = lambda c: F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in rows.columns and c in current.columns else F.col(f"_new_{c}") if c in rows.columns else F.col(c)
    return both.select(F.coalesce(F.col(key), F.col("_k")).alias(key), *[pick(c).alias(c) for c in columns if c != key])


def replace(current: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return current.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def stale(existing: DataFrame, produced: DataFrame, key: str) -> DataFrame:
    """Keys that were there and aren't made any more."""
    return existing.select(key).join(produced.select(key), key, "left_anti")


def last_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")
