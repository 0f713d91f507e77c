"""Streams: rate limits, leases and backfills over event tables, as Structured Streaming.

Batch forms of the same operators work on a table of events; the streaming forms keep their state per key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LIMITS = "key string, at double, allowed boolean, remaining int, retry_after int"


class SlidingLog:
    """Times of allowed events within a window; those that are refused leave no trace."""

    def __init__(self, limit: int, window: int, times: list[float] = ()):
        self.limit, self.window, self.times = max(1, int(limit)), max(1, int(window)), list(times)

    def check(self, now: float) -> tuple[bool, int, int]:
        """(allowed, remaining, seconds until the next may be)."""
        self.times = [t for t in self.times if t > now - self.window]
        if len(self.times) >= self.limit:
            return False, 0, max(1, int(self.times[0] + self.window - now))
        self.times.append(now)
        return True, max(0, self.limit - len(self.times)), 0


def rate_limit(events: DataFrame, key: str, at: str, limit: int, window: int) -> DataFrame:
    """(key, at, allowed, remaining, retry_after) of a table of events; ``at`` in seconds.

    Decisions depend on earlier decisions, so a key's events are folded in order; tasks stream them, sorted,
    and keep one key's window at a time.
    """
    rows = events.select(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("unknown")).alias("key"), F.col(at).cast("double").alias("at"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, log = None, None
        for pdf in batches:
            out = []
            for k, t in zip(pdf["key"], pdf["at"], strict=True):
                if k != current:
                    current, log = k, SlidingLog(limit, window)
                out.append((k, t, *log.check(t)))
            yield pd.DataFrame(out, columns=["key", "at", "allowed", "remaining", "retry_after"])

    return rows.repartition("key").sortWithinPartitions("key", "at").mapInPandas(run, LIMITS)


def rate_limit_stream(events: DataFrame, limit: int, window: int) -> DataFrame:
    """The same over a stream of (key, at): state is the window's times per key."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        log = SlidingLog(limit, window, list(state.get[0]) if state.exists else [])
        out = [(key[0], t, *log.check(t)) for pdf in batches for t in sorted(pdf["at"])]
        state.update((log.times,))
        yield pd.DataFrame(out, columns=["key", "at", "allowed", "remaining", "retry_after"])

    return events.groupBy("key").applyInPandasWithState(step, LIMITS, "times array<double>", "append", GroupStateTimeout.NoTimeout)


def concurrency(events: DataFrame, limit: int) -> DataFrame:
    """Work in flight after each event (kind acquire or release) and whether an acquire would pass, by time and id."""
    change = F.when(F.col("kind") == "acquire", 1).when(F.col("kind") == "release", -1).otherwise(0)
    flying = F.sum(change).over(W.partitionBy("pool").orderBy("at", "event_id").rowsBetween(W.unboundedPreceding, 0))
    return events.withColumn("in_flight", flying).withColumn("within", F.col("in_flight") <= limit)


def windowed_counts(events: DataFrame, at: str, by: list[str], every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per window of time, with a watermark; for streams and tables alike."""
    return events.withWatermark(at, late).groupBy(F.window(at, every), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def lease_state(events: DataFrame, by: str, at: str, now: Column, seconds: int) -> DataFrame:
    """The last event per key and whether its lease has run out."""
    last = events.groupBy(by).agg(F.max_by("event_type", F.struct(F.col(at), F.col("event_id"))).alias("last_event"), F.max(at).alias("last_at"))
    return last.withColumn("stale", F.unix_timestamp(now) - F.unix_timestamp("last_at") >= seconds)


def backfill(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, transform, most_files: int = 100) -> None:
    """Process what has come to a folder since the last run, in bounded slices, and stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(source)
    query = transform(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()


def should_continue(processed: int, limit: int, pending: int) -> bool:
    """Whether a bounded run should be followed by another."""
    return processed >= limit and pending > 0
