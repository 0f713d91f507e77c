"""Mixing sources to target weights by pivotal dependent rounding.

Main path: DataFrame functions only. A source's target is shared out by weight, at most ``most_copies``
times its size, the excess reshared (``targets``). Every document of a source first has the same
number of copies, target / size; the whole part is taken, the fraction is rounded. Two documents at a
time, words move from one to the other until one fraction is 0 or 1, in the direction that a hashed coin
says, with odds such that every expectation stays; the words of the pair do not change. The other carries on.
The words of a source stay, and no document passes ``most_copies``.

The pairing is a reduction tree: ``FAN_IN`` documents of a source meet in one task, what is left (one
document at most) meets the others' on the next level, and so on until a source has one, which the
coin rounds. A hot source is thus many small groups on every level. Groups, their order and the coins
come from hashes of source, id and text alone, so reruns agree on any number of machines.

Defined cases: a null text has size 0; size 0 takes 0; a null source is a source, ordered last; a
null id is an id, and rows are told apart by source, id and text, so that rows with a null id are rounded one by one. Rows that agree in
all three are one unit of the tree with as many words as they have together, and a unit is rounded to a whole number of its
rows' copies, which go to its rows in no order that shows (they are equal): only the last of them is left to the tree. An empty table gives an empty table; further columns
are kept out of the tree and come back with ``mixed``; texts of any length are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from graniteloom.llm.common import WORD, Scratch, documents

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
FAN_IN = 64
SEED = 10


def words(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most_copies: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) for (source, source_size), one row per source.

    Sources fill up in order of cap per weight: if the first m are at their caps, the rest stand at
    level (total - caps) / weights; the m to use is the first whose level the next source holds.
    The window runs over one row per source.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    total = F.lit(float(share)) * F.sum("source_size").over(W.partitionBy())
    rows = sizes.select("source", "source_size", F.get(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights)).alias("w"), total.alias("total"))
    rows = rows.withColumn("cap", F.lit(float(most_copies)) * F.col("source_size"))
    order = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("level", left / weight)
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))).over(W.partitionBy())
    held = F.coalesce(F.least("cap", level * F.col("w")), F.col("cap"))
    return rows.select("source", "source_size", held.alias("target"))


def _coin(a: Column, b: Column, level: int) -> Column:
    """A number in [0, 1) that two keys and the level fix."""
    return F.pmod(F.xxhash64(F.lit(SEED), F.lit(level), a, b), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _pair_up(rows: Column, level: int) -> Column:
    """Fold rows (key, size, p) to (open, up): the one left open, if any, and the keys rounded up."""
    row = "struct<h:bigint,key:bigint,size:double,p:double>"
    zero = F.struct(F.lit(None).cast(row).alias("open"), F.array().cast("array<bigint>").alias("up"))

    def step(st: Column, x: Column) -> Column:
        o = st["open"]
        first = F.least((1 - o["p"]) * o["size"], x["p"] * x["size"])  # words that can go from x to the open one
        second = F.least(o["p"] * o["size"], (1 - x["p"]) * x["size"])  # and the other way
        gain = F.when(_coin(o["key"], x["key"], level) * (first + second) < second, first).otherwise(-second)
        fills = F.when(gain > 0, (1 - o["p"]) * o["size"] <= x["p"] * x["size"]).otherwise(o["p"] * o["size"] <= (1 - x["p"]) * x["size"])  # whether the open one becomes whole
        stays = F.when(fills, F.struct(x["h"].alias("h"), x["key"].alias("key"), x["size"].alias("size"), (x["p"] - gain / x["size"]).alias("p"))).otherwise(
            F.struct(o["h"].alias("h"), o["key"].alias("key"), o["size"].alias("size"), (o["p"] + gain / o["size"]).alias("p")))
        up = F.when(fills & (gain > 0), F.array(o["key"])).when(~fills & (gain <= 0), F.array(x["key"])).otherwise(F.array().cast("array<bigint>"))
        tiny = 1e-12
        closed = (stays["p"] <= tiny) | (stays["p"] >= 1 - tiny)
        up = F.concat(up, F.when(stays["p"] >= 1 - tiny, F.array(stays["key"])).otherwise(F.array().cast("array<bigint>")))
        return F.when(o.isNull(), F.struct(x.cast(row).alias("open"), st["up"].alias("up"))).otherwise(
            F.struct(F.when(~closed, stays).alias("open"), F.concat(st["up"], up).alias("up")))

    return F.aggregate(rows, zero, step)


def round_copies(rows: DataFrame, most_rows: int, scratch: Scratch) -> DataFrame:
    """(source, key) of what is rounded up, of rows (source, key, size, p), size > 0 and 0 < p < 1.

    ``most_rows`` is the largest number of rows of a source; it sets the levels of the tree. Each
    level is a table a ``FAN_IN``-th of the one before, so the levels together are about the first.
    """
    level, left, out = 0, rows.withColumn("h", F.xxhash64(F.lit(SEED), "key")), None
    groups = max(1, -(-most_rows // FAN_IN))
    while True:
        bucket = F.pmod(F.shiftrightunsigned("h", 8), F.lit(groups))
        folded = left.groupBy("source", bucket.alias("bucket")).agg(F.array_sort(F.collect_list(F.struct("h", "key", F.col("size").cast("double").alias("size"), "p"))).alias("rows"))
        folded = scratch.keep(folded.select("source", _pair_up(F.col("rows"), level).alias("f")), f"level-{level}")
        up = folded.select("source", F.explode("f.up").alias("key"))
        out = up if out is None else out.unionByName(up)
        left = folded.where("f.open IS NOT NULL").select("source", "f.open.h", "f.open.key", "f.open.size", "f.open.p")
        if groups == 1:
            last = left.where(F.col("p") >= 0.5)
            return out.unionByName(last.select("source", "key"))
        groups, level = max(1, -(-groups // FAN_IN)), level + 1


def _keyed(df: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [words(F.col(text_col)).alias("size"), F.xxhash64(F.lit(SEED), F.col(source_col), F.col(id_col), F.col(text_col)).alias("key")]


def _placed(rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Rows that repeat a key with their ``place`` among its rows: by task first, then the tasks' counts added up, so that no task holds a key's rows."""
    kept = scratch.keep(rows.withColumn("_task", F.spark_partition_id()), name)
    here = kept.withColumn("_here", F.row_number().over(W.partitionBy("key", "_task").orderBy(F.lit(1))))
    before = F.coalesce(F.sum("count").over(W.partitionBy("key").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = kept.groupBy("key", "_task").count().select("key", "_task", before.alias("_before"))
    return here.join(counts, ["key", "_task"]).withColumn("place", F.col("_before") + F.col("_here")).drop("_task", "_here", "_before")


def _solved(df: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple, share: float, most_copies: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sized rows, the sources' rates, and per key (``of_key``, n rows, ``extra`` of them that get one more copy than the whole part).

    A key's n rows of fraction p have n * p more copies between them: the whole part for sure, what is left through the tree.
    Texts are read once, for their sizes; all that follows reads a table of ids, sources and sizes.
    """
    sized = scratch.keep(df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), *_keyed(df, id_col, text_col, source_col)), "sized")
    totals = scratch.keep(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "totals")
    goals = scratch.keep(targets(totals, weights, share, most_copies), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(rate + 1e-12), F.lit(int(most_copies)))
    part = F.when(rate - whole > 1e-12, rate - whole).otherwise(F.lit(0.0))
    rates = goals.select(F.col("source").alias("of"), "source_size", "target", whole.alias("whole"), part.alias("p"))
    units = sized.where("size > 0").groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("n")).join(rates, F.col("source").eqNullSafe(F.col("of")))
    sure = F.floor(F.col("n") * F.col("p") + 1e-9)
    units = scratch.keep(units.select("source", "key", "size", "n", sure.alias("sure"), F.greatest(F.col("n") * F.col("p") - sure, F.lit(0.0)).alias("p")), "units")
    up = round_copies(units.where("p > 1e-9").select("source", "key", "size", "p"), totals.agg(F.max("n")).first()[0] or 0, scratch)
    up = up.groupBy(F.col("key").alias("up_key")).agg(F.lit(1).alias("up"))
    extra = units.join(up, F.col("key") == F.col("up_key"), "left").select(F.col("key").alias("of_key"), "n", (F.col("sure") + F.coalesce("up", F.lit(0))).alias("extra"))
    return sized, rates, scratch.keep(extra, "extra")


def _with_copies(rows: DataFrame, extra: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (key, whole, ...) with ``copies``; rows whose key isn't in ``extra`` have no words and none."""
    joined = rows.join(extra, F.col("key") == F.col("of_key"), "left")
    out = joined.where("n IS NULL OR n = 1").withColumn("copies", F.when(F.col("n").isNull(), F.lit(0)).otherwise(F.col("whole") + F.col("extra")).cast("int"))
    if not extra.where("n > 1").isEmpty():
        many = _placed(joined.where("n > 1"), scratch, "repeated")
        out = out.unionByName(many.withColumn("copies", (F.col("whole") + F.when(F.col("place") <= F.col("extra"), 1).otherwise(0)).cast("int")).drop("place"))
    return out.drop("of_key", "n", "extra")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most_copies: int = MOST_COPIES) -> DataFrame:
    """(doc_id, source, key, size, source_size, target, copies) for every row."""
    scratch = Scratch(df.sparkSession, "mixing")
    sized, rates, extra = _solved(df, id_col, text_col, source_col, weights, share, most_copies, scratch)
    out = _with_copies(sized.join(rates, F.col("source").eqNullSafe(F.col("of"))), extra, scratch)
    return out.select("doc_id", "source", "key", "size", "source_size", "target", "copies")


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most_copies: int = MOST_COPIES) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it, with ``df``'s columns."""
    scratch = Scratch(df.sparkSession, "mixing")
    _, rates, extra = _solved(df, id_col, text_col, source_col, weights, share, most_copies, scratch)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    keyed = df.select(row, _keyed(df, id_col, text_col, source_col)[1], F.col(source_col).alias("source"))
    keyed = keyed.join(rates.select("of", "whole"), F.col("source").eqNullSafe(F.col("of"))).select("_row", "key", "whole")
    many = _with_copies(keyed, extra, scratch).where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_i"))
    return many.select(*[F.col("_row")[c].alias(c) for c in df.columns])


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of every document."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
