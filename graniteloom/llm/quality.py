"""Quality rules: a threshold table compiled into one Spark projection.

Main path: DataFrame functions only. Words are runs of anything but space and the controls
from tab to return. A repeated window of eight words is told by the 64-bit hash of its words
(two different windows of one text agree by chance about once in 2**64 pairs).

Defined cases: a null text counts as empty (no words, all counts 0, it fails the base rule);
a null or repeated id is carried as it is, one result row per input row; an empty table gives an
empty table; further columns of the input are ignored, whatever their names; texts of any length
are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graniteloom.llm.common import WORD, documents, let

#: Words whose share tells running text from lists and tables. Fixed values.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he this are or "
    "le la les de des du et en un une que qui dans par pour "
    "der die das und den von zu mit sich ist im dem nicht ein eine auf "
    "el los las y se del con para al es su"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text if ``least <= numerator / denominator <= most``; no denominator, no complaint."""

    name: str
    numerator: str
    denominator: str
    least: float | None = None
    most: float | None = None


#: The method's threshold table. Each ratio is of the counts that ``measure`` gives.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", least=2, most=12),
    Rule("symbols_per_word", "n_symbols", "n_words", most=0.1),
    Rule("exclamations_per_word", "n_exclamations", "n_words", most=0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", least=0.05),
    Rule("distinct_word_ratio", "n_distinct_words", "n_words", least=0.3),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", most=0.3),
)

BASE_LEAST_WORDS = 20
BASE_MOST_REPEATED_PERCENT = 30
WINDOW = 8


def _repeated(words: Column, window: int = WINDOW) -> Column:
    """Words in windows found twice or more in the text, the first find included."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(window))))

    def covered(h: Column) -> Column:
        in_order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def of_sorted(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
            starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
            begin = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-window).alias("last"))
            return F.aggregate(starts, begin, lambda st, p: F.struct((st["total"] + F.least(F.lit(window), p - st["last"])).alias("total"), p.alias("last")), lambda st: st["total"])

        zero = F.lit(0).cast("long")
        return F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(let(in_order, of_sorted))

    return F.when(n < window, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def _without(text: Column, kept: str) -> Column:
    """How many code points of the text are of the class ``kept``."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", ""))


def measure(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The counts that rules are made of, beside the columns named in ``carry``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = df.select(*[F.col(c) for c in carry], text.alias("_text"), F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)).alias("_words"), F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"))
    words, long = F.col("_words"), lambda c: c.cast("long")
    return split.select(
        *[F.col(c) for c in carry],
        long(F.size(words)).alias("n_words"),
        long(F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", ""))).alias("word_chars"),
        long(_without(F.col("_text"), "#*$%&|<>")).alias("n_symbols"),
        long(_without(F.col("_text"), "!")).alias("n_exclamations"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(F.size(F.array_distinct(words))).alias("n_distinct_words"),
        long(F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))).alias("n_stop_words"),
        _repeated(words).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """The base rule on the columns of ``measure``."""
    return (F.col("n_words") < BASE_LEAST_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(BASE_MOST_REPEATED_PERCENT) * F.col("n_words"))


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression (products, so that no row divides by zero)."""
    out = F.lit(True)
    for r in rules:
        top, bottom = F.col(r.numerator), F.col(r.denominator)
        if r.least is not None:
            out = out & (top >= F.lit(float(r.least)) * bottom)
        if r.most is not None:
            out = out & (top <= F.lit(float(r.most)) * bottom)
    return out


def judge(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = (), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row of ``df``."""
    return measure(df, text_col, carry).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & passes(rules))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over every document."""
    return judge(documents(spark, sf_dir), carry=("doc_id",)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
_CONDITIONS = " AND ".join(
    [f"{r.numerator} >= CAST({r.least} AS DOUBLE) * {r.denominator}" for r in RULES if r.least is not None]
    + [f"{r.numerator} <= CAST({r.most} AS DOUBLE) * {r.denominator}" for r in RULES if r.most is not None]
)
OP3_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_exclamations,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct_words,
         CAST(len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_CONDITIONS} AS kept
FROM b
"""
