"""Text columns: cleaning, ordered distinct lists, hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Longest keyword that a store keeps, in bytes. A fixed value.
LONGEST_KEYWORD = 32766


def let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space at either end (all Unicode white space, unlike SQL trim)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """Stripped text; null counts as empty."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def lowered(c: Column) -> Column:
    return F.lower(clean(c))


def ordered_distinct(values: Column, cap: int = 0, longest: int = LONGEST_KEYWORD) -> Column:
    """Stripped, not empty, not longer than a keyword, each once in order of first find, at most ``cap`` (0: all)."""
    kept = F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), clean), lambda v: (v != "") & (F.octet_length(v) <= longest))
    found = F.array_distinct(kept)
    return F.slice(found, 1, cap) if cap else found


def sorted_distinct(values: Column) -> Column:
    """Stripped, not empty, each once, in order."""
    return F.array_sort(ordered_distinct(values))


def compact_struct(**columns: Column) -> Column:
    """JSON of the columns that hold something: nulls, empty texts and empty lists are left out."""
    return F.to_json(F.struct(*[F.when(c.cast("string") != "", c).alias(n) for n, c in columns.items()]))


def lines(c: Column) -> Column:
    """Lines of a text as an editor counts them: a line end at the end starts no further line; CR LF is one end."""
    text = F.regexp_replace(F.coalesce(c, F.lit("")), "\r\n?", "\n")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(text, "\n$", ""), "\n", -1))


def line_windows(c: Column, size: int = 80, overlap: int = 20) -> Column:
    """Overlapping windows of lines: array of (start_line, end_line, text), lines counted from 1.

    The step is at least one line; the last window ends with the text.
    """
    step = max(1, size - overlap)

    def windows(ls: Column) -> Column:
        count = F.greatest(F.lit(1), F.ceil((F.size(ls) - size) / step).cast("int") + 1)
        one = lambda k: F.struct((k * step + 1).cast("int").alias("start_line"), F.least(k * step + size, F.size(ls)).cast("int").alias("end_line"), F.array_join(F.slice(ls, k * step + 1, F.lit(size)), "\n").alias("text"))
        return F.when(F.size(ls) > 0, F.transform(F.sequence(F.lit(0), count - 1), one)).otherwise(F.array().cast("array<struct<start_line:int,end_line:int,text:string>>"))

    return F.get(F.transform(F.array(lines(c)), windows), F.lit(0))


def normalized(c: Column) -> Column:
    """Runs of blanks as one, no blanks at line ends, no runs of empty lines, stripped."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "[ \t]+", " ")
    t = F.regexp_replace(t, "(?m)[ \t]+$", "")
    return strip(F.regexp_replace(t, "\n{3,}", "\n\n"))


def folded(c: Column) -> Column:
    """Letters only, lower case: the loosest form that two texts are compared in."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}]+", " ")


def sha1_text(c: Column) -> Column:
    return F.sha1(F.coalesce(c, F.lit("")).cast("binary"))


def stable_digest(c: Column) -> Column:
    """The first twelve hexadecimal digits of SHA-1."""
    return F.substring(sha1_text(c), 1, 12)


def safe_path_fragment(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(clean(c), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")


def shard_of(c: Column, shards: int) -> Column:
    """The shard that the first eight hexadecimal digits of SHA-1 name."""
    return F.pmod(F.conv(F.substring(sha1_text(c), 1, 8), 16, 10).cast("bigint"), F.lit(max(1, int(shards)))).cast("int")
