"""Secret scans: patterns, and sliding-window Shannon entropy over candidate strings.

Main path: DataFrame functions only. The base kinds are read by pattern (``assign``, ``access``,
``hex``). The method adds ``entropy`` spans: a candidate is a maximal run of twenty or more of
``[A-Za-z0-9+/_=-]``; over each window of twenty characters the Shannon entropy follows from counts
that are kept up as the window slides (one symbol in, one out). A candidate is judged by its
character class: hexadecimal strings need 3.0 bits in some window, other strings that mix digits with
letters 3.7 bits; strings of digits alone, or without a digit, are no candidates. An allow-list
suppresses what is known to be harmless: whole candidates, and parts of them, beside which the rest is judged alone. A candidate inside a base span is not told twice.

Places are code points, end exclusive. Defined cases: a null text is empty; one result row per
input row, whatever its id; an empty table gives an empty table; further columns are ignored;
texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graniteloom.llm.common import cut, documents, let, pieces, running_totals

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Bits that some window needs, by character class.
LEAST_BITS = {"hex": 3.0, "mixed": 3.7}
#: Candidates that are known to be harmless: UUIDs, rules of dashes or equal signs, paths of words.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[-=_+/]+$",
    r"^/?(?:[A-Za-z_-]+/)+[A-Za-z0-9_-]*$",
)
#: Parts of candidates that are known to be harmless: alphabets in order, placeholders, dates. What stands beside them is judged alone.
ALLOWED_PARTS = r"(?i)(?:abcdefghijklmnopqrstuvwxyz|abcdefghij|0123456789|example|placeholder|changeme|x{8,})|(?<![0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])"

SPAN = "array<struct<start:bigint,end:bigint,kind:string,rank:int>>"


def _found(text: Column, pattern: str, kind: str, rank: int, keep, group: int = 0) -> Column:
    """Spans of the matches of ``pattern``; ``keep`` judges (match, group)."""
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    inner = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1)) if group else whole
    gaps = F.split(text, pattern, -1)

    def spans(ms: Column) -> Column:
        def placed(gs: Column) -> Column:
            both = F.transform(ms, lambda m, i: (F.length(F.get(gs, i)) + F.length(m)).cast("long"))

            def at(ts: Column) -> Column:
                return F.zip_with(F.zip_with(ms, inner, lambda m, g: F.struct(m.alias("m"), g.alias("g"))), F.transform(ts, lambda t, i: t + F.length(F.get(gs, i))), lambda x, s: F.when(keep(x["m"], x["g"]), F.struct(s.cast("long").alias("start"), (s + F.length(x["m"])).cast("long").alias("end"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), x["m"].alias("m"))))

            return let(running_totals(both), at)

        return F.filter(let(gaps, placed), lambda s: s.isNotNull())

    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,rank:int,m:string>>")
    return F.when(text.rlike(pattern), let(whole, spans)).otherwise(empty)


def window_bits(s: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy (bits a character) of any window of ``s``.

    The sum of c*log2(c) over the counts c is changed by the symbol that comes and the one that goes.
    """
    term = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))
    index = lambda i: F.instr(F.lit(ALPHABET), F.substring(s, i, F.lit(1)))
    zero = F.struct(F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("most"))

    def step(st: Column, i: Column) -> Column:
        def with_ends(e: Column) -> Column:
            new, old = e["new"], e["old"]
            n_new, n_old = F.get(st["n"], new), F.get(st["n"], old)
            same = new == old
            total = F.when(same, st["sum"]).otherwise(st["sum"] + term(n_new + 1) - term(n_new) + F.when(old > 0, term(n_old - 1) - term(n_old)).otherwise(F.lit(0.0)))
            counts = F.when(same, st["n"]).otherwise(F.transform(st["n"], lambda c, k: c + F.when(k == new, F.lit(1)).otherwise(F.lit(0)) - F.when((k == old) & (old > 0), F.lit(1)).otherwise(F.lit(0))))
            bits = F.when(i >= window, F.log2(F.lit(float(window))) - total / window).otherwise(F.lit(0.0))
            return F.struct(counts.alias("n"), total.alias("sum"), F.greatest(st["most"], bits).alias("most"))

        ends = F.struct(index(i).alias("new"), F.when(i > window, index(i - window)).otherwise(F.lit(0)).alias("old"))
        return let(ends, with_ends)

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), zero, step, lambda st: st["most"])


def _is_secret(s: Column) -> Column:
    allowed = F.lit(False)
    for p in ALLOWED:
        allowed = allowed | s.rlike(p)

    def judged(part: Column) -> Column:
        least = F.when(part.rlike(r"^[0-9a-fA-F]+$"), F.lit(LEAST_BITS["hex"])).otherwise(F.lit(LEAST_BITS["mixed"]))
        mixed = part.rlike("[0-9]") & part.rlike("[A-Za-z]") & (F.length(part) >= WINDOW)
        return F.when(mixed, window_bits(part) >= least).otherwise(F.lit(False))

    return F.when(allowed, F.lit(False)).otherwise(F.exists(F.split(s, ALLOWED_PARTS, -1), judged))


def scan(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Every row with ``base`` and ``added``: arrays of (start, end, kind, rank, m), m being the match."""
    text = F.col("_text")
    rows = df.select(*[F.col(c) for c in carry], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = F.array_sort(F.concat(
        _found(text, ASSIGN, "assign", 0, lambda m, g: F.length(g) >= 6, group=1),
        _found(text, ACCESS, "access", 1, lambda m, g: F.length(m) >= 20),
        _found(text, HEX, "hex", 2, lambda m, g: F.lit(True)),
    ), lambda a, b: F.when(a["start"] != b["start"], (a["start"] - b["start"]).cast("int")).otherwise(a["rank"] - b["rank"]))
    rows = rows.select("*", base.alias("base"), _found(text, CANDIDATE, "entropy", 3, lambda m, g: m.rlike("[0-9]") & m.rlike("[A-Za-z]")).alias("_candidates"))
    outside = lambda c: ~F.exists("base", lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"]))
    added = F.filter("_candidates", lambda c: F.when(outside(c), _is_secret(c["m"])).otherwise(F.lit(False)))
    return rows.select("*", added.alias("added")).drop("_candidates")


def told(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def by_start(spans: Column) -> Column:
    return F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: s)


def redact(df: DataFrame, text_col: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """``df`` with every found secret (base or added) replaced by ``mark``; other columns stay.

    Overlapping spans are merged first; a row without secrets keeps its text, a null text too.
    """
    found = scan(df.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in df.columns])), text_col, carry=("_row",))
    spans = by_start(F.concat("base", "added"))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(st: Column, s: Column) -> Column:
        gap = cut(F.col("_pieces"), st["at"], s["start"])
        return F.struct(F.greatest(st["at"], s["end"]).alias("at"), F.when(s["start"] >= st["at"], F.concat(st["out"], F.array(gap, F.lit(mark)))).otherwise(st["out"]).alias("out"))

    found = found.withColumn("_pieces", F.when(F.size("base") + F.size("added") > 0, pieces(F.col("_text"))))
    clean = F.aggregate(spans, begin, step, lambda st: F.concat(F.array_join(st["out"], ""), cut(F.col("_pieces"), st["at"], F.length(F.col("_text")).cast("long"))))
    new = F.when(F.size("base") + F.size("added") > 0, clean).otherwise(F.col("_row")[text_col])
    return found.select(*[new.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in df.columns])


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan over every document."""
    found = scan(documents(spark, sf_dir), carry=("doc_id",))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(by_start(F.concat("base", "added"))).alias("spans"),
    )
