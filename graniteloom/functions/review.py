"""Scores and levels of matched chunks: variant scores, evidence, set overlap, licence review.

The reviews are cascades: each rule reads the score that the ones before left. ``Cascade`` keeps the
order in one place and makes one column of it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from graniteloom.functions.classify import licence_family
from graniteloom.functions.text import clean, let
from graniteloom.functions.tokens import DOMAIN_FAMILIES, GENERIC_CALLS, HIGH_SIGNAL_TERMS, TRAITS, call_tokens, domain_terms, families, identifier_term_set, lowered_tokens, semantic_terms

#: What each kind of evidence is called and worth, strongest first. Fixed values.
EVIDENCE = {
    "raw_hash": ("raw_hash_match", 0.99),
    "normalized_hash": ("normalized_hash_match", 0.95),
    "anonymized_hash": ("anonymized_hash_match", 0.92),
    "normalized_code": ("normalized_code_match", 0.6),
    "anonymized_code": ("anonymized_code_match", 0.58),
    "raw_code": ("raw_code_match", 0.56),
    "summary": ("structural_similarity", 0.22),
}
UNKNOWN_EVIDENCE = ("unknown", 0.25)
LEXICAL = ("raw_code_match", "normalized_code_match", "anonymized_code_match")
#: Scores from which a level holds. Fixed values.
LEVELS = (("critical", 0.95), ("high", 0.8), ("medium", 0.6))
LEVEL_RANK = {"critical": 0, "high": 1, "medium": 2, "low": 3, "same_repo": 4}
VISIBLE_LEVELS = ("critical", "high", "medium")


def level(score: Column) -> Column:
    out = None
    for name, least in LEVELS:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise("low")


def level_rank(name: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in LEVEL_RANK.items() for x in kv])[name], F.lit(99))


def variant_score(raw: Column, most: Column, rank: Column, priority: Column) -> Column:
    """Seven tenths of the share of the variant's best score, three of the rank's inverse (from 0), by priority."""
    share = (raw / most * 0.7 + 1.0 / (rank + 1) * 0.3) * F.greatest(priority, F.lit(1)) / 100.0
    return F.when((raw > 0) & (most > 0), share).otherwise(F.lit(0.0))


def evidence_type(name: Column) -> Column:
    """(type, base) of a variant's name."""
    made = lambda t, b: F.struct(F.lit(t).alias("type"), F.lit(b).alias("base"))
    out = None
    for key, (t, b) in EVIDENCE.items():
        out = F.when(name == key, made(t, b)) if out is None else out.when(name == key, made(t, b))
    return out.otherwise(made(*UNKNOWN_EVIDENCE))


def strongest(names: Column) -> Column:
    """The (type, base) worth most among variant names; of equals the first; none is unknown at 0."""
    zero = F.struct(F.lit("unknown").alias("type"), F.lit(0.0).alias("base"))
    return F.aggregate(names, zero, lambda best, n: F.when(evidence_type(n)["base"] > best["base"], evidence_type(n)).otherwise(best))


def cluster_key(raw: Column, normalized: Column, anonymized: Column, chunk: Column) -> Column:
    """The first hash that a chunk has, else the chunk itself."""
    part = lambda name, c: F.when(clean(c) != "", F.concat(F.lit(f"{name}:"), clean(c)))
    return F.coalesce(part("raw_hash", raw), part("normalized_hash", normalized), part("anonymized_hash", anonymized), F.concat(F.lit("chunk:"), clean(chunk)))


def _step(f, when: Column | None):
    return (lambda s: f(s)) if when is None else (lambda s: F.when(F.coalesce(when, F.lit(False)), f(s)).otherwise(s))


@dataclass
class Cascade:
    """A score and the rules applied to it, in order."""

    score: Column
    steps: list = field(default_factory=list)

    def add(self, amount: Column, when: Column | None = None) -> "Cascade":
        return self._then(lambda s: F.least(F.lit(1.0), s + amount), when)

    def cap(self, most: Column | float, when: Column | None = None) -> "Cascade":
        return self._then(lambda s: F.least(s, most if isinstance(most, Column) else F.lit(most)), when)

    def floor(self, least: Column, when: Column | None = None) -> "Cascade":
        return self._then(lambda s: F.greatest(s, least), when)

    def _then(self, f, when: Column | None) -> "Cascade":
        self.steps.append((f, when))
        return self

    def column(self) -> Column:
        """The score after all rules, each rule a step of one fold so that no expression is repeated."""
        out = F.array(self.score.cast("double"))
        for f, when in self.steps:
            out = F.transform(out, _step(f, when))
        return F.get(out, F.lit(0))


def _n(c: Column, most: int | None = None) -> Column:
    n = F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    return n if most is None else F.least(n, F.lit(most))


def _upto(c: Column, most: int) -> Column:
    return F.least(F.coalesce(c, F.lit(0)), F.lit(most))


def features(prefix: str = "", **c: Column) -> list[Column]:
    """Token sets of a chunk that overlaps are made of, each computed once per chunk.

    Columns by name: identifiers, calls, operators, symbol, path, code.
    """
    terms = semantic_terms(c["identifiers"], c["calls"], c["symbol"], c["path"], c["code"])
    both = let(terms, lambda ts: F.struct(families(ts, DOMAIN_FAMILIES).alias("families"), families(ts, TRAITS)["active"].alias("traits")))
    return [
        call_tokens(c["calls"]).alias(f"{prefix}calls"), call_tokens(c["calls"], generic=True).alias(f"{prefix}all_calls"),
        identifier_term_set(c["identifiers"], c["symbol"]).alias(f"{prefix}terms"), lowered_tokens(c["operators"]).alias(f"{prefix}operators"),
        domain_terms(c["identifiers"], c["calls"], c["symbol"]).alias(f"{prefix}domain"),
        both.alias(f"{prefix}semantic"),
    ]


def overlap(a: str, b: str) -> Column:
    """What two chunks' features (prefixes ``a`` and ``b``) have in common, as a struct."""
    both = lambda n: F.array_intersect(F.col(f"{a}{n}"), F.col(f"{b}{n}"))
    fa, fb = F.col(f"{a}semantic.families"), F.col(f"{b}semantic.families")
    traits = F.array_intersect(F.col(f"{a}semantic.traits"), F.col(f"{b}semantic.traits"))
    shared = F.array_sort(F.array_intersect(fa["active"], fb["active"]))
    generic = F.array(*[F.lit(g) for g in GENERIC_CALLS])
    calls, terms, operators = both("calls"), both("terms"), both("operators")
    return F.struct(
        F.size(calls).alias("calls"), F.size(terms).alias("identifiers"), F.size(operators).alias("operators"),
        F.size(F.array_intersect(both("all_calls"), generic)).alias("boilerplate"),
        F.array_sort(both("domain")).alias("domain"), F.array_sort(F.array_intersect(both("domain"), F.array(*[F.lit(t) for t in HIGH_SIGNAL_TERMS]))).alias("high_signal"),
        shared.alias("families"), ((F.size(fa["active"]) > 0) & (F.size(fb["active"]) > 0) & (F.size(shared) == 0)).alias("conflict"),
        fa["primary"].alias("source_primary"), fb["primary"].alias("candidate_primary"), F.array_sort(traits).alias("traits"),
        ((F.size(calls) > 0).cast("int") + (F.size(terms) > 0).cast("int") + (F.size(operators) > 0).cast("int")).alias("support"),
    )


def ranking_score(o: Column, strongest_type: Column, aggregate: Column) -> Column:
    """The aggregate score with bonuses for what is shared and penalties for weak or conflicting matches, to six places."""
    when = lambda c, w: F.when(c, F.lit(w)).otherwise(F.lit(0.0))
    anonymized = strongest_type == "anonymized_code_match"
    bonus = _n(o["domain"], 5) * 0.04 + _n(o["high_signal"], 4) * 0.09 + _n(o["families"], 2) * 0.12 + _upto(o["calls"], 3) * 0.04 + _upto(o["identifiers"], 5) * 0.03 + _upto(o["operators"], 6) * 0.04
    penalty = (
        when((o["boilerplate"] > 0) & (o["calls"] == 0), 0.12) + when(anonymized & (o["support"] < 2), 0.12) + when(anonymized & (_n(o["domain"]) == 0), 0.14)
        + when((_n(o["domain"]) == 0) & (_n(o["families"]) == 0) & (o["calls"] == 0) & (o["identifiers"] <= 1), 0.08)
        + when(o["conflict"] & (_n(o["traits"]) <= 1), 0.16) + when((o["candidate_primary"] == "config_setter") & (o["source_primary"] != "config_setter"), 0.2)
    )
    return F.round(aggregate + bonus - penalty, 6)


def rule_risk(kind: Column, base: Column, evidences: Column, aggregate: Column, o: Column, ranking: Column) -> Column:
    """The risk score of a rule-based match (unrounded), before it is told which repository it is from."""
    lexical, in_unit = kind.isin(list(LEXICAL)), F.least(F.greatest(aggregate, F.lit(0.0)), F.lit(1.0))
    supported = (_n(o["domain"]) > 0) | (_n(o["families"]) > 0) | ((o["operators"] >= 4) & (o["identifiers"] >= 3))
    semantic = (
        _n(o["domain"], 3) * 0.02 + _n(o["high_signal"], 4) * 0.025 + _n(o["families"], 2) * 0.05 + _n(o["traits"], 2) * 0.02 + _upto(o["operators"], 6) * 0.008
        + _upto(o["identifiers"], 4) * 0.004 + _upto(o["calls"], 2) * 0.02 + F.least(F.greatest(ranking - aggregate, F.lit(0.0)), F.lit(1.0)) * 0.12
    )
    no_call = F.least(F.lit(0.79), 0.68 + _n(o["high_signal"], 4) * 0.015 + _n(o["families"], 2) * 0.03 + _upto(o["operators"], 6) * 0.005 + _upto(o["identifiers"], 4) * 0.003)
    setter = (o["candidate_primary"] == "config_setter") & (o["source_primary"] != "config_setter")
    c = Cascade(F.least(F.lit(1.0), base + F.least(evidences, F.lit(4)) * 0.03 + in_unit * 0.1))
    c.cap(0.55, (kind == "anonymized_code_match") & (o["support"] < 2)).cap(0.35, kind == "structural_similarity").add(semantic, lexical).cap(0.55, lexical & ~supported)
    c.cap(F.when(_n(o["traits"]) >= 2, F.lit(0.68)).otherwise(F.lit(0.52)), lexical & o["conflict"]).cap(0.38, lexical & setter).cap(no_call, lexical & (o["calls"] == 0))
    return c.column()


def rule_review(kind: Column, base: Column, evidences: Column, aggregate: Column, o: Column, ranking: Column, same_repo: Column) -> Column:
    """(risk_score, risk_level) of a rule-based match."""
    risk = rule_risk(kind, base, evidences, aggregate, o, ranking)
    return F.when(same_repo, F.struct(F.lit(0.0).alias("risk_score"), F.lit("same_repo").alias("risk_level"))).otherwise(
        F.get(F.transform(F.array(risk), lambda r: F.struct(F.round(r, 4).alias("risk_score"), level(r).alias("risk_level"))), F.lit(0)))


def hybrid_review(fused: Column, by_rule: Column, by_knn: Column, kind: Column, base: Column, evidences: Column, o: Column, ranking: Column, spdx: Column) -> Column:
    """(risk_score, risk_level, evidence_type, license_family) of a fused match: support, licence, then caps by source and kind."""
    similarity = F.least(F.greatest(fused / 2.0, F.lit(0.0)), F.lit(1.0))
    start = F.round(rule_risk(kind, base, evidences, similarity, o, ranking), 4)
    both, knn_only, rule_only = by_rule & by_knn, by_knn & ~by_rule, by_rule & ~by_knn
    one = knn_only | rule_only
    by_vector = knn_only & (kind == "unknown")
    told = F.when(by_vector, F.lit("embedding_knn_match")).otherwise(kind)
    domain, fams, traits = _n(o["domain"]), _n(o["families"]), _n(o["traits"])
    support = _upto(o["support"], 3) * 0.04 + _upto(o["calls"], 2) * 0.03 + _upto(o["identifiers"], 6) * 0.008 + _upto(o["operators"], 6) * 0.008 + _n(o["families"], 2) * 0.05 + _n(o["traits"], 2) * 0.015
    near = 0.28 + similarity * 0.48 + _upto(o["support"], 3) * 0.05 + _upto(o["calls"], 2) * 0.04 + _upto(o["identifiers"], 6) * 0.01 + _upto(o["operators"], 6) * 0.01 + _n(o["domain"], 3) * 0.03 + _n(o["families"], 2) * 0.05 + _n(o["traits"], 2) * 0.02
    near = F.least(near, F.when(~o["conflict"], F.lit(0.82)).when(traits < 2, F.lit(0.58)).otherwise(F.lit(0.72)))
    licence = licence_family(spdx)
    c = Cascade(start).add(F.lit(0.1), both).cap(0.72, knn_only).add(support).add(licence["bonus"]).add(F.lit(0.03), clean(spdx) == "").floor(near, by_vector)
    c.cap(0.9, one & (told == "normalized_hash_match")).cap(0.82, one & (told == "anonymized_hash_match"))
    c.cap(0.55 + similarity * 0.5, one & told.isin("raw_code_match", "normalized_code_match")).cap(0.45 + similarity * 0.45, one & (told == "anonymized_code_match"))
    c.cap(0.35 + similarity * 0.35, one & (told == "structural_similarity")).cap(0.85, one & (told == "embedding_knn_match"))
    weak = rule_only & (told == "anonymized_code_match")
    c.cap(0.52, weak & (o["support"] < 2)).cap(0.58, weak & (o["support"] >= 2) & (domain == 0) & (fams == 0) & (o["calls"] == 0))
    c.cap(0.59, knn_only & (told == "embedding_knn_match") & (o["calls"] == 0) & (o["identifiers"] < 3))
    c.cap(0.59, both & (told == "anonymized_code_match") & (o["calls"] < 3) & (fams == 0))
    twin = (o["calls"] == 0) & (o["support"] < 2) & (domain == 0) & (told.isin("structural_similarity", "embedding_knn_match") | (fams > 0) | o["conflict"])
    c.cap(0.59, twin)
    setter = (o["candidate_primary"] == "config_setter") & (o["source_primary"] != "config_setter")
    c.cap(F.when(setter, F.lit(0.38)).when(traits >= 2, F.lit(0.68)).otherwise(F.lit(0.52)), (told != "raw_hash_match") & o["conflict"])
    return F.get(F.transform(F.array(c.column()), lambda r: F.struct(F.round(r, 4).alias("risk_score"), level(r).alias("risk_level"), told.alias("evidence_type"), licence["family"].alias("license_family"))), F.lit(0))


def keeps(risk_level: Column, kind: Column, o: Column, path: Column, symbol: Column, language: Column, same_repo: Column, include_same_repo: bool = False, include_low: bool = False) -> Column:
    """Whether a match is worth showing: not of the same repository, not low, not structural alone, not boilerplate alone, not minified."""
    keep = F.lit(True) if include_same_repo else ~same_repo
    if not include_low:
        boilerplate = (o["boilerplate"] > 0) & (o["calls"] == 0) & (o["identifiers"] == 0) & (_n(o["domain"]) == 0)
        weak = risk_level.isin("low", "same_repo") | (kind == "structural_similarity") | ((kind == "anonymized_code_match") & (o["support"] < 2)) | boilerplate
        keep = keep & ~weak & ~F.lower(clean(path)).contains(".min.js") & ~((F.length(clean(symbol)) <= 1) & (F.lower(clean(language)) == "javascript"))
    return keep


def reasons(kind: Column, o: Column, spdx: Column, name: Column) -> Column:
    """Why a match was found, in the order of the review."""
    first = (
        F.when(kind == "raw_hash_match", "Raw text is the same as the candidate's.")
        .when(kind.isin("normalized_hash_match", "anonymized_hash_match"), "Text is the same after normalisation or renaming.")
        .when(kind.isin(list(LEXICAL)), "Words overlap strongly; a person should look.")
        .otherwise("Structure is alike; weaker, still worth a look.")
    )
    licence = F.coalesce(F.when(clean(spdx) != "", clean(spdx)), F.when(clean(name) != "", clean(name)))
    second = F.when(licence.isNotNull(), F.concat(F.lit("Licence of the source: "), licence, F.lit("."))).otherwise("The source's licence is unknown; a person must look.")
    third = F.when(_n(o["domain"]) > 0, F.concat(F.lit("Shared interaction terms: "), F.array_join(o["domain"], ", "), F.lit("."))).when(_n(o["families"]) > 0, F.concat(F.lit("Shared families: "), F.array_join(o["families"], ", "), F.lit(".")))
    capped = F.when(kind.isin(list(LEXICAL)) & (o["calls"] == 0), F.lit("No call in common, so the risk stays below high."))
    return F.array_compact(F.array(first, second, third, capped))
