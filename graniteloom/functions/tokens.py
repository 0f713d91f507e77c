"""Terms and tokens of chunks, and the query variants that a chunk is expanded into."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from graniteloom.functions.text import clean, let, lowered, ordered_distinct

#: Terms and calls that say nothing of what a function does. Fixed values.
GENERIC_TERMS = "on handler this data event option value currenttarget dataset properties popup close open x".split()
GENERIC_CALLS = ("this.setdata", "setdata")
#: Words of touch and pointer interaction; those that weigh more; compounds that are looked for inside names. Fixed values.
INTERACTION_TERMS = (
    "touch touches changed target touchstart touchmove touchend swipe slide gesture drag threshold page pagex pagey client "
    "changedtouches targettouches clientx clienty start end move left right open close"
).split()
HIGH_SIGNAL_TERMS = "touch touches touchstart touchmove touchend swipe slide gesture drag threshold page pagex pagey changedtouches targettouches clientx clienty start end".split()
COMPOUND_TERMS = "touchstart touchmove touchend changedtouches targettouches pagex pagey clientx clienty".split()
#: Words of families of functions. Fixed values.
DOMAIN_FAMILIES = {
    "schema_generation": (
        "schema jsonschema openapi swagger nullable readonly writeonly deprecated enum default example minimum maximum pattern items properties "
        "additionalproperties required omitempty structfield format ref"
    ).split(),
    "orm_metadata": "orm modelinfo fieldinfo column dbtype relation foreignkey reverse m2m reltable relthrough ondelete dbcol fielder pk autonow autonowadd".split(),
    "protobuf_query_parsing": (
        "protobuf proto timestamp duration fieldmask wellknown bytesvalue stringvalue doublevalue int64value uint64value enumvaluemap messagename query parameter"
    ).split(),
    "openai_chat_wrapper": "openai chatcompletion toolcall functioncall toolchoice completion stream callbackmanager modelresult prompttokens completiontokens chatmessages".split(),
    "config_setter": "sessionvars session prefilter fallback retrain nprobe forceplan onoff parsepositiveint reindex setter config".split(),
}
#: Words of what a function does. Fixed values.
TRAITS = {
    "reflection": "reflect structfield fieldbyname kind elem valueof typeof struct ptr".split(),
    "tag_parsing": "tag lookup omitempty structtag json".split(),
    "schema_modeling": "schema properties items additionalproperties required nullable readonly writeonly deprecated enum format minimum maximum".split(),
    "typed_value_conversion": "parsefloat parseint parseuint parseduration type format fieldbyname value".split(),
    "openai_streaming": "openai chatcompletion stream toolcall callbackmanager completion messages".split(),
}
TOKEN_CAP = 16
#: The query variants of a chunk: name, family, priority, steps, cost. Fixed values.
VARIANTS = (
    ("raw_hash", "exact", 100, "", "low"),
    ("raw_code", "exact", 90, "", "medium"),
    ("normalized_hash", "normalized", 85, "normalize_code", "low"),
    ("anonymized_hash", "normalized", 85, "normalize_code,anonymize_identifiers", "low"),
    ("normalized_code", "normalized", 80, "normalize_code", "medium"),
    ("anonymized_code", "normalized", 80, "normalize_code,anonymize_identifiers", "medium"),
    ("summary", "structural", 70, "structure_summary", "low"),
)



def _list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _each(values: Column, f) -> Column:
    return F.array_distinct(F.flatten(F.transform(_list(values), f)))


def identifier_terms(value: Column) -> Column:
    """Lower-case parts of a name, split at case changes, digits and signs, without the generic ones."""
    raw = F.regexp_replace(clean(value), "[.-]", "_")
    found = F.regexp_extract_all(raw, F.lit("([A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+)"), F.lit(1))
    parts = let(found, lambda ps: F.when(F.size(ps) > 0, ps).when(clean(value) != "", F.array(clean(value))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.filter(F.transform(parts, F.lower), lambda t: ~t.isin(GENERIC_TERMS)))


def compact(value: Column) -> Column:
    return F.regexp_replace(F.lower(clean(value)), "[^a-z0-9]+", "")


def term_variants(value: Column) -> Column:
    """Parts of a name and, from three characters on, the name run together."""
    whole = let(compact(value), lambda w: F.when(F.length(w) >= 3, F.array(w)).otherwise(F.array().cast("array<string>")))
    return F.array_union(identifier_terms(value), whole)


def identifier_term_set(identifiers: Column, symbol: Column) -> Column:
    return F.array_union(_each(identifiers, identifier_terms), identifier_terms(symbol))


def lowered_tokens(tokens: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(_list(tokens), lowered), lambda t: t != ""))


def call_tokens(calls: Column, generic: bool = False) -> Column:
    out = lowered_tokens(calls)
    return out if generic else F.filter(out, lambda t: ~t.isin(list(GENERIC_CALLS)))


def domain_terms(identifiers: Column, calls: Column, symbol: Column) -> Column:
    """Interaction words among the terms, and compounds found inside names and calls."""
    plain = F.filter(identifier_term_set(identifiers, symbol), lambda t: t.isin(INTERACTION_TERMS))
    joined = F.transform(F.concat(_list(identifiers), _list(calls), F.array(symbol)), compact)
    compounds = let(joined, lambda js: F.filter(F.array(*[F.lit(k) for k in COMPOUND_TERMS]), lambda k: F.exists(js, lambda x: x.contains(k))))
    return F.array_union(plain, compounds)


def semantic_terms(identifiers: Column, calls: Column, symbol: Column, path: Column, code: Column) -> Column:
    """Terms of all names, of the path's parts and of every word of the code."""
    words = F.regexp_extract_all(clean(code), F.lit("([A-Za-z_][A-Za-z0-9_]*)"), F.lit(1))
    parts = F.concat(_list(identifiers), _list(calls), F.array(symbol), F.split(clean(path), "[^A-Za-z0-9_]+"), F.array_distinct(words))
    return _each(parts, term_variants)


def families(terms: Column, words: dict[str, list[str]]) -> Column:
    """(active, primary): families with two words at least, and of these the one with most (the later name on ties)."""
    def of(ts: Column) -> Column:
        counts = F.array(*[F.struct(F.size(F.array_intersect(ts, F.array(*[F.lit(w) for w in ws]))).alias("n"), F.lit(name).alias("name")) for name, ws in words.items()])
        told = lambda active: F.struct(F.array_sort(F.transform(active, lambda x: x["name"])).alias("active"), F.coalesce(F.array_max(active)["name"], F.lit("")).alias("primary"))
        return let(F.filter(counts, lambda x: x["n"] >= 2), told)

    return let(terms, of)


def variant_id(chunk: Column, family: Column, name: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.when(clean(chunk) != "", clean(chunk)), F.lit("unknown_chunk")), family, name)


def variant_name(variant: Column) -> Column:
    return F.regexp_replace(clean(variant), "^.*:", "")


def query_variants(chunk: Column, **fields: Column) -> Column:
    """The variants of a chunk as an array of (variant_id, family, name, priority, steps, cost, text).

    ``fields`` are the chunk's hashes and codes by name; ``summary`` is the structural payload (JSON). A field that is empty gives none.
    """
    rows = []
    for name, family, priority, steps, cost in VARIANTS:
        if name in fields:
            text = clean(fields[name])
            rows.append(F.when(text != "", F.struct(variant_id(chunk, F.lit(family), F.lit(name)).alias("variant_id"), F.lit(family).alias("family"), F.lit(name).alias("name"), F.lit(priority).alias("priority"), F.lit(steps).alias("steps"), F.lit(cost).alias("cost"), text.alias("text"))))
    return F.array_compact(F.array(*rows))


def structural_payload(chunk_type: Column, symbol_type: Column, signature: Column, flow: Column, calls: Column, identifiers: Column, operators: Column, nodes: Column, cap: int = TOKEN_CAP) -> Column:
    """JSON of what a chunk's structure says, lists cut to ``cap``, empty fields left out."""
    lists = {"control_flow_tags": flow, "call_tokens": calls, "identifier_tokens": identifiers, "operator_tokens": operators, "ast_node_sequence": nodes}
    texts = {"chunk_type": chunk_type, "symbol_type": symbol_type, "structure_signature": signature}
    fields = [F.when(clean(c) != "", clean(c)).alias(n) for n, c in texts.items()]
    fields += [F.when(F.size(ordered_distinct(c, cap)) > 0, ordered_distinct(c, cap)).alias(n) for n, c in lists.items()]
    out = F.to_json(F.struct(*fields))
    return F.when(out != "{}", out)
