"""PII by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers expand them.

Anchors are at-signs, schemes, identifier cues, plus signs and digits. From each, a deterministic
parser walks left and right over the characters that its kind allows and validates what it has:

* ``email``: local part left of the at-sign, dotted domain right of it;
* ``ip``: four dotted runs of digits, each at most 255;
* ``card``: 16 to 19 digits with single spaces or hyphens between, passing Luhn;
* ``phone``: a plus sign, then 8 to 15 digits with spaces, dots, hyphens and brackets;
* ``url``: a scheme and the address behind it; an address with a user before an at-sign is told too;
* ``account``: an identifier cue (``ssn``, ``iban``, ``account`` and the like), a colon, hash, equal sign or
  space, and a number of 6 digits at least; an IBAN must pass its checksum.

The first four are the base kinds and follow the patterns of ``BASE`` (leftmost, not overlapping,
no retries after a match that fails its check); the last two are what the method adds.

Places are code points, end exclusive. Defined cases: a null text is empty; one result row per input
row, whatever its id; an empty table gives an empty table; further columns are ignored; texts of
any length are read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graniteloom.llm.common import documents

#: Kinds in the order in which they are told; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("ssn", "social security", "iban", "account", "acct", "passport", "tax id", "customer id", "member id", "routing")

_LOCAL_CLASS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_URL = re.compile(r"[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]*[A-Za-z0-9_~/#=%-]")
_ACCOUNT = re.compile(r"(?:\s*(?:number|no\.?|nr\.?|#))?\s?[:#=]?\s?((?:[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)|[0-9](?:[\x20-]?[0-9]){5,17})(?![A-Za-z0-9])", re.IGNORECASE)
_WORD_BEFORE = re.compile(r"[A-Za-z0-9]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def iban_valid(s: str) -> bool:
    s = s.replace(" ", "").upper()
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digits_only(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def automaton():
    """Anchors: what is found decides which parser runs."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in ("@", "+", ".", *"0123456789", *SCHEMES, *CUES):
        a.add_word(word, word)
    a.make_automaton()
    return a


def emails(text: str, ats: list[int]) -> list[Span]:
    out, done = [], 0
    for at in ats:
        start = at
        while start > done and text[start - 1] in _LOCAL_CLASS:
            start -= 1
        if start == at:
            continue
        m = _DOMAIN.match(text, at + 1)
        if m:
            out.append((start, m.end()))
            done = m.end()
    return out


def _from_digits(text: str, runs: list[Span], pattern: re.Pattern, holds: Callable[[str], bool]) -> list[Span]:
    """Matches that start in runs of digits, leftmost first; a match that fails its check is used up all the same.

    A match must start where a run starts or where the last match ended inside it; when no match
    starts at a run's first digit none starts at a later one, as each pattern wants more to the right of a digit run's end.
    """
    out, done = [], 0
    for start, end in runs:
        at = max(start, done)
        while at < end:
            m = pattern.match(text, at)
            if not m:
                break
            if holds(m[0]):
                out.append(m.span())
            at = done = m.end()
    return out


def phones(text: str, pluses: list[int]) -> list[Span]:
    out, done = [], 0
    for p in pluses:
        if p >= done and (m := _PHONE.match(text, p)):
            if 8 <= len(_digits_only(m[0])) <= 15:
                out.append(m.span())
            done = m.end()
    return out


def urls(text: str, schemes: list[Span]) -> list[Span]:
    out, done = [], 0
    for start, end in schemes:
        if start >= done and (m := _URL.match(text, end)):
            out.append((start, m.end()))
            done = m.end()
    return out


def accounts(text: str, cues: list[Span]) -> list[Span]:
    out, done = [], 0
    for start, end in cues:
        if start and _WORD_BEFORE.match(text[start - 1]):
            continue
        m = _ACCOUNT.match(text, end)
        if m and m.start(1) >= done and (m[1][0].isdigit() or iban_valid(m[1])):
            out.append(m.span(1))
            done = m.end(1)
    return out


def find(text: str, anchors) -> dict[str, list[Span]]:
    """Spans of every kind in a text."""
    ats, pluses, digits, schemes, cues = [], [], [], [], []
    lower = text.lower()
    if len(lower) != len(text):  # a letter whose lower case is two characters: only A to Z are lowered then
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for last, word in anchors.iter(lower):
        if word == "@":
            ats.append(last)
        elif word == "+":
            pluses.append(last)
        elif "0" <= word[0] <= "9":
            if digits and digits[-1][1] == last:
                digits[-1] = (digits[-1][0], last + 1)
            else:
                digits.append((last, last + 1))
        elif word in _SCHEME_SET:
            schemes.append((last + 1 - len(word), last + 1))
        elif word in _CUE_SET:
            cues.append((last + 1 - len(word), last + 1))
    return {
        "email": emails(text, ats) if ats else [],
        "ip": _from_digits(text, digits, _IP, lambda s: all(len(p := q.lstrip("0") or "0") <= 3 and int(p) <= 255 for q in s.split("."))),
        "card": _from_digits(text, digits, _CARD, lambda s: 16 <= len(d := _digits_only(s)) <= 19 and luhn(d)),
        "phone": phones(text, pluses),
        "url": urls(text, sorted(schemes)),
        "account": accounts(text, sorted(cues)),
    }


_SCHEME_SET, _CUE_SET = frozenset(SCHEMES), frozenset(CUES)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors, cols = automaton(), list(KINDS)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in (b.slice(a, 500) for b in batches for a in range(0, max(b.num_rows, 1), 500)):
        found = [find(t.as_py() or "", anchors) for t in batch.column(batch.schema.get_field_index("_text"))]
        arrays = [pa.array([[{"start": s, "end": e} for s, e in f[k]] for f in found], type=kind) for k in cols]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(batch.num_columns - 1)] + arrays, names=batch.schema.names[:-1] + cols)


def scan(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``carry`` and, for every kind, an array of (start, end)."""
    rows = df.select(*[F.col(c) for c in carry], F.col(text_col).alias("_text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    spans = ", ".join(f"{k} array<struct<start:bigint,end:bigint>>" for k in KINDS)
    return rows.mapInArrow(_scan, f"{head}, {spans}" if head else spans)


def told(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by kind, then start, comma-joined."""

    def of(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))

    return F.array_join(F.concat(*[of(k) for k in kinds]), ",")


def op2_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of every document."""
    found = scan(documents(spark, sf_dir), carry=("doc_id",))
    n = {k: F.size(k).cast("long").alias(f"n_{k}") for k in KINDS}
    return found.select("doc_id", *[n[k] for k in KINDS[:4]], F.sha2(told(KINDS[:4]), 256).alias("base_sha256"), told(KINDS).alias("spans"), *[n[k] for k in KINDS[4:]])


def base_digest(text: str) -> str:
    """The digest of the base spans by the patterns alone, for tests."""
    checks = {
        "email": lambda s: True,
        "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 16 <= len(_digits_only(s)) <= 19 and luhn(_digits_only(s)),
        "phone": lambda s: 8 <= len(_digits_only(s)) <= 15,
    }
    told = [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text) if checks[k](m[0])]
    return hashlib.sha256(",".join(told).encode()).hexdigest()
