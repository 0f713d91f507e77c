"""Cutting files into chunks: functions and classes with tokens, signatures and anonymised code; line windows otherwise.

Python is parsed with the standard library and languages with braces are scanned (``braces``); others need a parser that is given (``parsers``),
and give line windows without.
Files are texts of one column, so this runs as ``mapInPandas`` over batches of files.
"""

from __future__ import annotations

import ast
import builtins
import hashlib
import io
import keyword
import re
import tokenize
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

VERSION = "chunker_v1"
IDENTIFIER_CAP, CALL_CAP, NODE_CAP = 64, 64, 64
LEAST_LINES, MOST_LINES = 3, 800
FLOW = {"If": "branch", "IfExp": "branch", "For": "loop", "AsyncFor": "loop", "While": "loop", "Try": "exception", "Raise": "exception", "With": "context", "AsyncWith": "context", "Return": "return", "Yield": "yield", "Await": "async", "Match": "branch"}
CATEGORIES = {"arguments": "params", **FLOW, "Call": "call", "Assign": "assign", "BinOp": "operator", "Compare": "compare", "ListComp": "comprehension", "DictComp": "comprehension", "SetComp": "comprehension"}
SIGNIFICANT = frozenset(CATEGORIES) | {"FunctionDef", "AsyncFunctionDef", "ClassDef", "Lambda", "BoolOp", "UnaryOp", "AugAssign", "AnnAssign", "Subscript", "Attribute", "Delete", "Global", "Assert"}
PRESERVED = frozenset(dir(builtins)) | frozenset(keyword.kwlist) | {"self", "cls"}


@dataclass
class Chunk:
    """A symbol of a file, or a window of its lines."""

    chunk_type: str
    symbol_name: str
    start_line: int
    end_line: int
    raw_code: str
    normalized_code: str
    anonymized_code: str
    validation_status: str = "valid"
    identifier_tokens: list[str] = field(default_factory=list)
    call_tokens: list[str] = field(default_factory=list)
    operator_tokens: list[str] = field(default_factory=list)
    control_flow_tags: list[str] = field(default_factory=list)
    ast_node_sequence: list[str] = field(default_factory=list)
    structure_signature: str = ""
    enclosing_class: str = ""


def without_comments(code: str) -> str:
    """Python code without comments, blanks collapsed outside of strings, no runs of empty lines."""
    out, at = [], (1, 0)
    lines = code.splitlines(keepends=True)
    try:
        for tok in tokenize.generate_tokens(io.StringIO(code).readline):
            if tok.type == tokenize.COMMENT:
                out.append(_between(lines, at, tok.start))
                at = tok.end
    except (tokenize.TokenError, IndentationError, SyntaxError):
        pass
    out.append(_between(lines, at, (len(lines) + 1, 0)))
    text = "\n".join(x.rstrip() for x in "".join(out).split("\n"))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def _between(lines: list[str], a: tuple[int, int], b: tuple[int, int]) -> str:
    if a[0] == b[0]:
        return lines[a[0] - 1][a[1] : b[1]]
    last = lines[b[0] - 1][: b[1]] if b[0] <= len(lines) else ""
    return (lines[a[0] - 1][a[1] :] if a[0] <= len(lines) else "") + "".join(lines[a[0] : b[0] - 1]) + last


def _distinct(values: Iterator[str] | list[str], cap: int) -> list[str]:
    return list(dict.fromkeys(v for v in values if v))[:cap]


def call_target(node: ast.Call) -> str:
    """A callee's dotted path; subscripts and calls inside it are left out."""
    parts, f = [], node.func
    while True:
        if isinstance(f, ast.Attribute):
            parts.append(f.attr)
            f = f.value
        elif isinstance(f, (ast.Subscript, ast.Await)):
            f = f.value
        elif isinstance(f, ast.Call):
            f = f.func
        else:
            break
    if isinstance(f, ast.Name):
        parts.append(f.id)
    return ".".join(reversed(parts))


def walk(node: ast.AST) -> Iterator[ast.AST]:
    """All nodes, parents before children, in source order."""
    yield node
    for child in ast.iter_child_nodes(node):
        yield from walk(child)


def local_symbols(node: ast.AST) -> dict[str, set[str]]:
    """Names that a symbol binds itself: parameters, variables, nested functions and classes; and what it imports."""
    found: dict[str, set[str]] = {"param": set(), "var": set(), "func": set(), "class": set(), "import": set()}
    for n in walk(node):
        if isinstance(n, ast.arg):
            found["param"].add(n.arg)
        elif isinstance(n, ast.Name) and isinstance(n.ctx, ast.Store):
            found["var"].add(n.id)
        elif isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)):
            found["func"].add(n.name)
        elif isinstance(n, ast.ClassDef):
            found["class"].add(n.name)
        elif isinstance(n, (ast.Import, ast.ImportFrom)):
            found["import"] |= {(a.asname or a.name).split(".")[0] for a in n.names}
        elif isinstance(n, ast.ExceptHandler) and n.name:
            found["var"].add(n.name)
    return found


def anonymize(code: str, node: ast.AST) -> tuple[str, str]:
    """(code, status): own names as ARG_n, VAR_n, FUNC_n and CLASS_n and strings as STR_n, by first occurrence.

    Members (after a dot), keyword arguments, builtins and imported names stay. If the code can't be read as tokens
    it stays as it is and says so.
    """
    own = local_symbols(node)
    kind = {}
    for k, prefix in (("var", "VAR"), ("param", "ARG"), ("func", "FUNC"), ("class", "CLASS")):
        kind |= {n: prefix for n in own[k]}
    kind = {n: p for n, p in kind.items() if n not in PRESERVED and n not in own["import"] and not n.startswith("__")}
    names: dict[str, str] = {}
    counts: dict[str, int] = {}

    def number(key: str, prefix: str) -> str:
        if key not in names:
            names[key] = f"{prefix}_{counts.get(prefix, 0)}"
            counts[prefix] = counts.get(prefix, 0) + 1
        return names[key]

    lines, out, at, before, depth = code.splitlines(keepends=True), [], (1, 0), "", 0
    try:
        toks = [t for t in tokenize.generate_tokens(io.StringIO(code).readline)]
    except (tokenize.TokenError, IndentationError, SyntaxError):
        return code, "fallback_normalized"
    for i, t in enumerate(toks):
        new = None
        if t.type == tokenize.OP:
            depth += (t.string in "([{") - (t.string in ")]}")
        elif t.type == tokenize.STRING:
            new = number(t.string, "STR")
        elif t.type == tokenize.NAME and t.string in kind and before != ".":
            following = next((x.string for x in toks[i + 1 : i + 2]), "")
            if not (depth and following == "=" and before in "(,"):
                new = number(f"name:{t.string}", kind[t.string])
        if new is not None:
            out += [_between(lines, at, t.start), new]
            at = t.end
        if t.type not in (tokenize.NL, tokenize.NEWLINE, tokenize.COMMENT):
            before = t.string
    out.append(_between(lines, at, (len(lines) + 1, 0)))
    return "".join(out), "valid"


def python_chunks(source: str) -> list[Chunk]:
    """Functions and classes of a Python file; a file with a syntax error has none."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError, RecursionError):
        return []
    lines, out = source.splitlines(), []

    def visit(node: ast.AST, owner: str) -> None:
        for n in ast.iter_child_nodes(node):
            if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                c = _chunk(n, lines, owner)
                if c is not None:
                    out.append(c)
                visit(n, n.name if isinstance(n, ast.ClassDef) else owner)
            else:
                visit(n, owner)

    visit(tree, "")
    return out


def _chunk(n, lines: list[str], owner: str) -> Chunk | None:
    start = min([n.lineno, *(d.lineno for d in n.decorator_list)])
    if not LEAST_LINES <= n.end_lineno - start + 1 <= MOST_LINES:
        return None
    indent = len(lines[start - 1]) - len(lines[start - 1].lstrip())
    raw = "\n".join(x[indent:] if not x[:indent].strip() else x for x in lines[start - 1 : n.end_lineno])
    plain = without_comments(raw)
    nodes = [type(x).__name__ for x in walk(n) if type(x).__name__ in SIGNIFICANT][:NODE_CAP]
    calls = [call_target(x) for x in walk(n) if isinstance(x, ast.Call)]
    names = [x.id if isinstance(x, ast.Name) else x.arg if isinstance(x, ast.arg) else x.attr for x in walk(n) if isinstance(x, (ast.Name, ast.arg, ast.Attribute))]
    kind = "class" if isinstance(n, ast.ClassDef) else "function"
    flow = _distinct([FLOW[x] for x in nodes if x in FLOW] + ["recursion"] * (n.name in calls), 16) or ["none"]
    operators = _distinct([t.string for t in _tokens(plain) if t.type == tokenize.OP and t.string not in "()[]{},:;.@" or t.string in ("and", "or", "not", "in", "is")], 64)
    hidden, status = anonymize(plain, n)
    shape = _distinct([CATEGORIES[x] for x in nodes if x in CATEGORIES], 5)
    return Chunk(kind, n.name, start, n.end_lineno, raw, plain, hidden, status, _distinct(names, IDENTIFIER_CAP), _distinct(calls, CALL_CAP), operators, flow, nodes, "|".join([kind, *shape]), owner)


def _tokens(code: str) -> list[tokenize.TokenInfo]:
    try:
        return list(tokenize.generate_tokens(io.StringIO(code).readline))
    except (tokenize.TokenError, IndentationError, SyntaxError):
        return []


def line_window_chunks(source: str, size: int = 80, overlap: int = 20) -> list[Chunk]:
    """Overlapping windows of lines."""
    lines, step, out, a = source.splitlines(), max(1, size - overlap), [], 0
    while a < len(lines):
        text = "\n".join(lines[a : a + size])
        out.append(Chunk("line_window", "", a + 1, min(a + size, len(lines)), text, text.strip(), text.strip()))
        if a + size >= len(lines):
            break
        a += step
    return out


def sha1(text: str) -> str:
    return hashlib.sha1(text.encode()).hexdigest()


SCHEMA = (
    "chunk_id string, repo_id string, file_path string, language string, chunk_type string, symbol_name string, start_line int, end_line int, raw_code string, normalized_code string, "
    "anonymized_code string, raw_hash string, normalized_hash string, anonymized_hash string, validation_status string, identifier_tokens array<string>, call_tokens array<string>, "
    "operator_tokens array<string>, control_flow_tags array<string>, ast_node_sequence array<string>, structure_signature string, enclosing_class string, chunker_version string"
)


def chunk_files(files: DataFrame, windows: bool = True, parsers: dict[str, Callable[[str], list[Chunk]]] | None = None) -> DataFrame:
    """Chunks of files (repo_id, file_path, language, text)."""
    from graniteloom.operators import braces  # builds on this module

    by_language = {"python": python_chunks, **braces.parsers(), **(parsers or {})}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.strip().split(" ")[0] for c in re.sub(r"<[^>]*>", "", SCHEMA).split(",")]
        for pdf in batches:
            out = []
            for repo, path, language, text in zip(pdf["repo_id"], pdf["file_path"], pdf["language"], pdf["text"], strict=True):
                text = text or ""
                found = by_language.get(language, lambda _: [])(text) or (line_window_chunks(text) if windows else [])
                for c in found:
                    key = sha1("|".join(map(str, (repo, path, c.chunk_type, c.start_line, c.end_line, c.symbol_name, VERSION))))
                    out.append((key, repo, path, language, c.chunk_type, c.symbol_name, c.start_line, c.end_line, c.raw_code, c.normalized_code, c.anonymized_code, sha1(c.raw_code), sha1(c.normalized_code), sha1(c.anonymized_code), c.validation_status, c.identifier_tokens, c.call_tokens, c.operator_tokens, c.control_flow_tags, c.ast_node_sequence, c.structure_signature, c.enclosing_class, VERSION))
            yield pd.DataFrame(out, columns=columns)

    return files.select("repo_id", "file_path", "language", "text").mapInPandas(run, SCHEMA)
