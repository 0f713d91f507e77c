"""Chunks of languages whose blocks stand in braces, by scanning tokens instead of parsing.

A file is cut into tokens once: comments, strings, names, numbers and signs. Every ``{`` outside of them is told by the tokens before it
(its header): a function has a name and a closed list of parameters, a class one of the language's words for types. A header without a name
(an inline callback) and a control statement give no chunk. Bodies that are one expression without braces give none either.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from graniteloom.operators import chunker
from graniteloom.operators.chunker import Chunk


@dataclass(frozen=True)
class Language:
    """What tells functions and classes of a language; ``member`` and ``loose``: bare ``name(...) {`` inside a class, or outside of functions."""

    types: frozenset[str]
    functions: frozenset[str] = frozenset()
    nameless: frozenset[str] = frozenset()
    member: bool = False
    loose: bool = False
    arrow: bool = False
    local: bool = False
    semicolons: bool = True
    nested_comments: bool = False
    hash_comments: bool = False
    backticks: bool = False
    triple: bool = False
    directives: bool = False
    slash_regex: bool = False


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


LANGUAGES = {
    "javascript": Language(_words("class"), _words("function"), member=True, arrow=True, semicolons=False, backticks=True, slash_regex=True),
    "typescript": Language(_words("class"), _words("function"), member=True, arrow=True, semicolons=False, backticks=True, slash_regex=True),
    "java": Language(_words("class record interface"), member=True, triple=True),
    "go": Language(_words("type"), _words("func"), semicolons=False, backticks=True),
    "rust": Language(_words("struct enum trait impl"), _words("fn"), nested_comments=True),
    "c": Language(frozenset(), loose=True, directives=True),
    "cpp": Language(frozenset(), loose=True, member=True, directives=True),
    "csharp": Language(_words("class struct interface"), member=True, local=True, directives=True),
    "php": Language(_words("class interface trait"), _words("function"), hash_comments=True),
    "swift": Language(_words("class struct protocol actor"), _words("func"), _words("init deinit"), semicolons=False, nested_comments=True, triple=True),
    "kotlin": Language(_words("class object interface"), _words("fun"), _words("constructor"), semicolons=False, nested_comments=True, triple=True),
    "scala": Language(_words("class object trait"), _words("def"), semicolons=False, nested_comments=True, triple=True),
}
CONTROL = {"if": "branch", "else": "branch", "switch": "branch", "match": "branch", "when": "branch", "case": "branch", "for": "loop", "while": "loop", "do": "loop", "loop": "loop", "foreach": "loop", "try": "exception", "catch": "exception", "finally": "exception", "throw": "exception", "return": "return", "yield": "yield", "await": "async"}
#: Words before a parenthesis that name no function, and words that are no identifiers.
NO_NAME = frozenset(CONTROL) | _words("new using lock synchronized with guard until elif select defer fixed unless sizeof typeof")
KEYWORDS = NO_NAME | _words("class struct enum trait impl interface record object protocol actor type function func fn fun def let const var val public private protected static final abstract async export default extends implements import package namespace void this self super null nil true false in of is as pub mut override where throws break continue")
OPEN, CLOSE = {"(": ")", "[": "]", "{": "}"}, {")", "]", "}"}
_SIGN = re.compile(r"=>|->|::|\?\.|\?\?|===|!==|==|!=|<=|>=|&&|\|\||\+\+|--|[-+*/%&|^]=|.", re.S)
_NAME = re.compile(r"[^\W\d][\w$]*|[$@][\w$]+")
_NUMBER = re.compile(r"\d[\w.]*")
_RAW_CPP = re.compile(r'R"([^()\\\s]{0,16})\(')
_RAW_RUST = re.compile(r'b?r(#*)"')
_CHARACTER = re.compile(r"'(\\.[^'\n]{0,8}|[^'\\\n])'")
_REGEX = re.compile(r"/(?![/*])(?:\\.|\[(?:\\.|[^\]\\\n])*\]|[^/\\\[\n])+/\w*")


@dataclass(frozen=True)
class Token:
    kind: str
    text: str
    start: int
    end: int


def _quoted(s: str, at: int, quote: str, lines: bool) -> int:
    """Where the string ends that ``quote`` opens at ``at``; a line end closes it unless ``lines``."""
    i = at + len(quote)
    while i < len(s):
        if s[i] == "\\":
            i += 2
        elif s.startswith(quote, i):
            return i + len(quote)
        elif s[i] == "\n" and not lines:
            return i
        else:
            i += 1
    return len(s)


def _comment(s: str, at: int, nested: bool) -> int:
    depth, i = 1, at + 2
    while depth and i < len(s):
        close, again = s.find("*/", i), s.find("/*", i) if nested else -1
        if close < 0:
            return len(s)
        if 0 <= again < close:
            depth, i = depth + 1, again + 2
        else:
            depth, i = depth - 1, close + 2
    return i


def _line_end(s: str, at: int) -> int:
    end = s.find("\n", at)
    return len(s) if end < 0 else end


def tokens(s: str, language: str) -> list[Token]:
    """All tokens of a file but blanks; what doesn't close runs to the end of its line or of the file."""
    lang, out, i, prior = LANGUAGES[language], [], 0, ""
    while i < len(s):
        c = s[i]
        if c.isspace():
            i += 1
            continue
        kind, end = "", i
        if s.startswith("//", i) or (lang.hash_comments and c == "#" and not s.startswith("#[", i)):
            kind, end = "comment", _line_end(s, i)
        elif s.startswith("/*", i):
            kind, end = "comment", _comment(s, i, lang.nested_comments)
        elif language == "php" and s.startswith(("<?php", "<?=", "?>"), i):
            kind, end = "directive", i + (5 if s.startswith("<?php", i) else 3 if s[i + 2 : i + 3] == "=" else 2)
        elif lang.directives and c == "#" and not s[s.rfind("\n", 0, i) + 1 : i].strip():
            end = _line_end(s, i)
            while end < len(s) and s[end - 1] == "\\":
                end = _line_end(s, end + 1)
            kind = "directive"
        elif lang.triple and s.startswith('"""', i):
            kind, end = "string", _quoted(s, i, '"""', True)
        elif language == "cpp" and (m := _RAW_CPP.match(s, i)):
            close = s.find(f'){m[1]}"', m.end())
            kind, end = "string", len(s) if close < 0 else close + len(m[1]) + 2
        elif language == "rust" and (m := _RAW_RUST.match(s, i)):
            close = s.find('"' + m[1], m.end())
            kind, end = "string", len(s) if close < 0 else close + 1 + len(m[1])
        elif language == "csharp" and s.startswith('@"', i):
            end = i + 2
            while end < len(s) and (s[end] != '"' or s.startswith('""', end)):
                end += 2 if s[end] == '"' else 1
            kind, end = "string", min(end + 1, len(s))
        elif c == '"':
            kind, end = "string", _quoted(s, i, '"', language in ("php", "rust"))
        elif c == "'" and language in ("javascript", "typescript", "php"):
            kind, end = "string", _quoted(s, i, "'", language == "php")
        elif c == "'" and (m := _CHARACTER.match(s, i)):
            kind, end = "string", m.end()
        elif c == "`" and lang.backticks:
            end = s.find("`", i + 1) + 1 or len(s) if language == "go" else _quoted(s, i, "`", True)
            kind = "string"
        elif c == "/" and lang.slash_regex and (not prior or prior in "(,=:[!&|?{};+-*%~^<>" or prior in ("return", "typeof", "case", "=>", "&&", "||", "===", "!==", "==", "!=")) and (m := _REGEX.match(s, i)):
            kind, end = "string", m.end()
        elif m := _NAME.match(s, i):
            kind, end = "name", m.end()
        elif m := _NUMBER.match(s, i):
            kind, end = "number", m.end()
        else:
            kind, end = "sign", _SIGN.match(s, i).end()
        out.append(Token(kind, s[i:end], i, end))
        if kind not in ("comment", "directive"):
            prior = s[i:end]
        i = end
    return out


def _matches(toks: list[Token]) -> dict[int, int]:
    """Places of brackets that belong together, both ways; what stands alone has no entry."""
    stack, pair = [], {}
    for i, t in enumerate(toks):
        if t.kind != "sign":
            continue
        if t.text in OPEN:
            stack.append(i)
        elif t.text in CLOSE:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if OPEN[toks[stack[d]].text] == t.text), None)
            if depth is not None:
                pair[stack[depth]], pair[i] = i, stack[depth]
                del stack[depth:]
    return pair


def _goes_on(toks: list[Token], pair: dict[int, int], i: int, out: list[int]) -> bool:
    """Whether a header runs on before a comma (in a list of types or of type parameters) or an import's closing brace."""
    if toks[i].text == "}":
        return i in pair and bool(out) and toks[out[-1]].text in (")", "=", "from")
    if toks[i].text != ",":
        return False
    depth, i = 0, i - 1
    while i >= 0 and toks[i].text not in ("(", ";", "{", "}"):
        if toks[i].text in ("extends", "implements", "where", ":", "throws", "with"):
            return True
        depth += (toks[i].text == ">") - (toks[i].text == "<")
        if depth < 0:
            return True
        i = pair[i] - 1 if toks[i].text in (")", "]") and i in pair else i - 1
    return False


def _header(toks: list[Token], pair: dict[int, int], brace: int) -> list[int]:
    """Places of the tokens before a brace back to what ends a statement; of brackets only the two ends."""
    out, i = [], brace - 1
    while i >= 0:
        t = toks[i]
        if t.text == ":" and i and toks[i - 1].text in ("public", "protected", "private"):  # a label of members
            break
        if t.kind == "sign" and (t.text in ("(", "[") or (t.text in ";{}," and not _goes_on(toks, pair, i, out))):
            break
        if t.text in (")", "]") and i in pair:
            out += [i, pair[i]]
            i = pair[i] - 1
        else:
            out.append(i)
            i -= 1
    return out[::-1]


def _told(toks: list[Token], pair: dict[int, int], brace: int, lang: Language, inside: str) -> tuple[str, str, int] | None:
    """(kind, name, place of the word that tells it) of a brace's header."""
    head = _header(toks, pair, brace)
    text = [toks[i].text for i in head]
    is_name = lambda j: 0 <= j < len(head) and toks[head[j]].kind == "name"
    # A word for functions with a name and parameters behind it, past a receiver and the like.
    for j, w in enumerate(text):
        if w in lang.functions and (j == 0 or text[j - 1] not in (".", "::")):
            k = j + 1
            if k < len(text) and text[k] in ("(",):
                k = k + 2 if lang.functions == {"func"} and not lang.triple else len(text)  # a receiver, or a function without a name
            while k < len(text) and text[k] in ("*", "&"):
                k += 1
            if is_name(k) and "(" in text[k + 1 :] or (is_name(k) and "def" in lang.functions):
                last = k
                while last + 2 < len(text) and text[last + 1] == "." and is_name(last + 2):  # a receiver's type before the name
                    last += 2
                return "function", text[last], head[j]
            # A function without a name takes that of what it is given to.
            if lang.arrow and j >= 2 and text[j - 1] in ("=", ":") and is_name(j - 2):
                return "function", text[j - 2], head[j - 2]
            return None
        if w in lang.nameless and (j == 0 or text[j - 1] != ".") and (w == "deinit" or "(" in text[j:]):
            return "function", w, head[j]
        if w in lang.types and (j == 0 or text[j - 1] not in (".", "::", "new")) and is_name(j + 1):
            if w == "class" and "interface" in text[:j]:
                continue
            if "func" in lang.functions and w == "type" and not {"struct", "interface"} & set(text[j:]):
                continue
            return "class", text[j + 1], head[j]
        if w == "impl" and w in lang.types and text[j + 1 : j + 2] == ["<"]:
            depth, k = 0, j + 1
            while k < len(text):
                depth += (text[k] == "<") - (text[k] == ">")
                k += 1
                if not depth:
                    break
            if is_name(k):
                return "class", text[k], head[j]
    if lang.arrow and text and text[-1] == "=>":
        for j in range(len(text) - 1):
            if text[j] in ("=", ":") and is_name(j - 1) and text[j - 1] not in KEYWORDS and "(" not in text[:j]:
                return "function", text[j - 1], head[j - 1]
            if text[j] == ":" and is_name(j - 1) and "=" in text[j:]:
                return "function", text[j - 1], head[j - 1]
        return None
    for j, w in enumerate(text):  # type parameters between a name and its list are left out
        if w == "(" and j and text[j - 1] == ">":
            k, depth = j - 1, 1
            while k > 0 and depth:
                k -= 1
                depth += (text[k] == ">") - (text[k] == "<")
            if not depth and is_name(k - 1):
                head, text = head[:k] + head[j:], text[:k] + text[j:]
            break
    opens = [j for j, w in enumerate(text) if w == "(" and is_name(j - 1) and not (j >= 2 and text[j - 2] == "@")]
    opens = [j for j in opens if not text[j - 1].startswith("@")]
    if not opens or any(w in ("=", "=>", "->") and j < opens[0] for j, w in enumerate(text)):
        return None
    j = opens[0]
    name = text[j - 1]
    if name in NO_NAME or name in KEYWORDS - {"this"} or (j >= 2 and text[j - 2] in (".", "new", "return")) or text[0] in CONTROL:
        return None
    typed = j >= 2 and (is_name(j - 2) and text[j - 2] not in NO_NAME or text[j - 2] in (">", "]", "*", "&", "?", "::"))
    bare = (lang.member and inside == "class") or (lang.loose and inside != "function" and (typed or inside == "")) or (lang.local and inside == "function" and typed)
    return ("function", name, head[j - 1]) if bare else None


def spans(source: str, language: str) -> list[tuple[str, str, int, int, str, list[Token]]]:
    """(kind, name, first line, last line, class around it, tokens) of the functions and classes of a file, in order."""
    lang = LANGUAGES[language]
    every = tokens(source, language)
    toks = [t for t in every if t.kind not in ("comment", "directive")]
    pair = _matches(toks)
    ends = [i for i, c in enumerate(source) if c == "\n"]
    line = lambda at: _bisect(ends, at) + 1
    lines = source.split("\n")
    around: list[tuple[int, str, str]] = []
    out = []
    for i, t in enumerate(toks):
        if t.kind != "sign" or t.text != "{" or i not in pair:
            continue
        while around and around[-1][0] < i:
            around.pop()
        inside = next((k for _, k, _ in reversed(around) if k), "")
        if lang.loose and lang.member and inside == "" and _names_type(toks, pair, i):
            around.append((pair[i], "class", _names_type(toks, pair, i)))
            continue
        told = _told(toks, pair, i, lang, inside)
        if told is None:
            around.append((pair[i], "", ""))
            continue
        kind, name, word = told
        head = _header(toks, pair, i)
        first = line(toks[head[0]].start if lang.semicolons else toks[word].start)
        while first > 1 and re.match(r"\s*(@\w|#\[)", lines[first - 2]):  # decorators and attributes on lines of their own
            first -= 1
        owner = next((n for _, k, n in reversed(around) if k == "class"), "")
        mine = [x for x in toks[head[0] if lang.semicolons else word : pair[i] + 1]]
        out.append((kind, name, first, line(toks[pair[i]].start), owner, mine))
        around.append((pair[i], kind, name))
    return out


def _names_type(toks: list[Token], pair: dict[int, int], brace: int) -> str:
    """The name of a class or struct whose members are functions of their own, though it is no chunk itself; ``''`` otherwise."""
    head = _header(toks, pair, brace)
    text = [toks[i].text for i in head]
    for j, w in enumerate(text[:-1]):
        if w in ("class", "struct") and "(" not in text[j:] and toks[head[j + 1]].kind == "name":
            return text[j + 1]
    return ""


def _bisect(ends: list[int], at: int) -> int:
    from bisect import bisect_left

    return bisect_left(ends, at)


def plain(code: str, language: str) -> str:
    """Code without comments, blanks at line ends and runs of empty lines."""
    out, at = [], 0
    for t in tokens(code, language):
        if t.kind == "comment":
            out.append(code[at : t.start])
            at = t.end
    text = "\n".join(x.rstrip() for x in ("".join(out) + code[at:]).split("\n"))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def hidden(code: str, language: str, function: str) -> str:
    """Code with the symbol's own name as FUNC_0 or CLASS_0, parameters and declared names as ARG_n and VAR_n and strings as STR_n; members stay."""
    toks = [t for t in tokens(code, language) if t.kind not in ("comment", "directive")]
    own = {n: p for n, p in _declared(toks).items() if n not in KEYWORDS}
    out, at, names, counts = [], 0, {}, {}
    for i, t in enumerate(toks):
        before = toks[i - 1].text if i else ""
        after = toks[i + 1].text if i + 1 < len(toks) else ""
        if t.kind == "string":
            prefix, key = "STR", f"s{t.text}"
        elif t.kind == "name" and t.text in own and before not in (".", "?.", "->", "::") and not (after == ":" and before in ("{", ",")):
            prefix, key = own[t.text], f"n{t.text}"
        elif t.kind == "name" and t.text == function and before not in (".", "?."):
            prefix, key = "FUNC", f"n{t.text}"
        else:
            continue
        if key not in names:
            names[key] = f"{prefix}_{counts.get(prefix, 0)}"
            counts[prefix] = counts.get(prefix, 0) + 1
        out += [code[at : t.start], names[key]]
        at = t.end
    return "".join(out) + code[at:]


def _declared(toks: list[Token]) -> dict[str, str]:
    """Names that a symbol binds: parameters of its first list, and what stands behind a word that declares or before ``:=``."""
    found: dict[str, str] = {}
    pair = _matches(toks)
    brace = next((i for i, t in enumerate(toks) if t.kind == "sign" and t.text == "{"), len(toks))
    last = [i for i in range(brace) if toks[i].text == "(" and i in pair and pair[i] < brace]
    if last:
        a = max(last, key=lambda i: pair[i] - i)
        run: list[str] = []
        for t in [*toks[a + 1 : pair[a]], Token("sign", ",", 0, 0)]:
            if t.text == ",":
                colon = run.index(":") if ":" in run else run.index("=") if "=" in run else None
                names = [x for x in (run[:colon] if colon is not None else run) if re.fullmatch(r"[^\W\d][\w$]*|\$\w+", x) and x not in KEYWORDS]
                if names:
                    found[names[-1]] = "ARG"
                run = []
            else:
                run.append(t.text)
    for i, t in enumerate(toks[:-1]):
        following = toks[i + 1]
        if t.text in ("let", "const", "var", "val", "mut") and following.kind == "name" and following.text != "mut":
            found.setdefault(following.text, "VAR")
        elif t.kind == "name" and following.text == ":" and i + 2 < len(toks) and toks[i + 2].text == "=":
            found.setdefault(t.text, "VAR")
        elif t.kind == "name" and following.text == "=" and i and toks[i - 1].kind == "name" and toks[i - 1].text not in KEYWORDS - {"void"}:
            found.setdefault(t.text, "VAR")
    return found


def _calls(toks: list[Token]) -> list[str]:
    """Dotted paths before a parenthesis, but for the symbol's own header and control words."""
    out = []
    body = next((i for i, t in enumerate(toks) if t.kind == "sign" and t.text == "{"), len(toks))
    for i in range(body, len(toks) - 1):
        if toks[i].kind == "name" and toks[i + 1].text == "(" and toks[i].text not in NO_NAME and toks[i - 1].text not in ("function", "func", "fn", "fun", "def"):
            path, j = [toks[i].text], i
            while j >= 2 and toks[j - 1].text in (".", "?.", "->", "::") and toks[j - 2].kind == "name":
                path.append(toks[j - 2].text)
                j -= 2
            out.append(".".join(reversed(path)))
    return out


def brace_chunks(source: str, language: str) -> list[Chunk]:
    """Functions and classes of a file in a language of ``LANGUAGES``; bounds on lines are those of Python files."""
    out, lines = [], source.split("\n")
    for kind, name, first, last, owner, mine in spans(source, language):
        if not chunker.LEAST_LINES <= last - first + 1 <= chunker.MOST_LINES:
            continue
        indent = len(lines[first - 1]) - len(lines[first - 1].lstrip())
        raw = "\n".join(x[indent:] if not x[:indent].strip() else x for x in lines[first - 1 : last])
        text = plain(raw, language)
        calls = _calls(mine)
        tags = [CONTROL[t.text] for t in mine if t.kind == "name" and t.text in CONTROL]
        flow = chunker._distinct(tags + ["recursion"] * (name in calls), 16) or ["none"]
        names = chunker._distinct([t.text for t in mine if t.kind == "name" and t.text not in KEYWORDS], chunker.IDENTIFIER_CAP)
        signs = chunker._distinct([t.text for t in mine if t.kind == "sign" and t.text not in "()[]{},:;.@"], 64)
        nodes = [kind, *(["params"] if kind == "function" else []), *tags][: chunker.NODE_CAP]
        shape = "|".join([kind, *chunker._distinct(nodes[1:], 5)])
        out.append(Chunk(kind, name, first, last, raw, text, hidden(text, language, name), "fallback_conservative", names, chunker._distinct(calls, chunker.CALL_CAP), signs, flow, nodes, shape, owner))
    return out


def parsers() -> dict[str, Callable[[str], list[Chunk]]]:
    """A chunker per language, for ``chunk_files``."""

    def one(language: str) -> Callable[[str], list[Chunk]]:
        return lambda source: brace_chunks(source, language)

    return {name: one(name) for name in LANGUAGES}
