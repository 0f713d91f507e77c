"""Classification of files, sizes, paths, licences, timestamps and repositories, as column programs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from graniteloom.functions.text import clean, lines, lowered, strip
from graniteloom.functions.urls import is_workflow, plain_path

#: Language by file extension. Fixed values.
LANGUAGES = {
    "python": [".py"],
    "javascript": [".js", ".jsx"],
    "typescript": [".ts", ".tsx"],
    "java": [".java"],
    "go": [".go"],
    "rust": [".rs"],
    "c": [".c", ".h"],
    "cpp": [".cc", ".cpp", ".cxx"],
    "csharp": [".cs"],
    "php": [".php"],
    "ruby": [".rb"],
    "swift": [".swift"],
    "kotlin": [".kt", ".kts"],
    "scala": [".scala"],
    "shell": [".sh", ".bash", ".zsh"],
    "sql": [".sql"],
}
#: Code files known by name; licence files; configuration and document extensions. Fixed values.
CODE_NAMES = {"dockerfile": "dockerfile", "makefile": "makefile", "cmakelists.txt": "cmake", "build.gradle": "gradle"}
LICENCE_NAMES = ("license", "license.txt", "license.md", "copying", "copying.txt", "copying.md", "notice", "notice.txt", "notice.md")
CONFIG_EXTENSIONS = (".json", ".yaml", ".yml", ".toml", ".ini", ".cfg", ".conf", ".env")
DOCUMENT_EXTENSIONS = (".md", ".rst", ".txt")
#: Directories that a walk of a snapshot leaves out. Fixed values.
IGNORED_DIRECTORIES = (".git", ".hg", ".svn", ".idea", ".vscode", "__pycache__", ".mypy_cache", ".pytest_cache", "node_modules", "vendor", "dist", "build", "target", ".venv", "venv")
#: Directories and file endings of tests. Fixed values.
TEST_DIRECTORIES = ("test", "tests", "spec", "specs", "__tests__", "__mocks__")
TEST_ENDINGS = (
    *(f".{kind}.{ext}" for kind in ("test", "spec") for ext in ("js", "jsx", "ts", "tsx")),
    *(f"_test.{ext}" for ext in ("py", "rb", "go", "rs", "java", "cpp", "cc", "cxx", "cs", "php", "sh")),
)
#: Dependency manifests by name. Fixed values.
MANIFESTS = (
    "requirements.txt pyproject.toml setup.py setup.cfg Pipfile Pipfile.lock poetry.lock package.json pnpm-workspace.yaml "
    "go.mod go.work Cargo.toml Cargo.lock pom.xml build.gradle build.gradle.kts settings.gradle settings.gradle.kts Gemfile gems.rb "
    "composer.json mix.exs deps.edn .gitmodules WORKSPACE WORKSPACE.bazel MODULE.bazel"
).split()
#: Markers of licence families, in the order in which they are tried, with their weights. Fixed values.
LICENCE_FAMILIES = (
    ("strong_copyleft", 0.18, ("AGPL", "GPL", "SSPL", "BUSL", "CPAL")),
    ("weak_copyleft", 0.12, ("LGPL", "MPL", "EPL", "CDDL")),
    ("notice", 0.08, ("APACHE", "MIT", "BSD", "ISC", "ARTISTIC", "ZLIB")),
    ("public_domain", 0.02, ("UNLICENSE", "CC0", "0BSD")),
)
#: Marks of files that programs make; sizes from which a repository is large. Fixed values.
GENERATED_MARKERS = ("auto-generated", "autogenerated", "generated by", "generated file", "do not edit")
WHALE_KB, GIANT_KB = 50_000, 200_000
WHALE_BYTES, WHALE_FILES = 25 * 1024 * 1024, 500


def file_name(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(F.coalesce(path, F.lit("")), "/+$", ""), "/"), -1)


def extension(path: Column) -> Column:
    """The last suffix with its dot, lower case; a name's leading dot starts no suffix."""
    return F.regexp_extract(F.lower(file_name(path)), r"^.+(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def file_class(path: Column) -> Column:
    """(language, is_code, is_license, category) of a path: licence, special name, extension, configuration, document, else text."""
    name, ext = F.lower(file_name(path)), extension(path)
    made = lambda language, code, licence, category: F.struct(language.alias("language"), F.lit(code).alias("is_code"), F.lit(licence).alias("is_license"), F.lit(category).alias("category"))
    by_ext = F.create_map(*[F.lit(x) for lang, exts in LANGUAGES.items() for e in exts for x in (e, lang)])
    by_name = F.create_map(*[F.lit(x) for kv in CODE_NAMES.items() for x in kv])
    return (
        F.when(name.isin(list(LICENCE_NAMES)) | name.startswith("license"), made(F.lit("license"), False, True, "license"))
        .when(F.get(F.array(by_name[name]), F.lit(0)).isNotNull(), made(by_name[name], True, False, "code"))
        .when(by_ext[ext].isNotNull(), made(by_ext[ext], True, False, "code"))
        .when(ext.isin(list(CONFIG_EXTENSIONS)), made(F.lit("config"), False, False, "config"))
        .when(ext.isin(list(DOCUMENT_EXTENSIONS)), made(F.lit("document"), False, False, "document"))
        .otherwise(made(F.lit("unknown"), False, False, "text"))
    )


def in_ignored_directory(path: Column) -> Column:
    parts = F.split(F.coalesce(path, F.lit("")), "/")
    return F.exists(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: p.isin(list(IGNORED_DIRECTORIES)))


def is_binary(content: Column) -> Column:
    """Whether bytes hold a NUL."""
    return F.coalesce(F.hex(content).rlike("^(?:..)*?00"), F.lit(False))


def is_test_path(path: Column) -> Column:
    p = F.lower(strip(F.coalesce(path, F.lit(""))))
    parts, name, base = F.split(p, "/"), file_name(p), stem(p)
    in_dir = F.exists(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda x: x.isin(list(TEST_DIRECTORIES)))
    named = name.rlike(r"^(test|spec)\.") | base.rlike("^(test|spec)_") | base.isin("test", "tests", "spec", "specs")
    ends = name.rlike("(" + "|".join(e.replace(".", r"\.") for e in TEST_ENDINGS) + ")$")
    return (p != "") & (in_dir | named | ends)


def is_manifest(path: Column) -> Column:
    return file_name(plain_path(path)).isin(list(MANIFESTS)) | is_workflow(path)


def manifest_score(path: Column) -> Column:
    """(depth plus penalties, length, path): near the root and outside of vendored or built trees first."""
    p = plain_path(path)
    depth = F.greatest(F.lit(0), F.size(F.filter(F.split(p, "/"), lambda x: x != "")) - 1)
    cost = sum((F.when(F.lower(p).contains(d), F.lit(n)).otherwise(F.lit(0)) for d, n in (("vendor/", 4), ("node_modules/", 6), ("dist/", 2), ("build/", 2))), F.lit(0))
    return F.struct((depth + cost).alias("score"), F.length(p).alias("length"), p.alias("path"))


def size_kb(value: Column) -> Column:
    """A whole number of at least 0, else 0."""
    return F.greatest(F.coalesce(value.try_cast("bigint"), F.lit(0)), F.lit(0)).cast("bigint")


def size_tier(kb: Column, whale: int = WHALE_KB, giant: int = GIANT_KB) -> Column:
    n = size_kb(kb)
    return F.when(n >= giant, "giant_hint").when(n >= whale, "whale_hint").otherwise("normal")


def size_tier_rank(tier: Column) -> Column:
    t = lowered(tier)
    return F.when(t == "giant_hint", 2).when(t == "whale_hint", 1).otherwise(0)


def is_whale(code_bytes: Column, code_files: Column) -> Column:
    return (size_kb(code_bytes) >= WHALE_BYTES) | (size_kb(code_files) >= WHALE_FILES)


def chunk_phase(value: Column, default: str = "light") -> Column:
    v = lowered(value)
    return F.when(v.isin("light", "whale"), v).otherwise(F.lit(default))


def utc(value: Column) -> Column:
    """A timestamp of an ISO text; without a zone it is UTC; unreadable is null."""
    v = strip(value.cast("string"))
    zoned = v.rlike(r"(?i)(z|[+-]\d{2}:?\d{2})$")
    return F.try_to_timestamp(F.when(zoned, v).otherwise(F.concat(v, F.lit("+00:00"))))


def is_stale(value: Column, now: Column, seconds: int) -> Column:
    """Whether a lease has run out; what can't be read has."""
    return F.coalesce(F.unix_timestamp(now) - F.unix_timestamp(value) >= max(1, int(seconds)), F.lit(True))


def is_newer(current: Column, previous: Column) -> Column:
    """Later than before; no current time is not, no previous one is."""
    return F.coalesce(F.when(current.isNull(), F.lit(False)).when(previous.isNull(), F.lit(True)).otherwise(current > previous), F.lit(False))


def skip_by_interval(last_success: Column, now: Column, minutes: int) -> Column:
    """Whether the last success is less than so many minutes ago."""
    return F.lit(False) if minutes <= 0 else F.coalesce(F.unix_timestamp(now) - F.unix_timestamp(last_success) < 60 * minutes, F.lit(False))


def incremental_since(pushed: Column, updated: Column, success: Column, overlap_days: int) -> Column:
    """The date to ask from: the first known of the three, less an overlap."""
    return F.date_format(F.date_sub(F.coalesce(pushed, updated, success).cast("date"), max(0, overlap_days)), "yyyy-MM-dd")


def has_time_qualifier(query: Column) -> Column:
    return F.lower(F.coalesce(query, F.lit(""))).rlike(r"\b(pushed|updated|created):")


def with_since(query: Column, since: Column) -> Column:
    """The query with a ``pushed`` qualifier, unless it has one or no date is known."""
    q = F.coalesce(query, F.lit(""))
    return F.when(since.isNull() | has_time_qualifier(q), q).otherwise(strip(F.concat(q, F.lit(" pushed:>="), since)))


def licence_family(spdx: Column, strict: bool = False) -> Column:
    """(bonus, family). Families are tried in order, by substring; ``strict`` tries the names that hold another's first."""
    v = F.upper(clean(spdx))
    row = lambda bonus, name: F.struct(F.lit(bonus).alias("bonus"), F.lit(name).alias("family"))
    out = F.when(v == "", row(0.05, "unknown"))
    if strict:
        out = out.when(v.contains("0BSD"), row(0.02, "public_domain")).when(v.contains("LGPL"), row(0.12, "weak_copyleft"))
    for name, bonus, markers in LICENCE_FAMILIES:
        out = out.when(v.rlike("|".join(markers)), row(bonus, name))
    return out.otherwise(row(0.06, "other"))


def qualification(missing: Column, private: Column, archived: Column, licence: Column, fork: Column, branch: Column, stars: Column, updated: Column) -> Column:
    """(qualified, reason, score) of a repository's metadata."""
    yes = lambda c: F.coalesce(c.cast("boolean"), F.lit(False))
    has = lambda c: clean(c) != ""
    add = lambda c, w: F.when(c, F.lit(w)).otherwise(F.lit(0.0))
    n = F.coalesce(stars.cast("bigint"), F.lit(0))
    score = add(has(licence), 0.35) + add(~yes(fork), 0.20) + add(has(branch), 0.15) + F.when(n >= 1000, 0.20).when(n >= 100, 0.10).when(n >= 10, 0.05).otherwise(0.0) + add(has(updated), 0.10)
    reason = F.when(yes(missing), "repo_not_found").when(yes(private), "private_repo").when(yes(archived), "archived_repo").otherwise("qualified")
    return F.struct((reason == "qualified").alias("qualified"), reason.alias("reason"), F.when(reason == "qualified", F.round(score, 4)).otherwise(F.lit(0.0)).alias("score"))


def is_generated(code: Column) -> Column:
    """Whether one of the first five lines says that the file is made by a program."""
    return F.lower(F.array_join(F.slice(lines(code), 1, 5), "\n")).rlike("|".join(GENERATED_MARKERS))


def code_line_count(code: Column) -> Column:
    return F.size(F.filter(lines(code), lambda x: strip(x) != ""))


def line_span(start: Column, end: Column) -> Column:
    return F.when((start > 0) & (end >= start), end - start + 1).otherwise(F.lit(0)).cast("int")


def is_source_chunk(chunk_type: Column, start: Column, end: Column) -> Column:
    """Functions and classes of ten lines at least."""
    return lowered(chunk_type).isin("function", "class") & (line_span(start, end) >= 10)


def source_chunk_score(chunk_type: Column, symbol: Column, status: Column, calls: Column, operators: Column, identifiers: Column, start: Column, end: Column) -> Column:
    """How much a chunk is worth asking about."""
    add = lambda c, w: F.when(F.coalesce(c, F.lit(False)), F.lit(w)).otherwise(F.lit(0))
    n = lambda a: F.greatest(F.coalesce(F.size(a), F.lit(0)), F.lit(0))
    kind = lowered(chunk_type)
    return (
        add(kind == "function", 100) + add(kind == "class", 20) + add(clean(symbol) != "", 30) + add(lowered(status) == "valid", 10)
        + add(n(calls) > 0, 10) + add(n(operators) > 0, 5) + F.least(n(identifiers), F.lit(10)) + F.least(line_span(start, end), F.lit(120))
    )
