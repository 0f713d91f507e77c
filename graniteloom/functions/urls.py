"""Repository references: finding, cleaning and canonicalising them; identities made of them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from graniteloom.functions.text import clean, ordered_distinct, sha1_text, stable_digest, strip

#: Patterns of repository references, in the order in which they are tried. Fixed values.
REFERENCES = (
    r"(?:git\+)?https?://github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+(?:\.git)?",
    r"git@github\.com:[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+(?:\.git)?",
    r"github:[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+",
    r"github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+",
)
#: Hosts that a canonical reference may name. Fixed values.
HOSTS = ("github.com", "www.github.com")
OWNER, REPO = r"^[A-Za-z0-9][A-Za-z0-9-]{0,38}$", r"^[A-Za-z0-9._-]{1,100}$"
NPM_SECTIONS = ("dependencies", "devDependencies", "peerDependencies", "optionalDependencies", "overrides")


def https_style(url: Column, host: str = "github.com") -> Column:
    """``github:``, ``git+``, ``git@``, ``ssh://`` and ``git://`` forms as https."""
    u = strip(url)
    u = F.regexp_replace(u, "^github:", f"https://{host}/")
    u = F.regexp_replace(u, r"^git\+", "")
    u = F.regexp_replace(u, f"^git@{host}:", f"https://{host}/")
    u = F.regexp_replace(u, f"^ssh://git@{host}/", f"https://{host}/")
    return F.regexp_replace(u, f"^git://{host}/", f"https://{host}/")


def canonical(url: Column, hosts: tuple[str, ...] = HOSTS) -> Column:
    """(owner, repo, url) of a repository reference, null if it isn't one. Letter case is kept."""
    u = https_style(url, hosts[0])
    part = lambda k: F.regexp_extract(u, r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)", k)
    path = F.regexp_replace(F.regexp_replace(part(3), "^/+|/+$", ""), r"\.git$", "")
    owner, repo = F.get(F.split(path, "/"), F.lit(0)), F.get(F.split(path, "/"), F.lit(1))
    ok = F.lower(part(2)).isin(list(hosts)) & F.lower(part(1)).isin("", "http", "https") & owner.rlike(OWNER) & repo.rlike(REPO)
    return F.when(F.coalesce(ok, F.lit(False)), F.struct(owner.alias("owner"), repo.alias("repo"), F.concat(F.lit(f"https://{hosts[0]}/"), owner, F.lit("/"), repo).alias("url")))


def clean_reference(c: Column) -> Column:
    """A found reference without brackets, quotes, closing punctuation, fragment and query, with a scheme."""
    v = F.regexp_replace(strip(c), r"""^[()\[\]{}<>'"]+|[()\[\]{}<>'"]+$""", "")
    v = F.regexp_replace(v, "[.,:;]+$", "")
    v = F.regexp_replace(v, "[#?].*$", "")
    return F.when(v.startswith("github.com/"), F.concat(F.lit("https://"), v)).otherwise(v)


def references(text: Column) -> Column:
    """All repository references of a text, by pattern, each once."""
    t = F.coalesce(text, F.lit(""))
    found = F.concat(*[F.regexp_extract_all(t, F.lit(f"({p})"), F.lit(1)) for p in REFERENCES])
    return F.array_distinct(F.filter(F.transform(found, clean_reference), lambda v: v != ""))


def npm_shorthand(c: Column) -> Column:
    """``owner/repo`` or ``github:owner/repo#ref`` as a URL, else null."""
    v = strip(F.regexp_replace(F.regexp_replace(c, "^github:", ""), "#.*$", ""))
    return F.when(v.rlike("^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+$"), F.concat(F.lit("https://github.com/"), v))


def npm_references(manifest: Column) -> Column:
    """Shorthands among the versions that a package.json's dependency sections give."""
    values = [F.map_values(F.from_json(F.get_json_object(manifest, f"$.{s}"), "map<string,string>")) for s in NPM_SECTIONS]
    return F.filter(F.flatten(F.array_compact(F.array(*[F.transform(v, npm_shorthand) for v in values]))), lambda v: v.isNotNull())


def workflow_references(manifest: Column) -> Column:
    """Repositories that a workflow ``uses``."""
    found = F.regexp_extract_all(F.coalesce(manifest, F.lit("")), F.lit(r"(?mi)^\s*uses:\s*([A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+)@"), F.lit(1))
    return F.transform(found, lambda v: F.concat(F.lit("https://github.com/"), v))


def plain_path(path: Column) -> Column:
    """A path without leading dots and slashes."""
    return F.regexp_replace(clean(path), "^[./]+", "")


def is_workflow(path: Column) -> Column:
    return F.lower(strip(path)).rlike(r"^(?:\./)*\.?/?\.?github/workflows/.*\.ya?ml$")


def manifest_references(path: Column, text: Column) -> Column:
    """References of a dependency manifest: any, and by kind of file npm shorthands or workflow uses."""
    name = F.element_at(F.split(F.coalesce(path, F.lit("")), "/"), -1)
    none = F.array().cast("array<string>")
    extra = F.when(name == "package.json", F.coalesce(npm_references(text), none)).when(is_workflow(path), workflow_references(text)).otherwise(none)
    return F.array_distinct(F.concat(references(text), extra))


def module_path_url(path: Column) -> Column:
    """A Go module path whose first part is a dotted host, as a repository URL."""
    p = F.split(clean(path), "/")
    ok = (F.size(p) >= 3) & F.get(p, F.lit(0)).contains(".")
    return F.when(ok, F.concat(F.lit("https://"), F.array_join(F.slice(p, 1, 3), "/")))


def owner_repo_url(value: Column) -> Column:
    """``owner/repo``, ``github.com/...`` or a URL as a URL; else null."""
    v = clean(value)
    return (
        F.when(v.rlike("^https?://"), v).when(v.startswith("github.com/"), F.concat(F.lit("https://"), v))
        .when(v.rlike("^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+$"), F.concat(F.lit("https://github.com/"), v))
    )


def links(html: Column) -> Column:
    """Targets of a page's links, each once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?i)href\s*=\s*["']([^"'#]+)["']"""), F.lit(1)))


def repo_id(owner: Column, repo: Column) -> Column:
    return F.concat(F.lit("github:"), F.lower(strip(owner)), F.lit("/"), F.lower(strip(repo)))


def chunk_id(*parts: Column) -> Column:
    """SHA-1 of the parts joined by bars: repository, path, type, first and last line, symbol, version."""
    return sha1_text(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def file_id(repo: Column, path: Column) -> Column:
    return F.concat(repo, F.lit(":file:"), sha1_text(path))


def cursor_id(source_type: Column, source_name: Column, key: Column) -> Column:
    return F.concat_ws(":", F.lit("cursor"), source_type, source_name, stable_digest(key))


def request_key(*parts: Column) -> Column:
    """Digest of a request's parts (query or topic, sort, order)."""
    return stable_digest(F.concat_ws("|", *[clean(p) for p in parts]))


def ref_candidates(default_branch: Column) -> Column:
    """Refs to try for a snapshot: the default branch, main, master."""
    return ordered_distinct(F.array(F.regexp_replace(clean(default_branch), "^refs/heads/", ""), F.lit("main"), F.lit("master")))


def archive_url(owner: Column, repo: Column, ref: Column) -> Column:
    return F.concat(F.lit("https://codeload.github.com/"), owner, F.lit("/"), repo, F.lit("/tar.gz/"), ref)
