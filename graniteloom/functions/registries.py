"""Package registries: which fields of a registry's JSON hold repository references.

A registry payload stays a JSON text and is read late, by path; no schema is inferred.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from graniteloom.functions.text import ordered_distinct
from graniteloom.functions.urls import module_path_url, owner_repo_url

#: Per registry, the JSON paths that are read, in order; ``{...}`` marks an object all of whose values are taken. Fixed values.
PATHS = {
    "pypi": ["{$.info.project_urls}", "$.info.home_page"],
    "cratesio": ["$.crate.repository", "$.crate.homepage", "$.crate.documentation"],
    "rubygems": ["$.source_code_uri", "$.homepage_uri", "$.bug_tracker_uri", "$.documentation_uri", "$.wiki_uri"],
    "pubdev": ["$.latest.pubspec.repository", "$.latest.pubspec.homepage", "$.latest.pubspec.issue_tracker", "$.latest.pubspec.documentation"],
    "nuget": ["$.latest_catalog_entry.projectUrl", "$.latest_catalog_entry.repositoryUrl", "$.latest_catalog_entry.licenseUrl", "$.latest_catalog_entry.iconUrl", "$.source_reference_url"],
    "maven": [
        "$.latest_doc.url", "$.latest_doc.homepage", "$.latest_doc.repository", "$.latest_doc.documentation",
        "$.latest_pom.project_url", "$.latest_pom.scm_url", "$.latest_pom.scm_connection", "$.latest_pom.scm_developer_connection", "$.latest_pom.issue_management_url",
    ],
    "hexpm": ["{$.meta.links}", "$.html_url", "$.docs_html_url"],
    "cpan": ["$.resources.homepage", "$.resources.repository.url", "$.resources.repository.web", "$.resources.bugtracker.web", "$.resources.bugtracker.mailto", "$.download_url"],
    "hackage": ["$.cabal_fields.homepage", "$.cabal_fields.bug_reports", "$.cabal_fields.source_repository", "$.source_reference_url"],
    "cocoapods": ["$.latest_spec.homepage", "{$.latest_spec.source}", "$.page_url", "$.json_url"],
    "swiftpm": ["$.repository_url", "$.source_reference_url"],
}
REGISTRIES = (*PATHS, "npm", "packagist", "gomod")


def _text(payload: Column, path: str) -> Column:
    """A text at a path; an object or array there is no text."""
    v = F.get_json_object(payload, path)
    return F.when(~v.rlike(r"^\s*[\[{]"), v)


def _values(payload: Column, path: str) -> Column:
    return F.map_values(F.from_json(F.get_json_object(payload, path), "map<string,string>"))


def _npm(payload: Column) -> Column:
    """The latest version's fields, then the package's own: repository, homepage, bugs (text or object with a URL)."""
    latest = F.get_json_object(payload, "$['dist-tags'].latest")
    versions = F.from_json(F.get_json_object(payload, "$.versions"), "map<string,string>")
    out = []
    for p in (versions[latest], payload):
        out += [F.coalesce(_text(p, "$.repository.url"), _text(p, "$.repository")), _text(p, "$.homepage"), F.coalesce(_text(p, "$.bugs.url"), _text(p, "$.bugs"))]
    return F.array(*out)


def _packagist(payload: Column) -> Column:
    """Every version of every package: homepage, source, support links."""
    version = "struct<homepage:string,source:struct<url:string>,support:struct<source:string,issues:string,docs:string,forum:string>>"
    packages = F.map_values(F.from_json(F.get_json_object(payload, "$.packages"), f"map<string,array<{version}>>"))
    one = lambda v: F.array(v["homepage"], v["source"]["url"], v["support"]["source"], v["support"]["issues"], v["support"]["docs"], v["support"]["forum"])
    return F.flatten(F.transform(F.flatten(packages), one))


def _gomod(payload: Column) -> Column:
    path = F.get_json_object(payload, "$.module_path")
    return F.array(module_path_url(path), F.when(F.trim(path) != "", F.concat(F.lit("https://pkg.go.dev/"), F.trim(path))))


def candidate_urls(registry: str, payload: Column) -> Column:
    """The references that a registry's payload gives, each once."""
    if registry == "npm":
        found = _npm(payload)
    elif registry == "packagist":
        found = _packagist(payload)
    elif registry == "gomod":
        found = _gomod(payload)
    else:
        none = F.array().cast("array<string>")
        found = F.concat(*[F.coalesce(_values(payload, p[1:-1]), none) if p[0] == "{" else F.array(_text(payload, p)) for p in PATHS[registry]])
    return ordered_distinct(found)


def cabal_field(text: Column, name: str) -> Column:
    """A field of a cabal file."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?mi)^[ \t]*{name}\s*:\s*(\S[^\r\n]*)", 1)


def pom_fields(pom: Column) -> Column:
    """Reference fields of a POM, read from the root by XPath (namespaces are left out first)."""
    xml = F.regexp_replace(F.regexp_replace(F.coalesce(pom, F.lit("<project/>")), r'\sxmlns(:\w+)?="[^"]*"', ""), r'\s\w+:\w+="[^"]*"', "")
    at = lambda p: F.xpath_string(xml, F.lit(f"/project/{p}"))
    return F.struct(at("url").alias("project_url"), at("scm/url").alias("scm_url"), at("scm/connection").alias("scm_connection"), at("scm/developerConnection").alias("scm_developer_connection"), at("issueManagement/url").alias("issue_management_url"))


def maven_coordinates(package: Column) -> Column:
    """(group, artifact) of ``group:artifact``, else null."""
    p = F.split(F.trim(package), ":")
    return F.when((F.size(p) == 2) & (F.get(p, F.lit(0)) != "") & (F.get(p, F.lit(1)) != ""), F.struct(F.get(p, F.lit(0)).alias("group"), F.get(p, F.lit(1)).alias("artifact")))


def pom_url(group: Column, artifact: Column, version: Column) -> Column:
    return F.concat(F.lit("https://repo1.maven.org/maven2/"), F.replace(group, F.lit("."), F.lit("/")), F.lit("/"), artifact, F.lit("/"), version, F.lit("/"), artifact, F.lit("-"), version, F.lit(".pom"))


def swift_package_url(name: Column) -> Column:
    return owner_repo_url(name)
