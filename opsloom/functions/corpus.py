"""Infrastructure-as-code columns: gates, licences, redaction, prompts, classes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from opsloom.functions import rules
from opsloom.functions.common import (
    any_of, blank_to_null, col, contains_any, first_match, let, strip,
)

LICENSE_COLUMNS = [
    "max_stars_repo_licenses", "max_issues_repo_licenses", "max_forks_repo_licenses",
]
PATH_COLUMNS = ["max_stars_repo_path", "max_issues_repo_path", "max_forks_repo_path"]


def _yaml_udf():
    # nested, so that the function itself travels to the executors and they need no package
    def loads(text: str) -> bool:
        import yaml

        loaders = [getattr(yaml, "CSafeLoader", yaml.SafeLoader), yaml.SafeLoader]
        for loader in loaders:  # the fast loader accepts; a refusal is confirmed by the slow one
            try:
                yaml.load(text, Loader=loader)
                return True
            except (yaml.YAMLError, ValueError, RecursionError):
                continue
        return False

    def check(text: pd.Series) -> pd.Series:
        return text.map(loads, na_action="ignore").astype("boolean")

    return F.pandas_udf(check, BooleanType())


def yaml_valid(text: Column) -> Column:
    """True if the text is one loadable YAML document; null stays null.

    Spark has no YAML reader, so this is the one check that leaves the JVM. Callers null out
    every row that was already rejected, so only undecided texts are shipped.
    """
    return _yaml_udf()(text)


def licenses(*columns: Column | str) -> Column:
    """All non-blank licence names of the list columns, trimmed and lower-cased."""
    empty = F.array().cast("array<string>")
    names = columns or LICENSE_COLUMNS
    merged = F.concat(*[F.coalesce(col(c), empty) for c in names])
    return F.transform(
        F.filter(merged, lambda x: x.isNotNull() & (strip(x) != "")), lambda x: F.lower(strip(x))
    )


def best_path(*columns: Column | str) -> Column:
    """First non-blank repository path, trimmed; '' if there is none."""
    paths = [strip(blank_to_null(c)) for c in (columns or PATH_COLUMNS)]
    return F.coalesce(*paths, F.lit(""))


def kubernetes_gates(content: Column | str, api_version: bool = True, kind: bool = True,
                     metadata: bool = True) -> Column:
    """True if the text holds every enabled marker of a Kubernetes manifest."""
    content = col(content)
    marks = [(api_version, "apiVersion"), (kind, "kind:"), (metadata, "metadata:")]
    passed = F.lit(True)
    for enabled, mark in marks:
        if enabled:
            passed = passed & content.contains(mark)
    return passed


def has_keyword(content: Column | str, groups: list[str] | None = None) -> Column:
    """True if the lower-cased text holds any keyword of the groups."""
    words = [w for g in (groups or list(rules.CORPUS_KEYWORDS)) for w in rules.CORPUS_KEYWORDS[g]]
    return contains_any(F.lower(col(content)), words)


def folded(content: Column | str) -> Column:
    """Upper-case text in which a word occurs wherever a case-insensitive pattern finds it.

    The Kelvin sign and the dotted capital I are capitals already, so they are spelled out.
    """
    upper = F.upper(col(content))
    plain_k = F.replace(upper, F.lit("\u212a"), F.lit("K"))
    return F.replace(plain_k, F.lit("\u0130"), F.lit("I"))


def keyword_count(content: Column | str, word: str) -> Column:
    """Non-overlapping, case-insensitive occurrences of a literal word.

    A plain substring test spares most texts the pattern.
    """
    hits = F.regexp_count(col(content), F.lit(rf"(?iu)\Q{word}\E"))
    return F.when(folded(content).contains(word.upper()), hits).otherwise(0)


def pii_pattern(name: str, any_case: bool = False) -> str:
    """A personal-data pattern with Unicode word and digit classes."""
    return ("(?iuU)" if any_case else "(?U)") + rules.PII_PATTERNS[name]


def _may_hold(content: Column, name: str) -> Column:
    """A cheap test that every text with a match of the pattern passes."""
    if name == "ipv4":
        return content.rlike(r"\p{Nd}\.\p{Nd}")
    if name == "creds":
        return contains_any(folded(content), ["PASSWORD", "TOKEN", "API_KEY", "SECRET"])
    return content.contains({"email": "@", "api_key": "sk-"}[name])


def redact(content: Column | str) -> Column:
    """Replace addresses, keys, e-mails and credentials by markers, in the fixed order.

    The patterns are costly on long texts, so each one only runs where its cheap test passes.
    """
    def replacing(name: str):
        def replaced(text: Column) -> Column:
            pattern = pii_pattern(name, any_case=name == "creds")
            clean = F.regexp_replace(text, pattern, rules.PII_REPLACEMENTS[name])
            return F.when(_may_hold(text, name), clean).otherwise(text)

        return replaced

    out = col(content)
    for name in rules.PII_REDACTION_ORDER:
        out = let(out, replacing(name))
    return out


def pii_found(content: Column | str, name: str) -> Column:
    content = col(content)
    return _may_hold(content, name) & content.rlike(pii_pattern(name))


def has_pii(content: Column | str) -> Column:
    """Any pattern present; credentials are matched case-sensitively here."""
    return any_of(pii_found(content, name) for name in rules.PII_PATTERNS)


def prompt_slug(path: Column | str) -> Column:
    """File name without folder and YAML extension, dashes and underscores as spaces."""
    path = F.coalesce(F.nullif(col(path), F.lit("")), F.lit("manifest.yaml"))
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"(?i)\.(yaml|yml)$", "")
    return strip(F.regexp_replace(name, "[-_]+", " "))


def synthesize_prompt(path: Column | str) -> Column:
    """Instruction sentence chosen by the first rule word found in the slug."""
    slug = prompt_slug(path)

    def fill(template: str) -> Column:
        before, after = template.split("{slug}")
        return F.concat(F.lit(before), slug, F.lit(after))

    lowered = F.lower(slug)
    cases = [(lowered.contains(word), fill(template)) for word, template in rules.PROMPT_RULES]
    return first_match(cases, fill(rules.PROMPT_FALLBACK))


def wrap_manifest(content: Column | str) -> Column:
    """The manifest packed as the JSON of one tool call."""
    return F.to_json(F.struct(
        F.lit("apply_manifest").alias("tool"),
        F.struct(col(content).alias("manifest_content")).alias("params"),
    ))


def manifest_of(wrapped: Column | str) -> Column:
    return F.get_json_object(col(wrapped), "$.params.manifest_content")


def manifest_type(content: Column | str, terraform: bool = False) -> Column:
    """Kind of file, judged by its whole text."""
    text = col(content)
    kinds = rules.MANIFEST_TYPES + ([rules.TERRAFORM_TYPE] if terraform else [])
    return first_match([(text.rlike("(?U)" + p), name) for name, p in kinds], F.lit("other"))


def _occurrences(text: Column, mark: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(mark), F.lit("")))


def escape_difficulty(content: Column | str, medium: int = 1000, hard: int = 5000) -> Column:
    """How hard the text is to embed in JSON: line breaks, quotes and backslashes."""
    text = col(content)
    score = _occurrences(text, "\n") + _occurrences(text, '"') * 2 + _occurrences(text, "\\") * 3
    return first_match([(score > hard, "hard"), (score > medium, "medium")], F.lit("easy"))


def size_bucket(size: Column | str) -> Column:
    size = F.coalesce(col(size), F.lit(0))
    return first_match(
        [(size < 1000, "<1KB"), (size < 10000, "1-10KB"), (size < 100000, "10-100KB")],
        F.lit(">100KB"),
    )


def prompt_type(prompt: Column | str) -> Column:
    lowered = F.lower(col(prompt))
    return first_match([(lowered.contains(w), w) for w in rules.PROMPT_TYPES], F.lit("fallback"))


def license_class(names: Column | str) -> Column:
    """First permissive licence of the list; 'unknown' if empty, else 'other'."""
    names = col(names)
    known = F.filter(
        F.transform(names, lambda x: strip(F.lower(x))),
        lambda x: x.isin(rules.PERMISSIVE_LICENSES),
    )
    return F.when(F.coalesce(F.array_size(names), F.lit(0)) <= 0, F.lit("unknown")).otherwise(
        F.coalesce(F.get(known, F.lit(0)), F.lit("other"))
    )


def sampling_weight(percent: Column, cap: float = 40.0) -> Column:
    """min(p, cap) / p held within 0.1 and 5; 1 for an empty class."""
    share = F.least(percent, F.lit(cap)) / F.when(percent > 0, percent)
    bounded = F.greatest(F.lit(0.1), F.least(F.lit(5.0), share))
    return F.when(percent <= 0, F.lit(1.0)).otherwise(F.round(bounded, 4))
