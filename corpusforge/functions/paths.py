"""URL and file path predicates and classes."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..rules import (
    DEFAULT_PAGE_CLASS,
    LANGUAGES,
    PAGE_CLASSES,
    DomainRules,
)
from .text import contains_any


def url_path(url: Column) -> Column:
    """Path of a URL without ``;params``, query and fragment; never null for a non-null URL."""
    clean = F.ltrim(F.translate(url, "\t\r\n", ""))
    path = F.regexp_extract(clean, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def is_document_url(url: Column, rules: DomainRules) -> Column:
    return ~contains_any(url_path(url), rules.skipped_url_parts)


def page_class(url: Column) -> Column:
    path = F.lower(url_path(url))
    chosen = None
    for name, parts in PAGE_CLASSES:
        test = contains_any(path, parts)
        chosen = F.when(test, F.lit(name)) if chosen is None else chosen.when(test, F.lit(name))
    return chosen.otherwise(F.lit(DEFAULT_PAGE_CLASS))


def url_priority(url: Column, priority_paths) -> Column:
    """Position of the first listed prefix of the path; the list's length if none fits."""
    if not priority_paths:
        return F.lit(0)
    path = url_path(url)
    chosen = None
    for position, prefix in enumerate(priority_paths):
        test = path.startswith(prefix)
        chosen = F.when(test, F.lit(position)) if chosen is None else chosen.when(test, F.lit(position))
    return chosen.otherwise(F.lit(len(priority_paths)))


def extension(path: Column) -> Column:
    """Lower-cased suffix of the last path part, with its dot; empty if there is none."""
    return F.lower(F.regexp_extract(path, r"[^./](\.[^./]+)$", 1))


def has_kept_extension(path: Column, rules: DomainRules) -> Column:
    return extension(path).isin(*rules.kept_extensions)


def in_skipped_folder(path: Column, rules: DomainRules) -> Column:
    names = "|".join(re.escape(name) for name in rules.skipped_folders)
    return path.rlike(f"(?:^|/)(?:{names})/") if names else F.lit(False)


def file_language(path: Column) -> Column:
    table = F.create_map(*[F.lit(item) for pair in LANGUAGES.items() for item in pair])
    return F.try_element_at(table, extension(path))


def file_class(path: Column, implementation_words: tuple[str, ...] = ()) -> Column:
    """Class of a file by its path; ``implementation_words`` are the domain's."""
    lower = F.lower(path)
    return (
        F.when(lower.contains("test"), F.lit("test"))
        .when(contains_any(lower, ("sample", "example")), F.lit("example"))
        .when(path.endswith(".md") | path.endswith(".mdx") | lower.contains("readme"), F.lit("documentation"))
        .when(contains_any(lower, implementation_words), F.lit("implementation"))
        .otherwise(F.lit("code"))
    )


def is_relevant(path: Column, content: Column, rules: DomainRules) -> Column:
    """Domain word in the path, or one of the patterns in the content.

    One alternation, so the text is scanned once; ``(?d)`` lets ``.`` stop at newlines only.
    """
    by_path = contains_any(F.lower(path), rules.relevance_path_words)
    if not rules.relevance_patterns:
        return by_path
    pattern = "|".join(f"(?:{item})" for item in rules.relevance_patterns)
    return by_path | F.lower(content).rlike(f"(?d){pattern}")


def decode_base64(body: Column) -> Column:
    """Text of a base64 body, which may be wrapped in lines; null if it is not base64 or not UTF-8."""
    joined = F.translate(body, " \t\r\n", "")
    return F.try_validate_utf8(F.try_to_binary(joined, F.lit("base64")).cast("string"))
