"""Fetched pages to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import html as H
from ..functions.html_tree import tree_result
from ..functions.text import collapse_blanks
from ..functions.paths import is_document_url, page_class, url_path, url_priority
from ..rules import DomainRules, Limits
from ..schemas import METADATA
from ..sources.jsonl import utc_now
from .rows import keep_where


def document_urls(urls: DataFrame, rules: DomainRules) -> DataFrame:
    """Keep URLs of documentation pages."""
    return urls.where(is_document_url(F.col("url"), rules))


def ranked_urls(urls: DataFrame, rules: DomainRules) -> DataFrame:
    """Distinct URLs with the position of their section in the priority list."""
    ranked = urls.dropDuplicates(["url"])
    return ranked.withColumn("priority", url_priority(F.col("url"), rules.priority_paths))


def by_priority(ranked: DataFrame) -> DataFrame:
    return ranked.orderBy("priority", "url")


def extract_pages(pages: DataFrame, rules: DomainRules, limits: Limits = Limits(), keep_paragraphs: bool = False) -> DataFrame:
    """Add ``title``, ``content`` and ``code_blocks``; pages without enough text go away.

    The content is one line, or with ``keep_paragraphs`` a paragraph per block and a Markdown line per heading, from
    which pairs about paragraphs and headings can be made.
    """
    kept = pages.columns
    step = pages.withColumn("_bare", H.drop_page_furniture(F.col("html")))
    step = step.withColumn("_bare", H.replace_references(F.col("_bare")))
    step = step.withColumns({"_kind": H.region_kind(F.col("_bare")), "_h1": H.heading_html(F.col("_bare"))})
    step = step.withColumn("_region", H.region_html(F.col("_bare"), F.col("_kind")))
    step = step.withColumns(
        {"_spaced": H.spaced_text(F.col("_region")), "_pres": H.pre_bodies(F.col("_region"))}
    )
    hard = H.needs_tree(*map(F.col, ("_bare", "_kind", "_region", "_spaced", "_h1", "_pres")))
    step = step.withColumns(
        {"_hard": F.coalesce(hard | F.col("html").rlike(H.ODD_ATTRIBUTE), F.lit(False)), "_plain": H.markup_references(F.col("_spaced"))}
    )
    text = H.block_text(F.col("_region")) if keep_paragraphs else collapse_blanks(F.col("_plain"))
    easy = F.struct(
        H.page_title(F.col("_bare"), F.col("_h1"), rules.title_suffix).alias("title"),
        text.alias("content"),
        H.code_blocks(F.col("_pres")).alias("code_blocks"),
    )
    # The finished page, not its intermediate texts, waits next to the Python worker.
    step = step.select(
        *kept,
        F.when(~F.col("_hard"), easy).alias("_easy"),
        F.when(F.col("_hard"), F.col("html")).alias("_hard_html"),
    )
    step = step.withColumn("_tree", tree_result(F.col("_hard_html")))
    tree = F.col("_tree")
    title = F.when(tree["heading"].isNotNull(), tree["heading"]).otherwise(
        F.replace(tree["title"], F.lit(rules.title_suffix), F.lit("")) if rules.title_suffix else tree["title"]
    )
    walked = F.struct(
        H.or_untitled(title).alias("title"),
        tree["paragraphs" if keep_paragraphs else "content"].alias("content"),
        tree["code_blocks"].alias("code_blocks"),
    )
    page = F.coalesce(F.col("_easy"), walked)
    return keep_where(step, kept, page, lambda item: F.length(item["content"]) >= limits.min_content)


def page_documents(
    pages: DataFrame,
    rules: DomainRules,
    limits: Limits = Limits(),
    collected_at: str | None = None,
    keep_paragraphs: bool = False,
) -> DataFrame:
    """Documents of the pages ``(url, html)``."""
    found = extract_pages(pages.select("url", "html"), rules, limits, keep_paragraphs)
    path = url_path(F.col("url"))
    return found.select(
        F.concat(F.lit("docs:"), path).alias("id"),
        F.lit(rules.docs_source).alias("source"),
        "url",
        "title",
        "content",
        page_class(F.col("url")).alias("content_type"),
        F.lit(None).cast("string").alias("language"),
        F.struct(
            path.alias("path"),
            F.lit(None).cast("string").alias("repo"),
            F.lit(None).cast("string").alias("sha"),
            F.lit(None).cast("bigint").alias("size"),
            F.lit(None).cast("string").alias("search_term"),
            F.col("code_blocks"),
        )
        .cast(METADATA)
        .alias("metadata"),
        (F.lit(collected_at) if collected_at else utc_now()).alias("collected_at"),
    )
