"""Sitemap XML to URL rows."""

from __future__ import annotations

from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import is_document_url
from ..operators.joins import semi_or_anti
from ..rules import SITEMAP_NAMESPACE, DomainRules
from ..staging import stage

_ENTRY_END = "</url>"
# Blanks, comments and instructions; with them, the begin of a sitemap in front of its first entry, if it is there.
_MISC = r"(?:\s|<!--(?:(?!-->).)*-->|<\?(?:(?!\?>).)*\?>)*"
_PROLOG = rf"{_MISC}(?:<urlset(?=[\s>])[^>]*>{_MISC})?"
_URLSET = "url ARRAY<STRUCT<loc:STRING>>, _corrupt_record STRING"


def sitemap_urls(sitemaps: DataFrame, rules: DomainRules, xml: str = "xml") -> DataFrame:
    """One row ``url`` per location of each sitemap document.

    Well-formed sitemaps give their ``url/loc`` texts through the URL filter.  Malformed
    ones give what looks like a location on the documentation host, unfiltered.
    """
    text = F.col(xml)
    parsed = sitemaps.where(text != "").select(
        text.alias("_text"),
        F.from_xml(text, _URLSET, {"ignoreSurroundingSpaces": "false"}).alias("_set"),
    )
    located = F.when(
        F.col("_text").contains(SITEMAP_NAMESPACE),
        F.filter(
            F.transform(F.col("_set.url"), lambda entry: entry["loc"]),
            lambda url: (url != "") & is_document_url(url, rules),
        ),
    )
    salvaged = F.regexp_extract_all(
        F.col("_text"), F.lit(f"<loc>({rules.docs_host_pattern}[^<]+)</loc>"), F.lit(1)
    )
    urls = F.when(F.col("_set._corrupt_record").isNull(), located).otherwise(salvaged)
    return parsed.select(F.explode(urls).alias("url"))


def sitemap_file_urls(spark: SparkSession, path: str, rules: DomainRules) -> DataFrame:
    """``(file, url)`` of sitemap files of any size: one file is read by several tasks, entry by entry.

    A file is split behind each ``</url>``, and every entry is parsed alone.  It is well-formed if all its entries are, and
    if it begins and ends as a sitemap does; as in ``sitemap_urls``, such files give their locations through the URL
    filter, and others what looks like a location on the documentation host, unfiltered.  An end of an entry inside a
    comment or a CDATA section counts as malformed.  The entries are written once; a file's state is one aggregated row.
    """
    entries = spark.read.option("lineSep", _ENTRY_END).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    text = F.col("value")
    entry = F.regexp_extract(text, rf"(?s)^{_PROLOG}(<url[\s>].*)$", 1)
    closing = text.rlike(rf"(?s)^{_PROLOG}</urlset\s*>{_MISC}$")
    parsed = entries.select(
        "file",
        text.contains(SITEMAP_NAMESPACE).alias("named"),
        closing.alias("closing"),
        F.when(entry != "", F.from_xml(F.concat(F.lit("<urlset>"), entry, F.lit(f"{_ENTRY_END}</urlset>")), _URLSET, {"ignoreSurroundingSpaces": "false"})).alias("_set"),
        F.regexp_extract_all(text, F.lit(f"<loc>({rules.docs_host_pattern}[^<]+)</loc>"), F.lit(1)).alias("salvaged"),
    )
    sound = F.col("closing") | (F.col("_set").isNotNull() & F.col("_set._corrupt_record").isNull())
    located = F.filter(
        F.transform(F.col("_set.url"), lambda item: item["loc"]), lambda url: (url != "") & is_document_url(url, rules)
    )
    rows = stage(parsed.select("file", "named", "closing", sound.alias("sound"), located.alias("located"), "salvaged"), "sitemap-entries")
    files = rows.groupBy("file").agg(
        F.bool_or("named").alias("named_file"), (F.bool_and("sound") & F.bool_or("closing")).alias("sound_file")
    )
    files = stage(files, "sitemap-files")
    known = semi_or_anti(rows, files, "file", "inner")
    urls = F.when(~F.col("sound_file"), F.col("salvaged")).when(F.col("named_file"), F.col("located"))
    return known.select("file", F.explode(urls).alias("url"))


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """One row per sitemap file."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "xml")


def seed_urls(spark: SparkSession, rules: DomainRules) -> DataFrame:
    """The priority paths under the base URL, as starting points."""
    urls = [(urljoin(rules.docs_base_url, path),) for path in rules.priority_paths]
    return spark.createDataFrame(urls, "url string")


def with_seed_fallback(urls: DataFrame, rules: DomainRules) -> DataFrame:
    """``urls``, or the seed URLs if there are none."""
    found = urls.limit(1).agg(F.count("*").alias("found"))
    seeds = seed_urls(urls.sparkSession, rules)
    return urls.unionByName(seeds.where(found.scalar() == 0))
