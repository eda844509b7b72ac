"""What the provided tables lack (paths, headings, replies, ...), derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import file_class, file_language
from ..operators.dedup import first_questions
from ..operators.qa import rule_pairs
from ..operators.split import with_shuffle_key
from ..rules import SKIPPED_URL_PARTS, DomainRules, Limits
from ..schemas import METADATA
from ..sinks.training import shuffled_pairs
from ..sources.tables import read_table

COLLECTED_AT = "2024-01-02T00:00:00"
NOW = "2024-01-02 00:00:00"
SEED = "7"

RULES = DomainRules(
    domain="Acme",
    vocabulary=("that", "nicht", "für", "of the", "que"),
    system_prompt="You answer questions about Acme.",
    docs_source="acme_docs",
    docs_base_url="https://docs.acme.example",
    docs_host_pattern="https://[^/<]+",
    title_suffix=" | Acme",
    priority_paths=("/en", "/de", "/fr"),
    repositories=("acme/tools",),
    relevance_patterns=(r"@que", r"nicht\.", r"of.*that"),
    relevance_path_words=("worker",),
    skipped_url_parts=SKIPPED_URL_PARTS + ("/fr/",),
    implementation_words=("workflow", "activity", "worker"),
)
LIMITS = Limits()

# Two of these in a row are a term: 1,024 terms for searches with a large vocabulary.
SYLLABLES = (
    "th", "he", "an", "in", "er", "on", "re", "ti", "en", "ng", "ch", "sch", "ein", "ung", "keit", "lich",
    "qu", "eau", "aux", "tre", "ment", "os", "as", "ado", "ción", "rr", "ll", "ue", "ü", "ä", "é", "zu",
)
MANY_TERMS = tuple(first + second for first in SYLLABLES for second in SYLLABLES)

PATH = (
    "CASE doc_id % 6 WHEN 0 THEN 'src/worker_'||doc_id||'.py' WHEN 1 THEN 'samples/a_'||doc_id||'.go' "
    "WHEN 2 THEN 'docs/p_'||doc_id||'.md' WHEN 3 THEN 'node_modules/x_'||doc_id||'.js' "
    "WHEN 4 THEN 'tests/t_'||doc_id||'.java' ELSE 'lib/c_'||doc_id||'.rs' END"
)
PARAGRAPHS = "replace(text, chr(10), chr(10)||chr(10))"
HEADINGS = "'## Topic '||doc_id||chr(10)||text||chr(10)||'### How it works'||chr(10)||text"
# Headings and blank-line paragraphs in one text, so that every strategy has work.
RICH = (
    "'## Topic '||doc_id||chr(10)||replace(text, chr(10), chr(10)||chr(10))||chr(10)||"
    "'### How it works'||chr(10)||text"
)
SECTION_URL = (
    "'https://docs.acme.example'||CASE doc_id % 7 WHEN 0 THEN '/develop/p' WHEN 1 THEN '/REFERENCES/p' WHEN 2 THEN '/glossary/' "
    "WHEN 3 THEN '/production' WHEN 4 THEN '/en/develop' WHEN 5 THEN '/en?x=/develop' ELSE '/sdk/deploy' END||doc_id"
)
# A heading between every two paragraphs.
SECOND_HEADING = "replace(html, '</p><p>', '</p><h2 class=\"x\">How <i>'||page_id||'</i> works</h2><p>')"
REPLY = (
    "CASE WHEN doc_id % 3 = 0 THEN 'Sure: [{\"instruction\":\"Q'||doc_id||'\", ]' "
    "ELSE 'Sure: [{\"instruction\":\"Q'||doc_id||'\",\"response\":\"A\"}] done' END"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, content: str = RICH, content_type: str | None = None) -> DataFrame:
    """``documents`` in the document schema, plus ``doc_id``."""
    path = F.col("path")
    return (
        table(spark, folder, "documents")
        .selectExpr("doc_id", f"{content} AS content", f"{PATH} AS path")
        .select(
            "doc_id",
            F.concat(F.lit("doc:"), "doc_id").alias("id"),
            F.lit("acme_docs").alias("source"),
            F.concat(F.lit("https://docs.acme.example/"), path).alias("url"),
            F.concat(F.lit("Document "), "doc_id").alias("title"),
            "content",
            (F.lit(content_type) if content_type else file_class(path, RULES.implementation_words)).alias("content_type"),
            file_language(path).alias("language"),
            F.struct(
                path.alias("path"),
                F.lit(None).cast("string").alias("repo"),
                F.lit(None).cast("string").alias("sha"),
                F.lit(None).cast("bigint").alias("size"),
                F.lit(None).cast("string").alias("search_term"),
                F.array().alias("code_blocks"),
            )
            .cast(METADATA)
            .alias("metadata"),
            F.lit(COLLECTED_AT).alias("collected_at"),
        )
    )


def drawn_terms(spark: SparkSession, folder: str) -> DataFrame:
    """A vocabulary drawn from the documents: the first word and the first two words of each line-free beginning."""
    first = F.regexp_extract("text", "^([A-Za-z]+)[ ,.]", 1)
    second = F.regexp_extract("text", "^([A-Za-z]+ [A-Za-z]+)[ ,.]", 1)
    drawn = table(spark, folder, "documents").select(F.explode(F.array(first, second)).alias("term"), "doc_id")
    return drawn.where("term <> ''").groupBy("term").agg(F.min("doc_id").alias("position"))


def found_pairs(spark: SparkSession, folder: str, **options) -> DataFrame:
    return rule_pairs(documents(spark, folder), RULES, LIMITS, SEED, **options)


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return first_questions(found_pairs(spark, folder))


def keyed_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Questions are unique, so their keys are."""
    return with_shuffle_key(pairs(spark, folder), SEED, copies=False)


def stored_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return shuffled_pairs(pairs(spark, folder), SEED)


def repo_files(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "documents")
        .selectExpr("doc_id", "text", "n_chars", f"{PATH} AS path")
        .select(
            F.lit("acme/tools").alias("repo"),
            "path",
            F.regexp_extract("path", "([^/]+)$", 1).alias("name"),
            F.concat(F.lit("https://code.example/acme/tools/"), "path").alias("html_url"),
            F.md5("text").alias("sha"),
            F.col("n_chars").alias("size"),
            F.base64(F.encode("text", "UTF-8")).alias("content_b64"),
        )
    )


def repo_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The file table as JSON lines of three repositories; every fifth line is cut, every seventh names no path."""
    files = table(spark, folder, "documents").selectExpr("doc_id", "text", "n_chars", f"{PATH} AS path")
    line = F.to_json(
        F.struct(
            F.concat(F.lit("acme/r"), F.col("doc_id") % 3).alias("repo"),
            F.when(F.col("doc_id") % 7 != 0, F.col("path")).alias("path"),
            F.md5("text").alias("sha"),
            F.col("n_chars").alias("size"),
            F.base64(F.encode("text", "UTF-8")).alias("content_b64"),
        )
    )
    cut = F.substring(line, 1, 40)
    return files.select(F.when(F.col("doc_id") % 5 == 0, cut).otherwise(line).alias("value"))


def replies(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "documents")
        .selectExpr("doc_id", f"{PATH} AS path", f"{REPLY} AS reply")
        .select(
            F.concat(F.lit("doc:"), "doc_id").alias("id"),
            F.concat(F.lit("https://docs.acme.example/"), "path").alias("url"),
            "reply",
        )
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def sitemaps(spark: SparkSession, folder: str) -> DataFrame:
    """One small sitemap per page; those of odd pages do not escape their ampersands."""
    location = F.when(F.col("page_id") % 2 == 0, F.replace("url", F.lit("&"), F.lit("&amp;"))).otherwise(F.col("url"))
    return pages(spark, folder).select(
        F.concat(
            F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>'),
            location,
            F.lit("</loc></url></urlset>"),
        ).alias("xml")
    )


def sitemap_files(spark: SparkSession, folder: str, path: str) -> None:
    """Eight sitemap files of all pages; the odd ones do not escape ampersands."""
    number = F.pmod("page_id", F.lit(8)).cast("int")
    location = F.when(number % 2 == 0, F.replace("url", F.lit("&"), F.lit("&amp;"))).otherwise(F.col("url"))
    entry = F.concat(F.lit("<url><loc>"), location, F.lit("</loc></url>"))
    entries = pages(spark, folder).select(number.alias("number"), F.lit(1).alias("place"), entry.alias("value"))
    frame = spark.range(8).select(
        F.col("id").cast("int").alias("number"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("place"), F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">').alias("value")),
            F.struct(F.lit(2).alias("place"), F.lit("</urlset>").alias("value")),
        )),
    )
    rows = entries.unionByName(frame).repartitionById(8, F.col("number")).sortWithinPartitions("number", "place")
    rows.select("value").write.text(path)


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Each page fetched ``page_id`` hours ago, and once more an hour before that."""
    fetched = pages(spark, folder).select(
        "url", "html", F.expr(f"TIMESTAMP '{NOW}' - page_id * INTERVAL '1' HOUR").alias("fetched_at")
    )
    older = fetched.select(
        "url", F.concat("html", F.lit("<!-- old -->")).alias("html"),
        F.expr("fetched_at - INTERVAL '1' HOUR").alias("fetched_at"),
    )
    return fetched.unionByName(older).withColumn("status", F.lit(200))


def chat_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with all its turns as messages, and once more as an instruction and an output."""
    turns = table(spark, folder, "conversations")
    whole = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
        lambda turn: F.struct(turn["role"].alias("role"), turn["text"].alias("content")),
    )
    own = turns.groupBy("conv_id").agg(whole.alias("messages"))
    return own.unionByName(trainable_rows(spark, folder), allowMissingColumns=True)


def trainable_rows(spark: SparkSession, folder: str) -> DataFrame:
    """First user and first assistant turn of each conversation."""
    turns = table(spark, folder, "conversations")
    return turns.groupBy("conv_id").agg(
        F.min_by(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "user", F.col("turn"))).alias(
            "instruction"
        ),
        F.min_by(
            F.when(F.col("role") == "assistant", F.col("text")), F.when(F.col("role") == "assistant", F.col("turn"))
        ).alias("output"),
    )
