"""Registered queries: name to ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.paths import (
    decode_base64,
    extension,
    file_class,
    file_language,
    in_skipped_folder,
    page_class,
    url_path,
)
from ..operators.chat import prompt_messages, with_messages
from ..operators.corpus import run_counts, source_counts, unite
from ..operators.dedup import distinct_content, distinct_urls
from ..operators.formats import FORMATS, to_format
from ..operators.pages import by_priority, document_urls, extract_pages, page_documents, ranked_urls
from ..operators.qa import documents_with_concepts, rule_pairs
from ..operators.replies import attach_replies, pairs_with_fallback, parse_reply, prompt_text, reply_errors, with_model_replies
from ..operators.repo_files import repo_documents, search_documents, walk_documents
from ..operators.split import split_counts, split_pairs
from ..operators.templates import TEMPLATES, rendered
from ..operators.vocabulary import tag_with_table
from ..sinks.jsonl import write_documents, write_jsonl, write_pairs
from ..sinks.training import write_dataset, write_formats
from ..sources.jsonl import read_documents, read_documents_if_present, read_pairs, read_training_rows
from ..sources.repos import read_repo_files_and_rejects, reject_counts, with_content
from ..sources.sitemap import sitemap_file_urls, sitemap_urls, with_seed_fallback
from ..sources.snapshots import servable_pages, successful, urls_to_fetch
from ..staging import new_path
from . import inputs as I

RULES, LIMITS = I.RULES, I.LIMITS


def as_text(df: DataFrame, *names: str) -> DataFrame:
    """Nested columns as JSON text, which both engines write alike."""
    return df.withColumns({name: F.to_json(name) for name in names})


def pair_columns(pairs: DataFrame, *extra) -> DataFrame:
    return as_text(
        pairs.select("instruction", "response", "source_id", "source_url", "category", "concepts", *extra), "concepts"
    )


def with_place(pairs: DataFrame) -> DataFrame:
    return pair_columns(pairs, F.col("pair_order.place").cast("bigint").alias("place"))


# --- tagging and pairs ------------------------------------------------------


def concept_tags(spark, folder):
    docs = I.table(spark, folder, "documents").select("doc_id", F.col("text").alias("content"))
    return as_text(documents_with_concepts(docs, RULES).select("doc_id", "concepts"), "concepts")


def concept_tags_many(spark, folder):
    """Tags of a vocabulary that is a table of thousands of terms."""
    docs = I.table(spark, folder, "documents").select("doc_id", F.col("text").alias("content"))
    return as_text(tag_with_table(docs, I.drawn_terms(spark, folder), key="doc_id"), "concepts")


def concept_qa(spark, folder):
    docs = I.documents(spark, folder, I.PARAGRAPHS)
    return with_place(rule_pairs(docs, RULES, LIMITS, I.SEED, strategies=("concept",)))


def header_qa(spark, folder):
    docs = I.documents(spark, folder, I.HEADINGS, "documentation")
    return with_place(rule_pairs(docs, RULES, LIMITS, I.SEED, strategies=("headings",)))


def code_qa(spark, folder):
    return with_place(I.found_pairs(spark, folder, strategies=("code",)))


def rule_qa(spark, folder):
    return with_place(I.found_pairs(spark, folder))


def question_dedup(spark, folder):
    return pair_columns(I.pairs(spark, folder))


def content_dedup(spark, folder):
    docs = I.table(spark, folder, "documents").select("doc_id", F.col("text").alias("content"), "source")
    return distinct_content(docs, order="doc_id")


# --- split, formats, templates ----------------------------------------------


def train_split(spark, folder):
    split = split_pairs(I.keyed_pairs(spark, folder), LIMITS.train_fraction)
    return split.select("instruction", "source_id", "shuffle_key", "split")


def split_totals(spark, folder):
    return split_counts(split_pairs(I.keyed_pairs(spark, folder), LIMITS.train_fraction))


def training_format(name, spark, folder):
    formatted = to_format(I.pairs(spark, folder), name, RULES.system_prompt)
    nested = [field for field in ("messages", "conversations", "concepts") if field in formatted.columns]
    return as_text(formatted, *nested)


def chat_rendering(name, spark, folder):
    return as_text(rendered(I.pairs(spark, folder), name, RULES.system_prompt), "metadata")


def format_files(spark, folder):
    """Every format written and read back: rows, questions and splits per format."""
    path = new_path(spark, "formats")
    outputs = write_formats(I.stored_pairs(spark, folder), path, RULES.system_prompt, ["alpaca", "torchtune"])
    parts = [
        spark.read.json(paths[split]).select(
            F.lit(name).alias("format"), F.lit(split).alias("split"), "instruction", "input", "output"
        )
        for name, paths in outputs.items()
        for split in ("train", "validation")
    ]
    return unite(*parts)


def dataset_info(spark, folder):
    path = new_path(spark, "formats")
    write_formats(I.stored_pairs(spark, folder), path, RULES.system_prompt, ["alpaca"])
    info = spark.read.json(f"{path}/dataset_info")
    return info.select(
        "total_examples",
        "train_examples",
        "validation_examples",
        F.col("formats.alpaca.train_count").alias("alpaca_train"),
        F.col("formats.alpaca.val_count").alias("alpaca_validation"),
        "template",
    )


def split_dataset(spark, folder):
    path = write_dataset(I.stored_pairs(spark, folder), new_path(spark, "dataset"), RULES.system_prompt)
    return as_text(spark.read.parquet(path).select("messages", "source_id", "category", "split"), "messages")


def training_rows(spark, folder):
    """Instruction rows written as JSON lines, read with an inferred schema, made into messages."""
    path = new_path(spark, "rows")
    write_jsonl(to_format(I.pairs(spark, folder), "torchtune", RULES.system_prompt), path)
    rows = with_messages(read_training_rows(spark, path), RULES.system_prompt)
    return as_text(rows.select("source_id", "messages"), "messages")


# --- chat rows --------------------------------------------------------------


def normalize_chat(spark, folder):
    return as_text(with_messages(I.chat_rows(spark, folder), RULES.system_prompt), "messages")


def question_prompts(spark, folder):
    turns = I.table(spark, folder, "conversations")
    questions = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    return as_text(prompt_messages(questions, RULES.system_prompt), "messages")


# --- pages ------------------------------------------------------------------


def page_text(spark, folder):
    return extract_pages(I.pages(spark, folder), RULES, LIMITS).select("page_id", "content")


def page_title(spark, folder):
    return extract_pages(I.pages(spark, folder), RULES, LIMITS).select("page_id", "title")


def page_code_blocks(spark, folder):
    code = "replace(html, '</article>', '<pre><code class=\"language-py\">x='||page_id||'</code></pre></article>')"
    coded = I.pages(spark, folder).selectExpr("page_id", f"{code} AS html")
    return as_text(extract_pages(coded, RULES, LIMITS).select("page_id", "code_blocks"), "code_blocks")


def _page_docs(spark, folder):
    return page_documents(distinct_pages(spark, folder), RULES, LIMITS, I.COLLECTED_AT)


def distinct_pages(spark, folder):
    return document_urls(I.pages(spark, folder), RULES)


def page_docs(spark, folder):
    docs = _page_docs(spark, folder)
    return docs.select(
        "id", "source", "url", "title", "content", "content_type", "language",
        F.col("metadata.path").alias("path"), "collected_at",
    )


def _block_docs(spark, folder):
    """Documents of the pages by blocks, with a heading between every two paragraphs."""
    pages = distinct_pages(spark, folder).selectExpr("page_id", "url", f"{I.SECOND_HEADING} AS html")
    return page_documents(pages, RULES, LIMITS, I.COLLECTED_AT, keep_paragraphs=True)


def page_blocks(spark, folder):
    return _block_docs(spark, folder).select("id", "url", "title", "content")


def page_paragraph_qa(spark, folder):
    return with_place(rule_pairs(_block_docs(spark, folder), RULES, LIMITS, I.SEED, strategies=("concept",)))


def page_heading_qa(spark, folder):
    return with_place(rule_pairs(_block_docs(spark, folder), RULES, LIMITS, I.SEED, strategies=("headings",)))


def url_filter(spark, folder):
    pages = I.pages(spark, folder)
    return document_urls(pages, RULES).select("page_id", "url", url_path(F.col("url")).alias("path"))


def url_rank(spark, folder):
    ranked = ranked_urls(I.pages(spark, folder).select("url"), RULES)
    return ranked.select("url", F.col("priority").cast("bigint"), page_class(F.col("url")).alias("page_class"))


def sitemap_locations(spark, folder):
    return sitemap_urls(I.sitemaps(spark, folder), RULES)


def sitemap_files(spark, folder):
    """Locations of large sitemap files, some of them malformed."""
    path = new_path(spark, "sitemaps")
    I.sitemap_files(spark, folder, path)
    return sitemap_file_urls(spark, path, RULES).select("url")


def url_refresh(spark, folder):
    urls = distinct_urls(I.pages(spark, folder).select("url"))
    return urls_to_fetch(urls, I.snapshots(spark, folder), I.NOW)


def cached_pages(spark, folder):
    urls = distinct_urls(I.pages(spark, folder).select("url"))
    served = successful(servable_pages(urls, I.snapshots(spark, folder), I.NOW))
    return served.select("url", "html", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"))


def page_classes(spark, folder):
    """Class of a page by its path, over adapter paths of all five classes and mixed case."""
    docs = I.table(spark, folder, "documents").selectExpr("doc_id", f"{I.SECTION_URL} AS url")
    return docs.select("doc_id", page_class(F.col("url")).alias("page_class"))


def arrived_pages(spark, folder):
    """Snapshots that arrived with a body, of several status codes."""
    shots = I.snapshots(spark, folder).withColumn("status", F.expr("CAST(CASE hour(fetched_at) % 3 WHEN 0 THEN 200 WHEN 1 THEN 404 ELSE 500 END AS INT)"))
    return successful(shots).select("url", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"))


def wanted_urls(spark, folder):
    """The ranked list from the sitemaps, and the one that seeds stand in for where there are none."""
    listed = I.sitemaps(spark, folder)
    parts = []
    for case, xml in (("sitemap", listed), ("none", listed.where("xml = ''"))):
        ranked = ranked_urls(with_seed_fallback(sitemap_urls(xml, RULES), RULES), RULES)
        place = F.row_number().over(Window.partitionBy("case").orderBy("priority", "url"))
        parts.append(by_priority(ranked.withColumn("case", F.lit(case))).withColumn("place", place.cast("bigint")))
    return unite(*parts).select("case", "place", "url", F.col("priority").cast("bigint").alias("priority"))


def qa_pairs_file(spark, folder):
    """Pairs written as JSON lines and read back."""
    path = new_path(spark, "pairs")
    write_pairs(I.pairs(spark, folder), path)
    return pair_columns(read_pairs(spark, path))


def earlier_documents(spark, folder):
    """Documents of an earlier run, and of a run that never was."""
    path = new_path(spark, "documents")
    write_documents(I.documents(spark, folder, "text").drop("doc_id"), path)
    found = [read_documents_if_present(spark, at) for at in (path, new_path(spark, "absent"))]
    return unite(*found).select("id", "content")


# --- repository files -------------------------------------------------------


def _file_columns(docs):
    return docs.select(
        "id", "source", "url", "title", "content", "content_type", "language",
        F.col("metadata.path").alias("path"), F.col("metadata.repo").alias("repo"),
        F.col("metadata.sha").alias("sha"), F.col("metadata.size").alias("size"),
        F.col("metadata.search_term").alias("search_term"),
    )


def repo_docs(spark, folder):
    return _file_columns(walk_documents(I.repo_files(spark, folder), RULES, LIMITS, I.COLLECTED_AT))


def concept_search(spark, folder):
    return _file_columns(search_documents(I.repo_files(spark, folder), RULES, LIMITS, I.COLLECTED_AT))


def first_code_docs(spark, folder):
    docs = repo_documents(I.repo_files(spark, folder), RULES, LIMITS, I.COLLECTED_AT, limit=50)
    return _file_columns(docs).select("id", "url", "search_term")


def concept_search_many(spark, folder):
    """The search for more terms than can be tested one by one."""
    rules = replace(RULES, vocabulary=I.MANY_TERMS)
    docs = search_documents(I.repo_files(spark, folder), rules, LIMITS, I.COLLECTED_AT)
    return _file_columns(docs).select("id", "url", "search_term")


def file_classes(spark, folder):
    files = I.table(spark, folder, "documents").selectExpr("doc_id", f"{I.PATH} AS path")
    path = F.col("path")
    return files.select(
        "doc_id",
        "path",
        extension(path).alias("extension"),
        file_language(path).alias("language"),
        file_class(path, RULES.implementation_words).alias("content_type"),
        in_skipped_folder(path, RULES).alias("skipped"),
    )


def base64_text(spark, folder):
    body = F.when(F.col("doc_id") % 7 == 0, F.lit("###")).otherwise(F.base64(F.encode("text", "UTF-8")))
    return I.table(spark, folder, "documents").select("doc_id", decode_base64(body).alias("content"))


def _read_file_lines(spark, folder):
    path = new_path(spark, "file-lines")
    I.repo_file_lines(spark, folder).write.text(path)
    return read_repo_files_and_rejects(spark, path)


def repo_good_files(spark, folder):
    good, _ = _read_file_lines(spark, folder)
    return with_content(good).select("repo", "path", "sha", "size", F.length("content").cast("bigint").alias("characters"))


def repo_rejects(spark, folder):
    _, rejects = _read_file_lines(spark, folder)
    return reject_counts(rejects)


# --- model replies ----------------------------------------------------------


def reply_parse(spark, folder):
    parsed = I.replies(spark, folder).select("id", parse_reply(F.col("reply")).alias("pairs"))
    return as_text(parsed, "pairs")


def reply_fallback(spark, folder):
    docs = attach_replies(I.documents(spark, folder), I.replies(spark, folder))
    return with_place(pairs_with_fallback(docs, RULES, LIMITS, I.SEED))


def model_prompts(spark, folder):
    docs = I.documents(spark, folder, "text")
    return docs.select("id", prompt_text(RULES, LIMITS).alias("prompt"))


def prompt_length_model(prompts: pd.Series) -> pd.Series:
    """Stand-in for a model: asks about the length of its prompt."""
    return '[{"instruction":"Prompt of ' + prompts.str.len().astype(str) + ' characters","response":"ok"}]'


def model_answers(spark, folder):
    docs = with_model_replies(I.documents(spark, folder, "text"), prompt_length_model, RULES, LIMITS)
    return with_place(pairs_with_fallback(docs, RULES, LIMITS, I.SEED))


def refusing_model(prompts: pd.Series) -> pd.Series:
    """Stand-in for a model that fails on some prompts, and with them on every batch that holds one."""
    lengths = prompts.str.len()
    if (lengths % 3 == 0).any():
        raise ValueError(f"refused, remainder {lengths.iloc[0] % 2}" if len(prompts) == 1 else "refused")
    return prompt_length_model(prompts)


def model_failures(spark, folder):
    """Errors of the model by their texts, beside the replies that it gave."""
    docs = with_model_replies(I.documents(spark, folder, "text"), refusing_model, RULES, LIMITS)
    given = F.when(F.col("reply_error").isNull(), F.lit("none")).otherwise(F.col("reply_error"))
    return reply_errors(docs.withColumn("outcome", given), "outcome")


# --- whole corpus -----------------------------------------------------------


def _corpus(spark, folder):
    code = repo_documents(I.repo_files(spark, folder), RULES, LIMITS, I.COLLECTED_AT)
    return unite(_page_docs(spark, folder), code)


def doc_union(spark, folder):
    return _corpus(spark, folder).select("id", "source", "url", "title", "content_type", "language")


def documents_per_source(spark, folder):
    return source_counts(_corpus(spark, folder))


def run_totals(spark, folder):
    docs = _corpus(spark, folder)
    found = I.pairs(spark, folder)
    return run_counts(docs, found, RULES.docs_source, collected_code=False)


def jsonl_documents(spark, folder):
    path = new_path(spark, "documents")
    write_documents(I.documents(spark, folder, "text"), path)
    docs = read_documents(spark, path)
    return docs.select(
        "id", "source", "url", "title", "content", "content_type", "language",
        F.col("metadata.path").alias("path"), "collected_at",
    )


QUERIES = {
    "concept_tags": concept_tags,
    "concept_tags_many": concept_tags_many,
    "concept_qa": concept_qa,
    "header_qa": header_qa,
    "code_qa": code_qa,
    "rule_qa": rule_qa,
    "question_dedup": question_dedup,
    "content_dedup": content_dedup,
    "train_split": train_split,
    "split_counts": split_totals,
    **{f"fmt_{name}": partial(training_format, name) for name in FORMATS},
    **{f"render_{name}": partial(chat_rendering, name) for name in (*TEMPLATES, "alpaca")},
    "format_files": format_files,
    "dataset_info": dataset_info,
    "split_dataset": split_dataset,
    "training_rows": training_rows,
    "normalize_chat": normalize_chat,
    "question_prompts": question_prompts,
    "page_text": page_text,
    "page_title": page_title,
    "page_code_blocks": page_code_blocks,
    "page_docs": page_docs,
    "page_blocks": page_blocks,
    "page_paragraph_qa": page_paragraph_qa,
    "page_heading_qa": page_heading_qa,
    "url_filter": url_filter,
    "url_priority": url_rank,
    "sitemap_urls": sitemap_locations,
    "sitemap_files": sitemap_files,
    "url_refresh": url_refresh,
    "cached_pages": cached_pages,
    "repo_docs": repo_docs,
    "file_class": file_classes,
    "b64_decode": base64_text,
    "concept_search": concept_search,
    "first_code_docs": first_code_docs,
    "concept_search_many": concept_search_many,
    "repo_good_files": repo_good_files,
    "repo_rejects": repo_rejects,
    "reply_errors": model_failures,
    "reply_parse": reply_parse,
    "reply_fallback": reply_fallback,
    "model_prompts": model_prompts,
    "model_answers": model_answers,
    "doc_union": doc_union,
    "source_counts": documents_per_source,
    "run_stats": run_totals,
    "jsonl_documents": jsonl_documents,
    "page_class": page_classes,
    "arrived_pages": arrived_pages,
    "wanted_urls": wanted_urls,
    "qa_pairs_file": qa_pairs_file,
    "earlier_documents": earlier_documents,
}
