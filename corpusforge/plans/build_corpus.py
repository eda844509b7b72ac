"""From pages and repository files to training files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.corpus import unite
from ..operators.dedup import distinct_urls, first_questions
from ..operators.pages import document_urls, page_documents
from ..operators.qa import rule_pairs
from ..operators.replies import pairs_with_fallback, with_model_replies
from ..operators.repo_files import repo_documents
from ..rules import DomainRules, Limits
from ..sinks.jsonl import write_documents, write_jsonl, write_pairs
from ..sinks.training import ordered_pairs, write_formats, write_run_stats
from ..sources.jsonl import read_documents, read_documents_if_present
from ..sources.sitemap import sitemap_urls, with_seed_fallback
from ..sources.snapshots import newest_pages, successful
from ..staging import staged

DEFAULT_FORMATS = ("trl", "torchtune", "alpaca")


def wanted_urls(sitemaps: DataFrame, rules: DomainRules) -> DataFrame:
    """Distinct URLs of the sitemaps, or the seed URLs if they have none."""
    return distinct_urls(with_seed_fallback(sitemap_urls(sitemaps, rules), rules))


def collect_pages(
    snapshots: DataFrame,
    rules: DomainRules,
    limits: Limits = Limits(),
    urls: DataFrame | None = None,
    keep_paragraphs: bool = False,
) -> DataFrame:
    """Documents of the newest successful snapshot of each URL, of the wanted ``urls`` if given.

    URLs are filtered before the pages are moved and before they are taken apart.
    """
    pages = successful(snapshots)
    if urls is None:
        pages = document_urls(pages, rules)
    else:
        pages = pages.join(urls.select("url"), "url", "left_semi")
    return page_documents(newest_pages(pages), rules, limits, keep_paragraphs=keep_paragraphs)


def build_corpus(
    spark: SparkSession,
    rules: DomainRules,
    output_dir: str,
    snapshots: DataFrame | None = None,
    sitemaps: DataFrame | None = None,
    repo_files: DataFrame | None = None,
    repo_rejects: DataFrame | None = None,
    limits: Limits = Limits(),
    seed: str = "0",
    skip_docs: bool = False,
    skip_code: bool = False,
    code_limit: int | None = None,
    model=None,
    formats=DEFAULT_FORMATS,
    template: str = "llama3",
    partitions: int | None = None,
    keep_paragraphs: bool = False,
) -> dict:
    """Run all steps and write their results below ``output_dir``.

    Without ``snapshots``/``repo_files`` or with the skip flags, documents of an earlier
    run are read instead.  Each document set is written once and read back, so later
    steps neither repeat the extraction nor depend on the executors that did it; the
    counters are taken while writing, also that of prompts on which the model failed.  ``repo_rejects`` are lines of
    the file table that could not be read (``read_repo_files_and_rejects``); they are written beside the documents.
    """
    started = _utc_iso()
    root = output_dir.rstrip("/")
    # A source that is re-read instead of collected counts as 0.
    tables, counts = [], {"docs": 0, "code": 0}
    for name, skip, collect in (
        ("docs", skip_docs or snapshots is None, lambda: collect_pages(snapshots, rules, limits, _urls(sitemaps, rules), keep_paragraphs)),
        ("code", skip_code or repo_files is None, lambda: repo_documents(repo_files, rules, limits, limit=code_limit)),
    ):
        path = f"{root}/raw/{name}"
        if skip:
            tables.append(read_documents_if_present(spark, path))
        else:
            count = Observation()
            write_documents(collect().observe(count, F.count(F.lit(1)).alias("rows")), path)
            counts[name] = count.get["rows"]
            tables.append(read_documents(spark, path))
    docs = unite(*tables)
    rejected = 0
    if repo_rejects is not None:
        count = Observation()
        write_jsonl(repo_rejects.observe(count, F.count(F.lit(1)).alias("rows")), f"{root}/raw/rejects")
        rejected = count.get["rows"]

    failures = None
    if model is None:
        found = rule_pairs(docs, rules, limits, seed)
    else:
        failures = Observation()
        answered = with_model_replies(docs, model, rules, limits)
        answered = answered.observe(failures, F.count("reply_error").alias("rows"))
        found = pairs_with_fallback(answered, rules, limits, seed)
    with staged(ordered_pairs(first_questions(found), seed, partitions), "pairs") as pairs:
        write_pairs(pairs, f"{root}/processed/qa_pairs")
        outputs = write_formats(
            pairs, f"{root}/processed/training_data", rules.system_prompt, formats, template, limits.train_fraction
        )
        total = pairs.count()

    stats = {
        "docs_collected": counts["docs"],
        "code_collected": counts["code"],
        "qa_pairs_generated": total,
        "files_rejected": rejected,
        "model_errors": failures.get["rows"] if failures else 0,
        "start_time": started,
        "end_time": _utc_iso(),
    }
    write_run_stats(spark, stats, outputs, f"{root}/run_stats")
    return {"stats": stats, "output_paths": outputs}


def _urls(sitemaps: DataFrame | None, rules: DomainRules) -> DataFrame | None:
    return None if sitemaps is None else wanted_urls(sitemaps, rules)


def _utc_iso() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
