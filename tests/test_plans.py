"""The physical plans have the shape that large inputs need."""

import dataclasses
import re
import uuid

import pytest
from pyspark.sql import functions as F

from corpusforge.catalog import inputs as I
from corpusforge.catalog.queries import QUERIES
from corpusforge.operators.dedup import first_questions
from corpusforge.operators.pages import extract_pages
from corpusforge.operators.qa import documents_with_concepts, rule_pairs
from corpusforge.operators.repo_files import first_documents, repo_documents, search_documents, search_hits, walk_documents
from corpusforge.operators.split import boundary_row, split_counts, split_pairs
from corpusforge.sources.snapshots import newest_pages, urls_to_fetch

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Whole-table inputs of many partitions."""
    root = str(tmp_path_factory.mktemp("stored"))
    for name in ("documents", "pages"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").repartition(40).write.parquet(f"{root}/{name}.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    yield root
    spark.conf.unset("spark.sql.files.openCostInBytes")


# Lazily planned queries; the others write and read back while they are built.
LAZY = [
    "concept_tags", "rule_qa", "question_dedup", "content_dedup", "fmt_trl", "render_llama3", "normalize_chat",
    "page_docs", "url_filter", "url_priority", "sitemap_urls", "url_refresh", "cached_pages", "repo_docs",
    "concept_search", "reply_parse", "reply_fallback", "doc_union",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_row_wise_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "Scan ExistingRDD" not in text


def test_pairs_are_one_map_pass(spark, stored):
    text = plan(rule_pairs(I.documents(spark, stored), I.RULES))
    assert "Exchange" not in text and text.count("FileScan") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_tags_are_computed_once(spark, stored):
    docs = I.table(spark, stored, "documents").select("doc_id", F.col("text").alias("content"))
    text = plan(documents_with_concepts(docs, I.RULES))
    assert text.count("RLIKE") == len(I.RULES.vocabulary)


def test_question_dedup_is_one_shuffle_with_partial_reduction(spark, stored):
    text = plan(first_questions(rule_pairs(I.documents(spark, stored), I.RULES)))
    assert text.count("Exchange") == 1 and "partial_min" in text


def test_pages_are_taken_apart_once(spark, stored):
    text = plan(extract_pages(I.pages(spark, stored), I.RULES))
    assert "Exchange" not in text
    assert text.count("!--.*?-->") == 1, "the costly clean-up must not be repeated by a pushed-down filter"


def test_url_filter_runs_before_the_page_is_taken_apart(spark, stored):
    text = plan(QUERIES["page_docs"](spark, stored))
    scan, filtered, cleaned = text.index("FileScan"), text.index("Filter "), text.index("!--.*?-->")
    assert cleaned < filtered < scan, "a plan prints its last step first"


def test_walk_filters_paths_before_decoding(spark, stored):
    text = plan(walk_documents(I.repo_files(spark, stored), I.RULES))
    assert text.count("tryeval(unbase64") + text.count("try_to_binary") <= 1
    assert "Exchange" not in text


def test_search_shuffles_keys_only(spark, stored):
    hits = search_hits(I.repo_files(spark, stored), I.RULES)
    assert plan(hits).count("FileScan") == 1 and "Window" not in plan(hits)
    for below in exchanged_columns(plan(hits)):
        assert not re.search("content|text|_lower", below), below


def test_walk_and_search_share_one_scan_and_one_decoding(spark, stored):
    for found in (search_documents(I.repo_files(spark, stored), I.RULES), repo_documents(I.repo_files(spark, stored), I.RULES)):
        text = plan(found)
        assert text.count("FileScan") == 1 and "Exchange" not in text
        assert text.count("unbase64") + text.count("try_to_binary") == 1


def test_a_limit_sorts_keys_only(spark, stored):
    docs = repo_documents(I.repo_files(spark, stored), I.RULES)
    text = plan(first_documents(docs, I.RULES, 50))
    assert re.findall(r"TakeOrderedAndProject\(.*?output=\[(.*?)#", text) == ["order"]
    # The chosen documents are then looked up by their keys.
    assert "BroadcastHashJoin" in text and "TakeOrderedAndProject" not in plan(QUERIES["first_code_docs"](spark, stored))


def test_many_terms_are_one_python_node(spark, stored):
    rules = dataclasses.replace(I.RULES, vocabulary=I.MANY_TERMS)
    text = plan(search_documents(I.repo_files(spark, stored), rules))
    assert text.count("ArrowEvalPython") == 1 and text.count("Contains") < 10, "paths are tested for a few words only"


def exchanged_columns(text):
    """What stands right below each exchange of a plan: the node whose rows are moved."""
    rows = text.split("\n")
    return [rows[at + 1].partition("output=")[2] or rows[at + 1] for at, row in enumerate(rows) if "Exchange hashpartitioning" in row]


def test_refresh_reads_urls_only(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    I.snapshots(spark, FOLDER).write.parquet(path)
    snapshots = spark.read.parquet(path)
    text = plan(urls_to_fetch(snapshots.select("url").distinct(), snapshots, I.NOW))
    assert "html" not in "".join(re.findall(r"ReadSchema: (.*)", text))
    assert "PushedFilters: [IsNotNull(status)" in text and "GreaterThan(fetched_at" in text


def test_newest_pages_aggregate_keys_only(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    I.snapshots(spark, FOLDER).write.parquet(path)
    found = newest_pages(spark.read.parquet(path))
    text = plan(found.where("status >= 0"))
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    keys = [row for row in text.split("\n") if "partial_max(struct(_order" in row or "partial_count" in row]
    assert keys and not any("html" in row for row in keys)
    # Only the branch of equal (url, fetched_at) compares whole rows.
    assert len([row for row in text.split("\n") if "partial_max(" in row and "html" in row]) == 1


def test_split_rows_are_only_compared(spark):
    split = split_pairs(I.stored_pairs(spark, FOLDER))
    text = plan(split.where("split = 'train'").select("instruction"))
    scans = re.findall(r"ReadSchema: (struct<.*>)", text)
    assert scans.count("struct<instruction:string,shuffle_key:string,copy:string>") == 1
    assert {column for scan in scans if "instruction" not in scan for column in re.findall(r"(\w+):", scan)} <= {"shuffle_key", "copy"}
    # Only counts and the keys of one bucket are moved.
    for below in exchanged_columns(text) + re.findall(r"Exchange SinglePartition.*\n(.*)", text):
        assert "instruction" not in below and "response" not in below


def jobs_of(spark, build):
    """Jobs that ``build`` starts."""
    name = f"build-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(name, "")
    try:
        built = build()
        return built, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_split_starts_no_job(spark):
    keyed = I.keyed_pairs(spark, FOLDER)  # opening a table reads its schema
    split, jobs = jobs_of(spark, lambda: split_pairs(keyed))
    counts, more = jobs_of(spark, lambda: split_counts(split))
    assert jobs == more == 0
    for built in (split, counts):
        found, jobs = jobs_of(spark, built.count)
        assert found and jobs > 0, "jobs of the group are seen"


def test_a_split_makes_its_pairs_once(spark):
    split = QUERIES["train_split"](spark, FOLDER)
    split.collect()
    text = plan(split).split("== Initial Plan ==")[0]
    assert text.count("ReusedExchange") >= 1 and text.count("Generate posexplode") <= 1


def test_one_job_finds_the_boundary(spark):
    stored_pairs = I.stored_pairs(spark, FOLDER)
    text = plan(boundary_row(stored_pairs))
    columns = {column for scan in re.findall(r"ReadSchema: (struct<.*>)", text) for column in re.findall(r"(\w+):", scan)}
    assert columns == {"shuffle_key", "copy"}


def test_train_filter_reaches_the_scan(spark):
    from corpusforge.operators.split import in_train, split_boundary

    stored_pairs = I.stored_pairs(spark, FOLDER)
    text = plan(stored_pairs.where(in_train(split_boundary(stored_pairs))).select("instruction"))
    assert "Or(LessThan(shuffle_key" in text
