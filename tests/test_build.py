import base64
import json

import pytest

from corpusforge.operators.corpus import run_counts, source_counts, unite
from corpusforge.plans.build_corpus import build_corpus, collect_pages
from corpusforge.rules import DomainRules
from corpusforge.schemas import REPO_FILE
from corpusforge.sources.jsonl import read_documents, read_pairs

SITE = "https://docs.acme.example"
TEXT = "A workflow is run by a worker, and this text explains at length what that means. " * 3
PREFIX = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


def page(title, text):
    return f"<html><head><title>{title}</title></head><body><nav>menu</nav><main><h1>{title}</h1><p>{text}</p></main></body></html>"


@pytest.fixture(scope="module")
def inputs(spark):
    import datetime

    day = lambda number: datetime.datetime(2024, 1, number)
    snapshots = spark.createDataFrame(
        [
            (f"{SITE}/workflows", page("Workflows", "old " + TEXT), 200, day(1)),
            (f"{SITE}/workflows", page("Workflows", TEXT), 200, day(2)),
            (f"{SITE}/develop/go", page("Go", TEXT.replace("workflow", "signal")), 200, day(1)),
            (f"{SITE}/api/x", page("API", TEXT), 200, day(1)),
            (f"{SITE}/missing", "gone", 404, day(1)),
            (f"{SITE}/unlisted", page("Unlisted", TEXT.replace("worker", "timer")), 200, day(1)),
        ],
        "url string, html string, status int, fetched_at timestamp",
    )
    listed = "".join(f"<url><loc>{SITE}/{path}</loc></url>" for path in ("workflows", "develop/go", "api/x", "missing"))
    sitemaps = spark.createDataFrame([(f"<urlset {PREFIX}>{listed}</urlset>",)], "xml string")
    files = {
        "docs/guide.md": f"# Overview\n{TEXT}\n## How to start\nimport acme and a worker\n{TEXT}\n## Timers\n{TEXT}",
        "src/worker.py": "import acme  # a worker\n" + "x = 1\n" * 40,
        "src/other.rs": TEXT,
        "build/gen.py": TEXT,
    }
    rows = [
        ("acme/core", path, path.split("/")[-1], f"https://code.example/{path}", "s", len(text), base64.b64encode(text.encode()).decode())
        for path, text in files.items()
    ]
    return snapshots, sitemaps, spark.createDataFrame(rows, REPO_FILE)


@pytest.fixture(scope="module")
def preset():
    return DomainRules(
        domain="Acme",
        vocabulary=("workflow", "worker", "signal", "timer"),
        system_prompt="You answer questions about Acme.",
        docs_source="acme_docs",
        docs_base_url=SITE,
        docs_host_pattern=r"https://docs\.acme\.example",
        repositories=("acme/core",),
        relevance_patterns=(r"import.*acme",),
        relevance_path_words=("worker",),
    )


def lines(spark, path):
    return [json.loads(row[0]) for row in spark.read.text(path).collect()]


def test_whole_run(spark, inputs, preset, tmp_path):
    snapshots, sitemaps, files = inputs
    root = str(tmp_path / "data")
    result = build_corpus(spark, preset, root, snapshots, sitemaps, files, partitions=3)

    docs = {row["url"]: row for row in read_documents(spark, f"{root}/raw/docs").collect()}
    assert sorted(docs) == [f"{SITE}/develop/go", f"{SITE}/workflows"]
    assert docs[f"{SITE}/workflows"]["content"] == f"Workflows {TEXT.strip()}"
    assert docs[f"{SITE}/develop/go"]["content_type"] == "tutorial"
    code = [(row["metadata"]["path"], row["metadata"]["search_term"]) for row in read_documents(spark, f"{root}/raw/code").collect()]
    assert sorted(code, key=repr) == sorted(
        [
            ("docs/guide.md", None), ("src/worker.py", None), ("docs/guide.md", "workflow"), ("src/worker.py", "worker"),
            ("src/other.rs", "workflow"), ("build/gen.py", "workflow"),
        ],
        key=repr,
    )

    pairs = read_pairs(spark, f"{root}/processed/qa_pairs").collect()
    asked = {row["instruction"]: row for row in pairs}
    assert len(asked) == len(pairs) == result["stats"]["qa_pairs_generated"]
    assert "How to start?" in asked and "What is Timers in Acme?" in asked and not any("Overview" in q for q in asked)
    assert asked["How do I implement a worker in Acme using Python?"]["category"] == "code"

    stats = result["stats"]
    assert (stats["docs_collected"], stats["code_collected"]) == (2, 6) and stats["start_time"] < stats["end_time"]
    train = int(len(pairs) * 0.9)
    assert list(result["output_paths"]) == ["trl", "torchtune", "alpaca"]
    for name, paths in result["output_paths"].items():
        assert (paths["train_count"], paths["val_count"]) == (train, len(pairs) - train)
        assert len(lines(spark, paths["train"])) == train
    first = lines(spark, result["output_paths"]["trl"]["train"])[0]
    assert first["messages"][0]["content"].startswith("You answer questions about Acme.")
    info = lines(spark, f"{root}/processed/training_data/dataset_info")[0]
    assert info["total_examples"] == len(pairs) and info["template"] == "llama3"
    saved = lines(spark, f"{root}/run_stats")[0]
    assert saved["stats"] == stats and saved["output_paths"] == result["output_paths"]

    again = build_corpus(spark, preset, root, skip_docs=True, skip_code=True, formats=["raw"], partitions=7)
    assert again["stats"]["docs_collected"] == again["stats"]["code_collected"] == 0
    assert again["stats"]["qa_pairs_generated"] == len(pairs)
    asked_again = {row["instruction"]: row for row in read_pairs(spark, f"{root}/processed/qa_pairs").collect()}
    assert asked_again == asked


def test_run_without_anything(spark, preset, tmp_path):
    result = build_corpus(spark, preset, str(tmp_path / "empty"), skip_docs=True, skip_code=True, formats=["raw"])
    assert result["stats"]["qa_pairs_generated"] == 0


def test_run_with_a_model_and_a_limit(spark, inputs, preset, tmp_path):
    def model(prompts):
        return ['[{"instruction":"Asked?","response":"Yes"}]' if "Document Type: code" in p else "no" for p in prompts]

    _, _, files = inputs
    root = str(tmp_path / "data")
    result = build_corpus(spark, preset, root, repo_files=files, code_limit=3, model=model, formats=["raw"])
    assert result["stats"]["code_collected"] == 3 and result["stats"]["docs_collected"] == 0
    asked = {row["instruction"] for row in read_pairs(spark, f"{root}/processed/qa_pairs").collect()}
    assert "How to start?" in asked


def test_pages_without_a_sitemap_use_the_url_filter(spark, inputs, preset):
    urls = {row["url"] for row in collect_pages(inputs[0], preset).collect()}
    assert urls == {f"{SITE}/workflows", f"{SITE}/develop/go", f"{SITE}/unlisted"}


def test_hot_url_keeps_its_newest_page(spark, inputs, preset):
    """A third of all snapshots are of one URL."""
    base = inputs[0].where("html LIKE '%old%'")
    many = spark.range(600).join(base.hint("broadcast"), how="cross").selectExpr(
        f"if(id % 3 = 0, url, concat('{SITE}/p', id)) AS url", "replace(html, 'old', concat('v', id)) AS html",
        "status", "timestamp_seconds(1700000000 + id) AS fetched_at",
    )
    docs = collect_pages(many, preset)
    assert docs.count() == 401
    assert " v597 " in docs.where(f"url = '{SITE}/workflows'").first()["content"]


def test_counts(spark, make_docs):
    docs = make_docs({}, {"source": "github"}, {"source": "github"})
    assert {row["source"]: row["documents"] for row in source_counts(docs).collect()} == {"acme_docs": 1, "github": 2}
    assert tuple(run_counts(docs, docs, "acme_docs").first()) == (1, 2, 3)
    assert tuple(run_counts(docs, docs, "acme_docs", collected_docs=False).first()) == (0, 2, 3)
    assert unite(docs, docs.drop("language"), docs).count() == 9


def test_failures_and_rejects_are_counted(spark, rules, tmp_path):
    """A model that fails on every prompt and a broken file row leave a run that tells of both."""
    from corpusforge.sources.repos import read_repo_files_and_rejects

    text = "This paragraph is about a workflow and it is quite long, " * 3
    body = __import__("base64").b64encode(text.encode()).decode()
    rows = [{"repo": "acme/core", "path": f"worker/{n}.py", "name": f"{n}.py", "html_url": f"u{n}", "sha": "s", "size": 1, "content_b64": body} for n in range(3)]
    (tmp_path / "files.jsonl").write_text("\n".join([*map(__import__("json").dumps, rows), '{"repo": "acme/other", ']))
    files, rejects = read_repo_files_and_rejects(spark, str(tmp_path / "files.jsonl"))

    def failing(prompts):
        raise RuntimeError("no model today")

    root = str(tmp_path / "out")
    result = build_corpus(spark, rules, root, repo_files=files, repo_rejects=rejects, model=failing)
    stats = result["stats"]
    assert (stats["code_collected"], stats["files_rejected"], stats["model_errors"]) == (6, 1, 6)
    assert stats["qa_pairs_generated"] > 0  # by the rules
    saved = spark.read.json(f"{root}/run_stats").first()["stats"]
    assert (saved["files_rejected"], saved["model_errors"]) == (1, 6)
    assert spark.read.json(f"{root}/raw/rejects").first()["repo"] == "acme/other"
