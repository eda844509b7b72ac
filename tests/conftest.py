import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusforge import DomainRules, Limits, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rules():
    return DomainRules(
        domain="Acme",
        vocabulary=("workflow", "worker", "task queue", "query"),
        system_prompt="You know Acme.",
        docs_source="acme_docs",
        docs_base_url="https://docs.acme.example/start",
        docs_host_pattern=r"https://docs\.acme\.example",
        title_suffix=" | Acme",
        priority_paths=("/workflows", "/develop"),
        repositories=("acme/core", "acme/samples"),
        relevance_patterns=(r"@workflow", r"import.*acme"),
        relevance_path_words=("acme", "worker"),
        implementation_words=("workflow", "activity", "worker"),
    )


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over a one-row table."""

    def value(make, text):
        return spark.createDataFrame([(text,)], "x string").select(make(__import__("pyspark").sql.functions.col("x"))).first()[0]

    return value


@pytest.fixture(scope="session")
def each(spark):
    """Values of a column expression over texts, in order, in one job."""
    from pyspark.sql import functions as F

    def values(make, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "n int, x string")
        return [row[0] for row in rows.select(make(F.col("x")).alias("y"), "n").orderBy("n").collect()]

    return values


# Limits that cut, for tests of the cuts; by default nothing is cut.
CAPPED = Limits(
    max_content=50_000, max_answer=1_500, max_code=2_000, max_prompt=4_000, concepts_per_document=3,
    sections_per_document=5, searched_concepts=10, hits_per_concept=100,
)

PAGE = "https://docs.acme.example"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from dicts with defaults."""
    from corpusforge.schemas import DOCUMENT

    def make(*rows):
        full = []
        for number, row in enumerate(rows):
            base = dict(
                id=f"docs:{number:03}", source="acme_docs", url=f"{PAGE}/{number:03}", title="T", content="",
                content_type="documentation", language=None,
                metadata=(None, None, None, None, None, []), collected_at="2024-01-01T00:00:00",
            )
            base.update(row)
            full.append(tuple(base.values()))
        return spark.createDataFrame(full, DOCUMENT)

    return make
