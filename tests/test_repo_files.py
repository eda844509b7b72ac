import base64

from pyspark.sql import functions as F

from corpusforge.operators.repo_files import (
    first_documents,
    repo_documents,
    search_documents,
    search_hits,
    walk_documents,
)
from conftest import CAPPED

from corpusforge.rules import Limits
from corpusforge.schemas import REPO_FILE
from corpusforge.sources.repos import read_checkout, read_repo_files

TEXT = "import acme and more text " * 8


def files(spark, *rows, repo="acme/core"):
    full = []
    for path, text in rows:
        body = text if isinstance(text, str) and text == "###" else base64.b64encode(text.encode()).decode()
        owner = repo
        if ":" in path:
            owner, path = path.split(":")
        full.append((owner, path, path.split("/")[-1], f"https://code.example/{owner}/{path}", "sha", len(text), body))
    return spark.createDataFrame(full, REPO_FILE)


def by_path(docs):
    return {row["metadata"]["path"]: row for row in docs.collect()}


def test_walk(spark, rules):
    late = "x" * 50_000 + " import acme"
    found = by_path(
        walk_documents(
            files(
                spark, ("src/a.py", TEXT), ("build/a.py", TEXT), ("a.rs", TEXT), ("B.PY", TEXT), ("bad.py", "###"),
                ("empty.py", ""), ("short.py", "import acme"), ("dull.py", "y" * 200), ("late.py", late),
                ("worker/late.py", late), ("edge.py", "import acme" + "z" * 89), ("edge1.py", "import acme" + "z" * 88),
            ),
            rules,
            CAPPED,
            collected_at="now",
        )
    )
    assert sorted(found) == ["B.PY", "edge.py", "src/a.py", "worker/late.py"]
    assert len(found["worker/late.py"]["content"]) == 50_000
    doc = found["src/a.py"]
    assert doc["id"] == "github:acme/core/src/a.py" and doc["title"] == "core/src/a.py" and doc["source"] == "github"
    assert (doc["language"], doc["content_type"], doc["metadata"]["sha"]) == ("python", "code", "sha")
    assert doc["metadata"]["size"] == len(TEXT) and doc["metadata"]["search_term"] is None


def test_search_claims_before_it_checks(spark, rules):
    text = "z" * 200
    found = by_path(
        search_documents(
            files(
                spark, ("a.rs", f"Query worker {text}"), ("b.rs", f"a workflows {text}"), ("c.rs", "workflow"),
                ("build/d.rs", f"task queue query {text}"), ("e.rs", text),
            ),
            rules,
        )
    )
    terms = {path: row["metadata"]["search_term"] for path, row in found.items()}
    assert terms == {"a.rs": "worker", "b.rs": "workflow", "build/d.rs": "task queue"}
    assert found["a.rs"]["metadata"]["size"] is None


def test_search_limits_and_filters(spark, rules):
    text = "workflow worker " + "z" * 200
    many = files(spark, *[(f"f{n:03}.py" if n % 2 else f"f{n:03}.go", text) for n in range(60)])
    assert search_documents(many, rules).count() == 60
    limits = Limits(hits_per_concept=10)
    hits = {(row["doc_id"][-7:-3], row["search_term"]) for row in search_hits(many, rules, limits).collect()}
    assert hits == {(f"f{n:03}", "workflow") for n in range(10)}
    only = search_hits(many, rules, limits, language="python").collect()
    assert {row["doc_id"][-7:] for row in only} == {f"f{n:03}.py"[-7:] for n in range(1, 21, 2)}
    assert search_hits(many, rules, limits, repo="other/repo").count() == 0
    assert search_documents(many, rules, limits).count() == 10


def test_search_owner_and_files_listed_twice(spark, rules):
    import dataclasses

    text = "workflow " + "z" * 200
    table = files(spark, ("a.py", text), ("a.py", text), ("other/repo:b.py", text))
    assert sorted(by_path(search_documents(table, rules))) == ["a.py", "b.py"]
    assert search_documents(table, rules).count() == 2
    owned = dataclasses.replace(rules, search_owner="acme")
    assert sorted(by_path(search_documents(table, owned))) == ["a.py"]
    assert sorted(by_path(search_documents(table, owned, repo="other/repo"))) == ["b.py"]


def test_search_agrees_with_brute_force_when_a_term_is_everywhere(spark, rules):
    texts = [("worker " if n % 3 else "") + ("query " if n % 7 == 0 else "") + "workflow " * (n % 5 == 0) + "z" * 150 for n in range(300)]
    table = files(spark, *[(f"p{n:04}.py", text) for n, text in enumerate(texts)]).repartition(5)
    limits = Limits(hits_per_concept=40)
    claimed = {}
    for term in rules.vocabulary:
        hit = [f"p{n:04}.py" for n, text in enumerate(texts) if term in text.lower()][:40]
        for path in hit:
            claimed.setdefault(path, term)
    got = {row["doc_id"].split("/")[-1]: row["search_term"] for row in search_hits(table, rules, limits).collect()}
    assert got == claimed


def test_walk_and_search_together_keep_both(spark, rules):
    table = files(spark, ("a.py", TEXT + " workflow"), ("other/repo:b.py", TEXT + "worker"))
    docs = repo_documents(table, rules)
    assert sorted((row["id"], row["metadata"]["search_term"] or "") for row in docs.collect()) == [
        ("github:acme/core/a.py", ""), ("github:acme/core/a.py", "workflow"), ("github:other/repo/b.py", "worker"),
    ]


def test_limit_takes_the_first_in_collection_order(spark, rules):
    table = files(spark, ("acme/samples:a.py", TEXT), ("acme/core:z.py", TEXT + "worker"), ("acme/core:y.py", TEXT))
    docs = repo_documents(table, rules)
    assert first_documents(docs, rules, None).count() == first_documents(docs, rules, 0).count() == 4
    order = [row["id"] for row in first_documents(docs, rules, 4).collect()]
    assert order == [
        "github:acme/core/y.py", "github:acme/core/z.py", "github:acme/samples/a.py", "github:acme/core/z.py",
    ]
    assert [row["id"] for row in repo_documents(table, rules, limit=2).collect()] == order[:2]


def test_checkout(spark, rules, tmp_path):
    root = tmp_path / "checkout"
    (root / "src" / "dist").mkdir(parents=True)
    (root / "src" / "a.py").write_text(TEXT)
    (root / "src" / "dist" / "b.py").write_text(TEXT)
    (root / "README.MD").write_text(TEXT)
    (root / "logo.png").write_bytes(b"\xff\x00")
    (root / "bad.py").write_bytes(b"\xff" * 200)
    table = read_checkout(spark, str(root), "acme/core", "https://code.example/acme/core/", rules)
    assert sorted(row["path"] for row in table.collect()) == ["README.MD", "bad.py", "src/a.py", "src/dist/b.py"]
    doc = by_path(walk_documents(table, rules))
    assert sorted(doc) == ["README.MD", "src/a.py"]
    assert doc["src/a.py"]["url"] == "https://code.example/acme/core/src/a.py"
    import hashlib

    blob = b"blob %d\0" % len(TEXT) + TEXT.encode()
    assert doc["src/a.py"]["metadata"]["sha"] == hashlib.sha1(blob).hexdigest()


def test_file_table(spark, rules, tmp_path):
    from corpusforge.sinks.jsonl import write_jsonl

    table = files(spark, ("a.py", TEXT))
    write_jsonl(table, str(tmp_path / "files"))
    assert read_repo_files(spark, str(tmp_path / "files")).collect() == table.collect()
    assert table.select(F.col("content_b64")).count() == 1


def test_many_terms_give_what_few_give(spark, rules, monkeypatch):
    """The automaton and the single tests find the same terms."""
    import dataclasses

    from corpusforge.functions import terms as T

    vocabulary = ("Workflow", "work", "ork", "task queue", "zz", "é", "workflow", "q", "\n", "a.b*")
    texts = ["workflow", "ORK", "a task queue", "É", "x\ny", "a.b*", "nothing he", "zzzz work", "", None]
    table = spark.createDataFrame(list(enumerate(texts)), "n int, x string").select("n", F.lower("x").alias("x"))

    def both():
        found = table.select("n", T.first_term_position(F.col("x"), vocabulary).alias("first"), T.term_positions(F.col("x"), vocabulary).alias("every"))
        return [(r.n, r.first, None if texts[r.n] is None else r.every) for r in found.orderBy("n").collect()]

    few = both()
    assert few[0][1] == 0 and set(few[0][2]) >= {0, 1, 2, 6} and few[3][1] == 5
    monkeypatch.setattr(T, "FEW_TERMS", 0)
    many = both()
    # Of equal terms the automaton reports the first one.
    assert [(n, first, every and [p for p in every if p != 6]) for n, first, every in few] == many
    large = dataclasses.replace(rules, vocabulary=tuple(f"no{k}" for k in range(2_000)) + ("worker",))
    docs = search_documents(files(spark, ("a.rs", "the WORKER " + "z" * 200), ("b.rs", "z" * 200)), large)
    assert [(row["metadata"]["path"], row["metadata"]["search_term"]) for row in docs.collect()] == [("a.rs", "worker")]


def test_files_of_one_url_compete_and_the_rest_pass(spark, rules):
    """A URL that two files claim goes to the first concept; files of other URLs are not moved."""
    text = "import acme " * 20
    table = files(spark, ("a.py", f"query {text}"), ("b.py", f"workflow {text}"), ("c.py", f"worker {text}"), ("c.py", f"worker {text}"))
    shared = F.when(F.col("path").isin("a.py", "b.py"), F.lit("https://one")).otherwise(F.col("html_url"))
    table = table.withColumn("html_url", shared)
    found = search_documents(table, rules).collect()
    assert sorted((row["metadata"]["path"], row["metadata"]["search_term"]) for row in found) == [("b.py", "workflow"), ("c.py", "worker")]
    # The walk keeps a file as often as it is listed.
    assert sorted((row["metadata"]["path"], row["metadata"]["search_term"] or "") for row in repo_documents(table, rules).collect()) == [
        ("a.py", ""), ("b.py", ""), ("b.py", "workflow"), ("c.py", ""), ("c.py", ""), ("c.py", "worker"),
    ]


def test_limit_counts_equal_documents(spark, rules):
    """Files that stand twice in the walk have equal order keys; exactly ``limit`` documents come."""
    table = files(spark, ("a.py", TEXT), ("a.py", TEXT), ("b.py", TEXT))
    assert [repo_documents(table, rules, limit=n).count() for n in (1, 2, 3, 9)] == [1, 2, 3, 3]
