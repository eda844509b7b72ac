import datetime
import json

import pytest

from corpusforge.operators.pages import document_urls
from corpusforge.sinks.jsonl import write_documents
from corpusforge.sources.jsonl import read_documents, read_documents_if_present
from corpusforge.sources.sitemap import read_sitemaps, seed_urls, sitemap_urls, with_seed_fallback
from corpusforge.sources.snapshots import fresh, servable_pages, successful, urls_to_fetch

NAMESPACE = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
DOC = {"id": "1", "source": "s", "url": "u", "title": "t", "content": "größe", "content_type": "code"}


def test_documents_round_trip(spark, make_docs, tmp_path):
    docs = make_docs({"content": "größe\n\"x\""}, {"language": "go", "metadata": ("p", "r", "s", 5, None, None)})
    write_documents(docs, str(tmp_path / "docs"))
    lines = sorted(row[0] for row in spark.read.text(str(tmp_path / "docs")).collect())
    assert '"language":null' in lines[0] and "größe" in lines[0]
    assert sorted(read_documents(spark, str(tmp_path / "docs")).collect()) == sorted(docs.collect())


def test_blank_lines_and_defaults(spark, tmp_path):
    path = tmp_path / "docs.jsonl"
    path.write_text("\n" + json.dumps(DOC) + "\n   \n" + json.dumps({**DOC, "unknown": 1, "collected_at": "then"}) + "\n\n")
    rows = read_documents(spark, str(path), collected_at="now").collect()
    assert [row["collected_at"] for row in rows] == ["now", "then"]
    assert rows[0]["language"] is None and rows[0]["metadata"] is not None and rows[0]["metadata"]["path"] is None
    stamp = read_documents(spark, str(path)).first()["collected_at"]
    age = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None) - datetime.datetime.fromisoformat(stamp)
    assert abs(age.total_seconds()) < 300


def test_malformed_line_fails(spark, tmp_path):
    path = tmp_path / "docs.jsonl"
    path.write_text(json.dumps(DOC) + "\n{broken\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_documents(spark, str(path)).collect()


def test_absent_documents_are_none(spark, tmp_path):
    docs = read_documents_if_present(spark, str(tmp_path / "nothing"))
    assert docs.count() == 0 and "content" in docs.columns


def sitemap(spark, rules, *texts):
    return sorted(row[0] for row in sitemap_urls(spark.createDataFrame([(t,) for t in texts], "xml string"), rules).collect())


def test_sitemap(spark, rules):
    good = (
        f"<?xml version='1.0' encoding='UTF-8'?>\n<urlset {NAMESPACE}>\n<url><loc>https://docs.acme.example/a?x=1&amp;y=2</loc>"
        "<lastmod>2024-01-01</lastmod></url>\n<url><loc>https://docs.acme.example/api/b</loc></url>"
        "<url><loc>http://other.example/c</loc></url><url></url></urlset>"
    )
    assert sitemap(spark, rules, good) == ["http://other.example/c", "https://docs.acme.example/a?x=1&y=2"]


def test_malformed_sitemap_is_salvaged_unfiltered(spark, rules):
    cut = (
        f"<urlset {NAMESPACE}><url><loc>https://docs.acme.example/api/b</loc></url><url><loc>http://other.example/c</loc>"
        "</url><url><loc>https://docs.acme.example/x&y</loc>"
    )
    assert sitemap(spark, rules, cut) == ["https://docs.acme.example/api/b", "https://docs.acme.example/x&y"]


def test_empty_and_foreign_sitemaps(spark, rules):
    no_namespace = "<urlset><url><loc>https://docs.acme.example/a</loc></url></urlset>"
    assert sitemap(spark, rules, "", None, f"<urlset {NAMESPACE}></urlset>", no_namespace, "plain text") == []


def test_seed_urls(spark, rules, tmp_path):
    (tmp_path / "sitemap.xml").write_text(f"<urlset {NAMESPACE}>\n<url><loc>https://h/a</loc></url></urlset>")
    urls = sitemap_urls(read_sitemaps(spark, str(tmp_path / "sitemap.xml")), rules)
    assert [row[0] for row in with_seed_fallback(urls, rules).collect()] == ["https://h/a"]
    seeds = ["https://docs.acme.example/develop", "https://docs.acme.example/workflows"]
    assert sorted(row[0] for row in seed_urls(spark, rules).collect()) == seeds
    assert sorted(row[0] for row in with_seed_fallback(urls.where("false"), rules).collect()) == seeds


def snapshots(spark):
    time = lambda text: datetime.datetime.fromisoformat(f"2024-01-{text}")
    rows = [
        ("a", "old", 200, time("01T13:00:00")), ("a", "new", 200, time("01T20:00:00")), ("a", "failed", 500, time("01T23:00:00")),
        ("b", "expired", 200, time("01T00:00:00")), ("c", "failed", 404, time("01T23:00:00")), ("d", "", 200, time("01T23:00:00")),
        ("x", "unwanted", 200, time("01T23:00:00")), ("e", "just", 200, time("01T00:00:01")),
    ]
    return spark.createDataFrame(rows, "url string, html string, status int, fetched_at timestamp")


def test_snapshots(spark):
    now = "2024-01-02 00:00:00"
    urls = spark.createDataFrame([(url,) for url in "abcdef"], "url string")
    pages = snapshots(spark)
    assert sorted(row[0] for row in urls_to_fetch(urls, pages, now).collect()) == ["b", "c", "f"]
    served = {row["url"]: row["html"] for row in servable_pages(urls, pages, now).collect()}
    assert served == {"a": "new", "d": "", "e": "just"}
    assert fresh(pages, now, hours=1).count() == 0
    assert sorted(row["url"] for row in successful(pages).collect()) == ["a", "a", "b", "e", "x"]


def test_document_urls(spark, rules):
    urls = spark.createDataFrame([("https://h/api/x",), ("https://h/x",)], "url string")
    assert [row[0] for row in document_urls(urls, rules).collect()] == ["https://h/x"]


def test_a_broken_training_line_fails(spark, tmp_path):
    from corpusforge.sources.jsonl import read_training_rows

    path = tmp_path / "rows.jsonl"
    path.write_text('{"instruction": "a", "output": "b"}\n{"instruction": "a", \n')
    with pytest.raises(Exception):
        read_training_rows(spark, str(path), "instruction string, output string").collect()
    with pytest.raises(Exception):
        read_training_rows(spark, str(path)).collect()


def test_broken_file_rows_go_to_a_table_of_their_own(spark, tmp_path):
    from corpusforge.sources.repos import read_repo_files_and_rejects, reject_counts

    good = {"repo": "a/b", "path": "x.py", "name": "x.py", "html_url": "u", "sha": "s", "size": 3, "content_b64": "eA=="}
    lines = [
        json.dumps(good), '{"repo": "a/b", "path": "y.p', "nonsense", "", json.dumps({**good, "size": "many"}),
        json.dumps({**good, "path": None}), json.dumps({**good, "repo": ""}), json.dumps({**good, "extra": 1}),
    ]
    (tmp_path / "files.jsonl").write_text("\n".join(lines))
    files, rejects = read_repo_files_and_rejects(spark, str(tmp_path / "files.jsonl"))
    assert [(r.repo, r.path, r.size) for r in files.collect()] == [("a/b", "x.py", 3)] * 2
    assert {(r.repo, r.reason): r.rejects for r in reject_counts(rejects).collect()} == {
        ("a/b", "malformed"): 2, (None, "malformed"): 1, ("a/b", "no repository or path"): 1, (None, "no repository or path"): 1,
    }
    assert lines[1] in {r.line for r in rejects.collect()}
    (tmp_path / "none.jsonl").write_text("")
    files, rejects = read_repo_files_and_rejects(spark, str(tmp_path / "none.jsonl"))
    assert files.count() == rejects.count() == 0


def file_urls(spark, rules, tmp_path, **files):
    from corpusforge.sources.sitemap import sitemap_file_urls

    folder = tmp_path / "maps"
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.xml").write_text(text)
    rows = sitemap_file_urls(spark, str(folder), rules).collect()
    return sorted((row.file.split("/")[-1].removesuffix(".xml"), row.url) for row in rows)


def test_sitemap_files_agree_with_whole_texts(spark, rules, tmp_path):
    entry = "<url><loc>https://docs.acme.example/{}</loc><lastmod>2024</lastmod></url>"
    head = f"<?xml version='1.0'?>\n<!-- a > b -->\n<urlset {NAMESPACE}>\n"
    files = {
        "good": head + entry.format("a?x=1&amp;y=2") + "\n <url  >\n<loc>https://docs.acme.example/b</loc></url>" + entry.format("api/no") + "\n</urlset >\n",
        "cut": head + entry.format("api/b") + "<url><loc>https://docs.acme.example/c",
        "unclosed": head + entry.format("d"),
        "entity": head + entry.format("e") + entry.format("x&y") + "</urlset>",
        "nested": head + "<url><loc>https://docs.acme.example/f</lok></url></urlset>",
        "junk": head + "text" + entry.format("g") + "</urlset>",
        "empty": f"<urlset {NAMESPACE}></urlset>",
        "foreign": "<urlset><url><loc>https://docs.acme.example/h</loc></url></urlset>",
        "plain": "plain text",
    }
    got = file_urls(spark, rules, tmp_path, **files)
    # Loose text between entries is the one case that a parser of the whole lets pass.
    want = sorted((name, url) for name, text in files.items() if name != "junk" for url in sitemap(spark, rules, text))
    assert [row for row in got if row[0] != "junk"] == want
    assert [row for row in got if row[0] == "junk"] == [("junk", "https://docs.acme.example/g")]


def test_one_large_sitemap_is_read_by_several_tasks(spark, rules, tmp_path):
    from corpusforge.sources.sitemap import sitemap_file_urls

    many = 20_000
    text = f"<urlset {NAMESPACE}>" + "".join(f"<url><loc>https://docs.acme.example/p/{n}</loc></url>" for n in range(many)) + "</urlset>"
    (tmp_path / "large.xml").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        urls = sitemap_file_urls(spark, str(tmp_path / "large.xml"), rules)
        written = spark.read.option("lineSep", "</url>").text(str(tmp_path / "large.xml"))
        assert written.rdd.getNumPartitions() > 4
        assert urls.select("url").distinct().count() == urls.count() == many
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
