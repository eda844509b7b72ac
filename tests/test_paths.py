from pathlib import PurePath
from urllib.parse import urlparse

from corpusforge.functions import paths as P

URLS = [
    "https://docs.acme.example/a/b?x=/api/#/search", "http://h", "http://h?q", "http://h/p;v=1?x", "http://h/a;b/c;d;e",
    "/rel/path", "mailto:someone", "https://h/a b|c", "HTTPS://H/Path", "//host/p", "https://h/ü#x", "x:y/z", "",
    "\n https://h/p\n",
]


def test_url_path_is_that_of_urlparse(each):
    assert each(P.url_path, URLS) == [urlparse(url).path for url in URLS]


def test_document_url(each, rules):
    cases = {
        "https://h/api/x": False, "https://h/API/x": True, "https://h/_next": False, "https://h/a.json": False,
        "https://h/a?b=/api/": True, "https://h/changelog": False, "https://h/tags/x": False, "https://h/search": False,
        "https://h/sitemap.xml": False, "https://h/a_b": True, "not a url": True, "https://h/apix": True,
    }
    assert each(lambda x: P.is_document_url(x, rules), cases) == list(cases.values())


def test_page_class(each):
    cases = {
        "https://h/develop/deploy": "tutorial", "https://h/SDK": "tutorial", "https://h/references": "reference",
        "https://h/apis": "reference", "https://h/glossary": "concept", "https://h/encyclopedia/x": "concept",
        "https://h/production-x": "guide", "https://h/deploy": "guide", "https://h/?x=/deploy": "documentation",
    }
    assert each(P.page_class, cases) == list(cases.values())


def test_url_priority(each, rules):
    cases = {"https://h/workflows/x": 0, "https://h/workflowsx": 0, "https://h/develop": 1, "https://h/x/develop": 2}
    assert each(lambda x: P.url_priority(x, rules.priority_paths), cases) == list(cases.values())


def test_extension_is_the_lower_cased_suffix(each):
    names = [".gitignore", "A.PY", "a.tar.gz", "nodot", "x.MD", "d.ir/file", "d.ir/f.go", "a.", "dir/.env", "a.b.", "é.mdx"]
    assert each(P.extension, names) == [PurePath(name).suffix.lower() for name in names]


def test_language(each):
    cases = {"a.py": "python", "a.PY": "python", "b.mdx": "markdown", "c.yml": "yaml", "d.rs": None, ".py": None}
    assert each(P.file_language, cases) == list(cases.values())


def test_file_class(each):
    cases = {
        "latest/a.py": "test", "samples/test_x.py": "test", "examples/README.md": "example", "a/b.md": "documentation",
        "a/b.MD": "code", "README.MD": "documentation", "src/Workflow.java": "implementation", "src/a.go": "code",
        "docs/worker.mdx": "documentation",
    }
    words = ("workflow", "activity", "worker")
    assert each(lambda path: P.file_class(path, words), cases) == list(cases.values())
    assert each(P.file_class, ["src/Workflow.java", "a/worker.md"]) == ["code", "documentation"]


def test_skipped_folder(each, rules):
    cases = {
        "a/dist/b.py": True, "a/distx/b.py": False, "build.py": False, "build/x.py": True, "a/build": False,
        "x/.git/y": True, "x/agit/y": False, "a/node_modules/b/c.js": True, "a/__pycache__/x": True, "vendor/a": True,
    }
    assert each(lambda x: P.in_skipped_folder(x, rules), cases) == list(cases.values())


def test_relevance(spark, rules):
    from pyspark.sql import functions as F

    rows = [
        ("a.py", "IMPORT x from ACME", True), ("a.py", "import\nacme", False), ("a.py", "import acme", True),
        ("Acme/a.py", "", True), ("a.py", "x @Workflow y", True), ("a.py", "nothing", False), ("src/worker.py", "", True),
    ]
    table = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "n int, path string, content string, e boolean")
    got = table.select("n", P.is_relevant(F.col("path"), F.col("content"), rules), "e").collect()
    assert all(row[1] == row[2] for row in got), got


def test_base64(each):
    import base64

    good = base64.b64encode("größe\n".encode() * 40).decode()
    lines = "\n".join(good[i : i + 60] for i in range(0, len(good), 60)) + "\n"
    cases = [good, lines, "###", base64.b64encode(b"\xff\xfe").decode(), ""]
    assert each(P.decode_base64, cases) == ["größe\n" * 40, "größe\n" * 40, None, None, ""]
