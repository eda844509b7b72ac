import pytest
from pyspark.sql import functions as F

from corpusforge.catalog import inputs as I
from corpusforge.functions.html_tree import read_page
from corpusforge.operators.pages import by_priority, extract_pages, page_documents, ranked_urls
from corpusforge.rules import Limits

FILL = "lorem ipsum " * 10
ANY = Limits(min_content=0)


def body(inner):
    return f"<html><head><title>Site title | Acme</title></head><body>{inner}</body></html>"


# HTML to (title, content, code blocks).
PAGES = {
    '<html><body><script>var a="</p><h1>x</h1><!-- ";</script><p>one</p><!-- <p>no</p> -->two</body></html>':
        ("Untitled", "one two", []),
    body("<header><h1>Gone</h1></header><p>wo<!-- x -->rd</p>"): ("Site title", "wo rd", []),
    body("<h1></h1><p>x</p>"): ("Untitled", "x", []),
    body("<h1>A <b>b</b></h1><p>x</p>"): ("Ab", "A b x", []),
    body("<h1> Two  words </h1>x"): ("Two  words", "Two words x", []),
    body('<div class="top">no</div><div class="x Docs-y">in <div>side</div> end</div><p>out</p>'):
        ("Site title", "in side end", []),
    body("<article>a</article><main>m <i>n</i></main>"): ("Site title", "m n", []),
    body("<article>a<article>b</article>c</article>d"): ("Site title", "a b c", []),
    body("<nav>x<nav>y</nav>z</nav>text"): ("Site title", "text", []),
    body("<main>unclosed <p>region"): ("Site title", "unclosed region", []),
    body("<p>&lt;b&gt; &amp;lt; &quot;q&quot; &#x41;&#66; &eacute; &nbsp; end</p>"):
        ("Site title", "<b> &lt; \"q\" AB é end", []),
    body('<p title="a>b">x</p> 1 < 2'): ("Site title", "x 1 < 2", []),
    body('<pre><code class="hl language-py">x = 1\n  y &lt; 2</code></pre><pre>  </pre><pre>raw</pre>'):
        ("Site title", "x = 1 y < 2 raw", [("x = 1\n  y < 2", "py"), ("raw", None)]),
    body("<pre><code class=language-a-language-b>z <b>q</b></code></pre>"):
        ("Site title", "z q", [("zq", "a-b")]),
    body("<pre>a<pre>b</pre>c</pre>"): ("Site title", "a b c", [("abc", None), ("b", None)]),
    "<p>no body tag</p>": ("Untitled", "no body tag", []),
    body("<ARTICLE>Big <STYLE>p{}</STYLE>tags</ARTICLE>"): ("Site title", "Big tags", []),
    body("<style>p{}</style><p>a\xa0\n b</p><footer>f</footer>"): ("Site title", "a b", []),
    "<html><head><title>only a head</title></head></html>": None,
}


def extracted(spark, rules, pages, limits=ANY):
    table = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    found = extract_pages(table, rules, limits).collect()
    return {
        row["page_id"]: (row["title"], row["content"], [tuple(block) for block in row["code_blocks"]]) for row in found
    }


def test_pages(spark, rules):
    got = extracted(spark, rules, PAGES)
    for number, (html, wanted) in enumerate(PAGES.items()):
        assert got.get(number) == wanted, html


def test_minimum_length(spark, rules):
    got = extracted(spark, rules, [body("x" * 99), body("x" * 100), body("ä" * 100), body("&#65;" * 99)], Limits())
    assert sorted(got) == [1, 2]


def test_tree_walk_agrees_on_real_pages(spark, rules):
    pages = I.pages(spark, "/root/testdata/sf0.001")
    fast = {row["page_id"]: row for row in extract_pages(pages, rules, ANY).collect()}
    for row in pages.collect():
        slow = read_page(row["html"])
        assert fast[row["page_id"]]["content"] == slow["content"]
        assert fast[row["page_id"]]["title"] == (slow["heading"] or "Untitled")


@pytest.mark.parametrize("parts", [1, 5])
def test_page_documents(spark, rules, parts):
    url = "https://docs.acme.example/develop/x?q=1#f"
    pages = spark.createDataFrame([(url, body(f"<h1>T</h1>{FILL}")), (url + "2", body("short"))], "url string, html string")
    docs = page_documents(pages.repartition(parts), rules, collected_at="now").collect()
    assert len(docs) == 1
    doc = docs[0]
    assert (doc["id"], doc["source"], doc["url"], doc["title"]) == ("docs:/develop/x", "acme_docs", url, "T")
    assert (doc["content_type"], doc["language"], doc["collected_at"]) == ("tutorial", None, "now")
    assert doc["metadata"]["path"] == "/develop/x" and doc["metadata"]["repo"] is None


def test_ranked_urls(spark, rules):
    urls = ["https://h/z", "https://h/develop/b", "https://h/develop/a", "https://h/workflows", "https://h/z"]
    ranked = by_priority(ranked_urls(spark.createDataFrame([(url,) for url in urls], "url string"), rules))
    assert [row["url"] for row in ranked.collect()] == [urls[3], urls[2], urls[1], urls[0]]


def test_text_of_a_huge_page(spark, rules):
    html = body("<p>word <a href='x'>link</a></p>" * 30_000)
    got = extracted(spark, rules, [html])
    assert got[0][1] == " ".join(["word link"] * 30_000)


ODD = {
    '<img alt="5&quot; disk"><p>KEEP</p><img alt="3&quot; disk">': "KEEP",
    "<nav-card>KEEP1</nav-card><p>KEEP2</p><nav>menu</nav>": "KEEP1 KEEP2",
    "<header-title>T</header-title><p>KEEP</p><header>h</header>": "T KEEP",
    '<article data-x="a>b"><p title="c>d">KEEP</p></article>': "KEEP",
    "<main-part>A</main-part><p>B</p>": "A B",
}


def test_odd_markup_agrees_with_the_tree_walk(spark, rules):
    pages = [f"<html><body>{text}</body></html>" for text in ODD]
    got = extracted(spark, rules, pages, ANY)
    assert [got[n][1] for n in range(len(pages))] == list(ODD.values())
    assert [read_page(page)["content"] for page in pages] == list(ODD.values())


def test_many_open_tags_are_walked_in_linear_time():
    import time

    begun = time.perf_counter()
    assert read_page("<body>" + "<p>x" * 8_000)["content"].count("x") == 8_000
    assert time.perf_counter() - begun < 0.5


def blocks(spark, html):
    from corpusforge.operators.pages import extract_pages
    from corpusforge.rules import DomainRules, Limits

    pages = spark.createDataFrame([(n, page) for n, page in enumerate(html)], "n int, html string")
    found = extract_pages(pages, DomainRules("d", ("x",)), Limits(min_content=0), keep_paragraphs=True)
    return [row.content for row in found.orderBy("n").collect()]


BLOCKS = {
    "<article><h1 id='a>b'>A <b>big</b>\n title</h1><p>one<br>two<p>three</p><div></div><ul><li>x<li>y &amp; z</ul></article>":
        "# A big title\n\none two\n\nthree\n\nx\n\ny & z",
    "<article>lead <i>text</i><h3>Deep</h3><h2> </h2>tail</article>": "lead text\n\n### Deep\n\ntail",
    "<article><table><tr><td>1</td><td>2</td></tr></table><pre>a\n b</pre></article>": "1\n\n2\n\na b",
}


def test_blocks_become_paragraphs_and_headings(spark):
    easy = list(BLOCKS)
    # The same pages through the tree walk: a rare character reference sends them there.
    hard = [page.replace("<article>", "<article><span>&thinsp;</span>") for page in easy]
    assert blocks(spark, easy + hard) == list(BLOCKS.values()) * 2


def test_tree_walk_is_linear_in_nested_code():
    import time

    from corpusforge.functions.html_tree import read_page

    begun = time.time()
    page = read_page("<main>" + "<pre>a" * 8_000 + "<code class='language-go'>x</code>" + "</pre>" * 8_000 + "</main>")
    assert time.time() - begun < 2
    assert page["code_blocks"][0] == {"code": "a" * 8_000 + "x", "language": "go"} and page["code_blocks"][-1] == {"code": "ax", "language": "go"}


def test_languages_of_neighbouring_and_nested_code():
    from corpusforge.functions.html_tree import read_page

    html = "<main><pre>a<code>1</code></pre><pre>b</pre><pre><code class='x language-py'>2</code><code class='language-go'>3</code></pre><pre>c<pre><code class='language-js'>4</code></pre></main>"
    assert read_page(html)["code_blocks"] == [
        {"code": "a1", "language": None}, {"code": "b", "language": None}, {"code": "23", "language": "py"},
        {"code": "c4", "language": "js"}, {"code": "4", "language": "js"},
    ]
