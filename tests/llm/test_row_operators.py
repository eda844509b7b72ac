"""Outliers, mixing, perspectives, archives, main text, licences and toxicity on small tables."""

import base64
import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import common, density, licences, mixing, outliers, perspectives, toxicity, warc

DOC = "doc_id long, text string, lang string, source string"


# --- outliers -----------------------------------------------------------------


def brute_statistics(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a", "a b c a b c a b c", "x\x0by\x0cz\n\n \nx\x0by\x0cz", "é #$% 漢字 <&>|*"]
    texts += [" ".join(rng.choice("ab") + rng.choice(["", "\n"]) for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(texts)], DOC).withColumn("w", F.lit("clash"))
    got = outliers.statistics(docs).orderBy("doc_id").select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r) for r in got.collect()] == [brute_statistics(t) for t in texts]


def test_mcd_finds_the_clean_shape(spark):
    """The estimate ignores a quarter of far rows, and its numbers are those of numpy on the subset it ends with."""
    rng = np.random.default_rng(7)
    good = rng.normal([5, 1.5, 0.2, 0.1, 0.2], [0.5, 0.2, 0.15, 0.1, 0.1], (900, 5))
    bad = rng.normal([8, 2.5, 0.9, 0.6, 0.8], 0.05, (200, 5))
    rows = [(["=en", "=a"], *map(int, np.round(v * outliers.GRID))) for v in np.vstack([good, bad])]
    vectors = spark.createDataFrame(rows, "unit array<string>, x0 long, x1 long, x2 long, x3 long, x4 long")
    shape = outliers.estimate(vectors).first()
    centre = np.array([shape[f"m{i}"] for i in range(5)])
    root = np.array([[shape[f"r{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    assert np.abs(centre - good.mean(axis=0)).max() < 0.05
    x = np.array([r[1:] for r in rows]) / outliers.GRID
    distance = (((x - centre) @ root.T) ** 2).sum(axis=1)
    assert (distance[900:] > outliers.CHI2_CUT).all() and (distance[:900] <= outliers.CHI2_CUT).all()
    again = outliers.estimate(vectors.repartition(7)).first()
    assert again == shape


def test_judge_cases(spark):
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randrange(60, 400)), "en", None if i % 2 else "a") for i in range(500)]
    rows += [(900, None, None, None), (901, "few words", "xx", "b"), (902, "again and " * 60, "en", "a"), (903, " ".join(w + "###$$$" for w in text(90).split()), "en", "a")]
    rows.append(rows[0])
    got = {}
    for r in outliers.judge(spark.createDataFrame(rows, DOC)).collect():
        got.setdefault(r.doc_id, []).append((r.base_failed, r.kept))
    assert got[0] == [(False, True)] * 2
    assert got[900] == got[901] == got[902] == [(True, False)]
    assert got[903] == [(False, False)]
    assert sum(not kept for i in range(500) for _, kept in got[i]) == 0
    assert outliers.judge(spark.createDataFrame([], DOC)).count() == 0


# --- mixing -------------------------------------------------------------------


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    pool, target, open_ = share * sum(sizes.values()), {}, list(names)
    while open_:
        level = pool / sum(weight[s] for s in open_)
        full = [s for s in open_ if most * sizes[s] <= level * weight[s]]
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            pool -= target[s]
            open_.remove(s)
    return target


def test_mix_meets_targets(spark):
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        source = rng.choice(["a"] * 12 + ["b", "B", "c", "ä", "d", None])
        rows.append((i, "w " * rng.choice([0, 5, 5, 5, rng.randrange(1, 400)]), "en", source))
    rows += rows[:3] + [(None, None, "en", "a")]
    docs = spark.createDataFrame(rows, DOC)
    sized = mixing.with_size(docs).drop("text")
    got = mixing.mix(sized).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in got if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert all(abs(r.target - want[source]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - want[source]) <= 0.02 * want[source] + 5
    assert all(0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"] for r in got)
    again = mixing.mix(sized.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(sized.where("doc_id < 0")).count() == 0


# --- perspectives -------------------------------------------------------------


def test_perspectives(spark):
    turns = [(1, 0, "system", "be nice"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "who"), (2, 0, "system", "alone"), (None, 0, "ann", "x"), (1, 1, "ann", "hi")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("name", F.lit("clash"))
    got = sorted(map(str, (tuple(r)[:7] + (r["mask"],) for r in perspectives.rotate(df).collect())))
    row = lambda p, t, s, r, n, c, m: (1, p, t, s, r, n, c, m)
    want = []
    for p, other in (("ann", "bob"), ("bob", "ann")):
        want.append(row(p, 0, "system", "system", None, "be nice", 0))
        want += [row(p, 1, "ann", "assistant" if p == "ann" else "user", None if p == "ann" else "ann", "hi", int(p == "ann"))] * 2
        want.append(row(p, 2, "bob", "assistant" if p == "bob" else "user", None if p == "bob" else "bob", "", int(p == "bob")))
        want.append(row(p, 3, None, "user", "unknown", "who", 0))
    want.append((None, "ann", 0, "ann", "assistant", None, "x", 1))
    assert got == sorted(map(str, want))
    for r in perspectives.in_order(perspectives.rotate(df)).collect():
        assert all(r.text[s.start : s.end] in ("hi", "", "x") for s in r.spans)
    assert perspectives.rotate(df.where("conv_id = 5")).count() == 0


# --- archives -----------------------------------------------------------------


@pytest.mark.parametrize("few", [True, False])
def test_copies_are_found_without_a_shuffle_of_payloads(spark, monkeypatch, few):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 100 if few else 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = [(1, "a", "same"), (5, "b", "same"), (None, "c", "same"), (2, "d", None), (3, "e", ""), (4, "f", "other"), (5, "b", "same")]
        df = warc.with_originals(spark.createDataFrame(pages, "page_id long, url string, html string"))
        assert not few or "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.url, r.refers_to, r.revisit) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [("a", 5, True), ("b", None, False), ("b", None, False), ("c", 5, True), ("d", 3, True), ("e", None, False), ("f", None, False)]


def test_archive_round_trip(spark, tmp_path):
    big = "".join(chr(97 + (i * i) % 26) for i in range(300_000))
    pages = [(1, "http://a", "same"), (5, "http://b", "same"), (3, None, "same"), (2, "http://c", None), (4, "http://d\r\nX: y", ""), (6, "u", "é\r\n\r\nx" + big), (None, "n", "same"), (5, "http://b", "same"), (None, "m", "lonely")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    path = f"file:{tmp_path}/archives"
    warc.write_archives(df, path, records=2)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(pages) and all(r.valid and r.error is None for r in got)
    html = {i: (h or "").encode() for i, _, h in pages}
    for r in got:
        payload = html[r.page_id] if r.page_id else (b"same" if r.url == "n" else b"lonely")
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if r.record_type == "response":
            assert bytes(r.payload) == payload
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted(
        [("1", "revisit", 5), ("3", "revisit", 5), ("5", "response", None), ("5", "response", None), ("None", "revisit", 5), ("2", "revisit", 4), ("4", "response", None), ("6", "response", None), ("None", "response", None)]
    )


def test_members_are_plain_gzip_and_faults_are_told():
    one, two = warc.record_bytes(1, "u", b"abc", None, False), warc.record_bytes(2, "v", b"abc", 1, True)
    assert zlib.decompressobj(31).decompress(one).startswith(b"WARC/1.1\r\n")
    for chunk in (1, 7, 1 << 16):
        assert [f["warc-type"] for f, _ in warc.stream_members(one + b"\0" + two, chunk)] == ["response", "revisit"]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.stream_members(one + two[:-20]))
    fields, block = next(warc.stream_members(one))
    assert not warc.parse_record(fields, block.replace(b"abc", b"abd"))["valid"]


# --- main text ----------------------------------------------------------------


def test_main_text(spark):
    article = "<article><h1>A &amp; B</h1><p>One  long\nparagraph with <b>bold</b>ly many words in it, so it is dense.<p>Sh.<ul><li>x<li>y</ul></article>"
    page = f'<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">home</a></ul></nav><div class="cookie-notice">We use cookies</div>{article}<aside>side</aside><section id="comments"><p>a reader comment that is quite long too, longer than much else here</p></section><form>mail <input></form><footer>(c)</footer></body></html>'
    text = "A & B One long paragraph with boldly many words in it, so it is dense. Sh. x y"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "no tags &lt;here"), (1, "u", page), (None, "u", "<p>a<p>b"), (6, "u", "<" * 2000), (7, "u", "<div>" * 5000 + "deep")]
    got = density.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got][:6] == [(1, text, len(text)), (2, "", 0), (3, "", 0), (4, "no tags <here", 13), (1, text, len(text)), (None, "a b", 3)]
    assert got[7].text == "deep"


def test_two_dense_parts_are_both_found():
    long = "Many words stand here, one after the other, and none of them is a link at all. " * 3
    html = f"<body><div><div><p>{long}</p><p>{long}</p></div><div>x</div><div><p>{long}</p><p>{long}</p></div></div><div><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></div></body>"
    assert density.main_text(html).count("Many words") == 12
    assert "three" not in density.main_text(html)


@pytest.mark.parametrize("name", ["layout has-sidebar", "page no-ads", "site-content with-comments", "pageWithSidebar", "entry-header", "site-content comments-open", "share-page"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_wrappers_with_marks_keep_their_article(name, tag):
    long = "Many words stand here, one after the other, and none of them is a link at all. " * 4
    inner = f'<{tag}><div class="entry-header"><h1>T</h1></div><p>{long}</p><p>{long}</p><div class="share"><a href=1>share it</a></div></{tag}>'
    other = '<div class="sidebar"><a href=1>one</a> <a href=2>two</a> off</div><div class="ad">Buy this</div><div id="comments"><p>I say so.</p></div>'
    for page in (f'<body><div class="{name}">{inner}{other}</div></body>', f'<body><div id="x" class="a {name}"><div>{inner}</div></div>{other}</body>'):
        text = density.main_text(page)
        assert text.count("Many words") == 8
        assert not any(w in text for w in ("two", "off", "Buy", "say", "share it"))


def test_comments_longer_than_the_article_stay_out():
    long = "Many words stand here, one after the other, and none of them is a link at all. " * 3
    comment = "<li><article class='comment-body'><p>" + "This reader has much to say about the matter, and says it. " * 9 + "</p></article></li>"
    card = "<div class='related'><article><p>A card about something else.</p></article></div>"
    for article in (f"<article><h1>T</h1><p>{long}</p></article>", f"<main><p>{long}</p></main>"):
        text = density.main_text(f"<body><div class='has-sidebar'>{article}<ol class='comments'>{comment}</ol>{card}</div></body>")
        assert text.count("Many words") == 3 and "reader" not in text and "card" not in text


# --- licences -----------------------------------------------------------------


def test_licences(spark):
    mit = "\n".join("// " + line for line in ("MIT License\n\nCopyright (c) 2020 X\n\n" + "\n".join(licences.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-as-is", "mit-liable"))).split("\n"))
    mit = mit.replace(" the Software without", "\n// the Software without")
    rows = [(1, "Text. Released under the MIT License.\nMore."), (2, mit), (3, licences.SENTENCES["mit-notice"] + "\n" + licences.SENTENCES["mit-grant"]), (4, None), (5, ""), (6, "Released under the MIT License. Licensed under CC BY-NC 4.0."), (1, "Text. Released under the MIT License.\nMore.")]
    got = [(r.doc_id, r.licences) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("licences", F.lit("clash"))).collect()]
    assert got == [(1, ["MIT"]), (2, ["MIT"]), (3, []), (4, []), (5, []), (6, ["CC-BY-NC-4.0", "MIT"]), (1, ["MIT"])]


def test_ordered_rules_equal_brute_force():
    rng = random.Random(3)
    scanner = licences.Scanner({k: f"{k} sentence" for k in "abcd"}, (("X", ("a", "b", "c")), ("Y", ("a", "b")), ("Z", ("d",))), gap=1)
    for _ in range(400):
        parts = [rng.choice("abcd??") for _ in range(rng.randrange(12))]
        text = "\n".join(f"{p} sentence" if p != "?" else "other words" for p in parts)
        n, found = scanner.identifiers(text)
        assert n == len(parts) and [x[2] for x in found] == [p for p in parts if p != "?"]
        for licence, first, end in scanner.licences(found):
            names = iter({"X": "abc", "Y": "ab", "Z": "d"}[licence])
            assert parts[first] == next(names) and parts[end - 1] == {"X": "c", "Y": "b", "Z": "d"}[licence]


# --- toxicity -----------------------------------------------------------------


def test_kernel_is_what_it_says():
    def brute(a, b):
        def weights(t):
            out, codes = {}, toxicity.letters(t).tolist()
            for i in range(len(codes)):
                for j in range(i + 1, len(codes)):
                    for k in range(j + 1, min(len(codes), i + toxicity.SPAN)):
                        if codes[i] and codes[j] and codes[k]:
                            key = codes[i], codes[j], codes[k]
                            out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
            return out

        x, y = weights(a), weights(b)
        norm = lambda w: sum(v * v for v in w.values()) ** 0.5
        return (sum(v * y.get(k, 0) for k, v in x.items()) / (norm(x) * norm(y))) ** toxicity.SHARPEN

    tokens, marks = ["idiot", "i.d-iot", "stupid", "idiots", "éa"], ["idiot", "stupid"]
    got = toxicity.similarities(tokens, toxicity.landmark_table(marks))
    assert np.allclose(got, [[brute(t, m) for m in marks] for t in tokens], atol=1e-5)
    assert got[0, 0] > got[1, 0] > 0.02 > got[2, 0]


def test_toxicity_learns_and_scores_every_row(spark):
    rng = random.Random(5)
    words = [a + b + c for a in "bdfgkl" for b in "aeo" for c in ("nd", "rt", "st", "m")]
    def text(insult):
        found = [rng.choice(words) for _ in range(40)]
        if insult:
            found[rng.randrange(40)] = rng.choice(["wretchlump", "gobsnark"])
        return " ".join(found)

    rows = [(i, text(i % 4 == 0)) for i in range(400)] + [(1000, None), (1001, ""), (None, "gobsnark"), (1002, "you w.retch-lump you"), (1002, "you w.retch-lump you")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.detect(docs, labels).withColumn("held_out", toxicity.held_out()).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id < 400]
    assert unseen and all(r.predicted == int(r.doc_id % 4 == 0) for r in unseen)
    assert [r.held_out for r in got if r.doc_id is not None] == [zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in rows if i is not None]
    assert {r.predicted for r in got if r.doc_id in (1000, 1001)} == {0} and all(r.predicted == 1 for r in got if r.doc_id in (None, 1002))
    assert {r.score for r in toxicity.detect(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.detect(docs.where("doc_id = -1"), labels).count() == 0


ARTICLE = "<article><h1>Title</h1>" + "<p>Some long enough text of the article here, with words.</p>" * 5 + "</article>"


@pytest.mark.parametrize(
    "around",
    [
        "<form action='x'>%s</form>", "<div class='layout hidden lg:block'>%s</div>", "<div title='not hidden here'>%s</div>",
        "<div data-note='x display:none y'>%s</div>", "<dialog open>%s</dialog>", "<p><a title=\"foo>link</a></p>%s",
        "%s<form><label>Name</label><input></form>", "<menu><li>a</menu>%s<dialog>Sure?</dialog>", "<div title=it's>%s</div>", "<!doctype html><!-- > -->%s<!-- cut",
    ],
)
def test_wrappers_keep_their_article(around):
    want = density.main_text(f"<html><body>{ARTICLE}</body></html>")
    assert want.startswith("Title Some long") and density.main_text(f"<html><body>{around % ARTICLE}</body></html>") == want


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=''", "aria-hidden=true", "style='color:red; display : none'", "role=navigation"])
def test_hidden_parts_are_no_text(attribute):
    page = f"<html><body>{ARTICLE.replace('</article>', f'<div {attribute}>secret</div></article>')}</body></html>"
    assert "secret" not in density.main_text(page) and density.main_text(page).startswith("Title")


def test_markup_never_becomes_text():
    assert density.main_text(ARTICLE.replace("</article>", '<p>tail <a title="foo>link')) .endswith("tail link")
    assert "annotation" not in density.main_text(ARTICLE.replace("Some", "<math><mi>x</mi><annotation>annotation</annotation></math> Some"))
    assert "x Some" in density.main_text(ARTICLE.replace("Some", "<math><mi>x</mi></math> Some"))
    assert "1 < 2 and a<3" in density.main_text(ARTICLE.replace("Some", "1 < 2 and a&lt;3 Some"))


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "x", '<a title="x ' * 80_000, "<! " * 100_000, "<p><button>" + "<div>" * 50_000, "<div>" * 50_000 + "</span>" * 50_000,
        "<table><tr><td><p>" * 20_000, "<li>x" * 50_000, "<!--" * 100_000, "<" * 300_000,
    ],
)
def test_broken_pages_of_any_size_take_linear_time(page):
    def seconds(html):
        begun = time.perf_counter()
        density.main_text(html)
        return time.perf_counter() - begun

    small, whole = seconds(page[: len(page) // 4]), seconds(page)
    assert whole < 12 * small + 0.5 and whole < 15
