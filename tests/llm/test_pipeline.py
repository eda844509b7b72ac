"""The pipeline's stages against brute force, and the queries against their SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusforge.llm import mixing, queries, repeats, sql

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    want = con.execute(sql.ORACLES[name])
    names = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(n) for n in names]
    rows = sorted(str([r[i] for i in at]) for r in want.fetchall())
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == names
    assert sorted(str(list(r)) for r in got.select(*names).collect()) == rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with planted insults, copies, passages and benchmark text, written as parquet."""
    folder = f"file:{tmp_path_factory.mktemp('corpus')}"
    rng = random.Random(11)
    words = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in ("nd", "rt", "st", "m", "lk")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = {i: text(60) for i in range(60)}
    for i in range(100, 160):
        docs[i] = text(30) + " wretchlump " + text(30)
    docs[200], docs[201] = docs[3], docs[4] + " end"
    passage, item = text(90), text(14)
    docs[210], docs[211] = text(20) + " " + passage + " " + text(20), text(40) + " " + passage + " " + text(5)
    docs[220] = text(30) + " " + item.upper() + " " + text(30)
    docs[230], docs[231], docs[232] = "", None, "!"
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in docs.items()] + [(5, docs[5], "en", "s2", len(docs[5])), (None, text(50), None, None, 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i >= 100)) for i in docs if i < 160]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, passage


def test_stages(spark, tables):
    folder, docs, passage = tables
    now = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for at, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, now, folder)
        if at < 4:
            assert out.columns == now.columns
        out.write.parquet(f"{folder}/stage-{at}")
        now = spark.read.parquet(f"{folder}/stage-{at}")
        seen[name] = now.collect()
    ids = {name: {r.doc_id for r in rows} for name, rows in seen.items()}
    clean = set(range(60)) | {200, 201, 210, 211, 220, 230, 231, 232, None}
    assert ids["toxicity"] == clean
    assert ids["near_duplicates"] == clean - {200, 201}
    assert sum(r.doc_id == 5 for r in seen["near_duplicates"]) == 1
    text = {r.doc_id: r.text for r in seen["repeated_passages"]}
    assert ids["repeated_passages"] == clean - {200, 201}
    assert passage not in text[210] and passage not in text[211] and len(text[210]) < len(docs[210]) - repeats.LENGTH
    assert all(text[i] == docs[i] for i in range(60))
    assert ids["decontamination"] == clean - {200, 201, 220}
    assert ids["mixing"] == ids["decontamination"]
    ran = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, ran)) == sorted(map(str, seen["mixing"]))


def test_stages_on_empty_documents(spark, tables):
    folder, _, _ = tables
    now = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id = -1")
    for _, function in corpus_pipeline.STAGES:
        now = function(spark, now, folder)
    assert now.count() == 0


CLASHES = (
    "_id", "_h", "_hash", "_r", "_spans", "_nth", "_column0", "group", "kept", "runs", "n_removed", "n_bytes", "score", "predicted",
    "size", "n", "parts", "copies", "taken", "target", "source_size", "row_hash", "n_shingles", "a.b",
)


def test_stages_leave_columns_of_any_name_alone(spark, tables):
    """The same rows as without them, and their values unchanged; results of the last stage keep their names."""
    folder, _, _ = tables
    now = plain = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 20 or doc_id >= 150")
    now = now.select("*", *[F.concat(F.lit(f"{name}:"), "doc_id").alias(name) for name in CLASHES])
    for name, function in corpus_pipeline.STAGES:
        now, plain = function(spark, now, folder), function(spark, plain, folder)
        columns = [c for c in plain.columns]
        got, want = ([str(r) for r in t.select(*columns).collect()] for t in (now, plain))
        assert sorted(got) == sorted(want) and len(want) > 0, name
    added = {"size", "copies", "taken", "target", "source_size"}
    assert now.count() > 0 and set(now.columns) == set(plain.columns) | {f"doc_{c}" if c in added else c for c in CLASHES}
    for row in now.collect():
        assert all(row[f"doc_{c}" if c in added else c] == f"{c}:{row.doc_id}" for c in CLASHES)


def test_passage_of_51_short_words_goes(spark):
    """Shared by otherwise different documents, and well under 400 bytes; 50 shared words stay."""
    rng = random.Random(17)
    text = lambda n: " ".join(rng.choice("bcdfgl") + rng.choice("aeiou") + rng.choice(["", "n", "rt"]) for _ in range(n))
    passage, shorter = text(51), text(50)
    assert len(passage) < 250 < repeats.LENGTH
    ends = [(text(30), text(30)) for _ in range(8)]
    docs = [f"{a} {passage if i < 4 else shorter} {b}" for i, (a, b) in enumerate(ends)] + [text(120) for _ in range(20)]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(docs)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in dict(corpus_pipeline.STAGES)["repeated_passages"](spark, table, "").collect()}
    want = [f"{a} {b}" if i < 4 else docs[i] for i, (a, b) in enumerate(ends)] + docs[8:]
    assert got == {i: (t, len(t)) for i, t in enumerate(want)}


def test_mix_delivers_the_texts(spark):
    """Each row once with its text beside its copies, repeated rows, null ids and documents without words included."""
    rng = random.Random(19)
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(1, 30))), "en", f"s{i % 3}") for i in range(40)]
    rows += [(None, "a b c", "en", "s1")] * 5 + [(None, "d e", None, None), (None, None, "en", "s1"), (50, "", "en", "s2"), (7, "x", "en", "s0")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = dict(corpus_pipeline.STAGES)["mixing"](spark, docs, "").collect()
    assert sorted(str((r.doc_id, r.text, r.lang, r.source)) for r in got) == sorted(map(str, rows))
    sizes = mixing.with_size(docs).select("doc_id", "lang", "source", "n_chars", "size")
    narrow = [tuple(r) for r in mixing.mix(sizes).select("doc_id", "source", "n_chars", "size", "copies", "taken").collect()]
    assert sorted(map(str, narrow)) == sorted(str((r.doc_id, r.source, r.n_chars, r["size"], r.copies, r.taken)) for r in got)
    assert all(r["size"] == len((r.text or "").split()) for r in got)


def test_copies_are_rows_not_ids(spark):
    """Another text of a copy's id stays, wordless rows stay, and rows without id are copies too."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (7, a), (7, b), (3, b), (3, b), (None, c), (None, c), (None, a), (9, ""), (9, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("group", F.lit("clash")).withColumn("_id", F.lit(1))
    kept = corpus_pipeline.one_of_each(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (3, b), (None, c), (9, ""), (9, ""), (None, None)], key=str)
