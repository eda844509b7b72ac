"""Tagging with a table of terms gives what tagging term by term gives."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusforge.functions import packed
from corpusforge.functions.concepts import concept_tags
from corpusforge.operators import joins, vocabulary
from corpusforge.operators.vocabulary import spellings, tag_with_table

TERMS = (
    "workflow", "Task Queue", "c++", "node.js", ".net", "child workflow execution", "que", "gRPC", "été", "a-b", "x_1", "worker", "日本", "two  blanks", "#", "ab",
)


def texts(seed):
    rng = random.Random(seed)
    bits = [
        "workflow", "workflows", "Task", "queue", "task-queue", "taskqueue", "taskq ueue", "c++", "C++x", "node.js", "nodeXjs", "x.net", ".net", "child", "Workflow-execution",
        "execution", "que", "quel", "GRPC", "grpc", "ÉTÉ", "èété", "a-b", "a b", "ab", "x_1", "日本", "日本語", "two  blanks", "two", "blanks", "#", "a#b", "_", "worker_",
    ]
    joints = [" ", " ", "-", "", "\n", ".", "  "]
    return [None, "", "#", "c++", *("".join(rng.choice(bits) + rng.choice(joints) for _ in range(rng.randrange(1, 25))) for _ in range(400))]


def expected(spark, rows, terms):
    docs = spark.createDataFrame(rows, "id long, content string").withColumn("tags", concept_tags(F.lower("content"), terms))
    return {r.id: list(r.tags) for r in docs.where("size(tags) > 0").collect()}


def table(spark, terms):
    return spark.createDataFrame(list(enumerate(terms)), "position int, term string")


@pytest.mark.parametrize("small", [True, False])
def test_table_and_single_tests_agree(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(vocabulary, "is_small", lambda keys: False)
    rows = list(enumerate(texts(4)))
    docs = spark.createDataFrame(rows, "id long, content string").withColumn("key", F.lit("clash")).repartition(3)
    got = {r.id: r.concepts for r in tag_with_table(docs, table(spark, TERMS)).collect()}
    assert got == expected(spark, rows, TERMS) and len(got) > 300


def test_spellings_beyond_a_broadcast_are_looked_up(spark, monkeypatch):
    """Whatever number of spellings goes to the tasks, and also if terms have one position, repeat or have none, the result is the same."""
    rows = list(enumerate(texts(7)))
    docs = spark.createDataFrame(rows, "id long, content string").repartition(3)
    want = expected(spark, rows, TERMS)
    for most in (0, 1, 5, 12, 20):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", most or 1)
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 200 * most)
        assert {r.id: r.concepts for r in tag_with_table(docs, table(spark, TERMS)).collect()} == want, most
    odd = spark.createDataFrame([(None, "worker"), (1, "worker"), (1, "que"), (1, "Task Queue"), (0, "ab"), (0, "ab")], "position int, term string")
    got = tag_with_table(spark.createDataFrame([(1, "ab task-queue que worker"), (2, "none")], "id long, content string"), odd).collect()
    assert [tuple(r) for r in got] == [(1, ["worker", "ab", "Task Queue", "que", "worker"])]


def test_only_possible_spellings_of_a_large_table_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    docs = spark.createDataFrame([(n, " ".join(f"word{n} of{i}" for i in range(200)) + " rare7 term7") for n in range(50)], "id long, content string")
    terms = table(spark, ("of1", "of2", *(f"rare{n} term{n}" for n in range(100))))
    written = []
    stage = vocabulary.stage
    monkeypatch.setattr(vocabulary, "stage", lambda df, label: written.append((label, stage(df, label))) or written[-1][1])
    assert {r.id: r.concepts for r in tag_with_table(docs, terms).collect()} == {n: ["of1", "of2", "rare7 term7"] for n in range(50)}
    met = dict(written)["met-spellings"].select(F.sum(F.size("keys")).alias("n")).first().n
    assert met < 60


def test_spellings(spark):
    rows = spellings(table(spark, ("Task Queue", "c++"))).collect()
    assert sorted(r.key for r in rows) == ["c++", "task queue", "task-queue", "taskqueue"]
    assert {r.key: (r.size, r.first, r.last) for r in rows}["c++"] == (3, True, False)


def test_no_terms_no_documents_and_overlong_terms(spark):
    docs = spark.createDataFrame([(1, "a workflow")], "id long, content string")
    assert tag_with_table(docs, spark.createDataFrame([], "position int, term string")).collect() == []
    assert tag_with_table(docs.where("false"), table(spark, TERMS)).collect() == []
    with pytest.raises(Exception, match="more than 8 words"):
        tag_with_table(docs, table(spark, ("a b c d e f g h i",))).collect()


def test_work_does_not_grow_with_the_terms(spark):
    """No pattern per term in the plan, and a long text is read in one go."""
    docs = spark.createDataFrame([(1, "word workflow " * 20_000)], "id long, content string")
    few, many = table(spark, TERMS), table(spark, tuple(f"term{n} of{n}" for n in range(3_000)) + TERMS)
    plans = [tag_with_table(docs, terms)._jdf.queryExecution().optimizedPlan().toString() for terms in (few, many)]
    assert all("RLIKE" not in text and "term7" not in text and "Exchange" not in text for text in plans)
    begun = time.time()
    assert tag_with_table(docs, many).first().concepts == ["workflow"]
    assert time.time() - begun < 20


def _plainly(text, keys):
    """The keys that stand in a text bounded as terms are, by a regex for each."""
    return {key for key in keys if _bounded(text, key)}


def _bounded(text, key):
    before, after = (r"(?<!\w)" if re.match(r"\w", key) else r"(?<=\w)"), (r"(?!\w)" if re.search(r"\w\Z", key) else r"(?=\w)")
    return re.search(f"{before}{re.escape(key)}{after}", text) is not None


@pytest.mark.parametrize("collide", [False, True])
def test_packed_search_is_exact(monkeypatch, collide):
    """Also across pieces of the input, for all widths of characters, long keys and hashes that collide."""
    rng = random.Random(3)
    if collide:
        monkeypatch.setattr(packed, "_VALUE", np.ones(256, dtype=np.uint64))
    monkeypatch.setattr(packed, "CHUNK", 200)
    packed._chunk_powers.cache_clear()
    bits = ["a", "ab", "ba", "été", "日本", "𝒳y", "𐍈", "x_1", "½", "٣", " ", " ", "-", ".", "\n", "💡", "́", "averyveryverylongwordindeed", "averyveryverylongwordindeee"]
    written = [None, "", *("".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(300)), "", "ab " * 400 + "été", None]
    keys = sorted({"".join(rng.choice(bits) for _ in range(rng.randrange(1, 4))) for _ in range(400)} | {"ab été", "ab"})
    rows = [(key, n) for n, key in enumerate(keys)] + [(key, len(keys)) for key in keys[:5]]
    spelled = packed.Spellings.of(pa.array([k for k, _ in rows]), np.array([n for _, n in rows]))
    texts_ = pa.array(["cut off", *written])[1:]
    counts, numbers = packed.numbers_of(texts_, spelled)
    got = packed.lists(counts, pa.array(numbers)).to_pylist()
    held = [_plainly(text or "", keys) for text in written]
    assert got == [sorted({n for key, n in rows if key in here}) for here in held] and sum(counts) > 1_000
    flags = np.zeros(1 << 10, dtype=bool)
    flags[packed.key_bits(pa.array(keys), 1 << 10)] = True
    again, met = (column.to_pylist() for column in packed.numbers_and_keys_of(texts_, spelled, np.packbits(flags, bitorder="little"), spelled.kinds))
    assert again == got
    assert all(here <= set(keys_met) for here, keys_met in zip(held, met))
    assert all(keys_met == [] for keys_met, text in zip(met, written) if not text)
    if not collide:
        assert all(len(keys_met) == len(set(keys_met)) for keys_met in met)
    packed._chunk_powers.cache_clear()


def test_search_of_many_spellings_is_quick(spark):
    """A text's cost per byte is that of array steps, not of a Python object per token and sequence."""
    rng = random.Random(5)
    words = [f"w{n:x}" for n in range(30_000)]
    keys = pa.array([*words, *(f"{rng.choice(words)} {rng.choice(words)}" for _ in range(60_000))])
    spelled = packed.Spellings.of(keys, np.arange(len(keys)))
    texts_ = pa.array([" ".join(rng.choices(words, k=500)) for _ in range(1_000)])
    packed.numbers_of(texts_[:10], spelled)
    begun = time.process_time()
    counts, _ = packed.numbers_of(texts_, spelled)
    took = time.process_time() - begun
    begun = time.process_time()
    for text in texts_.to_pylist():  # what the search took at least before: the tokens and their sequences of three
        tokens = re.findall(r"\w+|\W", text)
        assert len({*tokens}) and len({*map("".join, zip(tokens, tokens[1:], tokens[2:]))})
    assert took < time.process_time() - begun and counts.sum() > 400_000


def test_more_spellings_than_rows_of_a_broadcast_are_read_once(spark, monkeypatch):
    """Packed, they are small: up to eight times the rows of a broadcast no text's terms are shuffled."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    terms = table(spark, tuple(f"rare{n}" for n in range(50)))
    docs = spark.createDataFrame([(n, f"a rare{n} rare7") for n in range(60)], "id long, content string")
    tagged = tag_with_table(docs, terms)
    assert "Exchange" not in tagged._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.concepts for r in tagged.collect()} == {n: sorted({f"rare{n}", "rare7"}, key=lambda t: int(t[4:])) if n < 50 else ["rare7"] for n in range(60)}
