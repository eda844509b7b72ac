"""Token alignment against whole encodings and a plain double loop."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusforge.llm import token_align as ta

FILES = [f"{ta.FOLDER}/{name}" for name in (ta.FILE_A, ta.FILE_B)]
pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")
BOTH = ta.vocabularies(*(open(path, "rb").read() for path in FILES))


def whole(text):
    """Ids of the whole text by both tokenizers; none if the bytes differ."""
    if not text:
        return [], []
    a, b = BOTH.a.encode(" " + text, add_special_tokens=False).ids, BOTH.b.encode(text)
    data = (" " + text).encode()
    if b"".join(BOTH.bytes_a[i] for i in a) != data or b"".join(BOTH.bytes_b[i] for i in b) != data:
        return [], []
    return a, b


def spans(ids, table):
    at, out = 0, []
    for number in ids:
        out.append((at, at + len(table[number]), number))
        at += len(table[number])
    return out


def brute(texts):
    rows, counts = [], Counter()
    for text in texts:
        a, b = whole(text)
        at_a, at_b = spans(a, BOTH.bytes_a), spans(b, BOTH.bytes_b)
        linked = [(x[2], y[2]) for x in at_a for y in at_b if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in at_a} & {y[1] for y in at_b})
        groups, before = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in found if before < e <= cut) for found in (at_a, at_b)))
            before = cut
        rows.append((len(a), len(b), len(groups), linked, ";".join(groups)))
        counts.update(set(linked))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [
        (n_a, n_b, n_groups, len(linked), hashlib.sha256(groups.encode()).hexdigest() if n_a else "",
         sum(counts[p] == most[p[0]] for p in linked), sum(counts[p] for p in linked))
        for n_a, n_b, n_groups, linked, groups in rows
    ]


def some_texts(seed):
    rng = random.Random(seed)
    words = ["the", "Über", "naïve", "x=1;", "don't", "日本語の", "<|endoftext|>", "<s>", "<unk>", "<0x0A>", "12345", "🙂🙃", "á", "...", "'s", " ", "www.example.com/a?b"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", " \n ", "", "\r\n", " ", "\x1c", "\u0085"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    return [None, "", " ", "  ", "\n", " a", "a ", "a", "a▁b c", "▁", "a\0b", "the the the", *texts, *texts[:5]]


def collected(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_a", F.lit("clash")).repartition(4)
    got = ta.aligned_counts(docs, **options).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()
    return [tuple(r)[1:] for r in sorted(got)]


@given(st.text(st.sampled_from("ab'.1 \n\t  ▁éß日🙂<|s>\x1c\u0085́"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_words_give_the_tokens_of_the_whole_text(text):
    (a, b), good = BOTH.encode([text or "a"])
    want_a, want_b = BOTH.a.encode(" " + (text or "a"), add_special_tokens=False).ids, BOTH.b.encode(text or "a")
    assert (a[0].tolist(), b[0].tolist()) == (want_a, want_b)
    assert bool(good[0]) == (whole(text or "a")[0] != [])


@pytest.mark.parametrize("hot", [ta.HOT, 20, 0])
def test_counts_equal_brute_force(spark, hot):
    texts = some_texts(2)
    assert collected(spark, texts, hot=hot) == brute(texts)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(ta, "PIECE", 50)
    monkeypatch.setattr(ta, "BLOCK", 120)
    texts = ["word, " * 200 + "end", None, "x" * 500, "a b ▁ " + "c d " * 100, "é " * 300]
    got = ta.align_texts(texts, BOTH, keep_groups=True)
    want = brute(texts)
    assert [row[:5] for row in got] == [row[:5] for row in want]
    assert all(hashlib.sha256(row[7].encode()).hexdigest() == row[4] for row in got if row[4])


def test_groups_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "the cat"), (None, "the cat"), (2**60 + 1, "the cat")], "doc_id long, text string")
    rows = ta.align(docs, groups=True).collect()
    a, b = whole("the cat")
    assert {r.groups for r in rows} == {f"{a[0]}|{b[0]};{a[1]}|{b[1]}"}
    got = ta.aligned_counts(docs).collect()
    assert sorted((r.doc_id or 0, r.n_best, r.count_sum) for r in got) == [(0, 2, 6), (0, 2, 6), (2**60 + 1, 2, 6)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.aligned_counts(empty).collect() == []


def test_unfit_vocabularies_are_refused():
    data_a, data_b = (open(path, "rb").read() for path in FILES)
    with pytest.raises(ValueError):
        ta.Vocabularies(data_a.replace(b'"add_prefix_space":false', b'"add_prefix_space":true').replace(b'"add_prefix_space": false', b'"add_prefix_space": true'), data_b)


def test_hot_bound(spark):
    pairs = spark.createDataFrame([(i, 1 + i % 7) for i in range(70)], "pair long, docs long")  # 1: 10, 2-3: 20, 4-7: 40
    assert [ta._hot_from(pairs, hot) for hot in (70, 69, 60, 59, 40, 39, 0)] == [1, 2, 2, 4, 4, 8, 8]
