from conftest import CAPPED
import pandas as pd
import pytest

from corpusforge.operators.replies import (
    attach_replies,
    model_replies,
    pairs_with_fallback,
    parse_reply,
    prompt_text,
    with_model_replies,
)

LONG = "This paragraph is about a workflow and it is quite long, " * 3


def test_parse(each):
    cases = {
        'Sure: [{"instruction":"Q","response":"A"}] done': [("Q", "A", "concept", [])],
        '[{"instruction":"Q","response":"A","category":"howto","concepts":["x"],"extra":1}]': [("Q", "A", "howto", ["x"])],
        "[]": [],
        "no bracket": None,
        '[{"instruction":"Q"}]': None,
        '[{"instruction":"Q","response":"A"},{"instruction":"R"}]': None,
        '[{"instruction":"Q","response":"A"}] and [x]': None,
        '[{"instruction":"Q","response":"A"}], "a": [1': [("Q", "A", "concept", [])],
        "[{'instruction':'Q','response':'A'}]": None,
        '[{"instruction":"Q","response":"A"}, ]': None,
        "[1,2]": None,
        '["a"]': None,
        "[null]": None,
        '[\n{"instruction":"Q",\n"response":"[A]"}\n]': [("Q", "[A]", "concept", [])],
        "": None,
    }
    got = each(parse_reply, cases)
    assert [None if pairs is None else [tuple(pair) for pair in pairs] for pairs in got] == list(cases.values())


def test_null_reply(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(parse_reply(F.lit(None).cast("string"))).first()[0] is None


def test_prompt(make_docs, rules):
    docs = make_docs({"title": "The {title}", "content": "c" * 4_001, "source": "s"})
    prompt = docs.select(prompt_text(rules, CAPPED)).first()[0]
    assert "Document Title: The {title}\nDocument Type: documentation\nSource: s\n" in prompt
    assert "\n" + "c" * 4_000 + "\n" in prompt and "c" * 4_001 not in prompt
    assert prompt.endswith("JSON Output:") and "about Acme." in prompt


@pytest.fixture
def answers():
    def answer(prompts: pd.Series) -> pd.Series:
        if any("explode" in prompt for prompt in prompts):
            raise ValueError("no answer")
        return pd.Series(['[{"instruction":"Asked?","response":"Yes"}]'] * len(prompts))

    return answer


def outcome(pairs):
    return sorted((row["source_id"], row["response"][:3]) for row in pairs.collect())


def test_model_next_to_the_document(make_docs, rules, answers):
    docs = make_docs({"content": LONG}, {"content": LONG + "explode"}, {"content": "x"}).coalesce(1)
    pairs = pairs_with_fallback(with_model_replies(docs, answers, rules), rules)
    assert outcome(pairs) == [("docs:000", "Yes"), ("docs:001", "Thi"), ("docs:002", "Yes")]


def test_reply_table(spark, make_docs, rules, answers):
    docs = make_docs(
        {"content": LONG}, {"content": LONG + "explode"}, {"id": "same", "url": "u1", "content": LONG},
        {"id": "same", "url": "u2", "content": LONG},
    )
    replies = model_replies(docs, answers, rules)
    doubled = replies.unionByName(replies).where("url <> 'u2'")
    joined = attach_replies(docs, doubled)
    assert joined.count() == 4
    assert outcome(pairs_with_fallback(joined, rules)) == [
        ("docs:000", "Yes"), ("docs:001", "Thi"), ("same", "Thi"), ("same", "Yes"),
    ]


def test_empty_reply_array_is_no_fallback(spark, make_docs, rules):
    docs = make_docs({"content": LONG})
    replies = docs.selectExpr("id", "url", "'nothing: []' AS reply")
    assert pairs_with_fallback(attach_replies(docs, replies), rules).count() == 0


def test_failures_of_the_model_are_data(make_docs, rules, answers):
    from corpusforge.operators.replies import reply_errors

    docs = make_docs({"content": LONG}, {"content": LONG + "explode"}, {"content": "explode"}).coalesce(1)
    asked = with_model_replies(docs, answers, rules)
    assert [(r.reply is None, r.reply_error) for r in asked.orderBy("id").collect()] == [
        (False, None), (True, "ValueError: no answer"), (True, "ValueError: no answer"),
    ]
    assert [tuple(r) for r in reply_errors(asked).collect()] == [("ValueError: no answer", 2)]
    table = model_replies(docs, answers, rules)
    assert [tuple(r) for r in reply_errors(table, "error").collect()] == [("ValueError: no answer", 2)]


def test_a_model_that_answers_too_little_is_asked_one_by_one(make_docs, rules):
    docs = make_docs({"content": LONG}, {"content": LONG}).coalesce(1)
    short = with_model_replies(docs, lambda prompts: list(prompts)[:1], rules)
    assert short.where("reply_error is null and reply is not null").count() == 2
    none = with_model_replies(docs, lambda prompts: [], rules)
    assert none.where("reply is null and reply_error like 'ValueError%'").count() == 2
