import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from corpusforge.functions import text as X
from corpusforge.functions.concepts import concept_tags

BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0      　"


def test_strip_is_that_of_str(each):
    texts = [f"{blank}a{blank}b{blank}{blank}" for blank in BLANKS] + ["", BLANKS, "x", "​x", "ab" + " " * 60_000]
    assert each(X.strip, texts) == [text.strip() for text in texts]


def test_blank_characters_are_exactly_those_of_str():
    assert set(X.BLANKS) == {chr(code) for code in range(0x110000) if chr(code).isspace()}


def test_collapse_blanks(each):
    texts = ["a  b\n\n c", " \xa0a b ", "", "a\x1fb"]
    assert each(X.collapse_blanks, texts) == [re.sub(r"\s+", " ", text).strip() for text in texts]


def test_shorten_counts_code_points(each):
    text = "ä😀" * 10
    assert each(lambda x: X.shorten(x, 20, "..."), [text, text + "x"]) == [text, text + "..."]


def test_fill_does_not_look_into_values(each):
    assert each(lambda x: X.fill("<{content}|{content}>", content=x), ["{content} {"]) == ["<{content} {|{content} {>"]


def test_question_key(each):
    assert each(X.question_key, [" What?\n", "what?", "WHAT?\t", "Größe "]) == ["what?", "what?", "what?", "größe"]


def test_let_computes_once(spark):
    value = X.let(F.rand(), lambda x: x - x)
    assert spark.range(5).select(value.alias("d")).distinct().collect()[0][0] == 0.0


VOCABULARY = ("workflow", "task queue", "für", "query")


def python_tags(text):
    lower = text.lower()
    return [
        term for term in VOCABULARY if re.search(rf"\b{'[ -]?'.join(map(re.escape, term.split(' ')))}\b", lower)
    ]


def tags(each, texts, vocabulary=VOCABULARY, **options):
    return each(lambda x: concept_tags(F.lower(x), vocabulary, **options), texts)


def test_tags_on_edges(each):
    texts = [
        "Workflows", "WORKFLOW", "task-queue", "task queue", "taskqueue", "task  queue", "a task_queue", "èfür", "für!",
        "_query", "query9", "query-x", "workfloẃ", "work flow", "", "subworkflow workflow", "query task queue workflow",
        "²query", "query٠", "workflowworkflow", "x task queue.",
    ]
    assert tags(each, texts) == [python_tags(text) for text in texts]


def test_plural_is_no_match(each):
    assert tags(each, ["workflows"]) == [[]]


def test_literal_mode_only_matches_the_pattern_text(each):
    texts = ["task queue", "a task[ -]?queue b", "workflow"]
    assert tags(each, texts, multiword="literal") == [[], ["task queue"], ["workflow"]]


def test_terms_with_symbols_at_their_edges(each):
    texts = ["use c++ now", "c++x", "xc++x", ".net", "a.net", "a .net"]
    vocabulary = ("c++", ".net")
    wanted = [[t for t in vocabulary if re.search(rf"\b{re.escape(t)}\b", text)] for text in texts]
    assert tags(each, texts, vocabulary) == wanted


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(
            st.sampled_from(["workflow", "task", "queue", "task queue", "für", " ", "-", "_", "é", "1", "\n", ".", "Ω", "query"]),
            max_size=8,
        ).map("".join),
        min_size=60,
        max_size=120,
    )
)
def test_tags_agree_with_python(each, texts):
    assert tags(each, texts) == [python_tags(text) for text in texts]
