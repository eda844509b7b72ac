from pyspark.sql import functions as F

from corpusforge.functions.pairs import sections
from corpusforge.operators.dedup import first_questions
from corpusforge.operators.qa import documents_with_concepts, rule_pairs
from conftest import CAPPED

from corpusforge.rules import CONCEPT_QUESTIONS, Limits

LONG = "This paragraph is about a workflow and it is quite long, " * 3
BODY = "b" * 120


def rows(pairs):
    return [row.asDict(recursive=True) for row in pairs.orderBy("pair_order").collect()]


def test_paragraph_choice(make_docs, rules):
    exact = "workflow " + "x" * 91
    docs = make_docs(
        {"content": f"{exact}\n\n{exact}y\n\n{LONG}", "content_type": "code"},
        {"content": "workflow short", "content_type": "code"},
        {"content": "a workflow\n\n" + "subworkflows " * 20, "content_type": "code"},
        {"content": "no concept " * 30, "content_type": "code"},
        {"content": f"\n {LONG}\n\n\n{LONG}".replace("workflow", "WorkFlow"), "content_type": "code"},
    )
    found = rows(rule_pairs(docs, rules))
    assert [(row["source_id"], row["response"]) for row in found] == [
        ("docs:000", exact + "y"),
        ("docs:002", ("subworkflows " * 20).strip()),
        ("docs:004", LONG.strip().replace("workflow", "WorkFlow")),
    ]
    wordings = {text.format(concept="workflow", domain="Acme") for text in CONCEPT_QUESTIONS}
    assert all(row["instruction"] in wordings and row["concepts"] == ["workflow"] for row in found)


def test_answers_are_cut_after_1500(make_docs, rules):
    texts = ["workflow " + "x" * 1491, "workflow " + "x" * 1492]
    found = rows(rule_pairs(make_docs(*[{"content": text, "content_type": "code"} for text in texts]), rules, CAPPED))
    assert [row["response"] for row in found] == [texts[0], texts[1][:1500] + "..."]
    whole = rows(rule_pairs(make_docs({"content": texts[1], "content_type": "code"}), rules))
    assert whole[0]["response"] == texts[1]


def test_first_three_concepts_in_vocabulary_order(make_docs, rules):
    text = "query, task-queue, worker and workflow " * 4
    found = rows(rule_pairs(make_docs({"content": text, "content_type": "test"}), rules, CAPPED))
    # "task queue" is a tag, but the paragraph only has its hyphenated form
    assert [row["concepts"] for row in found] == [["workflow"], ["worker"]]


def test_question_wording_depends_on_seed_only(make_docs, rules):
    docs = make_docs(*[{"content": LONG, "content_type": "code"} for _ in range(40)])
    first, again, other = (
        [row["instruction"] for row in rows(rule_pairs(docs.repartition(n), rules, seed=seed))]
        for n, seed in ((1, "a"), (7, "a"), (3, "b"))
    )
    assert first == again != other
    assert len(set(first)) == 4


def section_list(each, texts):
    return [[(part["heading"], part["body"]) for part in parts] for parts in each(sections, texts)]


# Text to its (heading, body) pairs.
SECTIONS = {
    '': [],
    'no heading': [],
    '# A\nbody': [('A', 'body')],
    'intro\n## A b \nx\n#### deep\ny\n### C\nz': [('A b ', 'x\n#### deep\ny'), ('C', 'z')],
    '# A\n# B\ntext': [('A', ''), ('B', 'text')],
    '# End': [],
    '# A\nx\n# End': [('A', 'x')],
    '#\n# B\ntext\n# C\nmore': [('# B', 'text'), ('C', 'more')],
    '#\n#\n# B\nt': [('#', ''), ('B', 't')],
    '#   \n\n\nfoo\nbar': [('foo', 'bar')],
    '#nospace\nx': [],
    '```\n# comment\ncode\n```\n': [('comment', 'code\n```')],
    '# A\r\nx\r\n': [('A\r', 'x')],
    '#\xa0Nbsp\nx': [('Nbsp', 'x')],
    'x # not\n# yes\nz\n': [('yes', 'z')],
    '##\t\tTabs\n\n\n': [('Tabs', '')],
    '# A\n\n\n## \nB\nrest': [('A', ''), ('B', 'rest')],
    '#### four\nx': [],
    '# a\x85b\nc\u2028# d\ne': [('a\x85b', 'c\u2028# d\ne')],
    '\n# A\nbody\n\n# B\n': [('A', 'body'), ('B', '')],
    '# A\nb\x01c\n# D\ne': [('A', 'b\x01c'), ('D', 'e')],
}


def test_sections(each):
    assert section_list(each, SECTIONS) == [[tuple(part) for part in parts] for parts in SECTIONS.values()]


def test_sections_of_long_texts(each):
    texts = ["# H\n" + "line of text\n" * 20_000 + "## I\n" + "y" * 200_000, "#\n" * 3_000]
    got = section_list(each, texts)
    assert [len(part) for part in got] == [2, 1500]
    assert got[0][1] == ("I", "y" * 200_000)


def test_heading_pairs(make_docs, rules):
    text = "A workflow.\n" + "".join(
        f"{line}\n{BODY}\n"
        for line in (
            "# Overview", "# Overview ", "## Whatever", "# Is it so? Yes", "# HOWto", "# too short",
        )
    ).replace("# too short\n" + BODY, "# too short\n" + "b" * 99)
    found = rows(rule_pairs(make_docs({"content": text}), rules, strategies=("headings",)))
    assert [row["instruction"] for row in found] == [
        "What is Overview in Acme?", "Whatever?", "Is it so? Yes", "HOWto?",
    ]


def test_at_most_five_sections_and_their_own_concepts(make_docs, rules):
    text = "workflow\n" + "".join(f"# S{n}\n{BODY} query {n}\n" for n in range(6))
    assert len(rows(rule_pairs(make_docs({"content": text}), rules, strategies=("headings",)))) == 6
    found = rows(rule_pairs(make_docs({"content": text}), rules, CAPPED, strategies=("headings",)))
    assert [row["instruction"][:10] for row in found] == [f"What is S{n}" for n in range(5)]
    assert all(row["concepts"] == ["query"] for row in found)


def test_sections_are_cut_before_they_are_tagged(make_docs, rules):
    text = "workflow\n# S\n" + "b" * 1499 + " query"
    found = rows(rule_pairs(make_docs({"content": text}), rules, CAPPED, strategies=("headings",)))
    assert found[0]["response"] == "b" * 1499 + " ..." and found[0]["concepts"] == []


def test_code_pairs(make_docs, rules):
    code = "worker and query " * 2
    docs = make_docs(
        {"content": code, "content_type": "code", "language": "python"},
        {"content": code, "content_type": "example", "language": "markdown"},
        {"content": code, "content_type": "test", "language": "python"},
        {"content": code, "content_type": "code", "language": None},
        {"content": code, "content_type": "implementation", "language": ""},
        {"content": "query " + "x" * 1994, "content_type": "implementation", "language": "go"},
        {"content": "query " + "x" * 1995, "content_type": "implementation", "language": "go"},
    )
    found = rows(rule_pairs(docs, rules, CAPPED, strategies=("code",)))
    assert [row["source_id"] for row in found] == ["docs:000", "docs:001", "docs:005", "docs:006"]
    assert found[0]["instruction"] == "How do I implement a worker in Acme using Python?"
    assert found[0]["response"] == (
        f"Here's an example of implementing a worker in Python:\n\n```python\n{code}\n```"
    )
    assert found[0]["concepts"] == ["worker", "query"] and found[0]["category"] == "code"
    assert "using markdown?" in found[1]["instruction"] and "```markdown\n" in found[1]["response"]
    assert "truncated" not in found[2]["response"]
    assert found[3]["response"].endswith("x\n# ... (truncated)\n```")


def test_documents_without_concepts_give_nothing(make_docs, rules):
    docs = make_docs({"content": f"# H\n{BODY}"}, {"content": "print()", "content_type": "code", "language": "go"})
    assert rule_pairs(docs, rules).count() == 0
    assert documents_with_concepts(docs, rules).count() == 0


def test_first_question_wins(make_docs, rules):
    docs = make_docs(
        {"id": "b", "content": f"workflow\n#  what IS it\n{BODY}b\n"},
        {"id": "a", "content": f"workflow\n# What is it\n{BODY}a1\n## WHAT is it? \n{BODY}a2\n"},
    )
    walked = docs.withColumn("metadata", F.col("metadata").withField("repo", F.lit("acme/core"))).withColumn(
        "id", F.lit("0")
    )
    for parts in (1, 7):
        united = walked.unionByName(docs).repartition(parts)
        found = rows(first_questions(rule_pairs(united, rules, strategies=("headings",))))
        assert [(row["source_id"], row["instruction"], row["response"][-2:]) for row in found] == [
            ("a", "What is it?", "a1")
        ]


def test_hot_question_keeps_every_other(spark, make_docs, rules):
    """A third of all pairs ask the same."""
    docs = make_docs({"content": f"workflow\n# Same\n{BODY}\n"}).drop("id", "url")
    many = (
        spark.range(3_000)
        .crossJoin(F.broadcast(docs))
        .withColumn("id", F.format_string("d%05d", "id"))
        .withColumn("url", F.col("id"))
        .withColumn("content", F.expr("if(id % 3 = 0, content, replace(content, 'Same', id))".replace("id %", "int(substr(id, 2)) %")))
    )
    found = first_questions(rule_pairs(many.select(docs.columns + ["id", "url"]), rules, strategies=("headings",)))
    assert found.count() == 2_001
    assert found.where("instruction = 'What is Same in Acme?'").first()["source_id"] == "d00000"


def test_limits_are_options(make_docs, rules):
    limits = Limits(max_answer=10, concepts_per_document=1)
    found = rows(rule_pairs(make_docs({"content": LONG + " worker", "content_type": "test"}), rules, limits))
    assert [row["response"] for row in found] == ["This parag..."]
