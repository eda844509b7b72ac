import json

from corpusforge.operators.chat import prompt_messages, with_messages
from corpusforge.plans.prepare_training import prepare_prompts, prepare_training


def write(path, *rows):
    path.write_text("\n".join(json.dumps(row) for row in rows) + "\n")
    return str(path)


def messages(*parts):
    return [{"role": role, "content": text} for role, text in parts]


OWN = messages(("user", "u"), ("assistant", "a"))


def loaded(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def test_messages_stay(spark, tmp_path):
    train, validation = prepare_training(spark, write(tmp_path / "a.jsonl", {"messages": OWN}), None, "S")
    assert loaded(train) == [{"messages": OWN}] and validation is None


def test_instructions_become_messages(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", {"instruction": "I", "input": "ignored", "output": "O"})
    train, validation = prepare_training(spark, path, str(tmp_path / "missing.jsonl"))
    row = loaded(train)[0]
    assert row["messages"] == messages(("user", "I"), ("assistant", "O")) and row["input"] == "ignored"
    assert validation is None
    train, validation = prepare_training(spark, path, path, "S")
    assert loaded(validation)[0]["messages"] == messages(("system", "S"), ("user", "I"), ("assistant", "O"))


def test_neither_stays(spark, tmp_path):
    train, _ = prepare_training(spark, write(tmp_path / "a.jsonl", {"text": "x"}))
    assert loaded(train) == [{"text": "x"}]


def test_mixed_file(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", {"messages": OWN}, {"instruction": "I", "output": "O"}, {"instruction": "only"})
    rows = loaded(with_messages(spark.read.json(path)))
    wanted = [OWN, messages(("user", "I"), ("assistant", "O")), None]
    assert [row["messages"] for row in rows] == wanted


def test_messages_with_more_fields(spark, tmp_path):
    own = [{"role": "user", "content": "u", "name": "n"}]
    path = write(tmp_path / "a.jsonl", {"messages": own}, {"instruction": "I", "output": "O"})
    rows = loaded(with_messages(spark.read.json(path)))
    assert rows[0]["messages"] == own
    assert [(m["role"], m["content"], m["name"]) for m in rows[1]["messages"]] == [("user", "I", None), ("assistant", "O", None)]


def test_prompts(spark):
    questions = spark.createDataFrame([("  What?\n",), ("",), (" \n",), (None,)], "question string")
    assert [row["messages"] for row in loaded(prepare_prompts(questions))] == [messages(("user", "What?"))]
    assert [row["messages"] for row in loaded(prompt_messages(questions, "S"))] == [messages(("system", "S"), ("user", "What?"))]
