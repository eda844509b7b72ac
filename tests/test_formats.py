import json

import pytest

from corpusforge.operators.formats import FORMATS, to_format
from corpusforge.operators.templates import rendered
from corpusforge.schemas import QA_PAIR
from corpusforge.sinks.training import shuffled_pairs, write_dataset, write_formats
from corpusforge.sources.jsonl import read_pairs
from corpusforge.sinks.jsonl import write_pairs

QUESTION, ANSWER, PROMPT = "What is {content}?", 'It is "{system}" {.\nÜber', "You know."
MESSAGES = [
    {"role": "system", "content": PROMPT}, {"role": "user", "content": QUESTION}, {"role": "assistant", "content": ANSWER},
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(QUESTION, ANSWER, "d1", "u1", "howto", ["a", "b"])], QA_PAIR)


LAYOUTS = {
    "trl": {"messages": MESSAGES, "source_id": "d1", "category": "howto"},
    "torchtune": {"instruction": QUESTION, "input": "", "output": ANSWER, "source_id": "d1"},
    "gpt": {"messages": MESSAGES},
    "qwen": {"messages": MESSAGES, "source_id": "d1", "category": "howto"},
    "axolotl": {
        "conversations": [
            {"from": "system", "value": PROMPT}, {"from": "human", "value": QUESTION}, {"from": "gpt", "value": ANSWER},
        ]
    },
    "raw": {
        "instruction": QUESTION, "response": ANSWER, "source_id": "d1", "source_url": "u1", "category": "howto",
        "concepts": ["a", "b"],
    },
    "alpaca": {"instruction": QUESTION, "input": "", "output": ANSWER},
}


@pytest.mark.parametrize("name", FORMATS)
def test_layout(pairs, name):
    row = to_format(pairs, name, PROMPT).first().asDict(recursive=True)
    assert row == LAYOUTS[name] and list(row) == list(LAYOUTS[name])


def chatml():
    return "".join(f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n" for m in MESSAGES)


def llama3():
    parts = (f"<|start_header_id|>{m['role']}<|end_header_id|>\n\n{m['content']}<|eot_id|>" for m in MESSAGES)
    return "<|begin_of_text|>" + "".join(parts)


TEXTS = {
    "llama3": llama3(), "unknown": llama3(), "chatml": chatml(), "qwen": chatml(), "gpt": "",
    "mistral": f"[INST] {QUESTION} [/INST]{ANSWER}</s>",
    "alpaca": "Below is an instruction that describes a task. Write a response that appropriately completes the request."
    f"\n\n### Instruction:\n{QUESTION}\n\n### Response:\n{ANSWER}",
}


@pytest.mark.parametrize("name", TEXTS)
def test_chat_text(pairs, name):
    row = rendered(pairs, name, PROMPT).first().asDict(recursive=True)
    assert row == {"text": TEXTS[name], "metadata": {"source_id": "d1", "category": "howto", "concepts": ["a", "b"]}}


def many(spark, count):
    rows = [(f"Q{n}", f"Ä{n}", f"d{n}", "u", "concept", []) for n in range(count)]
    return spark.createDataFrame(rows, QA_PAIR)


def test_written_formats(spark, tmp_path, caplog):
    root = str(tmp_path / "out")
    outputs = write_formats(shuffled_pairs(many(spark, 25)), root, PROMPT, ["trl", "nonsense", "raw"], "chatml")
    assert list(outputs) == ["trl", "raw"] and "nonsense" in caplog.text
    splits = {}
    for name, paths in outputs.items():
        assert (paths["train_count"], paths["val_count"]) == (22, 3)
        for split in ("train", "validation"):
            assert paths[split] == f"{root}/{name}/{split}"
            rows = [json.loads(line) for line in spark.read.text(paths[split]).toPandas()["value"]]
            splits[name, split] = sorted(row["source_id"] for row in rows)
    assert splits["trl", "train"] == splits["raw", "train"] and len(splits["raw", "train"]) == 22
    assert splits["trl", "validation"] == splits["raw", "validation"] and len(splits["raw", "validation"]) == 3
    info = json.loads(spark.read.text(f"{root}/dataset_info").first()[0])
    assert info == {
        "total_examples": 25, "train_examples": 22, "validation_examples": 3, "formats": outputs, "template": "chatml",
    }


def test_default_formats_and_no_pairs(spark, tmp_path):
    outputs = write_formats(shuffled_pairs(many(spark, 0)), str(tmp_path / "out"), PROMPT)
    assert list(outputs) == ["trl", "torchtune", "raw"] and outputs["raw"]["train_count"] == 0


def test_dataset(spark, tmp_path):
    path = write_dataset(shuffled_pairs(many(spark, 10)), str(tmp_path), PROMPT)
    data = spark.read.parquet(path)
    assert data.where("split = 'train'").count() == 9 and data.where("split = 'validation'").count() == 1
    assert data.columns == ["messages", "source_id", "category", "split"]


def test_pairs_round_trip(spark, tmp_path, pairs):
    write_pairs(pairs, str(tmp_path / "pairs"))
    assert read_pairs(spark, str(tmp_path / "pairs")).collect() == pairs.collect()
    assert "Über" in spark.read.text(str(tmp_path / "pairs")).first()[0]
