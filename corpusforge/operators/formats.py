"""Pairs to the row layouts of the training tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import PAIR_FIELDS


def _message(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("content"))


def _turn(speaker: str, text: Column) -> Column:
    return F.struct(F.lit(speaker).alias("from"), text.alias("value"))


def _messages(system_prompt: str) -> Column:
    return F.array(
        _message("system", F.lit(system_prompt)),
        _message("user", F.col("instruction")),
        _message("assistant", F.col("response")),
    ).alias("messages")


def _no_input() -> Column:
    return F.lit("").alias("input")


def _answer() -> Column:
    return F.col("response").alias("output")


def _conversations(system_prompt: str) -> Column:
    return F.array(
        _turn("system", F.lit(system_prompt)),
        _turn("human", F.col("instruction")),
        _turn("gpt", F.col("response")),
    ).alias("conversations")


FORMATS = {
    "trl": lambda prompt: (_messages(prompt), "source_id", "category"),
    "torchtune": lambda prompt: ("instruction", _no_input(), _answer(), "source_id"),
    "axolotl": lambda prompt: (_conversations(prompt),),
    "gpt": lambda prompt: (_messages(prompt),),
    "qwen": lambda prompt: (_messages(prompt), "source_id", "category"),
    "raw": lambda prompt: PAIR_FIELDS,
    "alpaca": lambda prompt: ("instruction", _no_input(), _answer()),
}

DEFAULT_FORMATS = ("trl", "torchtune", "raw")


def json_row(name: str, system_prompt: str) -> Column:
    """A row of the layout as one JSON line, nulls written."""
    fields = [F.col(field) if isinstance(field, str) else field for field in FORMATS[name](system_prompt)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_format(pairs: DataFrame, name: str, system_prompt: str) -> DataFrame:
    return pairs.select(*FORMATS[name](system_prompt))
