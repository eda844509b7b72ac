"""Any JSON-lines training file to chat messages, and question tables to prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.chat import prompt_messages, with_messages
from ..sources.jsonl import read_training_rows, read_validation_rows


def prepare_training(
    spark: SparkSession, train_path: str, validation_path: str | None = None, system_prompt: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Training rows and, if the file exists, validation rows, both with ``messages``."""
    train = with_messages(read_training_rows(spark, train_path), system_prompt)
    validation = read_validation_rows(spark, validation_path)
    return train, None if validation is None else with_messages(validation, system_prompt)


def prepare_prompts(questions: DataFrame, system_prompt: str | None = None) -> DataFrame:
    return prompt_messages(questions, system_prompt)
