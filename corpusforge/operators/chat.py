"""Training rows and questions to chat messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip


def _message(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("content"))


def _chat(system_prompt: str | None, *messages: Column) -> Column:
    system = [_message("system", F.lit(system_prompt))] if system_prompt else []
    return F.array(*system, *messages)


def with_messages(rows: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """Give every row ``messages``: its own, or those of its instruction and output.

    Rows with neither stay as they are, and so do all other columns.  A row's own
    messages may carry more fields than role and content, which are kept.
    """
    has = set(rows.columns)
    if not {"instruction", "output"} <= has:
        return rows
    asked = (F.col("instruction").isNotNull()) & (F.col("output").isNotNull())
    made = F.when(
        asked, _chat(system_prompt, _message("user", F.col("instruction")), _message("assistant", F.col("output")))
    )
    if "messages" not in has:
        return rows.withColumn("messages", made)
    fields = rows.schema["messages"].dataType.elementType.fieldNames()

    def fitted(message):
        return F.struct(
            *[(message[name] if name in ("role", "content") else F.lit(None)).alias(name) for name in fields]
        )

    own_type = rows.schema["messages"].dataType.simpleString()
    return rows.withColumn(
        "messages", F.coalesce(F.col("messages"), F.transform(made, fitted).cast(own_type))
    )


def prompt_messages(questions: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """Messages for answering each non-empty question."""
    question = strip(F.col("question"))
    asked = questions.withColumn("question", question).where(question != "")
    return asked.withColumn("messages", _chat(system_prompt, _message("user", F.col("question"))))
