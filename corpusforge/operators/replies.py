"""Pairs from a model's replies, with the rules as fallback.

The model itself is a function of the caller.  ``with_model_replies`` runs it next to
the document, so nothing is joined; ``model_replies`` and ``attach_replies`` are the
two-step form for replies that are computed elsewhere.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fill, let, shorten
from ..rules import DomainRules, Limits
from ..schemas import DRAFT_PAIRS
from .qa import draft_pairs, pair_rows, tagged_documents

# Fixed value: the wording asked of the model.
PROMPT = """You are creating training data for a language model that will answer questions about {subject}.

Given the following document, generate 3-5 high-quality question-answer pairs.

Document Title: {title}
Document Type: {content_type}
Source: {source}

Content:
{content}

Generate questions that:
1. Cover key concepts explained in the document
2. Include "how-to" questions if code examples are present
3. Ask about best practices or common patterns
4. Are specific to {domain} concepts

Return your response as a JSON array with objects containing:
- "instruction": The question
- "response": A comprehensive answer based on the document
- "category": One of "concept", "howto", "code", "troubleshooting"
- "concepts": Array of {domain} concepts covered

JSON Output:"""

_ENVELOPE = f"struct<pairs:{DRAFT_PAIRS}>"


def prompt_text(rules: DomainRules, limits: Limits = Limits()) -> Column:
    return fill(
        PROMPT,
        subject=rules.subject,
        domain=rules.domain,
        title=F.col("title"),
        content_type=F.col("content_type"),
        source=F.col("source"),
        content=shorten(F.col("content"), limits.max_prompt),
    )


def parse_reply(reply: Column) -> Column:
    """Pairs in a reply; null if it is unusable, an empty array for a literal ``[]``.

    The span from the first ``[`` to the last ``]`` must be one JSON array.  It is parsed
    as a member of an object, because the JSON reader ignores what follows a complete value.
    """
    span = F.nullif(F.regexp_extract(reply, r"(?s)\[.*\]", 0), F.lit(""))
    envelope = F.concat(F.lit('{"pairs":'), span, F.lit("}"))
    pairs = F.from_json(envelope, _ENVELOPE, {"allowSingleQuotes": "false"})["pairs"]
    return let(pairs, lambda parsed: F.when(F.forall(parsed, _is_complete), F.transform(parsed, _with_defaults)))


def _is_complete(pair: Column) -> Column:
    return pair["instruction"].isNotNull() & pair["response"].isNotNull()


def _with_defaults(pair: Column) -> Column:
    return F.struct(
        pair["instruction"].alias("instruction"),
        pair["response"].alias("response"),
        F.coalesce(pair["category"], F.lit("concept")).alias("category"),
        F.coalesce(pair["concepts"], F.array().cast("array<string>")).alias("concepts"),
    )


def with_model_replies(
    docs: DataFrame, model: Callable[[pd.Series], pd.Series], rules: DomainRules, limits: Limits = Limits()
) -> DataFrame:
    """Add ``reply``, the model's text for each document, and ``reply_error``: why there is none, else null."""

    @F.pandas_udf("reply string, error string")
    def ask(prompts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in prompts:
            yield _answers(model, batch)

    asked = docs.withColumn("_asked", ask.asNondeterministic()(prompt_text(rules, limits)))
    return asked.withColumns({"reply": F.col("_asked.reply"), "reply_error": F.col("_asked.error")}).drop("_asked")


def model_replies(
    docs: DataFrame, model: Callable[[pd.Series], pd.Series], rules: DomainRules, limits: Limits = Limits()
) -> DataFrame:
    """Table ``(id, url, reply, error)`` of the model's answers and failures."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.concat([batch[["id", "url"]], _answers(model, batch["prompt"])], axis=1)

    prompts = docs.select("id", "url", prompt_text(rules, limits).alias("prompt"))
    return prompts.mapInPandas(ask, "id string, url string, reply string, error string")


def reply_errors(answered: DataFrame, error: str = "reply_error") -> DataFrame:
    """``(error, documents)``: how often the model failed, by the text of its failure."""
    failed = answered.where(F.col(error).isNotNull())
    return failed.groupBy(F.col(error).alias("error")).agg(F.count(F.lit(1)).alias("documents"))


def _answers(model, prompts: pd.Series) -> pd.DataFrame:
    """A failing batch is asked one prompt at a time; a failing prompt has no reply but an error."""
    try:
        rows = [(reply, None) for reply in model(prompts)]
        if len(rows) != len(prompts):
            raise ValueError(f"{len(rows)} replies to {len(prompts)} prompts")
    except Exception:
        rows = [_answer(model, prompt) for prompt in prompts]
    return pd.DataFrame(rows, columns=["reply", "error"], index=prompts.index, dtype=object)


def _answer(model, prompt) -> tuple[str | None, str | None]:
    try:
        (reply,) = model(pd.Series([prompt]))
        return reply, None
    except Exception as failure:
        return None, f"{type(failure).__name__}: {failure}"


def attach_replies(docs: DataFrame, replies: DataFrame) -> DataFrame:
    """Add ``reply`` from a reply table ``(id, url, reply)``.

    Ids can repeat, so id and URL together are the key, and repeated replies are reduced
    to one before the join: documents never multiply.
    """
    one = replies.groupBy("id", "url").agg(F.min("reply").alias("reply"))
    return docs.join(one, ["id", "url"], "left")


def pairs_with_fallback(
    docs: DataFrame, rules: DomainRules, limits: Limits = Limits(), seed: str = "0"
) -> DataFrame:
    """Pairs of the column ``reply``; documents without a usable one get the rule-made pairs."""
    answered = docs.withColumn("_answer", parse_reply(F.col("reply")))
    # The rules only see the documents that need them.
    needed = answered.withColumn("content", F.when(F.col("_answer").isNull(), F.col("content")))
    tagged = tagged_documents(needed, rules)
    drafts = F.coalesce(F.col("_answer"), draft_pairs(rules, limits, seed))
    return pair_rows(tagged, drafts, rules)
