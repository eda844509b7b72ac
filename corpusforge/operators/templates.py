"""Chat texts: a pair rendered with the control marks of a model family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fill

# System, user and assistant part of each template.
_LLAMA3 = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{system}<|eot_id|>",
    "<|start_header_id|>user<|end_header_id|>\n\n{content}<|eot_id|>",
    "<|start_header_id|>assistant<|end_header_id|>\n\n{content}<|eot_id|>",
)
_CHATML = (
    "<|im_start|>system\n{system}<|im_end|>\n",
    "<|im_start|>user\n{content}<|im_end|>\n",
    "<|im_start|>assistant\n{content}<|im_end|>\n",
)
TEMPLATES = {
    "llama3": _LLAMA3,
    "mistral": ("", "[INST] {content} [/INST]", "{content}</s>"),
    "chatml": _CHATML,
    "qwen": _CHATML,
    "gpt": ("", "", ""),
}
ALPACA = (
    "Below is an instruction that describes a task. Write a response that appropriately "
    "completes the request.\n\n### Instruction:\n{instruction}\n\n### Response:\n{response}"
)


def chat_text(template: str, system_prompt: str) -> Column:
    """The whole pair as one text; an unknown template name means llama3."""
    question, answer = F.col("instruction"), F.col("response")
    if template == "alpaca":
        return fill(ALPACA, instruction=question, response=answer)
    system, user, assistant = TEMPLATES.get(template, _LLAMA3)
    parts = [
        fill(system, system=system_prompt) if system else None,
        fill(user, content=question) if user else None,
        fill(assistant, content=answer) if assistant else None,
    ]
    parts = [part for part in parts if part is not None]
    return F.concat(*parts) if parts else F.lit("")


def rendered(pairs: DataFrame, template: str, system_prompt: str) -> DataFrame:
    """``text`` plus ``metadata {source_id, category, concepts}``."""
    return pairs.select(
        chat_text(template, system_prompt).alias("text"),
        F.struct("source_id", "category", "concepts").alias("metadata"),
    )
