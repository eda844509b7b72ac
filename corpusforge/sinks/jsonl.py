"""JSON-lines outputs: nulls are written, non-ASCII text is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_documents(docs: DataFrame, path: str) -> None:
    write_jsonl(docs, path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    from ..schemas import PAIR_FIELDS

    write_jsonl(pairs.select(*PAIR_FIELDS), path)
