"""First-seen and newest-row selection by key.

Most are one aggregation ``min``/``max`` over a struct: every task first
reduces its own rows to one per key, so a key that holds a third of all rows
sends one row per task and never fills a reducer.  Where rows are wide and are read
from a table, only keys are aggregated and the winners are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import question_key


def _one_per_key(df: DataFrame, key: Column, order: tuple[str, ...], pick) -> DataFrame:
    """``order`` names the columns to compare by; the other columns ride along in ``row``."""
    row = F.struct(*[name for name in df.columns if name not in order]).alias("row")
    ranked = F.struct(*[F.col(name).alias(f"o{number}") for number, name in enumerate(order)], row)
    picked = df.groupBy(key.alias("_key")).agg(pick(ranked).alias("_picked"))
    fields = {name: f"_picked.row.`{name}`" for name in df.columns}
    fields |= {name: f"_picked.o{number}" for number, name in enumerate(order)}
    return picked.select(*[F.col(path).alias(name) for name, path in fields.items()])


def first_per_key(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """The row with the smallest ``order`` of each key."""
    return _one_per_key(df, key, order, F.min)


def latest_per_key(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """The row with the largest ``order`` of each key."""
    return _one_per_key(df, key, order, F.max)


def latest_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest ``order`` of each key, for wide rows; rows equal in both compare by their other columns.

    Keys and orders alone are aggregated.  The wide rows meet the winners unsorted, spread by key and order together, so
    that a key with very many rows is no hot one; only rows that are equal in both are compared as a whole.
    """
    keys = [F.col(key).alias("_key"), F.col(order).alias("_order")]
    times = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    latest = times.groupBy("_key").agg(F.max(F.struct("_order", "_n")).alias("_last")).select("_key", "_last.*")
    on = df[key].eqNullSafe(latest["_key"]) & df[order].eqNullSafe(latest["_order"])
    met = df.join(latest.hint("shuffle_hash"), on).select(*df.columns, "_n")
    tied = met.where("_n > 1").drop("_n")
    return met.where("_n = 1").drop("_n").unionByName(latest_per_key(tied, F.col(key), order))


def distinct_urls(urls: DataFrame) -> DataFrame:
    return urls.dropDuplicates(["url"])


def first_questions(pairs: DataFrame) -> DataFrame:
    """Keep the first pair of each question, in document and strategy order."""
    return first_per_key(pairs, question_key(F.col("instruction")), "pair_order")


def distinct_content(docs: DataFrame, content: str = "content", order: str = "id") -> DataFrame:
    """Keep the document with the lowest id of each content hash; ids are unique.

    Hashes and ids alone are aggregated; the texts only meet the winners, unsorted.
    """
    digest = content_hash(F.col(content))
    first = docs.groupBy(digest.alias("_hash")).agg(F.min(order).alias("_first"))
    on = digest.eqNullSafe(first["_hash"]) & (docs[order] == first["_first"])
    return docs.join(first.hint("shuffle_hash"), on, "left_semi")


def content_hash(content: Column) -> Column:
    return F.md5(content)
