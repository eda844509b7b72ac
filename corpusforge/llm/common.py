"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..staging import stage  # noqa: F401  (re-exported for the operators)

# The blanks that separate words, and everything that is no ASCII letter or digit.
BLANKS = r"[\x20\x09-\x0D]+"
NON_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A side of a join is broadcast up to this many counted rows; beyond it the join shuffles.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def split_words(text: Column, gap: str = BLANKS) -> Column:
    """Words between runs of ``gap``; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def fold_ascii(text: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def join_small(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", salt: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Join ``df`` with a table of one row per key that is usually small.

    The rows of ``small`` are counted: up to ``BROADCAST_ROWS`` they are broadcast.  Beyond that the join
    shuffles, and rows of a frequent key are spread over 32 salts (by the columns ``salt``), so that no key
    lands in one task.  Keys compare null-safe.  ``small`` should be a staged table; ``rows`` is its count if known.
    """
    if (small.count() if rows is None else rows) <= BROADCAST_ROWS:
        renamed = small.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in small.columns if c not in keys])
        on = [df[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
        return df.join(F.broadcast(renamed), on, how).drop(*[f"_r_{k}" for k in keys])
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*(salt or keys)), F.lit(32)).cast("int"))
    copies = small.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        F.explode(F.sequence(F.lit(0), F.lit(31))).alias("_r_salt"),
        *[c for c in small.columns if c not in keys],
    )
    on = [salted[k].eqNullSafe(copies[f"_r_{k}"]) for k in keys] + [salted["_salt"] == copies["_r_salt"]]
    return salted.join(copies, on, how).drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])


def shielded(df: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with every column outside ``needed`` under a name that no operator uses, and those names with the old ones.

    Work on it and give the result to ``unshielded``: columns of any name then pass an operator untouched.
    """
    hidden = {f"_column{i}": c for i, c in enumerate(df.columns) if c not in needed}
    back = {c: h for h, c in hidden.items()}
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns]), hidden


def unshielded(df: DataFrame, hidden: dict[str, str]) -> DataFrame:
    """Old names again; a column whose name the operator has given to a result of its own comes back as ``doc_<name>``."""
    taken = {c for c in df.columns if c not in hidden}
    names = []
    for c in df.columns:
        name = hidden.get(c, c)
        while c in hidden and name in taken:
            name = f"doc_{name}"
        taken.add(name)
        names.append(F.col(c).alias(name))
    return df.select(*names)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows per Arrow batch for the jobs of one block, where rows are wide; the old setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
