"""Deterministic shuffle and exact train/validation split."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import question_key

# Hex digits of the key that rows are counted by: at most 16**4 counts.
_PREFIX = 4


class Boundary(NamedTuple):
    """Where train ends: at this key and, among equal keys, at this copy."""

    total: int
    train: int
    key: str | None
    copy: str | None


def shuffle_key(seed: str = "0") -> Column:
    """Random-looking but reproducible order; unique as long as questions are."""
    return F.md5(
        F.concat(F.lit(f"{seed}:"), F.col("source_id"), F.lit(":"), question_key(F.col("instruction")))
    )


def with_shuffle_key(pairs: DataFrame, seed: str = "0", copies: bool = True) -> DataFrame:
    """Add ``shuffle_key`` and, for tables whose keys may repeat, ``copy``.

    ``copy`` is a row number that only tells equal keys apart.  Store the result before splitting it
    (``staging.stage``): a row number is only stable once written.  Keys alone are stable as they are.
    """
    keyed = pairs.withColumn("shuffle_key", shuffle_key(seed))
    return keyed.withColumn("copy", F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")) if copies else keyed


def in_shuffled_order(keyed: DataFrame, partitions: int | None = None) -> DataFrame:
    """Physically order rows by ``shuffle_key`` across and within partitions.

    The keys are uniform hashes, so equal key ranges are equal shares of the rows and the
    range is computed from the key; a range partitioner would first sample, i.e. run the
    input twice.
    """
    count = partitions or int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prefix = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("bigint")
    part = F.floor(prefix * count / F.lit(16**8)).cast("int")
    return keyed.repartitionById(count, part).sortWithinPartitions("shuffle_key")


def boundary_row(keyed: DataFrame, fraction: float = 0.9) -> DataFrame:
    """One row ``total, train, key, copy``: where train ends, as a plan; building it starts no job.

    Rows are counted by the first digits of their key, which makes at most 65,536 counts; the boundary lies in one of
    these buckets, and only its rows are numbered.  No row is sorted or moved but the keys of that bucket, which is
    one part in 65,536 because keys are uniform hashes.
    """
    order = [name for name in ("shuffle_key", "copy") if name in keyed.columns]
    keys = keyed.select(*order)
    prefix = F.substring("shuffle_key", 1, _PREFIX)
    every = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = keys.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
    counted = counted.select(
        "prefix", "rows", F.sum("rows").over(Window.orderBy("prefix")).alias("upto"), F.sum("rows").over(every).alias("all")
    )
    train = F.floor(F.col("all") * F.lit(float(fraction)))
    inside = F.when((train > 0) & (F.col("upto") >= train), F.struct("prefix", (train - F.col("upto") + F.col("rows")).alias("rank")))
    edge = counted.agg(
        F.coalesce(F.max("all"), F.lit(0)).alias("total"), F.coalesce(F.max(train), F.lit(0)).alias("train"), F.min(inside).alias("edge")
    )
    numbered = keys.where(prefix == edge.select("edge.prefix").scalar()).select(
        F.struct(*order).alias("at"), F.row_number().over(Window.orderBy(*order)).alias("rank")
    )
    last = numbered.where(F.col("rank") == edge.select("edge.rank").scalar()).select("at").scalar()
    copy = F.col("at.copy") if "copy" in order else F.lit(None).cast("string")
    return edge.select("total", "train", last.alias("at")).select("total", "train", F.col("at.shuffle_key").alias("key"), copy.alias("copy"))


def split_boundary(keyed: DataFrame, fraction: float = 0.9) -> Boundary:
    """The boundary as values, for writers that need the counts: one job over the key columns."""
    return Boundary(*boundary_row(keyed, fraction).first())


def in_train(boundary: Boundary) -> Column:
    """Map-only test; on a stored table in shuffled order it also prunes row groups."""
    key = F.col("shuffle_key")
    if boundary.key is None:
        return F.lit(False)
    if boundary.copy is None:
        return key <= boundary.key
    return (key < boundary.key) | ((key == boundary.key) & (F.col("copy") <= boundary.copy))


def split_pairs(keyed: DataFrame, fraction: float = 0.9) -> DataFrame:
    """Add ``split`` with exactly ``floor(n * fraction)`` rows in train, all in one plan.

    ``keyed`` has ``shuffle_key``, and ``copy`` if its keys may repeat (``with_shuffle_key``).  Rows are only compared
    with the boundary, which is a scalar subquery over the keys; where ``keyed`` ends in a shuffle, both share it.
    """
    end = boundary_row(keyed, fraction).select(F.struct("key", "copy")).scalar()
    key = F.col("shuffle_key")
    before = key <= end["key"]
    if "copy" in keyed.columns:
        before = (key < end["key"]) | ((key == end["key"]) & (F.col("copy") <= end["copy"]))
    # Without any row in train the boundary is null.
    return keyed.withColumn("split", F.when(before, F.lit("train")).otherwise(F.lit("validation")))


def split_counts(split: DataFrame) -> DataFrame:
    return split.agg(
        F.count("*").alias("total_examples"),
        F.count_if(F.col("split") == "train").alias("train_examples"),
        F.count_if(F.col("split") == "validation").alias("validation_examples"),
    )
