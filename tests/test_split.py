import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusforge.operators.split import in_shuffled_order, split_boundary, split_counts, split_pairs, with_shuffle_key
from corpusforge.sinks.training import shuffled_pairs
from corpusforge.staging import stage


def pairs(spark, count, copies=0):
    made = spark.range(count).select(
        F.concat(F.lit("Q "), "id").alias("instruction"),
        F.lit("A").alias("response"),
        F.concat(F.lit("d"), "id").alias("source_id"),
        F.lit("u").alias("source_url"),
        F.lit("concept").alias("category"),
        F.array(F.lit("c")).alias("concepts"),
    )
    if copies:
        made = made.unionByName(made.where("instruction = 'Q 0'").crossJoin(spark.range(copies)).drop("id"))
    return made


def expected_train(count, seed="0", fraction=0.9):
    key = lambda n: hashlib.md5(f"{seed}:d{n}:q {n}".encode()).hexdigest()
    return {f"Q {n}" for n in sorted(range(count), key=key)[: int(count * fraction)]}


@pytest.mark.parametrize("count", [0, 1, 9, 10, 11, 1000])
def test_exact_split(spark, count):
    split = split_pairs(shuffled_pairs(pairs(spark, count)))
    train = {row[0] for row in split.where("split = 'train'").select("instruction").collect()}
    assert train == expected_train(count)
    counts = split_counts(split).first()
    assert tuple(counts) == (count, math.floor(count * 0.9), count - math.floor(count * 0.9))


def test_same_split_for_any_partitioning(spark):
    results = [
        sorted(map(tuple, split_pairs(shuffled_pairs(pairs(spark, 500).repartition(n), "s", n)).select("instruction", "split").collect()))
        for n in (1, 7)
    ]
    assert results[0] == results[1]
    assert {question for question, split in results[0] if split == "train"} == expected_train(500, "s")


def test_seed_changes_the_split(spark):
    assert expected_train(300, "a") != expected_train(300, "b")
    split = split_pairs(shuffled_pairs(pairs(spark, 300), "b"))
    assert {row["instruction"] for row in split.where("split = 'train'").collect()} == expected_train(300, "b")


@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.9, 1.0])
def test_exact_with_many_copies(spark, fraction):
    """Half of the rows are the same pair; the boundary may fall among them."""
    split = split_pairs(shuffled_pairs(pairs(spark, 400, copies=400)), fraction)
    counts = split_counts(split).first()
    assert (counts["total_examples"], counts["train_examples"]) == (800, math.floor(800 * fraction))


def test_boundary_among_copies(spark):
    stored = stage(with_shuffle_key(pairs(spark, 1, copies=99)), "copies")
    boundary = split_boundary(stored, 0.37)
    assert (boundary.total, boundary.train) == (100, 37) and boundary.copy is not None
    assert split_pairs(stored, 0.37).where("split = 'train'").count() == 37


def test_unique_keys_need_no_row_numbers(spark):
    keyed = with_shuffle_key(pairs(spark, 1_000).repartition(6), copies=False)
    assert "copy" not in keyed.columns
    train = {row[0] for row in split_pairs(keyed).where("split = 'train'").select("instruction").collect()}
    assert train == expected_train(1_000)
    assert split_boundary(keyed)[:2] == (1_000, 900) and split_boundary(keyed).copy is None


@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.37, 0.999, 1.0])
def test_one_crowded_bucket(spark, fraction):
    """All keys begin alike, so one bucket holds every row."""
    keyed = spark.range(3_000).select(F.concat(F.lit("abcd"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("shuffle_key"))
    split = split_pairs(keyed, fraction)
    most = math.floor(3_000 * fraction)
    assert split.where("split = 'train'").count() == most
    assert split.where("split = 'train'").agg(F.max("shuffle_key")).first()[0] == (f"abcd{most - 1:08}" if most else None)


def test_physical_order_is_the_shuffled_order(spark):
    ordered = in_shuffled_order(with_shuffle_key(pairs(spark, 2_000)), 5)
    placed = ordered.select("shuffle_key", F.spark_partition_id().alias("part")).collect()
    keys = [row["shuffle_key"] for row in placed]
    assert keys == sorted(keys)
    sizes = [sum(row["part"] == part for row in placed) for part in range(5)]
    assert min(sizes) > 300
