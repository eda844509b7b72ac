"""The pipeline over ``documents``: stages in order, each written as Parquet and read back by the next.

In every stage null texts and texts without words stay, null ids are rows like others, repeated rows and rows of one id
are told apart by their texts (stage 2 says which of them go), and an empty table gives no rows.  Columns beyond those of
``documents`` pass a stage untouched, whatever their names.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusforge.llm import decontaminate, jaccard, mixing, repeats, toxicity
from corpusforge.llm.common import shielded, stage, table, unshielded

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def any_columns(function):
    """The stage with all further columns under names that meet none of its own."""

    @wraps(function)
    def guarded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner, hidden = shielded(docs, COLUMNS)
        return unshielded(function(spark, inner, sf_dir), hidden)

    return guarded


@any_columns
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained classifier calls toxic go."""
    scored = toxicity.detect(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


@any_columns
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near and exact copies one document stays: that of smallest id, else of smallest hash.

    Documents without words all stay.  Rows are told apart by id and text: another text of a removed document's id stays
    if it is no copy, rows equal in both are copies of each other, and null ids take part like others.
    """
    joined = jaccard.join_classes(docs).where("n_shingles > 0").select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_h"), "group")
    joined = stage(joined, "components")
    first = F.min(F.struct(F.col("_id").isNull().alias("nameless"), "_id", "_h")).alias("first")
    kept = stage(joined.groupBy("group").agg(first).select(F.col("first._id").alias("_kid"), F.col("first._h").alias("_kh")), "kept-copies")
    among_kept = joined["_id"].eqNullSafe(kept["_kid"]) & (joined["_h"] == kept["_kh"])
    gone = joined.join(kept, among_kept, "left_anti").select("_id", "_h").distinct()
    repeated = joined.join(kept, among_kept, "left_semi").groupBy("_id", "_h").count().where("count > 1").select("_id", "_h")
    repeated = stage(repeated, "repeated-rows")

    def these(rows: DataFrame):
        return docs.doc_id.eqNullSafe(rows["_id"]) & (F.xxhash64(docs.doc_id, docs.text) == rows["_h"])

    stay = docs.join(gone, these(gone), "left_anti")
    if repeated.isEmpty():
        return stay
    once = stay.join(repeated, these(repeated), "left_anti")
    again = stay.join(repeated, these(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(again)


@any_columns
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that stand elsewhere too are cut out; the rest of the text stays."""
    return repeats.without_passages(docs)


@any_columns
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verified benchmark window go; the rest stay as they are."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@any_columns
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, text included, with the copies of it that bring the sources to their target weights.

    ``copies`` says how often a document stands in the mix; one of 0 copies is listed but is no part of it.
    Columns of ``docs`` named like one of these five results come back as ``doc_<name>``.
    """
    key = ["doc_id", "lang", "source", "n_chars", "_hash"]
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    sized = mixing.with_size(hashed).select(*key, "size")
    narrow = mixing.mix(stage(sized, "sizes"))
    # Rows that are equal in all of the key are told apart by a number; which of them takes which copies is all one.
    narrow = narrow.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy("copies")))
    shares = narrow.select(*[F.col(c).alias(f"_r{c}") for c in (*key, "_nth")], "size", "source_size", "target", "copies", "taken")
    whole = hashed.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1))))
    on = [whole[c].eqNullSafe(shares[f"_r{c}"]) for c in (*key, "_nth")]
    return whole.join(shares, on).select(*docs.columns, "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("repeated_passages", without_repeats),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

#: Trained scores, links and suffix arrays are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
