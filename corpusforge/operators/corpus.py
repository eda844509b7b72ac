"""The united document table, its order and its counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..rules import DomainRules


def unite(*tables: DataFrame) -> DataFrame:
    """Bag union of document tables."""
    united = tables[0]
    for table in tables[1:]:
        united = united.unionByName(table, allowMissingColumns=True)
    return united


def document_order(rules: DomainRules) -> Column:
    """Sortable struct: pages, then walked files by repository, then search hits by concept.

    It is derived from the document's own fields, so it is the same for collected and
    for re-read documents and for any partitioning.
    """
    repo, term = F.col("metadata.repo"), F.col("metadata.search_term")
    rank = F.when(repo.isNull(), 0).when(term.isNull(), 1).otherwise(2)
    position = F.when(repo.isNull(), 0).when(term.isNull(), _position(repo, rules.repositories)).otherwise(
        _position(term, rules.vocabulary)
    )
    return F.struct(
        rank.alias("rank"), position.alias("position"), F.col("id").alias("id"), F.col("url").alias("url")
    )


def _position(value: Column, values) -> Column:
    """Position in a fixed list; behind its end if absent."""
    if not values:
        return F.lit(0)
    listed = F.array(*[F.lit(item) for item in values])
    return F.coalesce(F.nullif(F.array_position(listed, value), F.lit(0)), F.lit(len(values) + 1)).cast("int")


def source_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("source").agg(F.count("*").alias("documents"))


def run_counts(docs: DataFrame, pairs: DataFrame, docs_source: str, collected_docs=True, collected_code=True) -> DataFrame:
    """One row of counters.  A source that was re-read instead of collected counts as 0."""
    by_source = docs.agg(
        F.count_if((F.col("source") == docs_source) & F.lit(collected_docs)).alias("docs_collected"),
        F.count_if((F.col("source") != docs_source) & F.lit(collected_code)).alias("code_collected"),
    )
    generated = pairs.agg(F.count("*").alias("qa_pairs_generated"))
    return by_source.select("*", generated.scalar().alias("qa_pairs_generated"))
