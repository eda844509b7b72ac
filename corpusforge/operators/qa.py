"""Documents to question-answer pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.concepts import concept_tags
from ..functions.pairs import code_pairs, concept_pairs, heading_pairs
from ..rules import DomainRules, Limits
from .corpus import document_order
from .rows import keep_where

STRATEGIES = ("concept", "code", "headings")


def tagged_documents(docs: DataFrame, rules: DomainRules) -> DataFrame:
    """Add ``concepts``, the vocabulary terms of the content in vocabulary order."""
    lower = docs.withColumn("_lower", F.lower("content"))
    tags = concept_tags(F.col("_lower"), rules.vocabulary, rules.multiword)
    return lower.withColumn("concepts", tags).drop("_lower")


def documents_with_concepts(docs: DataFrame, rules: DomainRules) -> DataFrame:
    """Like ``tagged_documents``, without the documents that hold no term."""
    lower = docs.withColumn("_lower", F.lower("content"))
    tags = concept_tags(F.col("_lower"), rules.vocabulary, rules.multiword)
    return keep_where(
        lower, docs.columns, F.struct(tags.alias("concepts")), lambda item: F.size(item["concepts"]) > 0
    )


def draft_pairs(rules: DomainRules, limits: Limits, seed: str, strategies=STRATEGIES) -> Column:
    """All rule-made pairs of a tagged document, in strategy order; none without concepts."""
    content, concepts = F.col("content"), F.col("concepts")
    kind, language = F.col("content_type"), F.col("language")
    made = {
        "concept": lambda: concept_pairs(F.col("id"), content, concepts, rules, limits, seed),
        "code": lambda: code_pairs(content, language, kind, concepts, rules, limits),
        "headings": lambda: heading_pairs(content, kind, rules, limits),
    }
    return F.when(F.size(concepts) > 0, F.concat(*[made[name]() for name in strategies]))


def pair_rows(tagged: DataFrame, drafts: Column, rules: DomainRules) -> DataFrame:
    """One row per pair, with the place it was found at in ``pair_order``."""
    spread = tagged.select(
        document_order(rules).alias("_doc"), "id", "url", F.posexplode(drafts).alias("_place", "_pair")
    )
    return spread.select(
        "_pair.instruction",
        "_pair.response",
        F.col("id").alias("source_id"),
        F.col("url").alias("source_url"),
        "_pair.category",
        "_pair.concepts",
        F.struct("_doc.*", F.col("_place").alias("place")).alias("pair_order"),
    )


def rule_pairs(
    docs: DataFrame,
    rules: DomainRules,
    limits: Limits = Limits(),
    seed: str = "0",
    strategies=STRATEGIES,
) -> DataFrame:
    """Pairs from concepts, code and headings in one pass over the documents."""
    return pair_rows(tagged_documents(docs, rules), draft_pairs(rules, limits, seed, strategies), rules)
