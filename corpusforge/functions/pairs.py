"""Question-answer pairs of one document, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..rules import (
    ANSWER_MARK,
    CODE_ANSWER,
    CODE_MARK,
    CODE_QUESTION,
    CODE_TYPES,
    CONCEPT_QUESTIONS,
    GENERIC_HEADINGS,
    HEADING_QUESTION,
    HEADING_TYPE,
    LANGUAGE_NAMES,
    QUESTION_STARTS,
    DomainRules,
    Limits,
)
from ..schemas import DRAFT_PAIRS
from .concepts import concept_tags
from .text import BLANK, fill, first_items, let, shorten, strip

# Set around every heading; no text holds this sequence.
_MARK = "\x01\uffff\x01"
_SECTIONS = "array<struct<heading:string,body:string>>"


def _draft(instruction: Column, response: Column, category: str, concepts: Column) -> Column:
    return F.struct(
        instruction.alias("instruction"),
        response.alias("response"),
        F.lit(category).alias("category"),
        concepts.alias("concepts"),
    )


def _no_pairs() -> Column:
    return F.array().cast(DRAFT_PAIRS)


def template_choice(seed: str, doc_id: Column, concept: Column) -> Column:
    """Which question wording: a hash of seed, document and concept instead of chance."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), doc_id, F.lit(":"), concept))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % len(CONCEPT_QUESTIONS)


def concept_question(seed: str, doc_id: Column, concept: Column, rules: DomainRules) -> Column:
    wordings = [fill(text, concept=concept, domain=rules.domain) for text in CONCEPT_QUESTIONS]
    return F.get(F.array(*wordings), template_choice(seed, doc_id, concept).cast("int"))


def concept_pairs(
    doc_id: Column, content: Column, concepts: Column, rules: DomainRules, limits: Limits, seed: str
) -> Column:
    """One pair per concept whose first long enough paragraph exists."""
    long = F.filter(F.split(content, "\n\n"), lambda text: F.length(text) > limits.min_paragraph)
    paragraphs = F.transform(long, lambda text: F.struct(text.alias("text"), F.lower(text).alias("lower")))
    leading = first_items(concepts, limits.concepts_per_document)

    def first_about(concept, paragraphs):
        about = F.filter(paragraphs, lambda item: item["lower"].contains(F.lower(concept)))
        return F.struct(concept.alias("concept"), strip(F.get(about, F.lit(0))["text"]).alias("text"))

    found = let(paragraphs, lambda item: F.transform(leading, lambda concept: first_about(concept, item)))
    return F.transform(
        F.filter(found, lambda item: item["text"].isNotNull()),
        lambda item: _draft(
            concept_question(seed, doc_id, item["concept"], rules),
            shorten(item["text"], limits.max_answer, ANSWER_MARK),
            "concept",
            F.array(item["concept"]),
        ),
    )


def code_pairs(
    content: Column, language: Column, content_type: Column, concepts: Column, rules: DomainRules, limits: Limits
) -> Column:
    """A how-to pair for a code file, about its first concept."""
    names = F.create_map(*[F.lit(item) for pair in LANGUAGE_NAMES.items() for item in pair])
    name = F.coalesce(F.try_element_at(names, language), language)
    first = F.coalesce(F.get(concepts, F.lit(0)), F.lit(rules.domain))
    code = shorten(content, limits.max_code, CODE_MARK)
    pair = _draft(
        fill(CODE_QUESTION, concept=first, domain=rules.domain, language=name),
        fill(CODE_ANSWER, concept=first, language=name, tag=language, code=code),
        "code",
        concepts,
    )
    fits = (language != "") & content_type.isin(*CODE_TYPES)
    return F.when(fits, F.array(pair)).otherwise(_no_pairs())


def heading_question(heading: Column, rules: DomainRules) -> Column:
    lower = F.lower(heading)
    asks = F.lit(False)
    for start in QUESTION_STARTS:
        asks = asks | lower.startswith(start)
    return (
        F.when(heading.contains("?"), heading)
        .when(asks, F.concat(heading, F.lit("?")))
        .otherwise(fill(HEADING_QUESTION, heading=heading, domain=rules.domain))
    )


def sections(content: Column) -> Column:
    """``array<struct<heading,body>>``: ``#`` to ``###`` lines and what follows each of them.

    Headings are marked one after the other, so a bare ``#`` line takes the next line as its
    text even if that is a heading itself.  A body ends at anything that looks like a
    heading, also at a last line that is none because nothing follows it.
    """
    line = rf"(?dmU)^#{{1,3}}{BLANK}+([^\n]+)(?=\n)"
    parts = F.split(F.regexp_replace(content, line, f"{_MARK}$1{_MARK}"), _MARK)
    # text before the first heading, heading, body, heading, body, ...
    headed = let(
        parts,
        lambda part: F.when(
            F.size(part) > 1,
            F.transform(
                F.sequence(F.lit(1), F.size(part) - 1, F.lit(2)),
                lambda place: F.struct(
                    F.get(part, place).alias("heading"), strip(_body(F.get(part, place + 1))).alias("body")
                ),
            ),
        ),
    )
    return F.coalesce(F.when(content.contains("#"), headed), F.array().cast(_SECTIONS))


def _body(rest: Column) -> Column:
    """Text up to a line that looks like a heading; only a text's last lines can be one here."""
    cut = F.get(F.split(rest, rf"(?dmU)\n(?=#{{1,3}}{BLANK})", 2), F.lit(0))
    return F.when(rest.contains("\n#"), cut).otherwise(rest)


def heading_pairs(content: Column, content_type: Column, rules: DomainRules, limits: Limits) -> Column:
    """One pair per section with enough text, for documentation only."""
    useful = F.filter(
        sections(F.when(content_type == HEADING_TYPE, content)),
        lambda part: (F.length(part["body"]) >= limits.min_section)
        & ~F.lower(part["heading"]).isin(*GENERIC_HEADINGS),
    )
    answered = F.transform(
        first_items(useful, limits.sections_per_document),
        lambda part: F.struct(
            let(strip(part["heading"]), lambda text: heading_question(text, rules)).alias("question"),
            shorten(part["body"], limits.max_answer, ANSWER_MARK).alias("answer"),
        ),
    )
    with_lower = F.transform(
        answered,
        lambda part: F.struct(part["question"], part["answer"], F.lower(part["answer"]).alias("lower")),
    )
    pairs = F.transform(
        with_lower,
        lambda part: _draft(
            part["question"],
            part["answer"],
            "concept",
            concept_tags(part["lower"], rules.vocabulary, rules.multiword),
        ),
    )
    return F.coalesce(pairs, _no_pairs())
