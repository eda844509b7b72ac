"""Vocabulary tagging."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# A word character as in Unicode \w; Java's own \b would not agree on all letters.
WORD = r"[\p{L}\p{N}_]"


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _bounded(pattern: str, first: str, last: str) -> str:
    """Word boundaries around ``pattern``.

    The pattern comes first and the left boundary looks back over it, so that a search
    looks for the literal instead of testing a boundary at every character.
    """
    left = f"(?<!{WORD}{pattern})" if _is_word(first) else f"(?<={WORD}{pattern})"
    right = f"(?!{WORD})" if _is_word(last) else f"(?={WORD})"
    return f"{pattern}{left}{right}"


def term_test(lower_text: Column, term: str, multiword: str = "hyphenated") -> Column:
    """Does the lower-cased text contain ``term`` as a whole word?

    The term's case is all one.  The substring test in front is a plain byte search; the regex
    runs only for texts that pass it.
    """
    term = term.lower()
    joint = "[ -]?"
    if multiword == "literal":
        literal = term.replace(" ", joint)
        pattern, probe = re.escape(literal), literal
    else:
        words = term.split(" ")
        pattern, probe = joint.join(re.escape(word) for word in words), words[0]
    regex = _bounded(pattern, term[0], term[-1])
    return lower_text.contains(probe) & lower_text.rlike(regex)


def concept_tags(lower_text: Column, vocabulary, multiword: str = "hyphenated") -> Column:
    """Array of the vocabulary terms in the text, in vocabulary order."""
    found = [F.when(term_test(lower_text, term, multiword), F.lit(term)) for term in vocabulary]
    return F.array_compact(F.array(*found))
