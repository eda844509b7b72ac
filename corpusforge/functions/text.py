"""Whitespace, shortening and template helpers."""

from __future__ import annotations

import re
from typing import Callable

from pyspark.sql import Column, functions as F

# The characters that count as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same as a regex class, to be used with the flag (?U).
BLANK = r"[\s\x1c-\x1f]"
_ASCII_BLANKS = r"[\t-\r\x1c-\x20]+"
_OTHER_BLANK = r"[\p{Z}\x85&&[^ ]]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def collapse_blanks(text: Column) -> Column:
    """Runs of blanks to one blank.  Unicode classes are slow, so only texts beyond ASCII pay for them."""
    is_ascii = F.octet_length(text) == F.length(text)
    plain = F.when(is_ascii, text).otherwise(F.regexp_replace(text, _OTHER_BLANK, " "))
    return F.trim(F.regexp_replace(plain, _ASCII_BLANKS, " "))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Inside array functions an expression that is mentioned twice is computed twice, and one
    mentioned in a lambda once per element; as a lambda variable it is only looked up.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shorten(text: Column, size: int | None, mark: str = "") -> Column:
    """At most ``size`` code points, if a size is given; ``mark`` is added to what was cut."""
    if size is None:
        return text
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit(mark))).otherwise(text)


def first_items(items: Column, count: int | None) -> Column:
    """The first ``count`` items; all of them without a count."""
    return items if count is None else F.slice(items, 1, count)


def fill(template: str, **slots: Column | str) -> Column:
    """Concatenate the literal pieces of ``template`` with the slot values.

    The values are never scanned for slots, so a text holding ``{content}`` is safe.
    """
    pieces = []
    for literal, name in re.findall(r"([^{]+)|\{(\w+)\}", template):
        value = literal if literal else slots[name]
        pieces.append(value if isinstance(value, Column) else F.lit(value))
    return F.concat(*pieces)


def question_key(question: Column) -> Column:
    """Two questions with the same key are the same question."""
    return strip(F.lower(question))


def contains_any(text: Column, parts) -> Column:
    """True if ``text`` contains one of the literal ``parts``."""
    return text.rlike("|".join(re.escape(part) for part in parts)) if parts else F.lit(False)
