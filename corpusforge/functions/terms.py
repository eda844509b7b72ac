"""Search for the terms of a vocabulary: as plain substrings, and as whole words."""

from __future__ import annotations

from bisect import bisect_left
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, functions as F

from .packed import key_bits, lists, numbers_and_keys_of, numbers_of

#: Up to this many terms are tested one by one in the JVM; more are searched together by an automaton.
#: Both give the same positions.
FEW_TERMS = 32


def first_term_position(lower_text: Column, terms: tuple[str, ...]) -> Column:
    """Position of the first term, in vocabulary order, that the lower-cased text contains; null if none."""
    if not terms:
        return F.lit(None).cast("int")
    if len(terms) <= FEW_TERMS:
        tests = [F.when(lower_text.contains(term.lower()), F.lit(number)) for number, term in enumerate(terms)]
        return F.coalesce(*tests)
    return _automaton(terms, "int", lambda found, text: min(found(text), default=None))(lower_text)


def term_positions(lower_text: Column, terms: tuple[str, ...]) -> Column:
    """Positions of all terms that the lower-cased text contains."""
    if len(terms) <= FEW_TERMS:
        tests = [F.when(lower_text.contains(term.lower()), F.lit(number)) for number, term in enumerate(terms)]
        return F.array_compact(F.array(*tests).cast("array<int>"))
    return _automaton(terms, "array<int>", lambda found, text: sorted(set(found(text))))(lower_text)


def _automaton(terms: tuple[str, ...], returns: str, pick: Callable):
    """Arrow function over texts; each task builds the automaton once, and a text is read once for all terms."""

    @F.pandas_udf(returns)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            if not automaton.exists(term.lower()):  # of equal terms the first one counts
                automaton.add_word(term.lower(), number)
        automaton.make_automaton()

        def found(text: str) -> Iterator[int]:
            return (number for _, number in automaton.iter(text))

        for texts in batches:
            values = [None if text is None else pick(found, text) for text in texts]
            yield pd.Series(values, index=texts.index, dtype="Int32" if returns == "int" else object)

    return search


def whole_terms(lower_text: Column, spellings: Broadcast) -> Column:
    """Terms that the lower-cased text holds as whole words, in vocabulary order.

    ``spellings`` are the packed spellings and the terms, whose places in the vocabulary are the numbers.
    """

    @F.arrow_udf("array<string>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packed, terms = spellings.value
        for texts in batches:
            counts, numbers = numbers_of(texts, packed)
            yield lists(counts, terms.take(pa.array(numbers)))

    return search(lower_text)


def key_bit(key: Column, bits: int) -> Column:
    """Place of a spelling in a bitmap of ``bits``, a power of two."""

    @F.arrow_udf("long")
    def place(texts: pa.Array) -> pa.Array:
        return pa.array(key_bits(texts, bits))

    return place(key)


def numbers_and_keys(lower_text: Column, spellings: Broadcast, bitmap: Broadcast, kinds: list[tuple[int, bool, bool]]) -> Column:
    """``(numbers, keys)`` of a lower-cased text: its terms of the packed ``spellings`` and its sequences that may be other spellings.

    Those are the sequences of ``kinds`` (tokens, begins with a word, ends with one) whose ``key_bit`` is set in ``bitmap``.
    """

    @F.arrow_udf("numbers array<int>, keys array<string>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packed, flags = spellings.value, np.frombuffer(bitmap.value, dtype=np.uint8)
        for texts in batches:
            yield pa.StructArray.from_arrays(numbers_and_keys_of(texts, packed, flags, kinds), names=["numbers", "keys"])

    return search(lower_text)


def named_terms(numbers: Column, further: Column, vocabulary: Broadcast) -> Column:
    """The terms of ``numbers``, by ``vocabulary`` (number to (position, term)), and of the structs ``further``, in vocabulary order."""

    @F.arrow_udf("array<string>")
    def named(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = vocabulary.value
        names = pa.array([term for _, term in known], pa.string())
        for some, more in batches:
            # A further term that is not known itself comes in front of the known one that it is before.
            items = more.flatten()
            pairs = list(zip(items.field("position").to_pylist(), items.field("term").to_pylist()))
            distinct = sorted(set(pairs), key=in_order)
            before = np.array([bisect_left(known, in_order(pair), key=in_order) for pair in distinct], dtype=np.int64)
            is_known = np.array([n < len(known) and known[n] == pair for n, pair in zip(before, distinct)], dtype=bool)
            rank = {pair: number for number, pair in enumerate(distinct)}
            ranks = np.array([rank[pair] for pair in pairs], dtype=np.int64)
            own = some.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.concatenate([np.repeat(np.arange(len(some)), pc.list_value_length(held).to_numpy(zero_copy_only=False)) for held in (some, more)])
            place = np.concatenate([2 * own + 1, (2 * before + is_known)[ranks]])
            name = np.concatenate([own, np.where(is_known, before, len(known) + np.arange(len(distinct)))[ranks]])
            order = np.lexsort((name, place, row))
            row, name = row[order], name[order]
            new = np.append(True, (row[1:] != row[:-1]) | (name[1:] != name[:-1])) if len(row) else np.zeros(0, dtype=bool)
            both = pa.concat_arrays([names, pa.array([term for _, term in distinct], pa.string())])
            yield lists(np.bincount(row[new], minlength=len(some)), both.take(pa.array(name[new])))

    return named(numbers, further)


def in_order(pair: tuple) -> tuple:
    position, term = pair
    return (position is not None, position if position is not None else 0, term)
