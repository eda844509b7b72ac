"""Search for many spellings in many texts at once, in arrays.

Texts are their UTF-8 bytes, cut into tokens (runs of word characters, and every other character alone).  One running sum over
the bytes gives every sequence of tokens a hash of 64 bits, and every spelling the same one; where hashes agree the bytes are
compared, so the result is exact.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are searched together; a longer text is searched alone.
CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
# The lowest bytes of an eight-byte word, by their number.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=1)
def _word_characters() -> np.ndarray:
    """Is a code point a word character, as in Python's \\w?"""
    flags = np.zeros(0x110000, dtype=bool)
    for run in re.finditer(r"\w+", "".join(map(chr, range(0x110000)))):
        flags[run.start() : run.end()] = True
    return flags


@lru_cache(maxsize=1)
def _chunk_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(CHUNK)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    steps = (_BASE, pow(_BASE, -1, 1 << 64))
    made = tuple(np.full(size, step, dtype=np.uint64) for step in steps)
    for powers in made:
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
    return made


def _in_words(data: np.ndarray) -> np.ndarray:
    """Does each byte belong to a word character?"""
    table = _word_characters()
    flags = np.concatenate([table[:128], np.zeros(128, dtype=bool)])[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.concatenate([data, np.zeros(3, dtype=np.uint8)])
        head, *tail = (padded[lead + n].astype(np.int32) for n in range(4))
        one, two, three = (byte & 63 for byte in tail)
        point = np.where(head < 0xE0, (head & 31) << 6 | one, (head & 15) << 12 | one << 6 | two)
        point = np.where(head < 0xF0, point, (head & 7) << 18 | one << 12 | two << 6 | three)
        of_word = table[point]
        for n, least in enumerate((0, 0, 0xE0, 0xF0)):
            flags[lead[head >= least] + n] = of_word[head >= least]
    return flags


class Tokens:
    """The tokens of texts that lie one after the other in ``data``, each beginning at one of ``starts``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        in_word = _in_words(data)
        begins = (data & 0xC0) != 0x80
        begins[1:] &= ~(in_word[1:] & in_word[:-1])
        begins[starts[starts < len(data)]] = True
        self.starts = starts
        self.at = np.append(np.flatnonzero(begins), len(data))
        opens = np.zeros(len(self.at), dtype=bool)
        opens[np.searchsorted(self.at, starts)] = True
        opens[-1] = True
        self.text = np.cumsum(opens[:-1], dtype=np.int32)
        self.word = word = in_word[self.at[:-1]]
        # A boundary as in \b: a word character on just one side.
        before, after = np.zeros_like(word), np.zeros_like(word)
        before[1:], after[:-1] = word[:-1] & ~opens[1:-1], word[1:] & ~opens[1:-1]
        self._bounds = {"first": before != word, "last": after != word}
        size = len(data) + 1
        powers, self._inverse = _chunk_powers() if size <= CHUNK else _powers(size)
        self._sums = np.zeros(size, dtype=np.uint64)
        np.cumsum(_VALUE[data] * powers[: len(data)], out=self._sums[1:])
        self._data = data
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        self._eight = np.ascontiguousarray(np.ndarray(size, dtype="<u8", buffer=padded, strides=(1,)))

    def _ends(self, side: str, of_word: bool) -> np.ndarray:
        return self._bounds[side] & (self.word == of_word)

    def sequences(self, size: int, first: bool, last: bool) -> np.ndarray:
        """First tokens of the sequences of ``size`` tokens in one text that are bounded as a term is and begin and end with a word or not."""
        stop = len(self.word) - size + 1
        if stop <= 0:
            return np.zeros(0, dtype=np.intp)
        inside = self._ends("first", first)[:stop] & self._ends("last", last)[size - 1 :]
        return np.flatnonzero(inside & (self.text[:stop] == self.text[size - 1 :]) if size > 1 else inside)

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self._sums[end] - self._sums[begin]) * self._inverse[begin])

    def text_of(self, begin: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, begin, "right") - 1

    def words(self, begin: np.ndarray, size: np.ndarray, number: int) -> np.ndarray:
        """The eight bytes of that number of each span, filled up with zeros."""
        return self._eight[begin + 8 * number] & _MASK[np.minimum(size - 8 * number, 8)]

    def spans(self, begin: np.ndarray, size: np.ndarray) -> pa.StringArray:
        ends = np.cumsum(size)
        data = self._data[np.repeat(begin - ends + size, size) + np.arange(size.sum())]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data))


def _equal(size: np.ndarray, left: Callable, right: Callable) -> np.ndarray:
    """Which spans of these sizes agree in all their bytes; ``left`` and ``right`` give their words for places and a number."""
    equal = np.ones(len(size), dtype=bool)
    places, number = np.arange(len(size)), 0
    while len(places):
        same = left(places, number) == right(places, number)
        equal[places[~same]] = False
        number += 1
        places = places[same & (size[places] > 8 * number)]
    return equal


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8), at


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int, Tokens]]:
    """The texts' tokens, some texts at a time: the first one, the one behind the last, and the tokens."""
    if not len(texts):
        return
    data, at = _bytes_of(texts)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK)) - 1)
        yield first, end, Tokens(data[at[first] : at[end]], at[first:end] - at[first])
        first = end


def text_hashes(texts: pa.Array) -> np.ndarray:
    """The hash of each whole text."""
    made = [np.zeros(0, dtype=np.uint64)]
    for _, _, tokens in _chunks(texts):
        made.append(tokens.hashes(tokens.starts, np.append(tokens.starts[1:], tokens.at[-1])))
    return np.concatenate(made)


@dataclass
class Spellings:
    """Spellings by hash: ``first`` has where those begin that share the uppermost bits, ``words`` their bytes, ``numbers`` their terms' numbers."""

    hashes: np.ndarray
    first: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    words_at: np.ndarray
    numbers: np.ndarray
    numbers_at: np.ndarray
    kinds: list[tuple[int, bool, bool]]

    @staticmethod
    def of(keys: pa.Array, numbers: np.ndarray) -> Spellings:
        """From rows of a spelling, which is no empty text, and a number."""
        hashes = text_hashes(keys)
        order = np.argsort(hashes, kind="stable").astype(np.int32)
        texts, hashes, numbers = keys.cast(pa.large_string()).take(pa.array(order)), hashes[order], np.asarray(numbers, dtype=np.int32)[order]
        del keys, order
        new = np.ones(len(texts), dtype=bool)
        if len(texts):  # rows of one spelling are neighbours, but for hashes that collide; then it comes twice, which does no harm
            new[1:] = (hashes[1:] != hashes[:-1]) | pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
        numbers_at = np.append(np.flatnonzero(new), len(new)).astype(np.int32)
        if not new.all():
            texts, hashes = texts.filter(pa.array(new)), hashes[new]
        bits = max(len(hashes), 1).bit_length()
        first = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        sizes = np.diff(_bytes_of(texts)[1]).astype(np.int32)
        words_at = np.concatenate([[0], np.cumsum((sizes + 7) // 8)])
        words, kinds = np.zeros(words_at[-1], dtype=np.uint64), set()
        for begin, end, tokens in _chunks(texts):
            for number in range(int(sizes[begin:end].max() + 7) // 8):
                long = np.flatnonzero(sizes[begin:end] > 8 * number)
                words[words_at[begin:end][long] + number] = tokens.words(tokens.starts[long], sizes[begin:end][long], number)
            at = np.append(np.searchsorted(tokens.at, tokens.starts), len(tokens.word))
            kinds.update(zip(np.diff(at).tolist(), tokens.word[at[:-1]].tolist(), tokens.word[at[1:] - 1].tolist()))
        return Spellings(hashes, first, sizes, words, words_at[:-1].astype(np.int32), numbers, numbers_at, sorted(kinds))

    def _held(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Texts and spellings, once for every place where a text holds a spelling."""
        texts, spelled = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        shift = np.uint64(64 - (len(self.first) - 1).bit_length() + 1)
        for size, first, last in self.kinds:
            tokens_at = tokens.sequences(size, first, last)
            begin, end = tokens.at[tokens_at], tokens.at[tokens_at + size]
            hashes = tokens.hashes(begin, end)
            group = (hashes >> shift).astype(np.intp)
            at, stop = self.first[group], self.first[group + 1]
            live = np.flatnonzero(at < stop)
            while len(live):
                at, stop = at[live], stop[live]
                hashes, begin, end = hashes[live], begin[live], end[live]
                met = np.flatnonzero(self.hashes[at] == hashes)
                key, where = at[met], begin[met]
                length = end[met] - where
                same = np.flatnonzero(length == self.sizes[key])
                key, where, length = key[same], where[same], length[same]
                equal = _equal(length, lambda p, n: tokens.words(where[p], length[p], n), lambda p, n: self.words[self.words_at[key[p]] + n])
                texts.append(tokens.text_of(where[equal]))
                spelled.append(key[equal].astype(np.int64))
                at = at + 1
                live = np.flatnonzero(at < stop)
        return np.concatenate(texts), np.concatenate(spelled)

    def numbers_in(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Texts and the distinct numbers of the terms that they hold, in order."""
        texts, spelled = _distinct(*self._held(tokens), len(self.hashes))
        counts = self.numbers_at[spelled + 1] - self.numbers_at[spelled]
        at = np.repeat(self.numbers_at[spelled] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return _distinct(np.repeat(texts, counts), self.numbers[at], int(self.numbers.max(initial=0)) + 1)


def _distinct(texts: np.ndarray, items: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order; the items are below ``most``."""
    both = np.sort(texts * most + items)
    both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    return np.divmod(both, max(most, 1))


def lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def numbers_of(texts: pa.Array, spellings: Spellings) -> tuple[np.ndarray, np.ndarray]:
    """How many terms each text holds, and their numbers, text by text and in order."""
    counts, numbers = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for first, end, tokens in _chunks(texts):
        held, found = spellings.numbers_in(tokens)
        counts.append(np.bincount(held, minlength=end - first))
        numbers.append(found)
    return np.concatenate(counts), np.concatenate(numbers)


def key_bits(texts: pa.Array, bits: int) -> np.ndarray:
    """Place of each text in a bitmap of ``bits``, a power of two."""
    return (text_hashes(texts) >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def numbers_and_keys_of(texts: pa.Array, spellings: Spellings, bitmap: np.ndarray, kinds: list[tuple[int, bool, bool]]) -> tuple[pa.ListArray, pa.ListArray]:
    """The numbers of each text's terms, and its sequences of ``kinds`` (tokens, begins with a word, ends with one) whose place in the packed ``bitmap`` is set."""
    own, further = ([], []), ([], [])
    for first, end, tokens in _chunks(texts):
        held, found = spellings.numbers_in(tokens)
        text, keys = _possible_keys(tokens, bitmap, kinds)
        for (counts, values), (of, some) in zip((own, further), ((held, pa.array(found.astype(np.int32))), (text, keys))):
            counts.append(np.bincount(of, minlength=end - first))
            values.append(some)
    none = np.zeros(0, dtype=np.int64), pa.array([], pa.int32()), pa.array([], pa.string())
    return tuple(lists(np.concatenate([none[0], *counts]), pa.concat_arrays([empty, *values])) for (counts, values), empty in zip((own, further), none[1:]))


def _possible_keys(tokens: Tokens, bitmap: np.ndarray, kinds: list[tuple[int, bool, bool]]) -> tuple[np.ndarray, pa.StringArray]:
    shift = np.uint64(65 - (len(bitmap) * 8).bit_length())
    spans = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))]
    for size, *ends in kinds:
        at = tokens.sequences(size, *ends)
        begin, end = tokens.at[at], tokens.at[at + size]
        hashes = tokens.hashes(begin, end)
        place = hashes >> shift
        in_map = np.flatnonzero(bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
        spans.append((begin[in_map], end[in_map] - begin[in_map], hashes[in_map]))
    begin, size, hashes = (np.concatenate(column) for column in zip(*spans))
    text = tokens.text_of(begin)
    # Left out is a copy of the span in front of it in this order.
    order = np.argsort(hashes + text.astype(np.uint64) * np.uint64(_BASE))
    here, before = order[1:], order[:-1]
    near = np.flatnonzero((text[here] == text[before]) & (hashes[here] == hashes[before]) & (size[here] == size[before]))
    here, before = here[near], before[near]
    copy = here[_equal(size[here], lambda p, n: tokens.words(begin[here[p]], size[here[p]], n), lambda p, n: tokens.words(begin[before[p]], size[before[p]], n))]
    kept = np.delete(np.arange(len(begin)), copy)
    kept = kept[np.argsort(text[kept], kind="stable")]
    return text[kept], tokens.spans(begin[kept], size[kept])
