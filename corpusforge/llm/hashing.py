"""Word and shingle hashes of a batch of texts, computed on their bytes with whole-array operations."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Bytes of text that are hashed together.
BLOCK = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if len(_powers[0]) < size:
        for at, base in enumerate((_BASE, _INVERSE)):
            run = np.full(size, base, dtype=np.uint64)
            run[0] = 1
            _powers[at] = np.multiply.accumulate(run)
    return _powers[0][:size], _powers[1][:size]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums: the hash of data[a:b] is (sums[b] - sums[a]) * inverse power a."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def window_hashes(sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` bytes from each start."""
    _, down = powers(len(sums))
    return mix((sums[starts + size] - sums[starts]) * down[starts])


def in_blocks(texts: list[str | None]):
    """(first index, encoded texts) of neighbouring texts of about ``BLOCK`` bytes together."""
    held, size, first = [], 0, 0
    for at, text in enumerate(texts):
        data = (text or "").encode()
        if held and size + len(data) > BLOCK:
            yield first, held
            held, size, first = [], 0, at
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def word_hashes(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z folded) and the number of words of each text."""
    data = _LOWER[np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)]
    word = ~_BLANK[data]
    edge = np.diff(np.r_[False, word].astype(np.int8))
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    _, down = powers(len(data) + 1)
    sums = prefix_hashes(data)
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    bounds = np.cumsum([len(e) + 1 for e in encoded])
    counts = np.diff(np.r_[0, np.searchsorted(starts, bounds)])
    return hashes, counts


def shingle_sets(encoded: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word ``size``-grams of each text; a shorter text is one gram of all its words."""
    words, counts = word_hashes(encoded)
    grams = np.zeros(len(words), dtype=np.uint64)
    factor = np.uint64(0xD6E8FEB86659FD93)
    for k in range(size):
        part = np.zeros(len(words), dtype=np.uint64)
        part[: max(0, len(words) - k)] = words[k:]
        grams = grams * factor + part
    grams = mix(grams + np.uint64(size))
    found, at = [], 0
    for n in counts.tolist():
        if n >= size:
            found.append(np.unique(grams[at : at + n - size + 1]))
        elif n:
            whole = np.zeros(1, dtype=np.uint64)
            for k in range(n):
                whole = mix(whole * factor + words[at + k : at + k + 1])
            found.append(mix(whole + np.uint64(n)))
        else:
            found.append(np.zeros(0, dtype=np.uint64))
        at += n
    return found


def word_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the words between blanks; kana and ideographs, which have no blanks, are words each."""
    word = ~_BLANK[data]
    alone = (data >= 0xE3) & (data <= 0xE9)  # lead bytes of U+3000 to U+9FFF
    begin = word & np.r_[True, ~word[:-1]][: len(data)] | alone
    begin[3:] |= alone[:-3] & word[3:]
    last = word & np.r_[~word[1:] | begin[1:], True][: len(data)]
    return np.nonzero(begin)[0], np.nonzero(last)[0] + 1


def bare_word_hashes(text: bytes) -> np.ndarray:
    """Hashes of all words of a text, each without the ASCII signs around it; a word of signs only has that of no word."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends = word_starts(data)
    core = np.r_[np.nonzero(_ALNUM[data])[0], len(data)]
    first = np.minimum(core[np.searchsorted(core[:-1], starts)], ends)
    last = np.maximum(core[np.searchsorted(core[:-1], ends) - 1] + 1, first)
    last = np.where(first == ends, ends, last)
    _, down = powers(len(data) + 1)
    sums = prefix_hashes(data)
    return mix((sums[last] - sums[first]) * down[first])
